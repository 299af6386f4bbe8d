"""Kernels over one ordered series of any length. Its values lie in temporary files of the task (in memory while they are few) and are worked on in blocks;
from block to block pass a few numbers, so memory doesn't grow with the series. Results are those of the kernels for series in memory."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa

from .filters import biquad, sections
from .repair import SHARE, SHORT, _steps, _unlike

#: Rows of a block (a multiple of the filter's blocks), and bytes that a column has in memory before it is a file.
BLOCK, HELD = 1 << 16, 4 << 20


class Values:
    """A column: added to at the end, read by place."""

    def __init__(self, kind=np.float64, values: np.ndarray | None = None):
        self.kind, self.n, self.file = np.dtype(kind), 0, tempfile.SpooledTemporaryFile(HELD)
        if values is not None:
            self.add(values)

    def add(self, values: np.ndarray) -> None:
        self.file.seek(0, 2)
        self.file.write(np.ascontiguousarray(values, self.kind).tobytes())
        self.n += len(values)

    def read(self, lo: int, hi: int) -> np.ndarray:
        """A copy of the values from lo up to hi, as far as there are any."""
        lo, hi = max(lo, 0), min(hi, self.n)
        self.file.seek(lo * self.kind.itemsize)
        return np.frombuffer(bytearray(self.file.read(max(0, hi - lo) * self.kind.itemsize)), self.kind)

    def blocks(self) -> Iterator[tuple[int, int]]:
        for lo in range(0, self.n, BLOCK):
            yield lo, min(lo + BLOCK, self.n)


class Batches:
    """Record batches, kept to be read again in order."""

    def __init__(self):
        self.file, self.out = tempfile.SpooledTemporaryFile(HELD), None

    def add(self, batch: pa.RecordBatch) -> None:
        if self.out is None:
            self.out = pa.ipc.new_stream(self.file, batch.schema, options=pa.ipc.IpcWriteOptions(compression="lz4"))
        self.out.write_batch(batch)

    def __iter__(self) -> Iterator[tuple[int, int, pa.RecordBatch]]:
        """(place of the first row, place behind the last, batch)."""
        if self.out is None:
            return
        self.out.close()
        self.file.seek(0)
        lo = 0
        for batch in pa.ipc.open_stream(self.file):
            yield lo, lo + batch.num_rows, batch
            lo += batch.num_rows


def _known_behind(x: Values) -> tuple[list[tuple[int, float] | None], tuple[int, float] | None]:
    """For each block the first known value behind it with its place; and the last known one of all."""
    firsts, last = [], None
    for lo, hi in x.blocks():
        part = x.read(lo, hi)
        at = np.flatnonzero(~np.isnan(part))
        firsts.append((lo + int(at[0]), float(part[at[0]])) if len(at) else None)
        last = (lo + int(at[-1]), float(part[at[-1]])) if len(at) else last
    behind, near = [], None
    for first in reversed(firsts):
        behind.append(near)
        near = first or near
    return behind[::-1], last


def lines(x: Values, scale: float = 1.0) -> Values:
    """x, times scale, with lines over missing values and the nearest known one before the first and behind the last; as it is without known ones."""
    out, (behind, _), before = Values(), _known_behind(x), None
    for (lo, hi), after in zip(x.blocks(), behind, strict=True):
        part = x.read(lo, hi)
        gaps = np.isnan(part)
        at = lo + np.flatnonzero(~gaps)
        known = [(before, after)[k] for k in (0, 1)]
        places = np.concatenate([[k[0] for k in known[:1] if k], at, [k[0] for k in known[1:] if k]])
        values = np.concatenate([[k[1] for k in known[:1] if k], part[~gaps], [k[1] for k in known[1:] if k]])
        if len(at):
            before = (int(at[-1]), float(part[at[-1] - lo]))
        if gaps.any() and len(places):
            part[gaps] = np.interp(lo + np.flatnonzero(gaps), places, values)
        out.add(part * scale)
    return out


def repair(y: Values, fs: float, threshold: float) -> tuple[Values, Values]:
    """As repair.repair()."""
    rows = int(10 * fs)
    around, slips, good, total = Values(), Values(bool), Values(), 0
    for lo, hi in y.blocks():
        a = max(lo - rows - 1, 0)
        steps = _steps(y.read(a - 1, hi + rows + 1))[min(a, 1) :]  # from row a on; the first row of all has none
        middle = pd.Series(steps).rolling(rows, min_periods=max(3, rows // 10), center=True).median().to_numpy()
        around.add(middle[lo - a : hi - a])
    behind, last = _known_behind(around)
    for (lo, hi), after in zip(y.blocks(), behind, strict=True):
        steps, usual = _steps(y.read(lo - 1, hi))[min(lo, 1) :], around.read(lo, hi)
        at = np.flatnonzero(~np.isnan(usual))
        k = np.searchsorted(at, np.arange(hi - lo))
        end = after or last  # medians take the next known one, or the last one of all
        usual = np.concatenate([usual[at], [end[1] if end else np.nan]])[k]
        slip = _unlike(steps, usual, threshold)
        part = np.where(slip, np.nan, steps)
        if lo == 0 and y.n > 1:
            part[0] = part[1]
        total += int(slip.sum())
        slips.add(slip)
        good.add(part)
    if y.n > SHORT and total / y.n > SHARE:
        return y, slips
    out, carry, good = Values(), np.longdouble(0), lines(good)
    first = y.read(0, 1)
    for lo, hi in good.blocks():
        part = np.cumsum(np.concatenate([[carry], good.read(lo, hi)]))[1:]  # in extended precision, since errors would grow with the series
        carry = part[-1]
        out.add(first + part)
    return out, slips


def highpass(x: Values, fs: float) -> Values:
    """As filters.highpass()."""
    out, states = Values(), [[0.0] * 4 for _ in sections(fs)]
    for lo, hi in x.blocks():
        part = x.read(lo, hi)
        for (b, a), state in zip(sections(fs), states, strict=True):
            part = biquad(part, b, a, state)
        out.add(part)
    return out


def without_mean(x: Values) -> Values:
    """x less the mean of its known values; as it is without them."""
    sums = [(np.nansum(part), np.count_nonzero(~np.isnan(part))) for part in (x.read(lo, hi) for lo, hi in x.blocks())]
    n = sum(c for _, c in sums)
    if not n:
        return x
    out, mean = Values(), np.sum([s for s, _ in sums]) / n
    for lo, hi in x.blocks():
        out.add(x.read(lo, hi) - mean)
    return out
