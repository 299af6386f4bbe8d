"""Recursive filters. They are no window functions, so they run in grouped maps over one satellite of one file."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

CUTOFF_HZ, BLOCK = 0.1, 256
#: Damping of the three sections of a sixth-order Butterworth filter.
DAMPING = (np.sqrt(2 + np.sqrt(3)), np.sqrt(2.0), np.sqrt(2 - np.sqrt(3)))


def sections(fs: float, cutoff: float = CUTOFF_HZ) -> list[tuple[np.ndarray, np.ndarray]]:
    """(b, a) of the high-pass sections s^2 / (s^2 + d w s + w^2), by the bilinear transform without pre-warping; a starts with 1."""
    w, k = 2 * np.pi * cutoff, 2 * fs
    out = []
    for d in DAMPING:
        scale = k * k + d * w * k + w * w
        out.append((np.array([k * k, -2 * k * k, k * k]) / scale, np.array([scale, 2 * (w * w - k * k), k * k - d * w * k + w * w]) / scale))
    return out


@lru_cache(maxsize=64)
def _responses(a1: float, a2: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The recursion's answers within a block to each of its samples, and to one unit of the output one and two places before the block."""
    h = np.zeros(BLOCK + 2)
    h[1] = 1.0  # h[0] is the value before the impulse
    for i in range(2, BLOCK + 2):
        h[i] = -a1 * h[i - 1] - a2 * h[i - 2]
    h = h[1:]
    lag = np.subtract.outer(np.arange(BLOCK), np.arange(BLOCK))
    return np.where(lag >= 0, h[np.abs(lag)], 0.0).T.copy(), h[1:], -a2 * h[:-1]


def biquad(x: np.ndarray, b: np.ndarray, a: np.ndarray, state: list[float] | None = None) -> np.ndarray:
    """One section from rest. Blocks of BLOCK samples are products with the recursion's impulse response; two values pass from block to block.

    state: the last two inputs and outputs before x, the nearer first; they are set to the last ones of x, so that a series can come in parts."""
    x = np.asarray(x, float)
    n = len(x)
    if not n:
        return x
    x1, x2, y1, y2 = state if state is not None else [0.0] * 4
    u = b[0] * x
    u[1:] += b[1] * x[:-1]
    u[2:] += b[2] * x[:-2]
    u[0] += b[1] * x1 + b[2] * x2
    u[1:2] += b[2] * x1
    inside, last, before = _responses(float(a[1]), float(a[2]))
    ends = [y1, y2]
    if n <= BLOCK:
        out = u @ inside[:n, :n] + last[:n] * y1 + before[:n] * y2
    else:
        blocks = np.zeros(-(-n // BLOCK) * BLOCK)
        blocks[:n] = u
        y = blocks.reshape(-1, BLOCK) @ inside
        for row in y:
            row += last * y1 + before * y2
            y1, y2 = row[-1], row[-2]
        out = y.reshape(-1)[:n]
    if state is not None:
        state[:] = [x[-1], x[-2] if n > 1 else x1, out[-1], out[-2] if n > 1 else ends[0]]
    return out


def highpass(x: np.ndarray, fs: float, cutoff: float = CUTOFF_HZ) -> np.ndarray:
    """Causal sixth-order high-pass."""
    for b, a in sections(fs, cutoff):
        x = biquad(x, b, a)
    return x


def highpassed(df: DataFrame, keys: list[str], order: list[str], x: str, fs: float, name: str = "filtered") -> DataFrame:
    """Adds the high-passed series of every key."""

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([(c, "ascending") for c in order])
        series = rows.column(x).to_numpy().astype(float)
        return rows.append_column(name, pa.array(highpass(series, fs), from_pandas=True))

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.groupBy(*keys).applyInArrow(run, f"{kinds}, `{name}` double")


def equalised(x: np.ndarray, fs: float = 20.0, cutoff: float = 3.0, gain: float = 11.0, longest_plain: int = 600) -> np.ndarray:
    """Adds gain times a first-order Butterworth high-pass, run forwards and backwards from its steady state, in each run of values
    longer than longest_plain samples; shorter runs are scaled by 1 + gain."""
    x = np.asarray(x, float).copy()
    k = np.tan(np.pi * cutoff / fs)
    b0, a1 = 1 / (1 + k), (k - 1) / (k + 1)
    known = ~np.isnan(x)
    edges = np.flatnonzero(np.diff(np.concatenate([[False], known, [False]]).astype(int)))

    def one_way(v: np.ndarray) -> np.ndarray:
        return biquad(v - v[0], np.array([b0, -b0, 0.0]), np.array([1.0, a1, 0.0]))  # a constant input has settled to 0

    for lo, hi in zip(edges[::2], edges[1::2], strict=True):
        part = x[lo:hi]
        x[lo:hi] = part + gain * (one_way(one_way(part)[::-1])[::-1] if hi - lo > longest_plain else part)
    return x


def without_slopes(times: pd.DatetimeIndex, x: np.ndarray, threshold: float = 1e3, longest: float = 5.0) -> np.ndarray:
    """Takes out jumps found by slope: the rest of the series goes on with the slope before the jump. Gaps count as `longest` seconds at most.

    A jump's step becomes the step before it (as already corrected), scaled by the times between; what the steps have changed by is added up over the series."""
    x = np.asarray(x, float)
    if len(x) < 2:
        return x.copy()
    gap = np.diff(times.as_unit("ns").asi8) / 1e9  # gap[i] and step[i] lie between values i and i + 1
    step, short = np.diff(x), np.minimum(gap, longest)
    with np.errstate(divide="ignore", invalid="ignore"):
        jumps = np.flatnonzero(np.abs(step / short) > threshold)
    fixed = step.copy()
    for i in jumps:
        fixed[i] = fixed[i - 1] / gap[i - 1] * short[i] if i else 0.0
    moved = np.zeros(len(step))
    moved[jumps] = fixed[jumps] - step[jumps]
    return x + np.concatenate([[0.0], np.cumsum(moved)])
