"""Vectorised words and shingles over Arrow text columns.

Words are the runs of bytes outside 0x20 and 0x09-0x0D. Every word gets a 64-bit multilinear hash: the sum of its
bytes' random values, each times a random factor of its place in the word, so texts are handled as arrays of integers and no Python string
is made per word. Factors of places have no rule that repetitive words could meet (as powers of a number have). Null texts count as empty.
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_RNG = np.random.Generator(np.random.PCG64(20240511))
_TABLE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = _TABLE.copy()
_LOWER[65:91] = _TABLE[97:123]
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_GRAM = _RNG.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mixed(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every output bit depends on every input bit."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def memory_returned() -> None:
    """Gives back to the system what a task has freed: Python workers outlive their tasks, and what they hold on to is missing in the next stages."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not in every C library
        ctypes.CDLL(None).malloc_trim(0)


def factors(n: int, kind: int = 0) -> np.ndarray:
    """Random odd factors of the places 0 to n - 1; kinds are independent of each other."""
    return mixed(mixed(np.arange(1, n + 1, dtype=np.uint64) * _BASE) + np.uint64(2 * kind + 1)) | np.uint64(1)


_FACTORS = factors(256)


@dataclass
class Words:
    """The words of some consecutive rows: row r has words doc[r] up to doc[r + 1]."""

    lo: int
    hi: int
    raw: np.ndarray
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    hash: np.ndarray
    offsets: np.ndarray | None = None  # row borders in bytes

    def bytes_of(self, a: int, b: int) -> bytes:
        """Words a up to b, joined by one space each."""
        view = self.raw
        return b" ".join(view[s:e].tobytes() for s, e in zip(self.start[a:b], self.end[a:b], strict=True))


def offsets_and_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    if n == 0:
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    _, off, data = column.buffers()
    off = np.frombuffer(off, np.int64, n + 1, column.offset * 8)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return off, data


def words(column: pa.Array, lower: bool = False, chunk_bytes: int = 1 << 18) -> Iterator[Words]:
    """The rows of a text column, in chunks of about chunk_bytes; a longer text is a chunk of its own."""
    off, data = offsets_and_bytes(column)
    n, lo = len(off) - 1, 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + chunk_bytes, "right")) - 1)
        hi = min(hi, n)
        yield _words(lo, hi, data[off[lo] : off[hi]], off[lo : hi + 1] - off[lo], _LOWER if lower else _TABLE)
        lo = hi


def _words(lo: int, hi: int, raw: np.ndarray, off: np.ndarray, table: np.ndarray, space: np.ndarray = _SPACE, first_chars: int = 0) -> Words:
    size = len(raw)
    if size == 0:
        none = np.zeros(0, np.int64)
        return Words(lo, hi, raw, none, none, np.zeros(hi - lo + 1, np.int64), np.zeros(0, np.uint64), off)
    full = ~space[raw]
    edge = np.zeros(size + 1, dtype=bool)
    edge[off] = True
    first = full.copy()
    first[1:] &= ~full[:-1] | edge[1:size]
    last = full.copy()
    last[:-1] &= ~full[1:] | edge[1:size]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    doc = np.searchsorted(start, off)
    if not len(start):
        return Words(lo, hi, raw, start, end, doc, np.zeros(0, np.uint64), off)
    longest = int((end - start).max())
    at = np.arange(size, dtype=np.int64)
    at -= np.maximum.accumulate(np.where(first, at, 0))
    np.minimum(at, longest, out=at)
    power = _FACTORS if longest < len(_FACTORS) else factors(longest + 1)
    value = table[raw] * power[at]
    value[~full] = 0
    if first_chars:  # only so many characters of a word count
        lead = np.cumsum((raw & 0xC0) != 0x80)
        lead -= np.maximum.accumulate(np.where(first, lead - 1, 0))
        value[lead > first_chars] = 0
    return Words(lo, hi, raw, start, end, doc, mixed(np.add.reduceat(value, start)), off)


def grams(h: np.ndarray, k: int, kind: int | None = None) -> np.ndarray:
    """The hash of every k consecutive words; position i starts at word i. Kinds are independent hashes of the same words."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    factor = (_GRAM if k <= len(_GRAM) else factors(k)) if kind is None else factors(k, kind)
    out = h[:n] * factor[0]
    for j in range(1, k):
        out += h[j : j + n] * factor[j]
    return mixed(out)


def stretches(h: np.ndarray, start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The hash of n words from each start on."""
    if not len(start):
        return np.zeros(0, np.uint64)
    first = np.cumsum(n) - n
    place = np.arange(int(n.sum())) - np.repeat(first, n)
    value = h[np.repeat(start, n) + place] * factors(int(n.max()), 3)[place]
    return mixed(np.add.reduceat(value, first) + n.astype(np.uint64))


def pairs_of(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """A column of 16 bytes each, as rows of two numbers."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.frombuffer(b"".join(column.to_pylist()), ">u8").astype(np.uint64).reshape(-1, 2)


def sixteen(pairs: np.ndarray) -> pa.Array:
    """Rows of two numbers as a column of 16 bytes each."""
    data = np.ascontiguousarray(pairs.astype(">u8"))
    return pa.Array.from_buffers(pa.binary(), len(pairs), [None, pa.py_buffer((16 * np.arange(len(pairs) + 1, dtype=np.int32)).tobytes()), pa.py_buffer(data.tobytes())])


def shingle_sets(w: Words, k: int = 5) -> Iterator[np.ndarray]:
    """Per row the sorted distinct hashes of its k-word shingles; with fewer words, the sequence as one; without words, none."""
    every = grams(w.hash, k)
    for r in range(w.hi - w.lo):
        a, b = int(w.doc[r]), int(w.doc[r + 1])
        if b - a >= k:
            s = np.sort(every[a : b - k + 1])
            yield s[np.concatenate([[True], s[1:] != s[:-1]])]
        elif b > a:
            yield mixed((w.hash[a:b] * _GRAM[: b - a]).sum(keepdims=True) + np.uint64(b - a))
        else:
            yield np.zeros(0, np.uint64)
