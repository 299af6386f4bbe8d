"""A compressed FM-index over sequences of integers: wavelet matrix, documents of suffixes, and matching statistics for many patterns at once."""

from __future__ import annotations

import numpy as np


class Wavelet:
    """Ranks over a sequence of numbers below 2**levels: one bit vector for each bit of them, in 64-bit words with their running counts."""

    def __init__(self, values: np.ndarray, levels: int):
        self.words, self.counts, self.zeros, self.levels = [], [], [], levels
        now = values
        for k in reversed(range(levels)):
            bit = (now >> k & 1).astype(bool)
            padded = np.zeros((len(bit) // 64 + 1) * 64, np.uint8)
            padded[: len(bit)] = bit
            word = np.packbits(padded, bitorder="little").view(np.uint64)
            self.words.append(word)
            self.counts.append(np.concatenate([[0], np.cumsum(np.bitwise_count(word), dtype=np.int64)]))
            self.zeros.append(len(bit) - int(bit.sum()))
            now = np.concatenate([now[~bit], now[bit]])

    def walk(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where the prefix of length `at` ends in the order of the last level, among the symbol's places."""
        for level, (word, count, zeros) in enumerate(zip(self.words, self.counts, self.zeros, strict=True)):
            w = at >> 6
            ones = count[w] + np.bitwise_count(word[w] & ((np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)))
            at = np.where(symbol >> (self.levels - 1 - level) & 1, zeros + ones, at - ones)
        return at


class Minima:
    """Minima of ranges of a sequence in about four times its own space: those from each place to both ends of its block of SIDE, and a sparse table of the blocks'."""

    SIDE = 16

    def __init__(self, values: np.ndarray):
        self.values = values
        blocks = -(-len(values) // self.SIDE)
        padded = np.full(blocks * self.SIDE, np.iinfo(values.dtype).max, values.dtype)
        padded[: len(values)] = values
        padded = padded.reshape(blocks, self.SIDE)
        self.before = np.minimum.accumulate(padded, axis=1).reshape(-1)
        self.after = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].reshape(-1)
        rows, k = [padded.min(axis=1)], 1
        while 2 * k <= blocks:
            last = rows[-1].copy()
            last[: blocks - k] = np.minimum(last[: blocks - k], rows[-1][k:])
            rows.append(last)
            k *= 2
        self.blocks = np.stack(rows)  # row k: of 2**k blocks from each on, where there are so many

    def least(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """The minimum of each [lo, hi), which isn't empty."""
        a, b = lo // self.SIDE, (hi - 1) // self.SIDE
        out = np.minimum(self.after[lo], self.before[hi - 1])
        far = np.flatnonzero(b - a > 1)
        if len(far):
            x, y = a[far] + 1, b[far]
            k = np.floor(np.log2(y - x)).astype(np.int64)
            out[far] = np.minimum(out[far], np.minimum(self.blocks[k, x], self.blocks[k, y - (np.int64(1) << k)]))
        near = np.flatnonzero(a == b)
        if len(near):
            x, last = lo[near], hi[near] - 1
            now = self.values[x]
            for j in range(1, int((last - x).max()) + 1):
                now = np.minimum(now, self.values[np.minimum(x + j, last)])
            out[near] = now
        return out

    def below(self, at: np.ndarray, bound: np.ndarray, up: bool) -> np.ndarray:
        """The nearest place from each `at` on, upwards or downwards, whose value is less than the bound. There must be one."""
        at, sign = at.copy(), 1 if up else -1
        far = np.flatnonzero((self.after if up else self.before)[at] >= bound)
        if len(far):
            b, most = at[far] // self.SIDE + sign, bound[far]
            for k in reversed(range(len(self.blocks))):
                step = 1 << k
                first = b if up else b - step + 1
                inside = (first >= 0) & (first + step <= self.blocks.shape[1])
                b += np.where(inside & (self.blocks[k, np.clip(first, 0, self.blocks.shape[1] - 1)] >= most), sign * step, 0)
            at[far] = b * self.SIDE + (0 if up else self.SIDE - 1)
        left = np.arange(len(at))
        while len(left):
            left = left[self.values[at[left]] >= bound[left]]
            at[left] += sign
        return at


class FMIndex:
    """Of sequences of non-negative integers, each with an owner. Suffixes are sorted by their first 64 symbols, so patterns of up to 63 are found exactly."""

    def __init__(self, symbols: np.ndarray, lengths: np.ndarray, owner: np.ndarray):
        self.alphabet, code = np.unique(symbols, return_inverse=True)
        total = int(lengths.sum()) + len(lengths)
        text = np.zeros(total, np.int64)  # 0 ends a sequence
        ends = np.cumsum(lengths + 1) - 1
        inside = np.ones(total, bool)
        inside[ends] = False
        text[inside] = code + 1
        self.n = total
        ranks, rank, k = [], text, 1
        while True:
            ranks.append(rank)
            if k == 64:
                break
            ahead = np.zeros(total, np.int64)
            ahead[: total - k] = rank[k:] if k < total else 0
            key = rank * (int(rank.max()) + 1) + ahead
            _, rank = np.unique(key, return_inverse=True)
            k *= 2
        order = np.argsort(rank, kind="stable")
        self.levels = max(1, int(text.max()).bit_length())
        self.wavelet = Wavelet(text[order - 1], self.levels)
        every = np.arange(int(text.max()) + 1)
        first = np.searchsorted(np.sort(text), every)
        self.offset = first - self.wavelet.walk(every, np.zeros(len(every), np.int64))
        self.owners = Minima(np.repeat(owner, lengths + 1)[order])
        shared = np.zeros(total + 1, np.int64)
        a, b = order[:-1].copy(), order[1:].copy()
        for k in reversed(range(len(ranks))):
            inside = (a < total) & (b < total)
            same = inside & (ranks[k][np.minimum(a, total - 1)] == ranks[k][np.minimum(b, total - 1)])
            step = np.where(same, 1 << k, 0)
            a, b = a + step, b + step
        shared[1:total] = np.minimum(a - order[:-1], 127)
        shared[0] = shared[total] = -1
        self.shared = Minima(shared.astype(np.int8))

    def extend(self, code: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward search: the suffixes that start with a symbol (by code) and go on with one of [lo, hi)."""
        both = self.wavelet.walk(np.concatenate([code, code]), np.concatenate([lo, hi])) + np.tile(self.offset[code], 2)
        return both[: len(code)], both[len(code) :]

    def least_owner(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """The smallest owner of the suffixes in [lo, hi), which isn't empty."""
        return self.owners.least(lo, hi)

    def widened(self, lo: np.ndarray, hi: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All suffixes that share their first `depth` symbols with those in [lo, hi)."""
        return self.shared.below(lo, depth, up=False), self.shared.below(hi, depth, up=True)


def matched_windows(index: FMIndex, symbols: np.ndarray, lengths: np.ndarray, owner: np.ndarray, window: int = 50) -> np.ndarray:
    """Per place of the streamed sequences, whether its `window` symbols also occur in a sequence of a smaller owner.

    Matching statistics from right to left: a place's longest match with a smaller owner, cut at `window`. A match is extended to the left by
    backward search; where that fails, its right end is drawn in to the next depth at which more suffixes share it."""
    code = np.searchsorted(index.alphabet, symbols)
    known = index.alphabet[np.minimum(code, len(index.alphabet) - 1)] == symbols
    code = np.where(known, code + 1, 0)
    found = np.zeros(len(symbols), bool)
    base = np.cumsum(lengths) - lengths
    at, owner = lengths - 1, owner
    lo, hi, depth = np.zeros(len(at), np.int64), np.full(len(at), index.n), np.zeros(len(at), np.int64)
    while True:
        alive = at + 1 + np.minimum(depth, window - 1) >= window
        alive &= at >= 0
        if not alive.all():
            at, base, owner, lo, hi, depth = (x[alive] for x in (at, base, owner, lo, hi, depth))
        if not len(at):
            return found
        full = np.flatnonzero(depth == window)
        if len(full):
            lo[full], hi[full] = index.widened(lo[full], hi[full], np.full(len(full), window - 1))
            depth[full] = window - 1
        c = code[base + at]
        a, b = index.extend(c, lo, hi)
        good = (c > 0) & (a < b)
        i = np.flatnonzero(good)
        good[i] = index.least_owner(a[i], b[i]) < owner[i]
        lo, hi = np.where(good, a, lo), np.where(good, b, hi)
        depth += good
        done = good & (depth == window)
        found[(base + at)[done]] = True
        at = at - (good | (depth == 0))
        bad = np.flatnonzero(~good & (depth > 0))
        if len(bad):
            less = np.maximum(index.shared.values[lo[bad]], index.shared.values[hi[bad]]).astype(np.int64)
            less = np.maximum(less, 0)
            zero = less == 0
            lo[bad], hi[bad] = index.widened(lo[bad], hi[bad], less)
            lo[bad[zero]], hi[bad[zero]] = 0, index.n
            depth[bad] = less
