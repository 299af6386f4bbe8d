"""Benchmark decontamination by pigeonhole edit matching over words.

An item of m words may occur with up to k = floor(ratio * m) word edits. Cut into k + 1 pieces, at least one piece is intact in every such
occurrence. The pieces' leading words (as many as the item's shortest piece has) are kept in a hash table that every document's
rolling word n-grams are looked up in; each hit names a diagonal, and hits of an item on nearby diagonals give one stretch of
words, in which Myers' bit-parallel algorithm finds the edit distance of the whole item to the best part that ends at each word. Each occurrence is a
row: the ends with at most k edits are read from left to right, and one that is less than m - k words behind the last kept end (no occurrence is shorter)
takes its place if it has fewer edits and is passed over if not.

Words are `[^\\x20\\x09-\\x0D]+` with A-Z lower-cased. Items come in blocks of at most BLOCK_ITEMS, each block's pieces are sent to the
executors and matched with all documents, so what is sent is bounded whatever the list's length. There is no shuffle.
Null and empty texts and items match nothing; repeated rows are reported each; an empty list or table gives an empty result; other
columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import grams, memory_returned, words

RATIO, BLOCK_ITEMS = 0.2, 20_000
SCHEMA = "item_id long, distance int, item_words int, first_word long, last_word long"


def myers(pattern: dict[int, int], m: int, text: list[int], k: int) -> list[tuple[int, int]]:
    """(end, distance) of every place in text where an occurrence of the pattern with at most k edits ends. pattern: a word's bits."""
    full, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score, out = full, 0, m, []
    for j, word in enumerate(text):
        eq = pattern.get(word, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph, mh = mv | ~(xh | pv) & full, pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph, mh = ph << 1 & full, mh << 1 & full
        pv, mv = mh | ~(xv | ph) & full, ph & xv
        if score <= k:
            out.append((j, score))
    return out


def apart(ends: list[tuple[int, int]], gap: int) -> list[tuple[int, int]]:
    """The best of the ends (end, distance; rising) that are less than gap behind the last kept one."""
    kept: list[tuple[int, int]] = []
    for end, distance in ends:
        if not kept or end - kept[-1][0] >= gap:
            kept.append((end, distance))
        elif distance < kept[-1][1]:
            kept[-1] = (end, distance)
    return kept


class Index:
    """The pieces of a block of items."""

    def __init__(self, items: list[tuple[int, str]], ratio: float = RATIO):
        self.items = []
        pieces: dict[int, list[tuple[int, int, int]]] = {}
        column = pa.array([t for _, t in items], pa.string())
        for w in words(column, lower=True):
            for r in range(w.lo, w.hi):
                h = w.hash[w.doc[r - w.lo] : w.doc[r - w.lo + 1]]
                m = len(h)
                if not m:
                    continue
                k = int(ratio * m)
                bits: dict[int, int] = {}
                for i, x in enumerate(h.tolist()):
                    bits[x] = bits.get(x, 0) | 1 << i
                cut = [m * i // (k + 1) for i in range(k + 2)]
                g = min(b - a for a, b in zip(cut, cut[1:], strict=False))
                for a in cut[:-1]:
                    pieces.setdefault(g, []).append((int(grams(h[a : a + g], g)[0]), len(self.items), a))
                self.items.append((items[r][0], m, k, bits))
        self.tables = {}
        for g, rows in pieces.items():
            rows.sort()
            key = np.array([x[0] for x in rows], np.uint64)
            seen = np.zeros(1 << 20, bool)
            seen[(key & np.uint64(0xFFFFF)).astype(np.int64)] = True
            self.tables[g] = (key, np.array([x[1] for x in rows]), np.array([x[2] for x in rows]), seen)

    def matches(self, h: np.ndarray, doc: np.ndarray) -> Iterator[tuple[int, ...]]:
        """(row, item, distance, words of the item, first word, last word), one for each occurrence; h: word hashes of all rows, cut at doc."""
        found = []
        for g, (key, item, offset, seen) in self.tables.items():
            every = grams(h, g)
            at = np.flatnonzero(seen[(every & np.uint64(0xFFFFF)).astype(np.int64)])
            lo, hi = np.searchsorted(key, every[at], "left"), np.searchsorted(key, every[at], "right")
            at, lo, n = at[hi > lo], lo[hi > lo], (hi - lo)[hi > lo]
            which = np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            at = np.repeat(at, n)
            row = np.searchsorted(doc, at, "right") - 1
            inside = at + g <= doc[row + 1]
            found.append(np.stack([row, item[which], at - doc[row] - offset[which]])[:, inside])
        if not found:
            return
        row, item, diagonal = np.concatenate(found, axis=1)
        order = np.lexsort((diagonal, item, row))
        row, item, diagonal = row[order].tolist(), item[order].tolist(), diagonal[order].tolist()
        i, best = 0, {}
        while i < len(row):
            key, m, k, bits = self.items[item[i]]
            j = i + 1
            while j < len(row) and row[j] == row[i] and item[j] == item[i] and diagonal[j] - diagonal[j - 1] <= 2 * k + 1:
                j += 1
            base, size = int(doc[row[i]]), int(doc[row[i] + 1] - doc[row[i]])
            a, b = max(0, diagonal[i] - k), min(size, diagonal[j - 1] + m + k)
            for end, distance in myers(bits, m, h[base + a : base + b].tolist(), k):
                best[a + end] = min(distance, best.get(a + end, k))
            if j == len(row) or row[j] != row[i] or item[j] != item[i]:
                for end, distance in apart(sorted(best.items()), m - k):
                    yield row[i], key, distance, m, max(0, end - m + 1), end
                best = {}
            i = j


def matched(docs: DataFrame, items: DataFrame, key: str = "doc_id", ratio: float = RATIO, block: int = BLOCK_ITEMS) -> DataFrame:
    """One row for each occurrence of an item in a document: key, item_id, distance, item_words, first_word and last_word (about: from the match's end)."""
    spark = docs.sparkSession
    items = items.select("item_id", "text").where("text IS NOT NULL")
    blocks = max(1, -(-items.count() // block))
    kind = docs.schema[key].dataType.simpleString()
    parts = []
    for b in range(blocks):
        own = items.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b) if blocks > 1 else items
        index = spark.sparkContext.broadcast(Index([(r["item_id"], r["text"]) for r in own.collect()], ratio))

        def run(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = []
                for w in words(batch.column(1), lower=True):
                    rows += [(w.lo + r, *rest) for r, *rest in index.value.matches(w.hash, w.doc)]
                ids = batch.column(0).take(pa.array([r[0] for r in rows], pa.int64()))
                types = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([ids, *[pa.array([r[i + 1] for r in rows], t) for i, t in enumerate(types)]], [key, "item_id", "distance", "item_words", "first_word", "last_word"])
            memory_returned()

        parts.append(docs.select(key, "text").mapInArrow(run, f"{key} {kind}, {SCHEMA}"))
    return reduce(DataFrame.unionAll, parts)


def clean(docs: DataFrame, items: DataFrame, ratio: float = RATIO) -> DataFrame:
    """The documents that hold no item, with all their columns: a document's rows go where its id is among the hits."""
    hits = matched(docs, items, ratio=ratio).select("doc_id").distinct()
    return docs.join(hits, "doc_id", "left_anti").select(*docs.columns)


def query(spark, sf_dir: str) -> DataFrame:
    return matched(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
