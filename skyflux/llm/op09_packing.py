"""Conflict-constrained best-fit packing of documents into bins of CAPACITY words.

A text's words are cut into full bins and a remainder. Remainders are packed by best fit decreasing: bins are held in order of their residual,
the first one with room is found by bisection, and the search goes on to the successor until a bin is compatible; none: a new bin.
A bin carries two bitmaps of sources (seen once, seen twice) and one of duplicate clusters: it takes a remainder only if its source is
in the bin fewer than PER_SOURCE times and its cluster not at all. A cluster is given by a column, or is all copies of a text up to
ASCII case and blanks.

Rows are dealt to groups of about GROUP_ROWS by a hash of doc_id and words, so no source, cluster, language or null id gathers in one task; only
(doc_id, words, source, cluster) are moved. Copies in different groups can't meet in a bin. Bins are numbered group * 2^32 + bin, in order of making.

Null and empty texts have no words and take a bin with 0 words in it like others. Null sources are one source. Repeated rows are packed each, and
order among equal sizes is by doc_id, then cluster. Other columns are not looked at. An empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import factors, memory_returned, mixed, words

CAPACITY, PER_SOURCE, GROUP_ROWS = 2048, 2, 4096
SCHEMA = "doc_id long, piece int, n_words long, bin long, bin_offset int, source string, cluster long"


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, source and cluster (a hash of the text's lower-cased words) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, cluster = [], []
            for w in words(batch.column(2), lower=True):
                count = np.diff(w.doc)
                place = np.arange(len(w.hash)) - np.repeat(w.doc[:-1], count)
                total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(w.hash * factors(int(count.max(initial=0)))[place])])
                cluster.append(mixed(total[w.doc[1:]] - total[w.doc[:-1]]).view(np.int64))
                n.append(count)
            if n:
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(n)), batch.column(1), pa.array(np.concatenate(cluster))], ["doc_id", "n_words", "source", "cluster"])
        memory_returned()

    return docs.select("doc_id", F.col("source").cast("string").alias("source"), "text").mapInArrow(run, "doc_id long, n_words long, source string, cluster long")


def best_fit(sizes: list[int], sources: list[int], clusters: list[int], capacity: int = CAPACITY, per_source: int = PER_SOURCE) -> list[tuple[int, int]]:
    """(bin, offset) of each item; items come in order of falling size."""
    residual: list[tuple[int, int]] = []  # (residual, bin), ascending
    levels: list[list[int]] = []  # per bin, bitmaps of the sources that it has more than 0, 1, ... times
    taken: list[int] = []  # per bin, bitmap of clusters
    placed = []
    for size, source, cluster in zip(sizes, sources, clusters, strict=True):
        at = bisect_left(residual, (size, -1))
        while at < len(residual):
            b = residual[at][1]
            if not levels[b][-1] >> source & 1 and not taken[b] >> cluster & 1:
                break
            at += 1
        if at < len(residual):
            room, b = residual.pop(at)
        else:
            room, b = capacity, len(levels)
            levels.append([0] * per_source)
            taken.append(0)
        placed.append((b, capacity - room))
        for k in range(per_source):
            if not levels[b][k] >> source & 1:
                levels[b][k] |= 1 << source
                break
        taken[b] |= 1 << cluster
        left = (room - size, b)
        residual.insert(bisect_left(residual, left), left)
    return placed


def packed(rows: DataFrame, groups: int, capacity: int = CAPACITY, per_source: int = PER_SOURCE) -> DataFrame:
    """Every piece of every row (doc_id, n_words, source, cluster) with its bin and place."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        group = key[0].as_py()
        table = table.sort_by([("n_words", "ascending"), ("doc_id", "ascending"), ("cluster", "ascending")])
        ids, n, source, cluster = (table.column(c).to_pylist() for c in ("doc_id", "n_words", "source", "cluster"))
        rest = sorted(range(len(n)), key=lambda i: -(n[i] % capacity))
        rest = [i for i in rest if n[i] % capacity or not n[i]]
        code_s = {s: i for i, s in enumerate(dict.fromkeys(source))}
        code_c = {c: i for i, c in enumerate(dict.fromkeys(cluster))}
        spots = best_fit([n[i] % capacity for i in rest], [code_s[source[i]] for i in rest], [code_c[cluster[i]] for i in rest], capacity, per_source)
        out = [(ids[i], n[i] // capacity, n[i] % capacity, b, at, source[i], cluster[i]) for i, (b, at) in zip(rest, spots, strict=True)]
        b = 1 + max((x[3] for x in out), default=-1)
        for i in range(len(n)):
            for piece in range(n[i] // capacity):
                out.append((ids[i], piece, capacity, b, 0, source[i], cluster[i]))
                b += 1
        columns = list(zip(*out, strict=True)) or [()] * 7
        types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.int64()]
        columns[3] = [(group << 32) + x for x in columns[3]]
        return pa.table([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["doc_id", "piece", "n_words", "bin", "bin_offset", "source", "cluster"])

    dealt = rows.withColumn("group", F.pmod(F.xxhash64("doc_id", "cluster", F.lit("group")), F.lit(groups)))
    return dealt.groupBy("group").applyInArrow(run, SCHEMA)


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, per_source: int = PER_SOURCE, group_rows: int = GROUP_ROWS) -> DataFrame:
    groups = max(1, -(-docs.count() // group_rows))
    return packed(measured(docs), groups, capacity, per_source)


def query(spark, sf_dir: str) -> DataFrame:
    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
