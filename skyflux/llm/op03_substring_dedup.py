"""Removal of word passages that also occur in a document with a smaller doc_id, by sharded FM-indexes.

Words are `[^\\x20\\x09-\\x0D]+`, unchanged. A window is WINDOW consecutive words of one document; it is repeated if its words also start in a
document with a smaller doc_id, and each word that a repeated window covers goes.

1. Routing. A window's anchor is the smallest hash of its GRAM-word sequences. Windows with equal words have equal anchors, so they are sought among
   the windows of their anchor only. Consecutive windows with one anchor are a segment (at most RUN windows; WINDOW - 1 words longer).
   Segments whose anchor occurs in one document only are dropped.
2. Pre-aggregation. Segments with equal words are one, owned by the smallest doc_id; one copy stands for those of all larger doc_ids. An
   anchor with more than HOT different segments has its segments cut into single windows, which are summed up in the same way, by a hash of their
   words; a passage in a third of all documents is then one row for each of its windows.
3. Index. All other anchors are dealt to shards of about SHARD segments. A shard builds a compressed FM-index (a wavelet matrix) of
   its segments and streams them through it, those with copies twice (for their owner, and for a larger doc_id than any): backward search gives matching
   statistics against smaller owners, and intervals of WINDOW words or more are reported, for the owner and for the copies.
4. A document's repeated intervals are brought together and its words are cut.

Lists of texts that a step needs, with their stretches, are broadcast only while they have at most SEND_MAX texts and SEND_PARTS stretches; beyond that the texts are shuffled.
Words are compared by 64-bit hashes, each at its place, so two windows are taken for equal wrongly only if hashes of different words agree; segments and single windows are
told apart by 128 bits (two hashes). Null texts have no words; texts shorter than a window stay. Windows repeated within one document only stay. Rows of one doc_id
don't count against each other, but each loses what its own text has of a smaller doc_id. Words kept are joined by one space. Rows with a null doc_id stay whole. Other columns are not
looked at. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .fm_index import FMIndex, matched_windows
from .store import dropped, written
from .text import Words, grams, memory_returned, stretches, words

WINDOW, GRAM, RUN, SHARD, HOT, SEND_MAX, SEND_PARTS = 50, 16, 200, 4000, 4096, 200_000, 1_000_000
OCCURRENCE = ["anchor", "seg", "doc_id", "text_key", "start", "windows"]
KINDS = "anchor long, seg long, doc_id long, text_key long, start int, windows int"


def _least(h: np.ndarray, n: int) -> np.ndarray:
    """The minimum of every n consecutive values."""
    k, now = 1, h
    while 2 * k <= n:
        now = np.minimum(now[:-k], now[k:])
        k *= 2
    rest = n - k
    return np.minimum(now[: len(now) - rest], now[rest:]) if rest else now


def _segments(w: Words, run: int = RUN) -> tuple[np.ndarray, ...]:
    """(row, anchor, first window, windows, hash of its words) of each segment of a chunk."""
    none = np.zeros(0, np.int64)
    if len(w.hash) < WINDOW:
        return none, none.astype(np.uint64), none, none, none.astype(np.uint64)
    low = _least(grams(w.hash, GRAM), WINDOW - GRAM + 1)  # a value for each window
    size = np.maximum(np.diff(w.doc) - WINDOW + 1, 0)
    row = np.repeat(np.arange(len(size)), size)
    at = np.repeat(w.doc[:-1] - (np.cumsum(size) - size), size) + np.arange(len(row))
    if not len(at):
        return none, none.astype(np.uint64), none, none, none.astype(np.uint64)
    value = low[at]
    new = np.concatenate([[True], (value[1:] != value[:-1]) | (row[1:] != row[:-1])])
    place = np.arange(len(at))
    inside = place - np.maximum.accumulate(np.where(new, place, 0))
    first = np.flatnonzero(inside % run == 0)
    count = np.diff(np.concatenate([first, [len(at)]]))
    start = at[first]
    return row[first], value[first], start - w.doc[row[first]], count, stretches(w.hash, start, count + WINDOW - 1)


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text and a hash of the text, which tells rows of one doc_id apart."""
    return docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"))


def _occurrences(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for w in words(batch.column(1)):
                row, anchor, start, count, seg = _segments(w)
                ids, keys = (batch.column(i)[w.lo : w.hi].take(pa.array(row)) for i in (0, 2))
                yield pa.RecordBatch.from_arrays([pa.array(anchor.view(np.int64)), pa.array(seg.view(np.int64)), ids, keys, pa.array(start.astype(np.int32)), pa.array(count.astype(np.int32))], OCCURRENCE)
        memory_returned()

    return _keyed(docs).mapInArrow(run, KINDS)


def _only(docs: DataFrame, needed: DataFrame) -> DataFrame:
    """docs (doc_id, text, text_key) joined with needed (doc_id, text_key, parts; one row each), which is sent to the executors while it is small."""
    needed = written(needed, "needed")
    size = needed.agg(F.count("*").alias("rows"), F.coalesce(F.sum(F.size("parts")), F.lit(0)).alias("parts")).first()
    small = size["rows"] <= SEND_MAX and size["parts"] <= SEND_PARTS
    return _keyed(docs).join(F.broadcast(needed) if small else needed, ["doc_id", "text_key"])


def _single_windows(docs: DataFrame, hot: DataFrame) -> DataFrame:
    """Occurrences of hot anchors, cut into a segment for each window; anchor and seg are two independent hashes of its words."""
    needed = hot.groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("start", "windows")).alias("parts"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = batch.column(3).to_pylist()
            for w in words(batch.column(1)):
                row = [(r, p["start"], p["windows"]) for r in range(w.hi - w.lo) for p in parts[w.lo + r]]
                if not row:
                    continue
                r, start, n = np.array(row, np.int64).T
                at = np.repeat(start - (np.cumsum(n) - n), n) + np.arange(n.sum())
                r = np.repeat(r, n)
                both = [pa.array(grams(w.hash, WINDOW, kind)[w.doc[r] + at].view(np.int64)) for kind in (1, 2)]
                ids, keys = (batch.column(i)[w.lo : w.hi].take(pa.array(r)) for i in (0, 2))
                yield pa.RecordBatch.from_arrays([*both, ids, keys, pa.array(at.astype(np.int32)), pa.array(np.ones(len(at), np.int32))], OCCURRENCE)
        memory_returned()

    return _only(docs, needed).select("doc_id", "text", "text_key", "parts").mapInArrow(run, KINDS)


def _shipped(docs: DataFrame, segments: DataFrame, shards: int) -> DataFrame:
    """shard, anchor, seg, owner, whether there are copies, and word hashes of the segments, each from its owner's text."""
    needed = segments.groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("anchor", "seg", "start", "windows", "copied")).alias("parts"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, parts = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            for w in words(batch.column(1)):
                out = []
                for r in range(w.hi - w.lo):
                    a = int(w.doc[r])
                    for p in parts[w.lo + r]:
                        x = a + p["start"]
                        out.append((p["anchor"], p["seg"], ids[w.lo + r], p["copied"], w.hash[x : x + p["windows"] + WINDOW - 1].tobytes()))
                yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary()))], ["anchor", "seg", "owner", "copied", "words"])
        memory_returned()

    rows = _only(docs, needed).select("doc_id", "text", "parts").mapInArrow(run, "anchor long, seg long, owner long, copied boolean, words binary")
    return rows.withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards)))


def _searched(table: pa.Table) -> pa.Table:
    """A shard: its index, all its segments streamed through it, and the repeated stretches of windows (first, last) of each, for its owner and for its copies."""
    blobs = table.column("words").to_pylist()
    symbols = np.concatenate([np.frombuffer(b, np.uint64) for b in blobs])
    lengths = np.array([len(b) // 8 for b in blobs], np.int64)
    owner = np.unique(table.column("owner").to_numpy(), return_inverse=True)[1].astype(np.int32)
    index = FMIndex(symbols, lengths, owner)
    copied = np.flatnonzero(table.column("copied").to_numpy())
    asked = np.concatenate([np.arange(len(lengths)), copied])
    symbols = np.concatenate([symbols, *[np.frombuffer(blobs[i], np.uint64) for i in copied]])
    lengths, owner = lengths[asked], np.concatenate([owner, np.full(len(copied), len(lengths), np.int32)])
    found = matched_windows(index, symbols, lengths, owner, WINDOW)
    del index, symbols, blobs
    memory_returned()
    of = np.repeat(np.arange(len(lengths)), lengths)
    at = np.flatnonzero(found)
    new = np.concatenate([[True], (np.diff(at) > 1) | (of[at[1:]] != of[at[:-1]])]) if len(at) else np.zeros(0, bool)
    last = np.concatenate([new[1:], [True]]) if len(at) else new
    base = np.cumsum(lengths) - lengths
    k = of[at[new]]
    which = pa.array(asked[k])
    return pa.table([table.column("anchor").take(which), table.column("seg").take(which), pa.array(k >= len(table)), pa.array((at[new] - base[k]).astype(np.int32)), pa.array((at[last] - base[k]).astype(np.int32))], ["anchor", "seg", "copy", "a", "b"])


def repeated(docs: DataFrame, shard: int = SHARD, hot: int = HOT) -> DataFrame:
    """(doc_id, text_key, a, b): words a up to b of the rows with this doc_id and text lie in repeated windows. Stretches may overlap."""
    every = written(_occurrences(docs).where("doc_id IS NOT NULL"), "segments")
    twice = every.groupBy("anchor").agg(F.min("doc_id").alias("x"), F.max("doc_id").alias("y")).where("x < y").select("anchor")
    some = written(every.join(twice, "anchor", "left_semi"), "candidates")
    dropped(every)
    owners = some.groupBy("anchor", "seg").agg(F.min(F.struct("doc_id", "text_key", "start", "windows")).alias("o"), F.max("doc_id").alias("last"))
    owners = written(owners.select("anchor", "seg", "o.*", (F.col("last") > F.col("o.doc_id")).alias("copied")), "owners")
    sizes = written(owners.groupBy("anchor").agg(F.count("*").alias("n")), "sizes")
    crowded = sizes.where(F.col("n") > hot).select("anchor")
    parts = []
    if not crowded.isEmpty():
        windows = written(_single_windows(docs, some.join(crowded, "anchor", "left_semi")), "windows")
        some = some.join(crowded, "anchor", "left_anti")
        first = windows.groupBy("anchor", "seg").agg(F.min("doc_id").alias("owner"), F.max("doc_id").alias("y")).where("owner < y").select("anchor", "seg", "owner")
        parts.append(windows.join(first, ["anchor", "seg"]).where("doc_id > owner").select("doc_id", "text_key", F.col("start").alias("a"), (F.col("start") + WINDOW).alias("b")))
        owners = owners.join(crowded, "anchor", "left_anti")
    shards = max(1, -(-(sizes.where(F.col("n") <= hot).agg(F.sum("n")).first()[0] or 0) // shard))
    found = _shipped(docs, owners, shards).groupBy("shard").applyInArrow(_searched, "anchor long, seg long, copy boolean, a int, b int")
    found = written(found, "found")
    of = some.join(owners.select("anchor", "seg", F.col("doc_id").alias("owner")), ["anchor", "seg"]).withColumn("copy", F.col("doc_id") > F.col("owner"))
    parts.append(of.join(found, ["anchor", "seg", "copy"]).select("doc_id", "text_key", (F.col("start") + F.col("a")).alias("a"), (F.col("start") + F.col("b") + WINDOW).alias("b")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionAll(p)
    return out


def fresh(names: list[str], taken: list[str]) -> list[str]:
    """The names, each with as many underscores in front as it takes to be new."""
    known = {t.lower() for t in taken}
    out = []
    for name in names:
        while name.lower() in known:
            name = f"_{name}"
        out.append(name)
    return out


def deduplicated(docs: DataFrame) -> DataFrame:
    """All rows and columns of docs, and three more at the end: n_words, n_removed and kept_text (the words kept, joined by one space);
    where docs has such names, theirs begin with underscores."""
    fields = docs.schema.fields
    names = [f.name for f in fields]
    cut_id, cut_key, cut_list, n_words, n_removed, kept_text = fresh(["cut_id", "cut_key", "cut_list", "n_words", "n_removed", "kept_text"], names)
    cuts = repeated(docs).groupBy(F.col("doc_id").alias(cut_id), F.col("text_key").alias(cut_key)).agg(F.collect_set(F.struct("a", "b")).alias(cut_list))
    cuts = written(cuts, "cuts")
    size = cuts.agg(F.count("*").alias("rows"), F.coalesce(F.sum(F.size(cut_list)), F.lit(0)).alias("parts")).first()
    small = size["rows"] <= SEND_MAX and size["parts"] <= SEND_PARTS
    rows = docs.join(F.broadcast(cuts) if small else cuts, (docs.doc_id == F.col(cut_id)) & (F.xxhash64(docs.text) == F.col(cut_key)), "left")
    where = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cuts = batch.column(len(names)).to_pylist()
            for w in words(batch.column(where)):
                n = np.diff(w.doc)
                gone = np.zeros(len(w.hash) + 1, np.int64)
                for r in range(w.hi - w.lo):
                    for c in cuts[w.lo + r] or ():
                        a, b = w.doc[r] + c["a"], min(w.doc[r] + c["b"], w.doc[r + 1])
                        if a < b:
                            gone[a] += 1
                            gone[b] -= 1
                stay = np.cumsum(gone[:-1]) == 0
                sums = np.concatenate([[0], np.cumsum(stay)])
                start, end = w.start[stay], w.end[stay]
                raw = w.raw.tobytes()
                at, texts = sums[w.doc], []
                pieces = [raw[s:e] for s, e in zip(start.tolist(), end.tolist(), strict=True)]
                for r in range(w.hi - w.lo):
                    texts.append(b" ".join(pieces[at[r] : at[r + 1]]))
                kept = pa.array(texts, pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([*[batch.column(i)[w.lo : w.hi] for i in range(len(names))], pa.array(n), pa.array(n - (sums[w.doc[1:]] - sums[w.doc[:-1]])), kept], [*names, n_words, n_removed, kept_text])
        memory_returned()

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    return rows.select(*names, cut_list).mapInArrow(run, f"{kinds}, `{n_words}` long, `{n_removed}` long, `{kept_text}` string")


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of every row."""
    rows = deduplicated(docs.select("doc_id", "text"))
    return rows.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def query(spark, sf_dir: str) -> DataFrame:
    return digests(spark.read.parquet(f"{sf_dir}/documents.parquet"))


#: The same by hashes of all windows.
SQL = r"""
WITH d AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
v AS (SELECT doc_id, unnest(range(1, len(w) - 48)) AS j, w FROM d WHERE len(w) >= 50), h AS (SELECT doc_id, j, md5(array_to_string(w[j:j + 49], ' ')) AS h FROM v),
f AS (SELECT h, min(doc_id) AS first FROM h GROUP BY h), r AS (SELECT doc_id, j FROM h JOIN f USING (h) WHERE doc_id > first),
x AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS j FROM d),
y AS (SELECT x.doc_id, x.word, x.j, max(r.j) OVER (PARTITION BY x.doc_id ORDER BY x.j) AS last FROM x LEFT JOIN r ON r.doc_id = x.doc_id AND r.j = x.j),
z AS (SELECT doc_id, count(*) AS n_words, count(*) FILTER (WHERE last >= j - 49) AS n_removed, string_agg(word, ' ' ORDER BY j) FILTER (WHERE last IS NULL OR last < j - 49) AS kept FROM y GROUP BY doc_id)
SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN z USING (doc_id)
"""
