"""Quality by perplexity under an interpolated modified Kneser-Ney model of the characters of trusted text.

The model has n-grams of whole Unicode characters, orders ORDER to 1, over an open alphabet (what the unigrams leave goes to all code points alike).
It has no bound: n-grams are strings, and their counts, contexts and probabilities are DataFrames sharded by them, so what is gathered
grows with the corpus and is never collected or broadcast. A text has ORDER - 1 signs BEFORE in front of it.

1. Folds. Every text belongs to one of two folds by its hash. There are two models, each of the trusted texts (labels with quality 1) of one fold, and
   a text is scored by the model of the other one; no text is judged by a model that has learnt it or a copy of it.
2. Counting. Each task counts the distinct n-grams of its texts, and how often they stand in trusted texts of each fold; these are added up by n-gram.
   A task holds some MERGE of them and gives them in several parts where it has more.
3. Probabilities. From ORDER down, each order's table holds all n-grams that scoring needs (suffixes of those in any text) with their counts or
   continuation counts; from 1 up, each is joined with its context's sums and with its suffix's probability.
4. Scoring. Tasks' texts are put together to blocks of about BLOCK bytes and packed. The probabilities that a block needs (its distinct n-grams) are joined from
   the sharded table, shipped to the block, and added up along its texts. So what is moved is one packed copy of the texts and
   the distinct n-grams of each block, not those of each document.

Perplexity is per character. Decision: per language the quantile HIGH of the trusted documents' perplexities (of texts that their model doesn't know), times MARGIN, is the most
that a document may have. A short text says little, so PRIOR characters at the language's median perplexity are counted in with each document.
Languages without trusted documents use the quantiles over all trusted ones; without any, all is kept.

docs must give the same rows in the same partitions when it is read twice (files do; write other plans to a table first); a block whose n-grams
don't fit its texts raises an error. Trusted ids are broadcast only while there are at most SEND_MAX; beyond that docs is joined with them by a shuffle and written.

Null and empty texts have null perplexity and are rejected (they hold no text to train on); blank ones are scored by their blanks. Null languages are a language of
their own. Repeated rows stay and are judged each, rows of one doc_id each by its own text; other columns stay in kept() and are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import dropped, written
from .text import memory_returned, mixed

ORDER, BEFORE, CODE_POINTS = 5, 0xFFFF, 0x110000
HIGH, MARGIN, PRIOR = 0.99, 1.03, 64
BLOCK, CHUNK, PART, MERGE, SEND_MAX = 96 << 20, 1 << 20, 1 << 18, 1_000_000, 2_000_000
_FACTORS = [mixed(np.arange(1, ORDER + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(s)) | np.uint64(1) for s in (1, 2)]


def _slices(batch: pa.RecordBatch, column: int, most: int) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in parts of about so many bytes of a text column; a longer text is a part of its own."""
    size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    lo = 0
    while lo < batch.num_rows:
        before = size[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(size, before + most, "right")))
        yield batch.slice(lo, hi - lo)
        lo = hi


def _sequence(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(code points, each text after ORDER - 1 signs BEFORE; row and place of each character)."""
    pad = chr(BEFORE) * (ORDER - 1)
    points = np.frombuffer("".join(pad + t for t in texts if t).encode("utf-32-le", "surrogatepass"), np.uint32)
    n = np.array([len(t) if t else 0 for t in texts], np.int64)
    row = np.repeat(np.arange(len(texts), dtype=np.int32), n)
    skipped = np.cumsum(np.where(n > 0, ORDER - 1, 0))
    return points, row, np.arange(len(row)) + np.repeat(skipped, n)


def _hashes(points: np.ndarray, at: np.ndarray, seed: int) -> np.ndarray:
    """A hash of the ORDER characters that end at each place."""
    if not len(at):
        return np.zeros(0, np.uint64)
    wide, n = points.astype(np.uint64), len(points) - ORDER + 1
    total = wide[ORDER - 1 :] * _FACTORS[seed][0]
    for back in range(1, ORDER):
        total += wide[ORDER - 1 - back : ORDER - 1 - back + n] * _FACTORS[seed][back]
    return mixed(total[at - (ORDER - 1)])


def _lookup(table: np.ndarray):
    """A function that gives the places of hashes in a sorted table without repeats, or any place for those that it lacks. Hashes are even, so their first bits almost tell the place."""
    if not len(table):
        return lambda hashes: np.zeros(len(hashes), np.int64)
    bits = np.uint64(len(table).bit_length() + 1)
    lead = (table >> (np.uint64(64) - bits)).astype(np.int64)
    first = np.minimum(np.searchsorted(lead, np.arange(1 << int(bits))), len(table) - 1).astype(np.int32)

    def places(hashes: np.ndarray) -> np.ndarray:
        k = first[hashes >> (np.uint64(64) - bits)]
        left = np.flatnonzero(table[k] < hashes)
        while len(left):
            left = left[k[left] + 1 < len(table)]
            k[left] += 1
            left = left[table[k[left]] < hashes[left]]
        return k

    return places


def _strings(points: np.ndarray) -> pa.Array:
    """Rows of ORDER code points as strings."""
    flat = np.ascontiguousarray(points, np.uint32).reshape(-1)
    width = 1 + (flat >= 0x80).astype(np.int64) + (flat >= 0x800) + (flat >= 0x10000)
    ends = np.concatenate([[0], np.cumsum(width)])[::ORDER].astype(np.int32)
    data = flat.tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass")
    return pa.StringArray.from_buffers(len(ends) - 1, pa.py_buffer(ends.tobytes()), pa.py_buffer(data))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (text, trusted, fold, block): distinct n-grams with their counts in trusted texts of fold 0 and 1. At most some MERGE n-grams are held:
    a task with more of them gives some several times, and their counts are added up with those of other tasks."""
    held: list[tuple] = []
    block = 0

    def merged() -> None:
        columns = [list(x) for x in zip(*held, strict=True)]
        held.clear()
        hashes = np.concatenate(columns[0])
        order = np.argsort(hashes)
        hashes = hashes[order]
        first = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]]))
        out = [hashes[first]]
        del hashes
        columns[0].clear()
        out.append(np.concatenate(columns[1])[order[first]])
        columns[1].clear()
        out += [np.add.reduceat(np.concatenate(c)[order], first) for c in columns[2:]]
        held.append(tuple(out))

    def given() -> Iterator[pa.RecordBatch]:
        _, points, c0, c1 = held.pop()
        for lo in range(0, len(c0), 50_000):
            hi = min(len(c0), lo + 50_000)
            yield pa.RecordBatch.from_arrays([_strings(points[lo:hi]), pa.array(np.full(hi - lo, block, np.int32)), pa.array(c0[lo:hi]), pa.array(c1[lo:hi])], ["g", "block", "c0", "c1"])

    for batch in batches:
        for part in _slices(batch, 0, PART):
            block = part.column(3)[0].as_py()
            points, row, at = _sequence(part.column(0).to_pylist())
            if not len(at):
                continue
            label = np.where(part.column(1).to_numpy(zero_copy_only=False), 1 + part.column(2).to_numpy(), 0).astype(np.int8)[row]
            h = _hashes(points, at, 0)
            order = np.argsort(h)
            h = h[order]
            first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
            label = label[order]
            counts = [np.add.reduceat(label == 1 + f, first, dtype=np.int64) for f in (0, 1)]
            ends = at[order[first]]
            held.append((h[first], points[ends[:, None] - np.arange(ORDER - 1, -1, -1)], *counts))
            if sum(len(x[0]) for x in held) > MERGE:
                merged()
                if 2 * len(held[0][0]) > MERGE:
                    yield from given()
    if held:
        merged()
        yield from given()
    memory_returned()


def _discounts(table: DataFrame) -> list[list[float]]:
    """D1, D2 and D3 of each fold, from the numbers of n-grams with count 1 to 4 (Chen and Goodman); where those are too few to tell, 0.5, 1 and 1.5."""
    n = table.agg(*[F.count_if(F.col(f"c{f}") == i).alias(f"n{f}{i}") for f in (0, 1) for i in (1, 2, 3, 4)]).first()
    out = []
    for f in (0, 1):
        n1, n2, n3, n4 = (n[f"n{f}{i}"] for i in (1, 2, 3, 4))
        if min(n1, n2, n3, n4) > 0:
            y = n1 / (n1 + 2 * n2)
            out.append([max(0.0, min(i, i - (i + 1) * y * b / a)) for i, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4))])
        else:
            out.append([0.5, 1.0, 1.5])
    return out


def probabilities(top: DataFrame) -> DataFrame:
    """g and p0, p1: the probability of its last character after the others under the model of each fold. top: g (ORDER characters) and its counts c0, c1;
    n-grams without counts take part, to be given a probability."""
    tables = [written(top, "order")]
    for order in range(ORDER - 1, 0, -1):
        lower = tables[-1].groupBy(F.substring("g", 2, order).alias("g")).agg(*[F.count_if(F.col(f"c{f}") > 0).alias(f"c{f}") for f in (0, 1)])
        tables.append(written(lower, "order"))
    p = None
    for order, table in zip(range(1, ORDER + 1), reversed(tables), strict=True):
        less = _discounts(table)
        sums, now = [], []
        for f in (0, 1):
            c, (d1, d2, d3) = F.col(f"c{f}"), less[f]
            taken = F.when(c == 0, 0.0).when(c == 1, d1).when(c == 2, d2).otherwise(d3)
            sums += [F.sum(c).alias(f"total{f}"), F.sum(taken).alias(f"left{f}")]
            share = (c - taken + F.col(f"left{f}") * F.col(f"lower{f}")) / F.col(f"total{f}")
            now.append(F.when(F.col(f"total{f}") > 0, share).otherwise(F.col(f"lower{f}")).alias(f"p{f}"))
        contexts = table.groupBy(F.substring("g", 1, order - 1).alias("h")).agg(*sums)
        rows = table.withColumns({"h": F.substring("g", 1, order - 1), "s": F.substring("g", 2, order - 1)}).join(contexts, "h")
        if p is None:
            rows = rows.withColumns({"lower0": F.lit(1 / CODE_POINTS), "lower1": F.lit(1 / CODE_POINTS)})
        else:
            rows = rows.join(p.select(F.col("g").alias("s"), F.col("p0").alias("lower0"), F.col("p1").alias("lower1")), "s")
        before, p = p, rows.select("g", *now)
        if order < ORDER:
            p = written(p, "shares")
        del before
    return p


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with the block last, in compressed pieces: block, size and bytes."""
    codec = pa.Codec("zstd", compression_level=3)
    for batch in batches:
        for part in _slices(batch, batch.num_columns - 2, CHUNK):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, part.schema) as out:
                out.write_batch(pa.RecordBatch.from_arrays([pa.array(c.to_pylist(), c.type) if c.offset else c for c in part.columns], schema=part.schema))
            raw = sink.getvalue()
            yield pa.RecordBatch.from_arrays([part.column(part.num_columns - 1)[:1], pa.array([raw.size], pa.int64()), pa.array([codec.compress(raw, asbytes=True)], pa.binary())], ["block", "size", "packed"])


def _points(strings: pa.ChunkedArray) -> np.ndarray:
    """The code points of strings of ORDER characters."""
    parts = [c.slice(lo, 10_000) for c in strings.chunks for lo in range(0, len(c), 10_000)]
    return np.concatenate([np.zeros(0, np.uint32), *[np.frombuffer("".join(x.to_pylist()).encode("utf-32-le", "surrogatepass"), np.uint32) for x in parts]])


def perplexities(docs: DataFrame, trusted: DataFrame, payload: list[str], block: int = BLOCK, send_max: int = SEND_MAX) -> DataFrame:
    """payload, trusted, n_chars and perplexity (null for null and empty texts) of every row of docs. trusted: distinct ids in a column doc_id."""
    names = [f"c{i}" for i in range(len(payload))]
    few = trusted.count() <= send_max
    marks = trusted.select(F.col("doc_id").alias("_id"), F.lit(True).alias("_mark"))
    rows = docs.join(F.broadcast(marks) if few else marks, F.col("doc_id") == F.col("_id"), "left")
    rows = rows.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(payload, names, strict=True)], F.coalesce("_mark", F.lit(False)).alias("trusted"), F.pmod(F.xxhash64("text"), F.lit(2)).cast("int").alias("fold"), "text")
    rows = rows if few else written(rows, "marked")
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, round(total / block))
    rows = rows.withColumn("block", F.pmod(F.spark_partition_id(), F.lit(blocks)))

    grams = rows.select("text", "trusted", "fold", "block").mapInArrow(_counted, "g string, block int, c0 long, c1 long")
    grams = written(grams.groupBy("g", "block").agg(F.sum("c0").alias("c0"), F.sum("c1").alias("c1")), "grams")
    p = probabilities(grams.groupBy("g").agg(F.sum("c0").alias("c0"), F.sum("c1").alias("c1")))
    needed = grams.select("g", "block").join(p, "g").select("block", "g", F.ln("p0").cast("float").alias("l0"), F.ln("p1").cast("float").alias("l1"))
    kinds = ", ".join(f"{n} {docs.schema[c].dataType.simpleString()}" for c, n in zip(payload, names, strict=True))
    packed = rows.mapInArrow(_packed, "block int, size long, packed binary")

    def scored(pieces: pa.Table, known: pa.Table) -> pa.Table:
        points = _points(known.column("g"))
        hashes = _hashes(points, np.arange(ORDER - 1, len(points), ORDER), 1)
        order = np.argsort(hashes)
        hashes = hashes[order]
        if (np.diff(hashes) == 0).any():
            raise ValueError("two n-grams have one hash")
        logs = np.concatenate([known.column(f"l{1 - f}").to_numpy()[order].astype(float) for f in (0, 1)])  # a fold is scored by the other one's model
        del points, order
        codec, out, places = pa.Codec("zstd"), [], _lookup(hashes)
        for size, piece in zip(pieces.column("size").to_pylist(), pieces.column("packed"), strict=True):
            for part in (x for batch in pa.ipc.open_stream(pa.py_buffer(codec.decompress(piece.as_buffer(), size, asbytes=True))) for x in _slices(batch, len(names) + 2, PART)):
                texts, fold = part.column(len(names) + 2).to_pylist(), part.column(len(names) + 1).to_numpy()
                chars, row, at = _sequence(texts)
                h = _hashes(chars, at, 1)
                k = places(h)
                if len(h) and (not len(hashes) or (hashes[k] != h).any()):
                    raise ValueError("texts have n-grams that weren't counted: docs gave other partitions when it was read again")
                n = np.bincount(row, minlength=len(texts))
                sums = np.bincount(row, logs[k + (fold * len(hashes))[row]] if len(k) else None, len(texts))
                with np.errstate(divide="ignore", invalid="ignore"):
                    value = np.exp(-sums / n)
                own = [c.take(pa.array(np.arange(len(c)))) for c in part.columns[: len(names) + 1]]  # copies: slices would keep the whole piece with its texts
                out.append(pa.RecordBatch.from_arrays([*own, pa.array(n), pa.array(value, mask=n == 0)], [*names, "trusted", "n_chars", "perplexity"]))
        del hashes, logs, places, known
        memory_returned()
        return pa.Table.from_batches(out)

    schema = f"{kinds}, trusted boolean, n_chars long, perplexity double"
    found = packed.groupBy("block").cogroup(needed.groupBy("block")).applyInArrow(scored, schema)
    found = written(found.select(*[F.col(n).alias(c) for c, n in zip(payload, names, strict=True)], "trusted", "n_chars", "perplexity"), "perplexities")
    dropped(grams)
    return found


def judged(docs: DataFrame, trusted: DataFrame, high: float = HIGH, margin: float = MARGIN, prior: int = PRIOR, payload: tuple[str, ...] = ("doc_id", "lang"), block: int = BLOCK, send_max: int = SEND_MAX) -> DataFrame:
    """payload (with lang among it), n_chars, perplexity, its value with the prior (adjusted), the bound (high), trusted and keep of every row. trusted: a doc_id column."""
    ids = trusted.select("doc_id").where("doc_id IS NOT NULL").distinct()
    scored = perplexities(docs, ids, list(payload), block, send_max)
    pair = F.percentile_approx(F.when(F.col("trusted"), F.col("perplexity")), F.array(F.lit(0.5), F.lit(high)), F.lit(10_000))
    by_lang = scored.groupBy("lang").agg(pair.alias("own")).withColumnRenamed("lang", "_lang")
    rows = scored.join(F.broadcast(by_lang) if by_lang.count() <= 100_000 else by_lang, F.col("lang").eqNullSafe(F.col("_lang")), "left").withColumn("own", F.coalesce("own", scored.agg(pair.alias("q")).scalar()))
    middle, most = F.get("own", F.lit(0)), F.get("own", F.lit(1)) * margin
    adjusted = F.exp((F.col("n_chars") * F.ln("perplexity") + prior * F.ln(middle)) / (F.col("n_chars") + prior))
    rows = rows.select(*payload, "n_chars", "perplexity", F.coalesce(adjusted, F.col("perplexity")).alias("adjusted"), most.alias("high"), "trusted")
    return rows.withColumn("keep", F.col("perplexity").isNotNull() & (F.col("high").isNull() | (F.col("adjusted") <= F.col("high"))))


def kept(docs: DataFrame, trusted: DataFrame, send_max: int = SEND_MAX) -> DataFrame:
    """The rows of docs, all columns, that are kept: each row by its own text and language, whatever other rows have its doc_id."""
    key = {"_k1": F.xxhash64("text"), "_k2": F.xxhash64(F.lit(1), "text")}
    columns = ["doc_id", "lang", "_k1", "_k2"]
    own = docs.select("doc_id", "lang", "text").withColumns(key)
    gone = judged(own, trusted, payload=tuple(columns)).where("NOT keep").select(*[F.col(c).alias(f"_{c}_gone") for c in columns]).distinct()
    gone = written(gone, "rejected")
    same = [F.col(c).eqNullSafe(F.col(f"_{c}_gone")) for c in columns]
    gone = F.broadcast(gone) if gone.count() <= send_max else gone
    return docs.withColumns(key).join(gone, same, "left_anti").select(*docs.columns)


def trusted_ids(spark, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 1").select("doc_id")


def query(spark, sf_dir: str) -> DataFrame:
    return judged(spark.read.parquet(f"{sf_dir}/documents.parquet"), trusted_ids(spark, sf_dir))
