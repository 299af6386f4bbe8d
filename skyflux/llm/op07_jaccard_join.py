"""Exact Jaccard self-join of documents on their 5-word shingles, with its connected components.

Texts have A-Z lower-cased; words are `[^\\x20\\x09-\\x0D]+`. A set holds a text's distinct shingles as 64-bit hashes; equal sets (by a digest of 128 bits) are one
class, so copies cost one row each and nothing more. Two sets are linked when 100 * |A & B| >= 80 * |A | B|.

1. Order. Shingles are ordered by hash, frequent ones last. A shingle is frequent if it is in more than FREQUENT sets' prefixes; as many
   as FREQUENT_MAX are sent to the executors, and the bound on the count is raised in powers of two until they are that few. Any order is right.
2. Prefix lists. Linked sets share a shingle among the first |A| - ceil(0.8 |A|) + 1. A list holds for each set its size and the shingle's position in it, and
   is cut into blocks of equal size and position. Blocks are compared before rows: the larger sizes behind a block that can't reach the similarity are jumped over as a whole, and
   so are blocks whose positions leave too little room for the overlap that their sizes need. Of the rest, the pairs of rows are added up over lists, and a pair stays a candidate if its
   shared prefix and all that lies behind it could reach the overlap that it needs, and the sets' bitmaps allow it: each bit is the parity of the shingles that fall on it, so two
   sets differ in at least as many shingles as their bitmaps in bits. The sets of a long list meet in one task with their bitmaps only; it returns a forest of the pairs that could be linked, so lists of sets that
   only share a common passage make no large clusters. Lists of more than LIST_MAX sets chain them in order of size.
3. Candidate clusters are the components of these edges; no linked pair crosses one. A cluster's sets meet in one task, or, where it has more
   than BLOCK sets, in a task for each pair of blocks of equal or neighbouring size classes.
4. Answers. In a task a set's overlaps with all others are derived from those of the most similar set that is done already: lists of
   the shingles that only one of both has are subtracted and added. Without a similar one they come from all its lists. Overlaps are exact.
   A task returns a forest of its links and each set's number of links, never the pairs.
5. Components of the forests are the result. Rows get it by their set's digest; the sets with more than one in COMMON of all rows, at most COMMON - 1, are
   sent to the rows instead, and rows without words meet nowhere.

Null texts and texts without words have no set, are linked with nothing, and are components of their own. Fewer than 5 words are one
shingle. Repeated rows (also of one doc_id with different texts) all stay. Rows with a null doc_id are linked like others; a component's id is its smallest
doc_id, and null only where all its rows have none. Other columns are not looked at. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .store import dropped, written
from .text import memory_returned, mixed, pairs_of, shingle_sets, sixteen, words

FREQUENT, FREQUENT_MAX, BLOCK, SEND_MAX, COMMON = 32, 1_000_000, 1024, 500_000, 1000
LIST_MAX, TILE, BITS = 1 << 15, 1024, 256
_PLAIN = np.zeros(0, np.uint64)


def _digest(s: np.ndarray) -> bytes:
    """16 bytes that tell sets apart: two sums of independent functions of the members."""
    both = np.array([mixed(s).sum() + np.uint64(len(s)), mixed(s ^ np.uint64(0xD6E8FEB86659FD93)).sum()], np.uint64)
    return mixed(both).astype(">u8").tobytes()


def _bitmap(s: np.ndarray) -> np.ndarray:
    """BITS parities as BITS / 64 numbers."""
    return np.packbits(np.bincount((mixed(s) % np.uint64(BITS)).astype(np.int64), minlength=BITS).astype(np.uint8) & 1).view(np.int64)


def _is_in(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Membership in a sorted table."""
    if not len(table):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(table, values), len(table) - 1)
    return table[at] == values


def _prefix(s: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """The first |s| - ceil(0.8 |s|) + 1 shingles, rare ones first."""
    size = len(s) - (4 * len(s) + 4) // 5 + 1
    late = _is_in(s, frequent)
    return np.concatenate([s[~late], s[late]])[:size] if late.any() else s[:size]


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text and a key that tells texts and ids apart; null ids have keys too."""
    return docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("key"))


def _sets(docs: DataFrame, shared=None, prefixes: bool = True) -> DataFrame:
    """doc_id, key, n_shingles, digest, bitmap and the prefix of every row; without words: 0, nulls and an empty prefix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = shared.value if shared is not None else _PLAIN
        for batch in batches:
            for w in words(batch.column(1), lower=True):
                n, digest, bits, prefix = [], [], [], []
                for s in shingle_sets(w):
                    n.append(len(s))
                    digest.append(_digest(s) if len(s) else None)
                    bits.append(_bitmap(s).tobytes() if len(s) and shared is None else None)
                    if prefixes:
                        prefix.append(_prefix(s, frequent) if len(s) else _PLAIN)
                out = [batch.column(0)[w.lo : w.hi], batch.column(2)[w.lo : w.hi], pa.array(n, pa.int32()), pa.array(digest, pa.binary()), pa.array(bits, pa.binary())]
                if prefixes:
                    offsets = np.concatenate([[0], np.cumsum([len(p) for p in prefix])]).astype(np.int32)
                    out.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(prefix).view(np.int64))))
                yield pa.RecordBatch.from_arrays(out, ["doc_id", "key", "n_shingles", "digest", "bits", "prefix"][: len(out)])
        memory_returned()

    return _keyed(docs).mapInArrow(run, "doc_id long, key long, n_shingles int, digest binary, bits binary" + ", prefix array<bigint>" * prefixes)


def _frequent(sets: DataFrame, bound: int, most: int) -> np.ndarray:
    """The shingles in more than bound prefixes, or in more than 2, 4, ... times that, at most `most` of them; sorted."""
    counts = sets.select(F.explode("prefix").alias("token")).groupBy("token").agg(F.count("*").alias("c")).where(F.col("c") > bound)
    counts = written(counts, "counts")
    steps = {r["k"]: r["n"] for r in counts.groupBy(F.floor(F.log2(F.col("c") / bound)).cast("int").alias("k")).agg(F.count("*").alias("n")).collect()}
    k = 0
    while sum(n for x, n in steps.items() if x >= k) > most:
        k += 1
    rows = counts.where(F.floor(F.log2(F.col("c") / bound)).cast("int") >= k).select("token").toArrow().column(0).to_numpy()
    dropped(counts)
    return np.sort(rows.view(np.uint64))


def _needed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least overlap of linked sets of these sizes."""
    return (4 * (a + b) + 8) // 9


def _block_pairs(token: np.ndarray, n: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of short lists (rows in order of token, n, position) from the blocks that aren't skipped."""
    first = np.flatnonzero(np.concatenate([[True], (token[1:] != token[:-1]) | (n[1:] != n[:-1]) | (at[1:] != at[:-1])])[: len(token)])
    count = np.diff(np.concatenate([first, [len(token)]]))
    of, size, place = token[first], n[first], at[first]
    i, apart, xs, ys = np.arange(len(first)), 0, [], []
    while len(i):
        i = i[i + apart < len(first)]
        j = i + apart
        near = (of[i] == of[j]) & (5 * size[i] >= 4 * size[j])  # sizes rise: once a block is too large, so are all behind it
        i, j = i[near], j[near]
        most = 1 + np.minimum(place[i], place[j]) + np.minimum(size[i] - place[i], size[j] - place[j]) - 1
        room = most >= _needed(size[i], size[j])
        a, b = i[room], j[room]
        each = count[a] * count[b]
        inside = np.arange(int(each.sum())) - np.repeat(np.cumsum(each) - each, each)
        x = np.repeat(first[a], each) + inside // np.repeat(count[b], each)
        y = np.repeat(first[b], each) + inside % np.repeat(count[b], each)
        xs.append(x[x < y])
        ys.append(y[x < y])
        apart += 1
    return np.concatenate([*xs, np.zeros(0, np.int64)]), np.concatenate([*ys, np.zeros(0, np.int64)])


def _edges_of_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (token, n, digest, p, at), lists one after the other, by n and at within: (u, v, least count needed, null) of the pairs of short lists, and (set, null, null, token) of the rows of long ones."""

    def of(token, n, p, at, d):
        first = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]])[: len(token)])
        size = np.diff(np.concatenate([first, [len(token)]]))
        size = np.repeat(size, size)
        some = size > 1
        token, n, p, at, d, long = token[some], n[some].astype(np.int64), p[some], at[some].astype(np.int64), d[some], size[some] > FREQUENT
        short = np.flatnonzero(~long)
        x, y = _block_pairs(token[short], n[short], at[short])
        x, y = short[x], short[y]
        need = _needed(n[x], n[y]) - np.maximum(n[x] - p[x], n[y] - p[y])
        u, v = d[x], d[y]
        swap = (u[:, 0] > v[:, 0]) | (u[:, 0] == v[:, 0]) & (u[:, 1] > v[:, 1])
        u, v = np.where(swap[:, None], v, u), np.where(swap[:, None], u, v)
        other = (u != v).any(axis=1)
        names, pairs, lists = ["u", "v", "need", "list"], int(other.sum()), int(long.sum())
        yield pa.RecordBatch.from_arrays([sixteen(u[other]), sixteen(v[other]), pa.array(need[other].astype(np.int32)), pa.nulls(pairs, pa.int64())], names)
        yield pa.RecordBatch.from_arrays([sixteen(d[long]), pa.nulls(lists, pa.binary()), pa.nulls(lists, pa.int32()), pa.array(token[long].view(np.int64))], names)

    held = None
    for batch in batches:
        columns = [*[batch.column(i).to_numpy() for i in range(4)], pairs_of(batch.column(4))]
        if held is not None:
            columns = [np.concatenate(x) for x in zip(held, columns, strict=True)]
        if not len(columns[0]):
            continue
        cut = len(columns[0]) - int((columns[0][::-1] != columns[0][-1]).argmax()) if columns[0][0] != columns[0][-1] else 0
        if cut:
            yield from of(*[c[:cut] for c in columns])
        held = [c[cut:] for c in columns]
        if len(held[0]) > 8 * FREQUENT:  # a long list in parts: FREQUENT + 1 rows stay, so that it is known to be long
            yield from of(*held)
            held = [c[-FREQUENT - 1 :] for c in held]
    if held is not None:
        yield from of(*held)
    memory_returned()


def _forest(table: pa.Table) -> pa.Table:
    """(u, v): edges that connect what the pairs of a long list's sets that could be linked connect; table: digest, n and bits. Tiles of the pairs are compared in order of size,
    without those whose sets are too far apart in size or are connected already."""
    digest, n = pairs_of(table.column("digest")), table.column("n").to_numpy().astype(np.int64)
    bits = np.frombuffer(b"".join(table.column("bits").to_pylist()), np.uint64).reshape(len(n), -1)
    order = np.lexsort((digest[:, 1], digest[:, 0], n))
    order = order[np.concatenate([[True], (digest[order[1:]] != digest[order[:-1]]).any(axis=1)])]  # a list that was read in parts has rows twice
    digest, n, bits = digest[order], n[order], bits[order]
    m, label = len(n), np.arange(len(n))
    if m > LIST_MAX:
        tiles = []
        u = np.flatnonzero(5 * n[:-1] >= 4 * n[1:])
        label = np.arange(m) - np.isin(np.arange(m), u + 1)
    else:
        tiles = [(a, b) for b in range(0, m, TILE) for a in range(b, -1, -TILE) if 5 * n[min(a + TILE, m) - 1] >= 4 * n[b]]
    for a, b in tiles:
        x, y = np.arange(a, min(a + TILE, m)), np.arange(b, min(b + TILE, m))
        if a < b and label[x[0]] == label[y[0]] and (label[x] == label[x[0]]).all() and (label[y] == label[x[0]]).all():
            continue
        apart = np.zeros((len(x), len(y)), np.int64)
        for k in range(bits.shape[1]):
            apart += np.bitwise_count(bits[x, k][:, None] ^ bits[y, k])
        both = n[x][:, None] + n[y]
        i, j = np.nonzero((apart <= both - 2 * ((4 * both + 8) // 9)) & (5 * n[x][:, None] >= 4 * n[y]) & (x[:, None] < y))
        i, j = x[i], y[j]
        while len(i):
            lower = np.minimum(label[i], label[j])
            np.minimum.at(label, label[i], lower)
            np.minimum.at(label, label[j], lower)
            while (label[label] != label).any():
                label = label[label]
            left = label[i] != label[j]
            i, j = i[left], j[left]
    other = np.flatnonzero(label != np.arange(m))
    return pa.table([sixteen(digest[label[other]]), sixteen(digest[other])], ["u", "v"])


def _answers(key: tuple, table: pa.Table) -> pa.Table:
    """A task's links: digest, root (a linked set's digest or its own) and links, a sum of the linked sets' weights.

    A task of two blocks counts links between them only, also if one is empty; those within a block have a task of their own."""
    _, k1, b1, k2, b2 = (x.as_py() for x in key)
    cross = (k1, b1) != (k2, b2)
    side = table.column("side").to_numpy()
    digest, weight = pairs_of(table.column("digest")), table.column("weight").to_numpy()
    order = np.lexsort((digest[:, 1], digest[:, 0]))
    keep = order[np.concatenate([[True], (digest[order[1:]] != digest[order[:-1]]).any(axis=1)])]  # a row that stands there twice is shipped twice
    keep = keep[np.argsort(table.column("n").to_numpy()[keep], kind="stable")]
    blobs = table.column("tokens")
    sets = [np.frombuffer(blobs[int(i)].as_py(), np.uint64) for i in keep]
    side, digest, weight = side[keep], digest[keep], weight[keep]
    m = len(sets)
    size = np.array([len(s) for s in sets], np.int64)
    every = np.concatenate(sets)
    owner = np.repeat(np.arange(m), size)
    order = np.argsort(every, kind="stable")
    every, owner = every[order], owner[order]
    first = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]]))
    length = np.diff(np.concatenate([first, [len(every)]]))
    first, length = first[length > 1], length[length > 1]
    shared = every[first]  # shingles of two sets or more

    def lists(tokens: np.ndarray) -> np.ndarray:
        """How many of these shingles each set has."""
        at, n = first[tokens], length[tokens]
        rows = np.repeat(at - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        return np.bincount(owner[rows], minlength=m)

    local = []
    for s in sets:
        at = np.minimum(np.searchsorted(shared, s), max(len(shared) - 1, 0))
        local.append(at[shared[at] == s] if len(shared) else at[:0])
    overlap = np.zeros((m, m), np.int32)
    label, links = np.arange(m), np.zeros(m, np.int64)
    for y in range(m):
        base = int(overlap[:y, y].argmax()) if y else -1
        if base >= 0 and size[base] + size[y] - 2 * overlap[base, y] < size[y] // 2:
            gone = np.setdiff1d(local[base], local[y], assume_unique=True)
            new = np.setdiff1d(local[y], local[base], assume_unique=True)
            overlap[y] = overlap[base] - lists(gone) + lists(new)
        else:
            overlap[y] = lists(local[y])
        both = overlap[y].astype(np.int64)
        linked = 100 * both >= 80 * (size[y] + size - both)
        linked[y] = False
        if cross:
            linked &= side != side[y]
        links[y] = weight[linked].sum()
        near = np.flatnonzero(linked[:y])
        if len(near):
            merged = np.unique(label[near])
            label[np.isin(label, merged)] = merged[0]
            label[y] = merged[0]
    if m > BLOCK // 2:
        del overlap, every, owner, sets
        memory_returned()
    return pa.table([sixteen(digest), sixteen(digest[label]), pa.array(links)], ["digest", "root", "links"])


def joined(docs: DataFrame, frequent: int = FREQUENT, frequent_max: int = FREQUENT_MAX, block: int = BLOCK, send_max: int = SEND_MAX, common: int = COMMON) -> DataFrame:
    """doc_id, n_shingles, component_id and n_links (documents that it is linked with, copies included) of every row."""
    return _joined(docs, frequent, frequent_max, block, send_max, common).drop("key")


def _joined(docs: DataFrame, frequent: int = FREQUENT, frequent_max: int = FREQUENT_MAX, block: int = BLOCK, send_max: int = SEND_MAX, common: int = COMMON) -> DataFrame:
    """As joined(), with the row's key."""
    spark = docs.sparkSession
    sets = written(_sets(docs), "sets")
    classes = sets.where("digest IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("least"), F.min("key").alias("rep"), F.count("*").alias("weight"), F.first("n_shingles").alias("n"), F.first("bits").alias("bits"))
    classes = written(classes, "classes")
    late = spark.sparkContext.broadcast(_frequent(sets, frequent, frequent_max))
    members = written(sets.select("doc_id", "key", "n_shingles", "digest"), "members")
    dropped(sets)

    lists = _sets(docs, late).where("digest IS NOT NULL").join(classes.select("digest", F.col("rep").alias("key")), ["digest", "key"], "left_semi")
    lists = lists.select(F.posexplode("prefix").alias("at", "token"), F.col("n_shingles").alias("n"), "digest", F.size("prefix").alias("p"))
    lists = lists.select("token", "n", "p", "at", "digest").repartition("token").sortWithinPartitions("token", "n", "at", "digest")
    found = lists.mapInArrow(_edges_of_lists, "u binary, v binary, need int, list long").groupBy("u", "v", "list").agg(F.count("*").alias("c"), F.min("need").alias("need"))
    found = written(found.where("list IS NOT NULL OR c >= need").select("u", "v", "list"), "found")
    bits = classes.select("digest", "n", "bits")
    long = found.where("list IS NOT NULL").select(F.col("u").alias("digest"), "list").join(bits, "digest")
    forest = long.groupBy("list").applyInArrow(lambda table: _forest(table), "u binary, v binary")
    few = found.where("list IS NULL").select("u", "v")
    for side in ("u", "v"):
        few = few.join(bits.select(F.col("digest").alias(side), F.col("n").alias(f"n_{side}"), F.col("bits").alias(f"bits_{side}")), side)
    at = [F.conv(F.substring(F.hex(F.col(f"bits_{side}")), 16 * k + 1, 16), 16, -10).cast("bigint") for k in range(BITS // 64) for side in ("u", "v")]
    apart = sum((F.bit_count(x.bitwiseXOR(y)) for x, y in zip(at[::2], at[1::2], strict=True)), F.lit(0))
    both = F.col("n_u") + F.col("n_v")
    few = few.where(apart <= both - 2 * F.floor((4 * both + 8) / 9)).select("u", "v")
    edges = written(few.unionAll(forest).distinct(), "edges")
    dropped(found)
    clusters = components(edges)
    dropped(edges)

    kinds = clusters.join(classes, clusters.node == classes.digest).select("digest", "label", "rep", "weight", "n", F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(1.25))).cast("int").alias("kind"))
    kinds = written(kinds, "clusters")
    sizes = kinds.groupBy("label", "kind").agg(F.count("*").alias("m"))
    total = sizes.groupBy("label").agg(F.sum("m").alias("all"), F.map_from_entries(F.collect_list(F.struct("kind", F.ceil(F.col("m") / block).cast("int")))).alias("blocks"))
    total = written(total, "totals")
    placed = kinds.join(F.broadcast(total) if total.count() <= send_max else total, "label")  # one row a cluster: a large cluster's sets stay where they are
    own = F.pmod(F.xxhash64("digest"), F.element_at("blocks", F.col("kind"))).cast("int")
    placed = placed.withColumn("own", own)

    def tasks(other_kind, name):
        n = F.coalesce(F.try_element_at("blocks", other_kind), F.lit(0))
        return F.transform(F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>")), name)

    k, b = F.col("kind"), F.col("own")
    same = tasks(k, lambda x: F.struct(k.alias("k1"), F.least(b, x).alias("b1"), k.alias("k2"), F.greatest(b, x).alias("b2"), (b > x).cast("int").alias("side")))
    above = tasks(k + 1, lambda x: F.struct(k.alias("k1"), b.alias("b1"), (k + 1).alias("k2"), x.cast("int").alias("b2"), F.lit(0).alias("side")))
    below = tasks(k - 1, lambda x: F.struct((k - 1).alias("k1"), x.cast("int").alias("b1"), k.alias("k2"), b.alias("b2"), F.lit(1).alias("side")))
    alone = F.array(F.struct(F.lit(-1).alias("k1"), F.lit(0).alias("b1"), F.lit(-1).alias("k2"), F.lit(0).alias("b2"), F.lit(0).alias("side")))
    placed = placed.select("digest", "label", "rep", "weight", F.when(F.col("all") <= block, alone).otherwise(F.concat(same, above, below)).alias("tasks"))
    placed = written(placed, "placed")
    size = placed.agg(F.count("*").alias("rows"), F.coalesce(F.sum(F.size("tasks")), F.lit(0)).alias("tasks")).first()
    if size["rows"] <= send_max and size["tasks"] <= 4 * send_max:
        placed = F.broadcast(placed)
    texts = _keyed(docs).select(F.col("key").alias("rep"), "text").join(placed, "rep")

    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["digest", "label", "weight", "tasks", "n", "tokens"]
        for batch in batches:
            for w in words(batch.column(0), lower=True):
                every = list(shingle_sets(w))
                fits = [len(s) > 0 and _digest(s) == d for s, d in zip(every, batch.column(1)[w.lo : w.hi].to_pylist(), strict=True)]
                rest = [batch.column(i)[w.lo : w.hi] for i in (1, 2, 3, 4)]
                out = pa.RecordBatch.from_arrays([*rest, pa.array([len(s) for s in every], pa.int32()), pa.array([s.tobytes() for s in every], pa.binary())], names)
                yield out.filter(pa.array(fits, pa.bool_()))
        memory_returned()

    kind = placed.schema["tasks"].dataType.simpleString()
    shipped = texts.select("text", "digest", "label", "weight", "tasks").mapInArrow(sets_of, f"digest binary, label binary, weight long, tasks {kind}, n int, tokens binary")
    shipped = shipped.select("digest", "label", "weight", "n", "tokens", F.explode("tasks").alias("t")).select("digest", "label", "weight", "n", "tokens", "t.*")
    answers = shipped.groupBy("label", "k1", "b1", "k2", "b2").applyInArrow(_answers, "digest binary, root binary, links long")
    answers = written(answers, "answers")
    label = components(answers.where("digest <> root").select(F.col("digest").alias("u"), F.col("root").alias("v")))
    links = answers.groupBy("digest").agg(F.sum("links").alias("links"))
    named = classes.join(label, classes.digest == label.node, "left").select("digest", "least", "weight", F.coalesce("label", "digest").alias("label"))
    first = named.groupBy("label").agg(F.min("least").alias("component_id"))
    named = named.join(first, "label").join(links, "digest", "left").select("digest", "weight", "component_id", (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).cast("bigint").alias("n_links"))
    named = written(named, "named")
    rows = classes.agg(F.coalesce(F.sum("weight"), F.lit(0))).first()[0]
    often = F.broadcast(named.where(F.col("weight") * common > rows))
    alone = members.where("digest IS NULL").withColumns({"component_id": F.col("doc_id"), "n_links": F.lit(0).cast("bigint")})
    known = members.where("digest IS NOT NULL")
    rest = known.join(often.select("digest"), "digest", "left_anti").join(named.where(F.col("weight") * common <= rows), "digest")
    out = [x.select("doc_id", F.col("n_shingles").cast("bigint").alias("n_shingles"), "component_id", "n_links", "key") for x in (alone, known.join(often, "digest"), rest)]
    return out[0].unionAll(out[1]).unionAll(out[2])


def one_of_each(docs: DataFrame, send_max: int = SEND_MAX) -> DataFrame:
    """The rows of docs, all columns, without those whose component has a smaller doc_id (or one at all, where theirs is null); a row goes for its own text, whatever other rows have
    its doc_id. Rows without words stay, and so do repeated rows of one id and text."""
    gone = _joined(docs, send_max=send_max).where("component_id < doc_id OR (doc_id IS NULL AND component_id IS NOT NULL)").select(F.col("key").alias("_gone")).distinct()
    gone = written(gone, "copies")
    return docs.join(F.broadcast(gone) if gone.count() <= send_max else gone, F.xxhash64("doc_id", "text") == F.col("_gone"), "left_anti")


def query(spark, sf_dir: str) -> DataFrame:
    return joined(spark.read.parquet(f"{sf_dir}/documents.parquet"))


#: The same by counting all common shingles and walking all links.
SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [hash(array_to_string(w, ' '))] ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: hash(array_to_string(w[i:i + 4], ' ')))) END AS g FROM d),
n AS (SELECT doc_id, len(g) AS n FROM s), e AS (SELECT doc_id, unnest(g) AS g FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM e a JOIN e b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
h AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * o >= 80 * (x.n + y.n - o)),
l AS (SELECT a, b FROM h UNION ALL SELECT b, a FROM h),
c AS (SELECT doc_id, doc_id AS root FROM n UNION SELECT l.b, c.root FROM c JOIN l ON l.a = c.doc_id),
m AS (SELECT doc_id, min(root) AS component_id FROM c GROUP BY doc_id), k AS (SELECT a AS doc_id, count(*) AS n_links FROM l GROUP BY a)
SELECT doc_id, n AS n_shingles, component_id, coalesce(n_links, 0) AS n_links FROM n JOIN m USING (doc_id) LEFT JOIN k USING (doc_id)
"""
