"""Substring removal and the Jaccard join, against brute force."""

import collections
import hashlib
import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from skyflux.llm import op03_substring_dedup as sub
from skyflux.llm import op07_jaccard_join as jac
from skyflux.llm.components import components
from skyflux.llm.fm_index import FMIndex, Minima, matched_windows
from skyflux.llm.text import shingle_sets, words

from .conftest import vocabulary


def cut(rows, window=50):
    """(n_words, n_removed, kept text) of each (doc_id, text)."""
    words = [(i, (t or "").encode().split()) for i, t in rows]
    first = {}
    for i, w in words:
        for k in range(len(w) - window + 1):
            s = tuple(w[k : k + window])
            first[s] = min(first.get(s, i), i)
    out = []
    for i, w in words:
        stay = [True] * len(w)
        for k in range(len(w) - window + 1):
            if first[tuple(w[k : k + window])] < i:
                stay[k : k + window] = [False] * window
        out.append((len(w), len(w) - sum(stay), b" ".join(x for x, s in zip(w, stay, strict=True) if s)))
    return out


def corpus(seed, n=60):
    rng = random.Random(seed)
    v = vocabulary(rng)
    shared = [[rng.choice(v) for _ in range(k)] for k in (49, 50, 51, 60, 120)]
    texts = []
    for _ in range(n):
        w = [rng.choice(v) for _ in range(rng.choice([0, 3, 49, 50, 80, 200, 400]))]
        for _ in range(rng.choice([0, 0, 1, 2])):
            p = rng.choice(shared)
            at = rng.randrange(len(w) + 1)
            w[at:at] = p[rng.randrange(3) :]
        texts.append(rng.choice([" ", "\n", "\t \x0b"]).join(w))
    texts += [texts[-1], texts[-1], texts[-2] + " tail", None, "", "word " * 300, "word " * 120, "a b " * 100, " ".join(["x"] * 80), "y " * 49]
    return texts


@pytest.mark.parametrize(("hot", "shard", "send"), [(4096, 4000, 500_000), (2, 5, 500_000), (4096, 3, 0)])
def test_substrings(docs_of, monkeypatch, hot, shard, send):
    monkeypatch.setattr(sub, "HOT", hot)
    monkeypatch.setattr(sub.repeated, "__defaults__", (shard, hot))
    monkeypatch.setattr(sub, "SEND_MAX", send)
    texts = corpus(hot + shard)
    ids = [(7 * i) % len(texts) * 3 - 20 if len(texts) % 7 else i for i in range(len(texts))]
    got = {r["doc_id"]: r for r in sub.digests(docs_of(texts, ids)).collect()}
    want = cut(list(zip(ids, texts, strict=True)))
    assert sum(x[1] for x in want) > 500
    for i, (n, gone, kept) in zip(ids, want, strict=True):
        assert (got[i]["n_words"], got[i]["n_removed"], got[i]["kept_sha256"]) == (n, gone, hashlib.sha256(kept).hexdigest()), i


def test_substring_edges(docs_of):
    assert sub.digests(docs_of([])).count() == 0
    long = " ".join(f"w{i}" for i in range(60_000))
    got = sub.digests(docs_of([long, "q " + long], ids=[2, 1])).orderBy("doc_id").collect()
    assert [r["n_removed"] for r in got] == [0, 60_000]
    got = sub.digests(docs_of([long, long, long], ids=[4, 4, None])).collect()
    assert len(got) == 3 and sum(r["n_removed"] for r in got) == 0


@pytest.mark.parametrize("n", [1, 15, 16, 17, 100, 1000])
def test_minima(n):
    rng = np.random.default_rng(n)
    values = rng.integers(0, 50, n).astype(np.int8)
    values[0] = values[-1] = -1
    m = Minima(values)
    lo = rng.integers(0, n, 500)
    hi = lo + 1 + rng.integers(0, n - lo)
    assert m.least(lo, hi).tolist() == [values[a:b].min() for a, b in zip(lo, hi, strict=True)]
    bound = rng.integers(0, 50, 500)
    assert m.below(lo, bound, False).tolist() == [int(np.flatnonzero(values[: a + 1] < b)[-1]) for a, b in zip(lo, bound, strict=True)]
    assert m.below(lo, bound, True).tolist() == [int(a + np.flatnonzero(values[a:] < b)[0]) for a, b in zip(lo, bound, strict=True)]


@pytest.mark.parametrize("seed", range(8))
def test_fm_index(seed):
    rng = np.random.default_rng(seed)
    window, sigma = int(rng.integers(2, 9)), int(rng.integers(1, 6))
    seqs = [rng.integers(0, sigma, rng.integers(1, 40)) for _ in range(int(rng.integers(1, 50)))]
    owner = rng.integers(0, 10, len(seqs))
    lengths, symbols = np.array([len(s) for s in seqs]), np.concatenate(seqs)
    index = FMIndex(symbols, lengths, owner)
    text = "".join(chr(97 + x) for x in seqs[0])
    c = index.wavelet.walk(np.array([1]), np.array([index.n]))
    assert c[0] >= 0 and text
    first = {}
    for s, o in zip(seqs, owner, strict=True):
        for i in range(len(s) - window + 1):
            first[tuple(s[i : i + window])] = min(first.get(tuple(s[i : i + window]), 99), o)
    want = [i + window <= len(s) and first[tuple(s[i : i + window])] < o for s, o in zip(seqs, owner, strict=True) for i in range(len(s))]
    assert matched_windows(index, symbols, lengths, owner, window).tolist() == want


def sets(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4)))


def linked(rows):
    s = [sets(t) for _, t in rows]
    n = len(rows)
    up, links = list(range(n)), [0] * n

    def find(a):
        while up[a] != a:
            a = up[a]
        return a

    order = sorted(range(n), key=lambda i: rows[i][0])
    for x, i in enumerate(order):
        for j in order[:x]:
            both = len(s[i] & s[j])
            if s[i] and s[j] and 100 * both >= 80 * (len(s[i]) + len(s[j]) - both):
                links[i] += 1
                links[j] += 1
                a, b = find(i), find(j)
                if a != b:
                    lo, hi = sorted((a, b), key=lambda k: rows[k][0])
                    up[hi] = lo
    return [(len(s[i]), rows[find(i)][0], links[i]) for i in range(n)]


def near_corpus(seed, groups=12):
    rng = random.Random(seed)
    v = vocabulary(rng)
    line = [rng.choice(v) for _ in range(40)]
    texts = [None, "", "one", "ONE", "one two", "One TWO", "a b c d e", "a b c d e f", "x " * 50, "x " * 9]
    for _ in range(groups):
        base = [rng.choice(v) for _ in range(rng.choice([6, 20, 60, 150]))] + (line if rng.random() < 0.6 else [])
        for _ in range(rng.choice([1, 2, 5, 14])):
            w = list(base)
            for _ in range(rng.randrange(5)):
                k = rng.randrange(len(w))
                rng.choice([lambda: w.__setitem__(k, rng.choice(v)), lambda: w.pop(k), lambda: w.insert(k, rng.choice(v))])()
            texts.append(" ".join(w).upper() if rng.random() < 0.2 else "\n".join(w))
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize(("frequent", "block", "send", "common"), [(32, 1024, 2_000_000, 1000), (3, 4, 0, 1), (2, 3, 2_000_000, 60)])
def test_jaccard(docs_of, monkeypatch, frequent, block, send, common):
    monkeypatch.setattr(jac, "FREQUENT", frequent)
    texts = near_corpus(frequent)
    ids = [5 * i - 30 for i in range(len(texts))]
    got = {r["doc_id"]: tuple(r)[1:] for r in jac.joined(docs_of(texts, ids), frequent, 1_000_000, block, send, common).collect()}
    want = linked(list(zip(ids, texts, strict=True)))
    assert sum(w[2] for w in want) > 50
    assert [got[i] for i in ids] == want


def test_jaccard_edges(docs_of):
    assert jac.joined(docs_of([])).count() == 0
    assert jac.joined(docs_of([None, ""])).count() == 2
    got = jac.joined(docs_of(["a b c d e f", "a b c d e f", "g"], ids=[3, 3, 1])).orderBy("doc_id").collect()
    assert [tuple(r) for r in got] == [(1, 1, 1, 0), (3, 2, 3, 1), (3, 2, 3, 1)]
    kept = jac.one_of_each(docs_of(["p q r s t u v", "p q r s t u v", "z"])).collect()
    assert sorted(r["doc_id"] for r in kept) == [0, 2] and kept[0]["digest"] == 1


def test_few_frequent_shingles_may_be_sent(docs_of, monkeypatch):
    monkeypatch.setattr(jac, "FREQUENT", 2)
    texts = near_corpus(5)
    got = {r["doc_id"]: tuple(r)[1:] for r in jac.joined(docs_of(texts), 2, 10).collect()}
    want = linked(list(enumerate(texts)))
    assert [got[i] for i in range(len(texts))] == want


def alike(k, n=1024):
    """Two words that are one under hashes with powers of a number: abba baab..., and the same with a and b changed."""
    w = "".join("ab"[bin(i).count("1") % 2] for i in range(n))
    return [w, w.translate(str.maketrans("ab", "ba"))][k]


@pytest.mark.parametrize("n", [1024, 4096])
def test_words_that_poor_hashes_take_for_one(docs_of, n):
    rng = random.Random(7)
    body = [rng.choice(vocabulary(rng)) for _ in range(60)]
    texts = [" ".join([*body[:30], alike(k, n), *body[30:]]) for k in (0, 1)] + [" ".join(alike(k, n) for _ in range(60)) for k in (0, 1)]
    got = sub.digests(docs_of(texts)).orderBy("doc_id").collect()
    assert [r["n_removed"] for r in got] == [0, 0, 0, 0]
    a, b = ([alike(bin(i).count("1") % 2 ^ k, 4) for i in range(1024)] for k in (0, 1))  # the same with words for letters
    texts = [" ".join(x) for x in ([*(f"x{i}" for i in range(9)), alike(0, n)], [*(f"x{i}" for i in range(9)), alike(1, n)], [alike(0, n)], [alike(1, n)], a[:90], b[:90])]
    rows = list(enumerate(texts))
    got = {r["doc_id"]: tuple(r)[1:] for r in jac.joined(docs_of(texts)).collect()}
    assert [got[i] for i in range(len(texts))] == linked(rows)
    got = {r["doc_id"]: r["n_removed"] for r in sub.digests(docs_of([" ".join(a), " ".join(b)])).collect()}
    assert [got[i] for i in (0, 1)] == [x[1] for x in cut([(0, " ".join(a)), (1, " ".join(b))])]


def test_words_take_little_memory():
    """A batch of 4 MB takes a small part of it at a time, and the sets don't depend on the parts."""
    rng = random.Random(4)
    v = vocabulary(rng)
    texts = pa.array([" ".join(rng.choices(v, k=500)) for _ in range(1400)])
    tracemalloc.start()
    n = sum(len(w.hash) for w in words(texts))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 500 * len(texts) and peak < 24 << 20
    for few in (texts[:7], pa.array(["a b", None, "", *texts[:3].to_pylist()])):
        each = [[s.tolist() for w in words(few, chunk_bytes=size) for s in shingle_sets(w)] for size in (1, 4000, 1 << 20)]
        assert each[0] == each[1] == each[2] and len(each[0]) == len(few)


def test_repeated_and_null_ids(docs_of):
    """Rows of one id are told apart by their texts; rows without an id are linked like others."""
    rng = random.Random(3)
    v = vocabulary(rng)
    one, other = ([rng.choice(v) for _ in range(90)] for _ in range(2))
    near = " ".join([*one[:89], "end"])
    one, other = " ".join(one), " ".join(other)
    docs = docs_of([one, near, other, near, None, None, other + " x"], ids=[1, 5, 5, None, None, 7, None])
    got = sorted((tuple(r) for r in jac.joined(docs).collect()), key=str)
    n = 86
    assert got == sorted([(1, n, 1, 2), (5, n, 1, 2), (5, n, 5, 1), (None, n, 1, 2), (None, 0, None, 0), (7, 0, 7, 0), (None, n + 1, 5, 1)], key=str)
    kept = sorted(((r["doc_id"], r["text"]) for r in jac.one_of_each(docs).collect()), key=str)
    assert kept == sorted([(1, one), (5, other), (None, None), (7, None)], key=str)
    passage = " ".join(rng.choice(v) for _ in range(60))
    a, b = passage + " " + " ".join(rng.choice(v) for _ in range(80)), " ".join(rng.choice(v) for _ in range(140))
    cuts = {(r["doc_id"], r["n_removed"]) for r in sub.digests(docs_of([passage, a, b], ids=[1, 5, 5])).collect()}
    assert cuts == {(1, 0), (5, 60), (5, 0)}


def test_blocks_skip_no_link():
    """Pairs of rows of equal lists from blocks: all that sizes and positions allow, and no other."""
    rng = np.random.default_rng(1)
    token, n = rng.integers(0, 6, 60), rng.integers(5, 40, 60)
    at = (rng.random(60) * (n - (4 * n + 4) // 5 + 1)).astype(np.int64)
    order = np.lexsort((at, n, token))
    token, n, at = token[order], n[order], at[order]
    x, y = jac._block_pairs(token, n, at)
    want = {(i, j) for i in range(60) for j in range(i + 1, 60) if token[i] == token[j] and 5 * n[i] >= 4 * n[j] and 1 + min(at[i], at[j]) + min(n[i] - at[i], n[j] - at[j]) - 1 >= -(-4 * (n[i] + n[j]) // 9)}
    assert set(zip(x.tolist(), y.tolist(), strict=True)) == want and len(x) == len(want) > 20


def test_long_paths_take_few_rounds(spark, monkeypatch):
    from skyflux.llm import components as module

    made, plain = [], module.written
    monkeypatch.setattr(module, "written", lambda df, label: (made.append(label), plain(df, label))[1])
    path = spark.range(10_000).selectExpr("id AS u", "id + 1 AS v")
    assert components(path).select("label").distinct().count() == 1 and made.count("labels") <= 20


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5000, 5000 + i) for i in range(50)]
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    up = {}

    def find(a):
        while up.setdefault(a, a) != a:
            a = up[a]
        return a

    for a, b in edges:
        if a != b:
            up[find(a)] = find(b)
    of = collections.defaultdict(set)
    for n, label in got.items():
        of[label].add(find(n))
    assert all(len(x) == 1 for x in of.values()) and len({find(n) for n in got}) == len(of)
    assert set(got) == {x for e in edges if e[0] != e[1] for x in e}


def test_lists_of_a_common_passage(spark, monkeypatch):
    """Sets that share a common passage only stay apart; every linked pair of a list is connected, also over tiles; rows that stand there twice don't matter."""
    monkeypatch.setattr(jac, "TILE", 16)
    rng = np.random.default_rng(5)
    passage, sets = rng.integers(0, 2**64, 8, dtype=np.uint64), []
    for _ in range(60):
        own = rng.integers(0, 2**64, int(rng.integers(20, 60)), dtype=np.uint64)
        for _ in range(int(rng.integers(1, 4))):
            sets.append(np.unique(np.concatenate([passage, own])))
            own = np.concatenate([own[2:], rng.integers(0, 2**64, 2, dtype=np.uint64)])
    table = pa.table({"digest": [jac._digest(s) for s in sets], "n": [len(s) for s in sets], "bits": [jac._bitmap(s).tobytes() for s in sets]})
    table = pa.concat_tables([table, table.slice(0, 5)])
    forest = {d: d for d in table.column("digest").to_pylist()}

    def root(d):
        while forest[d] != d:
            d = forest[d]
        return d

    for u, v in zip(*jac._forest(table).to_pydict().values(), strict=True):
        forest[root(u)] = root(v)
    digest, linked = table.column("digest").to_pylist(), 0
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            both = len(np.intersect1d(a, b))
            if 100 * both >= 80 * (len(a) + len(b) - both):
                linked += 1
                assert root(digest[i]) == root(digest[j])
    assert linked > 30 and len({root(d) for d in digest}) > 40
    d = [jac._bitmap(s) for s in sets[:20]]
    rows = spark.createDataFrame([(bytearray(x.tobytes()),) for x in d], "b binary")
    half = [F.conv(F.substring(F.hex("b"), 16 * k + 1, 16), 16, -10).cast("bigint") for k in range(4)]
    ours = [r[0] for r in rows.select(sum((F.bit_count(x.bitwiseXOR(F.lit(5))) for x in half), F.lit(0))).collect()]
    assert ours == [sum(bin((int.from_bytes(x.tobytes()[8 * k : 8 * k + 8], "big")) ^ 5).count("1") for k in range(4)) for x in d]
