"""Toxicity, decontamination, packing, quality and the pipeline."""

import collections
import math
import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql.pandas.group_ops import PandasCogroupedOps

from skyflux.llm import op01_toxicity as tox
from skyflux.llm import op05_decontamination as dec
from skyflux.llm import op09_packing as pack
from skyflux.llm import op10_quality as qual

from .conftest import vocabulary


@pytest.fixture(scope="module")
def toxic(spark):
    """Texts of invented words, every sixth with words of a list."""
    rng = random.Random(3)
    v, bad = vocabulary(rng, 300), ["idiot", "moronic", "scumbag", "pathetic", "loserish"]
    rows = []
    for i in range(600):
        w = [rng.choice(v) for _ in range(rng.randrange(20, 200))]
        if i % 6 == 0:
            for _ in range(1 + len(w) // 40):
                w[rng.randrange(len(w))] = rng.choice(bad)
        rows.append((i, " ".join(w), int(i % 6 == 0)))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    return df, tox.trained(df, df.where("doc_id % 5 <> 0").select("doc_id", "toxic"))


def test_held_out(toxic):
    df, model = toxic
    got = tox.scored(df.withColumn("score", F.lit("x")), model).join(df.select("doc_id", "toxic"), "doc_id").where("doc_id % 5 = 0").toPandas()
    assert ((got.predicted == 1) == (got.toxic == 1)).mean() > 0.97 and got.score.between(0, 1).all()


@pytest.mark.parametrize("word", ["1d10t", "iiidiot", "i.d.i.o.t", "I D I O T", "!diot", "id!0t", "p4th3t1c", "sc_um_b4g", "IDIOT"])
def test_restored(docs_of, toxic, word):
    _, model = toxic
    score = tox.scored(docs_of([f"abcde fghij {word} bcdea"]), model).first()
    plain = tox.scored(docs_of(["abcde fghij bcdea"]), model).first()
    assert score["predicted"] == 1 and plain["predicted"] == 0 and score["score"] > plain["score"]


@pytest.mark.parametrize("word", ["i" * 60 + "diot", "i" + "-" * 60 + "d-i-o-t", "I " * 50 + "D I O T", "i.-" * 30 + "d10t", "1" * 50 + "d10t"])
def test_long_stretches(docs_of, toxic, word):
    """A cue stretched to any length."""
    assert tox.scored(docs_of([f"abcde fghij {word} bcdea"]), toxic[1]).first()["predicted"] == 1


@pytest.mark.parametrize("word", ["j i h g f i d i o t", "fghij,1d10t", "fghij_1d10t", "(1d10t)", "1d10t!", "!1d10t", "idi07", "id107", "a.b.c.d.e i.d.i.o.t"])
def test_words_of_a_reading(docs_of, toxic, word):
    """Word borders within a stretch, signs that stand for nothing, and signs at a word's end."""
    got = tox.scored(docs_of([f"abcde fghij {word} bcdea", "abcde fghij idiot! bcdea", "abcde fghij idiot bcdea"]), toxic[1]).orderBy("doc_id").collect()
    assert got[0]["predicted"] == 1 and [x[:5] for x in got[0]["restored"]] == ["idiot"]
    assert got[1]["score"] == got[2]["score"] and got[1]["restored"] == []


@pytest.mark.parametrize("text", ["you are a i d i o t", "y o u i d i o t", "you,1d10t", "you_1d10t", "w e t o l d t h e m t h a t y o u a r e a b i g i d i o t a n d h e i s a f o o l"])
def test_borders_in_prose(docs_of, toxic, text):
    """With trigrams of prose, which has words of one letter."""
    prose = "you are a big dog and he is a fool so we told them that you are an idiot and a cat sat on the mat but i did not see it"
    model = tox.Model(tox.letter_trigrams(docs_of([prose] * 50)), {int(h): w for h, w in zip(toxic[1].stems.view(np.int64), toxic[1].weights, strict=True)}, toxic[1].every, toxic[1].prior)
    got = tox.scored(docs_of([text]), model).first()
    assert got["predicted"] == 1 and got["restored"] == ["idiot"]


@pytest.mark.parametrize("text", ["a$$", "4$$", "5h1", "bull5", "k i ll", "x" + "-y" * 60, "id i o t", "€x"])
def test_what_is_decoded(text):
    for t in (text, f"abc {text}", f"{text} abc"):
        w = next(tox.words(tox.pa.array(["we", t, "know"])))
        spans = [(int(r), w.raw[a:b].tobytes().decode()) for r, a, b in zip(*tox.suspicious(w), strict=True)]
        assert spans == [(1, text)]
    w = next(tox.words(tox.pa.array(["bull", "5", "x", "i", "ll", "a.", "b"])))
    assert [w.raw[a:b].tobytes() for _, a, b in zip(*tox.suspicious(w), strict=True)] == [b"5"]


def test_scores_do_not_depend_on_neighbours(spark, docs_of, toxic):
    """Under any order, partitioning, batch size and company."""
    rng = random.Random(0)
    texts = [f"{a} {b}" for a in ("we", "a", "1", "", "k i") for b in ("bull5", "idi0t", "ll", "i d", "idiot", "!!", "5")] * 2
    docs = docs_of(texts)
    want = {r["doc_id"]: r["score"] for r in tox.scored(docs.coalesce(1), toxic[1]).collect()}
    assert len({want[i] == want[i + len(texts) // 2] for i in range(len(texts) // 2)}) == 1 and len(set(want.values())) > 3
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3)
    try:
        rows = docs.collect()
        rng.shuffle(rows)
        got = {r["doc_id"]: r["score"] for r in tox.scored(spark.createDataFrame(rows, docs.schema).repartition(5), toxic[1]).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == want
    alone = {i: tox.scored(docs.where(f"doc_id = {i}"), toxic[1]).first()["score"] for i in (0, 9, 17)}
    assert alone == {i: want[i] for i in alone}
    a, b = (tox.letter_trigrams(docs.coalesce(1)), tox.letter_trigrams(docs.repartition(7)))
    np.testing.assert_array_equal(a, b)


def test_score_by_plain_code(docs_of, toxic):
    """The whole score, for texts without anything to restore, from the model's weights by stem."""
    import re

    _, model = toxic
    rng = random.Random(12)
    v = [*vocabulary(rng, 50), "idiot", "Idiots", "MORONIC", "scumbag", "pathetic", "élan", "Ärger"]
    texts = [" ".join(rng.choice(v) + rng.choice(["", ",", ".", "\n"]) for _ in range(rng.randrange(0, 60))) for _ in range(40)] + [None, ""]
    stem_of = lambda t: int(next(tox._stems(tox.pa.array([t]))).hash[0].view(np.int64))
    weights = dict(zip(model.stems.view(np.int64).tolist(), model.weights.tolist(), strict=True))
    got = {r["doc_id"]: r["score"] for r in tox.scored(docs_of(texts), model).collect()}
    for i, t in enumerate(texts):
        found = re.findall(r"[A-Za-z\u0080-\U0010FFFF]+", t or "")
        counts = collections.Counter(stem_of(x[: tox.STEM]) for x in found)
        logit = model.prior + tox.DAMPED * (model.every * len(found) + sum(weights[s] * math.log2(1 + c) for s, c in counts.items() if s in weights))
        assert got[i] == pytest.approx(1 / (1 + math.exp(-logit))), t


def test_viterbi_finds_the_best_path():
    """Against all readings of a lattice, by cost."""
    model = tox.letter_trigrams_of = np.log(np.random.default_rng(0).dirichlet(np.ones(28), (28, 28)))

    def cost(options):
        best = {}

        def go(i, a, b, last, c, text):
            if i == len(options):
                total = c - model[a, b, 0]
                best[text] = min(best.get(text, math.inf), total)
                return
            s = options[i]
            for x, more in ([(s, 0.0)] if s.isalpha() else []) + [(x, tox.COST["imitates"]) for x in tox.IMITATES.get(s, "")]:
                k = tox._class(x)
                go(i + 1, b, k, x, c + more + (tox.COST["twice"] if x == last else 0) - model[a, b, k], text + x)
                if x == last:
                    go(i + 1, a, b, last, c + more + tox.COST["again"], text)
            if s in tox.SEPARATORS:
                go(i + 1, a, b, last, c + tox.COST["nothing"], text)

        go(0, 0, 0, "", 0.0, "")
        return sorted(best, key=best.get)

    for word in ("1d10t", "aab1", "x.y1", "l0l1", "33e"):
        assert tox.restored(word, model, beam=500, readings=1)[0] == next(t for t in cost(word) if t)


def test_toxicity_edges(spark, docs_of, toxic):
    df, model = toxic
    got = tox.scored(docs_of([None, "", "!!! 111", "\x00\udcff".encode("utf-8", "replace").decode(), "1" * 100_000, "a " * 50_000, "é" * 10]), model).toPandas()
    assert len(got) == 7 and got.score.between(0, 1).all()
    assert tox.scored(docs_of([]), model).count() == 0
    none = tox.trained(df, df.limit(0).select("doc_id", "toxic"))
    assert tox.scored(df.limit(3), none).where("score <> 0").count() == 0
    one_sided = tox.trained(df, df.select("doc_id", F.lit(0).alias("toxic")))
    assert tox.scored(df.limit(3), one_sided).where("predicted = 1").count() == 0


def least_edits(item, text):
    """The smallest number of word edits that turn item into some part of text."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        before, row[0] = row[0], i
        for j, b in enumerate(text, 1):
            before, row[j] = row[j], min(before + (a != b), row[j] + 1, row[j - 1] + 1)
    return min(row)


def test_myers():
    rng = random.Random(0)
    for _ in range(300):
        m = rng.randrange(1, 80)
        item = [rng.randrange(6) for _ in range(m)]
        text = [rng.randrange(6) for _ in range(rng.randrange(0, 120))]
        bits = collections.defaultdict(int)
        for i, x in enumerate(item):
            bits[x] |= 1 << i
        found = dec.myers(dict(bits), m, text, m)
        assert min((d for _, d in found), default=m) == min(least_edits(item, text), m)


@pytest.mark.parametrize("block", [20_000, 3])
def test_decontamination(spark, docs_of, block):
    rng = random.Random(1)
    v = vocabulary(rng, 60)
    items = [[rng.choice(v) for _ in range(m)] for m in (1, 4, 5, 9, 16, 38, 59, 130)]
    texts = [None, ""]
    for _ in range(150):
        w = [rng.choice(v) for _ in range(rng.randrange(0, 120))]
        part = list(rng.choice(items))
        for _ in range(rng.randrange(0, len(part) // 4 + 2)):
            k = rng.randrange(len(part))
            rng.choice([lambda: part.__setitem__(k, rng.choice(v)), lambda: part.insert(k, rng.choice(v)), lambda: len(part) > 1 and part.pop(k)])()
        at = rng.randrange(len(w) + 1)
        w[at:at] = part
        texts.append(" ".join(w).upper() if rng.random() < 0.3 else "\n".join(w))
    table = spark.createDataFrame([(i, " ".join(t).title(), 1) for i, t in enumerate(items)] + [(98, None, 1), (99, "", 1)], "item_id long, text string, distance int")
    docs = docs_of(texts)
    got = {(r["doc_id"], r["item_id"]): r["distance"] for r in dec.matched(docs, table, block=block).orderBy(F.desc("distance")).collect()}
    want = {}
    for i, t in enumerate(texts):
        for j, item in enumerate(items):
            d = least_edits(item, (t or "").lower().split())
            if d <= int(dec.RATIO * len(item)):
                want[i, j] = d
    assert got == want and len(want) > 100
    left = {r["doc_id"] for r in dec.clean(docs, table).collect()}
    assert left == set(range(len(texts))) - {i for i, _ in want}
    assert dec.clean(docs, table).columns == docs.columns
    assert dec.matched(docs, table.limit(0)).count() == 0 and dec.matched(docs.limit(0), table).count() == 0


def occurrences(item, text, k):
    """(end, distance) by the whole table of edit distances: an end replaces the one kept before it if both can't be occurrences side by side and it is better."""
    above = list(range(len(item) + 1))
    out = []
    for j, word in enumerate(text):
        row = [0]
        for i, x in enumerate(item):
            row.append(min(above[i] + (x != word), above[i + 1] + 1, row[i] + 1))
        above = row
        if row[-1] > k:
            continue
        if out and j - out[-1][0] < len(item) - k:
            out[-1] = min(out[-1], (j, row[-1]), key=lambda x: (x[1], x[0]))
        else:
            out.append((j, row[-1]))
    return out


def test_every_occurrence(spark, docs_of):
    rng = random.Random(4)
    v = vocabulary(rng, 12)
    items = [[v[0], v[1]] * 5, [rng.choice(v) for _ in range(20)], [rng.choice(v) for _ in range(70)], [v[2]]]
    texts = [None, "", " ".join(items[0] * 3), " ".join(items[1] * 3), " ".join(items[0] + [v[3]] * 3 + items[0]), " ".join(["x"] * 20_000 + items[2] + ["y"] * 20_000 + items[2])]
    for _ in range(60):
        w = []
        for _ in range(rng.randrange(1, 5)):
            part = list(rng.choice(items))
            for _ in range(rng.randrange(0, len(part) // 6 + 1)):
                part[rng.randrange(len(part))] = rng.choice(v)
            w += part + [rng.choice(v) for _ in range(rng.choice([0, 0, 3, 30]))]
        texts.append(" ".join(w))
    texts += [texts[-1], texts[-2]]
    ids = [*range(len(texts) - 3), 7, 7, None]  # repeated rows and a null id
    table = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(items)], "item_id long, text string")
    want = collections.Counter()
    for i, t in zip(ids, texts, strict=True):
        for j, item in enumerate(items):
            want.update((i, j, d, end) for end, d in occurrences(item, (t or "").split(), int(dec.RATIO * len(item))))
    got = collections.Counter((r["doc_id"], r["item_id"], r["distance"], r["last_word"]) for r in dec.matched(docs_of(texts, ids), table).collect())
    assert got == want
    assert sum(1 for i, j, *_ in want if (i, j) == (2, 0)) == 3 == sum(1 for i, j, *_ in want if (i, j) == (3, 1))


def plain_best_fit(items, capacity, per_source):
    bins, out = [], []
    for size, source, cluster in items:
        fits = [(b["room"], i) for i, b in enumerate(bins) if b["room"] >= size and b["s"][source] < per_source and cluster not in b["c"]]
        if fits:
            i = min(fits)[1]
        else:
            i = len(bins)
            bins.append({"room": capacity, "s": collections.Counter(), "c": set()})
        b = bins[i]
        out.append((i, capacity - b["room"]))
        b["room"] -= size
        b["s"][source] += 1
        b["c"].add(cluster)
    return out


@pytest.mark.parametrize("seed", range(5))
def test_best_fit(seed):
    rng = random.Random(seed)
    items = sorted([(rng.randrange(0, 60), rng.choice([0, 0, 0, 1, 2, 3]), rng.randrange(40)) for _ in range(400)], key=lambda x: -x[0])
    got = pack.best_fit([x[0] for x in items], [x[1] for x in items], [x[2] for x in items], 100, 2)
    assert got == plain_best_fit(items, 100, 2)


def test_packing(docs_of):
    rng = random.Random(9)
    v = vocabulary(rng)
    texts = [None, "", "same text here", "SAME  text\nhere", "w " * 5000] + [" ".join(rng.choice(v) for _ in range(rng.randrange(1, 900))) for _ in range(300)]
    docs = docs_of(texts, source=["hot" if rng.random() < 0.4 else f"s{rng.randrange(9)}" for _ in texts])
    out = pack.pack_documents(docs, group_rows=100).toPandas()
    words = [len((t or "").split()) for t in texts]
    assert out.groupby("doc_id").n_words.sum().tolist() == words
    for _, g in out.groupby("bin"):
        assert g.n_words.sum() <= pack.CAPACITY and g.source.value_counts().max() <= pack.PER_SOURCE
        assert (g.n_words == pack.CAPACITY).any() or g.cluster.is_unique
        g = g.sort_values(["bin_offset", "n_words"])
        assert (g.bin_offset + g.n_words).tolist()[:-1] == g.bin_offset.tolist()[1:] or g.n_words.eq(0).any()
    assert out.n_words.sum() / (out.bin.nunique() * pack.CAPACITY) > 0.5
    assert pack.pack_documents(docs_of([])).count() == 0
    assert pack.pack_documents(docs_of(["a b"] * 3, ids=[1, 1, 1], source=[None] * 3)).select("bin").distinct().count() == 3


def kneser_ney(texts, n=qual.ORDER):
    """Probability of the last of n characters after the others, by dictionaries and the recursive definition."""
    grams = [collections.Counter() for _ in range(n + 1)]
    for t in texts:
        s = chr(qual.BEFORE) * (n - 1) + t
        grams[n].update(s[i - n + 1 : i + 1] for i in range(n - 1, len(s)))
    for k in range(n - 1, 0, -1):
        grams[k].update(g[1:] for g in grams[k + 1])
    discounts, follow = [None], collections.defaultdict(list)
    for k in range(1, n + 1):
        c = collections.Counter(grams[k].values())
        y = c[1] / (c[1] + 2 * c[2]) if c[1] else 0
        discounts.append([0, *[min(i, max(0.0, i - (i + 1) * y * c[i + 1] / c[i])) for i in (1, 2, 3)]] if all(c[i] for i in (1, 2, 3, 4)) else [0, 0.5, 1.0, 1.5])
        for g, c in grams[k].items():
            follow[g[:-1], k].append(c)

    def p(g):
        k = len(g)
        if not k:
            return 1 / qual.CODE_POINTS
        counts = follow[g[:-1], k]
        if not counts:
            return p(g[1:])
        d, c = discounts[k], grams[k][g]
        return (max(c - d[min(c, 3)], 0) + sum(d[min(x, 3)] for x in counts) * p(g[1:])) / sum(counts)

    return p


def perplexity(p, text, n=qual.ORDER):
    s = chr(qual.BEFORE) * (n - 1) + text
    return math.exp(-sum(math.log(p(s[i - n + 1 : i + 1])) for i in range(n - 1, len(s))) / len(text))


@pytest.fixture(scope="module")
def scripts(spark, docs_of):
    """Texts of two languages and three scripts, null, empty and repeated ones, and their folds."""
    rng = random.Random(8)
    v = [*vocabulary(rng, 25), "тест", "слово", "書物", "1999", "2024", "😀", "naïve"]
    texts = [" ".join(rng.choice(v) for _ in range(rng.randrange(1, 30))) for _ in range(60)] + ["слово новое", "аааа  2025\nтест", "é", "\x00a", None, "", " "]
    docs = docs_of(texts)
    docs = docs.unionAll(docs.where("doc_id = 41")).withColumn("lang", F.expr("CASE WHEN doc_id % 7 = 0 THEN NULL WHEN doc_id % 2 = 0 THEN 'en' ELSE 'xx' END"))
    fold = {r[0]: r[1] for r in docs.select("doc_id", F.pmod(F.xxhash64("text"), F.lit(2))).collect()}
    return texts, docs, fold


@pytest.mark.parametrize(("block", "chunk", "send"), [(1 << 20, 1 << 20, 1000), (400, 100, 0)])
def test_perplexity(spark, scripts, monkeypatch, block, chunk, send):
    """Each text under the model of the other fold's trusted texts, by the recursive definition; in one block and in many."""
    monkeypatch.setattr(qual, "CHUNK", chunk)
    texts, docs, fold = scripts
    ids = spark.createDataFrame([(i,) for i in range(40)], "doc_id long")
    got = collections.defaultdict(list)
    for r in qual.perplexities(docs.repartition(3, "doc_id"), ids, ["doc_id"], block, send).collect():
        got[r["doc_id"]].append(r)
    p = [kneser_ney([t for i, t in enumerate(texts[:40]) if fold[i] != f]) for f in (0, 1)]
    assert len(got) == len(texts) and len(got[41]) == 2
    for i, t in enumerate(texts):
        for r in got[i]:
            assert r["trusted"] == (i < 40) and r["n_chars"] == len(t or "")
            assert r["perplexity"] == (pytest.approx(perplexity(p[fold[i]], t), rel=1e-4) if t else None), t


@pytest.mark.parametrize("n", [0, 1, 2, 3, 1000, 4096])
def test_lookup(n):
    """Places in a sorted table, also of hashes before, between and behind its own, and where many share their first bits."""
    rng = np.random.default_rng(n)
    for table in (rng.integers(0, 2**64, n, dtype=np.uint64), np.arange(n, dtype=np.uint64), 2**64 - 1 - np.arange(n, dtype=np.uint64)):
        table = np.unique(table)
        asked = np.concatenate([rng.permutation(table), rng.integers(0, 2**64, 50, dtype=np.uint64), np.array([0, 2**64 - 1], np.uint64)])
        at = qual._lookup(table)(asked)
        assert at[: len(table)].tolist() == np.searchsorted(table, asked[: len(table)]).tolist()
        assert (at >= 0).all() and (at < max(1, len(table))).all()


def _texts(n, rows=1, fold=0, size=3000):
    """Batches of n times `rows` random texts with a great many n-grams, as the counting and the packing get them."""
    rng = np.random.default_rng(3)
    for _ in range(n):
        texts = ["".join(map(chr, rng.integers(0x61, 0x7B, size))) for _ in range(rows)]
        yield pa.RecordBatch.from_arrays([pa.array(texts), pa.array([True] * rows), pa.array([fold] * rows, pa.int32()), pa.array([0] * rows, pa.int32())], ["text", "trusted", "fold", "block"])


def test_counting_holds_few_ngrams(monkeypatch):
    """The n-grams of a task aren't all held; what it gives in parts adds up to the same counts."""
    monkeypatch.setattr(qual, "MERGE", 60_000)
    peaks = []
    for n in (10, 50):
        tracemalloc.start()
        total, parts = 0, 0
        for batch in qual._counted(_texts(n, rows=10)):
            total, parts = total + sum(batch.column("c0").to_pylist()), parts + 1
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
        assert total == n * 10 * 3000 and parts > 1
    assert peaks[1] < 1.2 * peaks[0]
    got, want = collections.Counter(), collections.Counter()
    monkeypatch.setattr(qual, "MERGE", 500)
    for batch in qual._counted(_texts(5, rows=2, size=400)):
        for g, c in zip(batch.column("g").to_pylist(), batch.column("c0").to_pylist(), strict=True):
            got[g] += c
    for batch in _texts(5, rows=2, size=400):
        for t in batch.column("text").to_pylist():
            s = chr(qual.BEFORE) * (qual.ORDER - 1) + t
            want.update(s[i : i + qual.ORDER] for i in range(len(t)))
    assert got == want


def test_scores_do_not_keep_texts(spark, docs_of, monkeypatch):
    """What a block's task keeps until it ends is its rows' scores, not the texts that they stood beside."""
    found = []
    monkeypatch.setattr(PandasCogroupedOps, "applyInArrow", lambda self, run, schema: found.append(run) or spark.createDataFrame([], schema))
    qual.perplexities(docs_of(["abc"]), spark.createDataFrame([], "doc_id long"), ["doc_id"])
    batch = next(_texts(1, rows=300))
    rows = pa.RecordBatch.from_arrays([pa.array(range(300)), *[batch.column(c) for c in ("trusted", "fold", "text", "block")]], ["c0", "trusted", "fold", "text", "block"])
    known = pa.Table.from_batches(list(qual._counted(iter([batch])))).select(["g"])
    known = known.append_column("l0", pa.array(np.full(len(known), -2.0, np.float32))).append_column("l1", pa.array(np.full(len(known), -1.0, np.float32)))
    pieces = pa.Table.from_batches(list(qual._packed(iter([rows]))))
    tracemalloc.start()
    out = found[0](pieces, known)
    kept = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert out.column("c0").to_pylist() == list(range(300)) and set(out.column("n_chars").to_pylist()) == {3000}
    np.testing.assert_allclose(out.column("perplexity").to_numpy(), np.e)
    assert kept < 0.3 * 3000 * 300


def test_probabilities_sum_to_one(spark):
    rows = [(a + b + c + d + e, 1 + (ord(a) + ord(e)) % 4 if a < "c" and e != "c" else 0, 0) for a in "abc" for b in "ab" for c in "ab" for d in "ab" for e in "abc"]
    p = qual.probabilities(spark.createDataFrame(rows, "g string, c0 long, c1 long")).toPandas()
    assert len(p) == len(rows)
    for _, own in p.groupby(p.g.str[:4]):  # every code point but a and b has what c has
        assert own[own.g.str[4] != "c"].p0.sum() + (qual.CODE_POINTS - 2) * own[own.g.str[4] == "c"].p0.item() == pytest.approx(1)
    np.testing.assert_allclose(p.p1, 1 / qual.CODE_POINTS)


def test_decision(spark, scripts):
    """Quantiles of each language, the fallback of a language without trusted texts, the prior and the decision, by plain code."""
    texts, docs, fold = scripts
    docs = docs.withColumn("lang", F.when(F.col("doc_id") >= 57, "zz").otherwise(F.col("lang")))
    rows = qual.judged(docs, spark.createDataFrame([(i,) for i in range(40)] + [(3,), (None,)], "doc_id long")).toPandas()
    assert len(rows) == len(texts) + 1
    quantile = lambda x, q: sorted(x)[max(0, math.ceil(q * len(x)) - 1)]
    every = rows[rows.trusted].perplexity.dropna()
    for r in rows.itertuples():
        own = rows[rows.trusted & (rows.lang.isna() if r.lang is None else rows.lang == r.lang)].perplexity.dropna()
        own = own if len(own) else every
        assert r.high == pytest.approx(quantile(own, qual.HIGH) * qual.MARGIN)
        if r.perplexity != r.perplexity:
            assert not r.keep
            continue
        adjusted = math.exp((r.n_chars * math.log(r.perplexity) + qual.PRIOR * math.log(quantile(own, 0.5))) / (r.n_chars + qual.PRIOR))
        assert r.adjusted == pytest.approx(adjusted) and r.keep == (adjusted <= r.high)
    assert set(rows[rows.lang == "zz"].high) == {rows[rows.lang == "zz"].high.iloc[0]} and rows.high.nunique() >= 3


def test_rows_of_one_id_are_judged_each(spark, docs_of):
    rng = random.Random(2)
    v = vocabulary(rng, 40)
    good = [" ".join(rng.choice(v) for _ in range(60)) for _ in range(60)]
    junk = "%%% QQQQ ### XXXX $$$ " * 20
    docs = docs_of([*good, junk, junk, good[3], None], ids=[*range(60), 3, None, None, None])
    kept = [(r["doc_id"], r["text"]) for r in qual.kept(docs, spark.createDataFrame([(i,) for i in range(60) if i != 3], "doc_id long")).collect()]
    assert (3, good[3]) in kept and (None, good[3]) in kept and all(t != junk and t for _, t in kept) and len(kept) >= 58


def test_quality(spark, docs_of):
    rng = random.Random(5)
    v = vocabulary(rng, 40)
    good = [" ".join(rng.choice(v) for _ in range(100)) for _ in range(100)]
    junk = ["%%% ".join(rng.choice("XYZQ") * 7 for _ in range(60)) for _ in range(10)]
    docs = docs_of([*good, *junk, None, "", "abc"])
    trusted = spark.createDataFrame([(i,) for i in range(0, 100, 2)] + [(None,), (9999,)], "doc_id long")
    kept = {r["doc_id"] for r in qual.kept(docs, trusted).collect()}
    assert not kept & set(range(100, 112)) and len(kept & set(range(100))) >= 97
    assert qual.kept(docs, trusted).columns == docs.columns
    assert qual.kept(docs.limit(0), trusted).count() == 0
    assert qual.judged(docs, trusted.limit(0)).where("NOT keep").count() == 2


def test_pipeline(spark, tmp_path):
    import corpus_pipeline as cp

    rng = random.Random(6)
    v = vocabulary(rng, 500)

    def text(n):
        return " ".join(rng.choice(v) for _ in range(n))

    passage, item = text(70), text(40)
    texts = [text(rng.randrange(60, 300)) for _ in range(80)]
    texts[10] += " " + passage
    texts[20] = passage + " " + texts[20]
    texts[30] = texts[3]
    texts[31] = texts[4].replace(texts[4].split()[50], "zzzzz")
    texts[40] = texts[40] + " " + item + " end"
    texts[50] = "%%% QQQQ ### XXXX $$$ " * 60
    rows = [(i, t, "en", f"s{i % 4}", len(t)) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, int(i != 50), 0) for i in range(60)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    seen = [set(range(80))]
    for name, stage in cp.STAGES[:-1]:
        columns = docs.columns
        docs = cp.written(stage(spark, docs, str(tmp_path)), name)
        assert docs.columns == columns
        seen.append({r["doc_id"] for r in docs.collect()})
    gone = [a - b for a, b in zip(seen, seen[1:], strict=False)]
    assert 50 in gone[0] and len(gone[0]) <= 3
    assert gone[1] == {30, 31} and gone[2] == set() and gone[3] == {40}
    cut = docs.where("doc_id = 20").first()
    assert passage not in cut["text"] and cut["n_chars"] == len(cut["text"]) and docs.where("doc_id = 10").first()["text"] == texts[10]
    out = cp.run(spark, str(tmp_path))
    assert {r["doc_id"] for r in out.select("doc_id").distinct().collect()} == seen[-1]
