"""Sharding, URL rules and licences."""

import collections
import math
import re
import struct
import zlib

import pytest
import xxhash

from skyflux.llm import op04_sharding, op06_url_filter, op08_licences


def jump(key: int, shards: int) -> int:
    at = 0
    for _ in range(min(64, shards)):
        h = xxhash.xxh64(struct.pack("<q", key), seed=42).intdigest()
        h = xxhash.xxh64(struct.pack("<q", at), seed=h).intdigest()
        to = math.floor((at + 1) / (((h >> 33) + 1) / 2.0**31))
        if to >= shards:
            break
        at = to
    return at


@pytest.mark.parametrize("rows_a_bucket", [4096, 5])
def test_sharding(docs_of, rows_a_bucket):
    texts = [None, "", "ß", "a" * 100_000] + [f"text {i % 50}" for i in range(3000)]
    out = op04_sharding.shard_documents(docs_of(texts), rows_a_bucket=rows_a_bucket).toPandas().sort_values("doc_id")
    assert out.doc_id.tolist() == list(range(len(texts)))
    raw = [(t or "").encode() for t in texts]
    assert out["size"].tolist() == [len(x) + 1 for x in raw] and out.text_crc32.tolist() == [zlib.crc32(x) for x in raw]
    assert out.shard.tolist() == [jump(i, 16) for i in range(len(texts))] and out.grown_shard.tolist() == [jump(i, 17) for i in range(len(texts))]
    assert ((out.shard == out.grown_shard) | (out.grown_shard == 16)).all()
    for _, g in out.groupby("shard"):
        assert sorted(g.slot) == list(range(len(g)))
    assert out.groupby("shard").size().min() > len(texts) / 16 * 0.6


def test_sharding_edges(docs_of):
    assert op04_sharding.shard_documents(docs_of([])).count() == 0
    out = op04_sharding.shard_documents(docs_of(["x", "x", "y"], ids=[5, 5, None])).toPandas()
    assert len(out) == 3 and sorted(out[out.doc_id == 5].slot) == [0, 1]


def judged(url, rules):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = re.search(r"[/?#]", rest)
        host = rest[: cut.start()] if cut else rest
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
        path = re.split(r"[?#]", rest[len(host) :])[0]
    fits = [(len(h + p), len(h), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits) if fits else (0, 0, None, "allow")
    return host, path, best[2], best[3]


def test_urls(spark):
    urls = [None, "", "no scheme", "http://", "http://A.EXAMPLE.com/en/x?y=://z", "https://example.com", "https://example.com/en", "http://www.example.com/en/#q", "http://notexample.com/en/", "x://net/fr/", "http://a.net/es/1", "http://a.net?/es/", "ftp://com/", "http://Ünï.com/é", "http://x.com/en/\n/q"] * 2
    urls += [f"http://h{i}.{'com' if i % 2 else 'net'}/{'es' if i % 3 else 'fr'}/{i}" for i in range(200)]
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], "page_id long, url string, rule string")
    rules = spark.createDataFrame(op06_url_filter.RULES, "verdict string, host string, path string")
    for blocks in (1, 64):
        got = op06_url_filter.judge_urls(pages, rules, blocks=blocks).orderBy("page_id").toPandas()
        want = [judged(u, op06_url_filter.RULES) for u in urls]
        assert [(r.host, r.path, r.rule, r.verdict) for r in got.itertuples()] == [(*w[:2], w[2], w[3]) for w in want]
    assert op06_url_filter.judge_urls(pages.limit(0), rules).count() == 0
    none = op06_url_filter.judge_urls(pages, rules.limit(0)).toPandas()
    assert len(none) == len(urls) and none.rule.isna().all()


def test_bloom_holds_all(spark):
    keys = spark.createDataFrame([(f"h{i}.com/",) for i in range(500)], "k string")
    from pyspark.sql import functions as F

    bloom = op06_url_filter.blocked_bloom(keys, "k", 16)

    def passing(df):
        return df.withColumn("block", op06_url_filter.block_of(F.col("k"), 16)).join(bloom, "block").where(op06_url_filter.may_hold(F.col("k"))).count()

    assert passing(keys) == 500
    assert passing(spark.createDataFrame([(f"x{i}.org/",) for i in range(2000)], "k string")) < 400


def test_many_rules_and_long_urls(spark):
    """More rules than one block, more lengths of paths than are listed, a shuffled filter, very long urls."""
    rules = [("block" if i % 2 else "allow", f"h{i % 40}.org", "/" + "p" * (i % 90)) for i in range(400)]
    rules = [*dict((h + p, (v, h, p)) for v, h, p in rules).values()]
    urls = [f"http://a.h{i % 45}.org/{'p' * (i * 7 % 100)}x" for i in range(300)] + ["http://h1.org/" + "p" * 5000, "http://" + "a." * 300 + "h3.org/ppp"] + ["http://h7.org/pp"] * 500 + [None] * 100
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    table = spark.createDataFrame(rules, "verdict string, host string, path string")
    want = [judged(u, rules) for u in urls]
    for lengths, send in ((64, 0), (128, 1000)):
        got = op06_url_filter.judge_urls(pages, table, max_lengths=lengths, send_max=send).orderBy("page_id").collect()
        assert [tuple(r)[1:] for r in got] == want


def licences(files, templates, threshold):
    """Cosines of all units with all templates, by dictionaries: (licence, score, licence file or not) of each file."""

    def terms(s):
        return [t for t in re.split(r"[^\w]+|_", s.lower()) if t]

    def lines(t):
        return [y for y in (t or "").split("\n") if y.strip(" ")]

    every = [x for _, t in files for x in lines(t)]
    listed = {w for _, t in templates for w in terms(t)}
    df = collections.Counter(w for x in every for w in set(terms(x)) & listed)
    n = len(every)

    def vector(s):
        return {w: c * (math.log((1 + n) / (1 + (df[w] if w in listed else 0))) + 1) for w, c in collections.Counter(terms(s)).items()}

    def cosine(a, b):
        return sum(a[w] * b.get(w, 0) for w in a) / (math.sqrt(sum(x * x for x in a.values())) * math.sqrt(sum(x * x for x in b.values())) or 1)

    out = []
    for _, t in files:
        units = [("line", x) for x in lines(t)] + [("block", x) for x in re.split(r"\n[ \t\r\n]*\n", t or "") if "\n" in x] + ([("file", t)] if "\n" in (t or "") else [])
        found = [(-round(cosine(vector(x), vector(text)), 9), name, kind, i) for i, (kind, x) in enumerate(units) for name, text in templates]
        found = [x for x in found if -x[0] >= threshold]
        if found:
            hits = len({i for _, _, kind, i in found if kind == "line"})
            out.append((min(found)[1], -min(found)[0], any(kind == "file" for _, _, kind, _ in found) or 2 * hits >= len(lines(t))))
        else:
            out.append(None)
    return out


def wrapped(text, width=72, before=""):
    import textwrap

    return "\n".join(before + x for x in textwrap.wrap(text, width))


def test_licences(spark):
    t = op08_licences.TEMPLATES
    body = {i: x for i, (_, x) in enumerate(t)}
    files = [
        ("p/LICENSE", "\n" + body[10] + "\n"), ("p/a/b/c.py", "print(1)\nthe work of this"), ("p/a/x.py", "# licensed under the mit license\ncode\ncode\ncode"), ("q/z.py", None), ("q/LICENSE", wrapped(body[3]).upper()),
        ("q/r/s.py", ""), ("top.py", "nothing"), ("w/a.py", body[8] + " " + body[8]), ("w/b.py", "work licensed public version gnu\n" * 3 + "x"), ("v/LICENSE.txt", "Copyright 2024 Somebody\n\n" + wrapped(body[0], 60)),
        ("v/deep/er/h.c", "/*\n" + wrapped(body[5], 70, " * ") + "\n */\n\nint main(void) { return 0; }\n" + "x = y;\n" * 30), ("v/deep/er/k.c", "int k;"), ("u/n.py", wrapped(body[4], 76, "# ") + "\n\nimport os\nimport sys\n"), ("w/b.py", "other text of one path"), ("p/LICENSE", "\n" + body[10] + "\n"), (None, body[6]), (None, "x"),
    ]
    df = spark.createDataFrame([(i, *f, 1) for i, f in enumerate(files)], "doc int, path string, text string, term int")
    templates = spark.createDataFrame(t, "licence string, text string")
    got = {r["doc"]: r for r in op08_licences.licensed(df, templates, keep=("doc",)).collect()}
    want = licences(files, t, op08_licences.THRESHOLD)
    assert len(got) == len(files)
    homes = {}
    for (p, _), w in sorted(zip(files, want, strict=True), key=lambda x: str(x[0][0])):
        if w and w[2] and p:
            homes.setdefault(p.rsplit("/", 1)[0], (p, w[0]))
    for i, ((p, _), w) in enumerate(zip(files, want, strict=True)):
        r = got[i]
        if w:
            assert (r["found"], r["licence"], r["licensed_by"]) == ("own", w[0], p) and r["score"] == pytest.approx(w[1], abs=1e-6)
            continue
        above = [d for d in homes if p and p.startswith(d + "/")]
        assert (r["found"], r["licensed_by"], r["licence"]) == (("inherited", *homes[max(above, key=len)]) if above else (None, None, None))
    names = {i: got[i]["licence"] for i in got}
    assert names[4] == "BSD-3-Clause" and names[9] == "MIT" and names[10] == "GPL-3.0" and names[11] == "MIT" and names[12] == "Apache-2.0" and got[11]["found"] == "inherited" and names[15] == "MPL-2.0"
    assert got[8]["found"] != got[13]["found"] or got[8]["score"] != got[13]["score"]
    assert op08_licences.licensed(df.limit(0), templates).count() == 0
    assert op08_licences.licensed(df, templates.limit(0)).where("found IS NOT NULL").count() == 0


def test_native_plans(spark, docs_of):
    """No Python on the executors, and scans of the needed columns only."""
    templates = spark.createDataFrame(op08_licences.TEMPLATES, "licence string, text string")
    files = docs_of(["x"]).selectExpr("source AS path", "text")
    for df in (op04_sharding.shard_documents(docs_of(["x"])), op08_licences.licensed(files, templates)):
        assert not re.search("Python|Pandas|InArrow", df._jdf.queryExecution().executedPlan().toString().replace("PythonRDD", ""))
