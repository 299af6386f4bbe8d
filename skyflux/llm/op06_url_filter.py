"""URL rules behind a blocked Bloom filter.

A rule is a host with a path; it fits that host and its subdomains where the url's path starts with the rule's. The canonical form
of a rule is host + path ("example.com/en/"). A url's candidates are every suffix of its host (at label borders) with every prefix of
its path that is as long as some listed path. The filter holds the canonical rules: a key picks one block of 512 bits and sets K bits in
it, so a test reads one cache line. Candidates that pass go to an exact hash join with the rules, which removes the false
positives; the longest rule wins (longer host first among equals). Urls without a rule get the default verdict.

The filter is a table with a row for each block, sized by the number of rules (RULES_A_BLOCK), so its rate of false positives is the same for any list. It is joined by block: broadcast
while it has at most SEND_MAX blocks (64 MB), shuffled beyond that. The rules' side of the exact join is left to Spark. Where paths have more than max_lengths distinct lengths, every prefix
of a url's path that isn't longer than the longest of them is a candidate.

Each distinct url is judged once and joined back by url and one of SALTS salts, so repeated urls and repeated rows keep all their rows and a very common url isn't
one task; null urls have keys of their own. A null url has an empty host and path and no rule; an empty table gives an empty result. Other columns
are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_WORDS, K = 8, 4
RULES_A_BLOCK, SEND_MAX, SALTS = 50, 1_000_000, 8
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The listed rules: verdict, host, path.
RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")]


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def block_of(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def bit_places(key: Column) -> list[tuple[Column, Column]]:
    """(which 64-bit word of its block, bit within it) of each of the K bits of a key."""
    bits = F.xxhash64(key, F.lit(1))
    places = [F.shiftrightunsigned(bits, 9 * i).bitwiseAND(F.lit(511)) for i in range(K)]
    return [(F.floor(b / 64).cast("int"), b.bitwiseAND(F.lit(63)).cast("int")) for b in places]


def blocked_bloom(keys: DataFrame, key: str, blocks: int) -> DataFrame:
    """The filter: block and its BLOCK_WORDS words of 64 bits; blocks without a key have no row."""
    places = F.array(*[F.struct(w.alias("word"), b.alias("bit")) for w, b in bit_places(F.col(key))])
    masks = keys.select(block_of(F.col(key), blocks).alias("block"), F.explode(places).alias("p")).select("block", "p.word", F.expr("shiftleft(1L, p.bit)").alias("mask"))
    return masks.groupBy("block").agg(*[F.coalesce(F.bit_or(F.when(F.col("word") == i, F.col("mask"))), F.lit(0).cast("bigint")).alias(f"w{i}") for i in range(BLOCK_WORDS)])


def may_hold(key: Column) -> Column:
    """Whether a key may be listed, from its block's words w0 to w7."""
    words, test = F.array(*[F.col(f"w{i}") for i in range(BLOCK_WORDS)]), F.lit(True)
    for w, b in bit_places(key):
        test = test & (F.call_function("shiftrightunsigned", F.get(words, w), b).bitwiseAND(F.lit(1)) == F.lit(1))
    return test


def judge_urls(pages: DataFrame, rules: DataFrame, url: str = "url", keep: tuple[str, ...] = ("page_id",), default: str = "allow", blocks: int | None = None, max_lengths: int = 64, send_max: int = SEND_MAX) -> DataFrame:
    """keep, host, path, rule and verdict of every row. rules: verdict, host, path.

    blocks: blocks of 64 bytes in the filter; None: one for RULES_A_BLOCK rules, which keeps false positives near 1 %."""
    rules = rules.select(F.concat("host", "path").alias("rule"), F.length("path").alias("path_len"), F.length("host").alias("host_len"), F.col("verdict").alias("rule_verdict")).dropDuplicates(["rule"])
    size = rules.agg(F.count("*").alias("n"), F.min("path_len").alias("least"), F.max("path_len").alias("most")).first()
    blocks = blocks or max(1, -(-size["n"] // RULES_A_BLOCK))
    lengths = sorted(r[0] for r in rules.select("path_len").distinct().limit(max_lengths + 1).collect())
    rows = pages.select(*keep, F.col(url).alias("_url"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    if len(lengths) <= max_lengths:
        prefixes = F.filter(F.array(*[F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in lengths]), lambda p: p.isNotNull())
    else:
        last = F.least(F.length("path"), F.lit(size["most"]))
        every = F.when(last >= size["least"], F.sequence(F.lit(size["least"]), last)).otherwise(F.array().cast("array<int>"))
        prefixes = F.transform(every, lambda n: F.substring(F.col("path"), F.lit(1), n))
    seen = rows.where(F.col("_url").isNotNull()).select("_url", "host", "path").distinct()
    both = seen.select("_url", F.explode(suffixes).alias("_suffix"), prefixes.alias("_prefixes")).select("_url", "_suffix", F.explode("_prefixes").alias("_prefix"))
    tried = both.select("_url", F.concat("_suffix", "_prefix").alias("rule")).withColumn("block", block_of(F.col("rule"), blocks))
    bloom = blocked_bloom(rules, "rule", blocks)
    hits = tried.join(F.broadcast(bloom) if blocks <= send_max else bloom, "block").where(may_hold(F.col("rule"))).select("_url", "rule")
    best = F.max_by(F.struct("rule", "rule_verdict"), F.struct(F.length("rule"), F.col("host_len")))
    found = hits.join(rules, "rule").groupBy("_url").agg(best.alias("best")).select("_url", "best.rule", "best.rule_verdict")
    found = found.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    own = F.monotonically_increasing_id()
    rows = rows.withColumns({"_salt": F.pmod(own, F.lit(SALTS)).cast("int"), "_key": F.coalesce("_url", F.concat(F.lit("no url "), own.cast("string")))})
    out = rows.join(found.withColumnRenamed("_url", "_key"), ["_key", "_salt"], "left")
    return out.select(*keep, "host", "path", "rule", F.coalesce(F.when(F.col("_url").isNotNull(), F.col("rule_verdict")), F.lit(default)).alias("verdict"))


def query(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return judge_urls(pages, spark.createDataFrame(RULES, "verdict string, host string, path string"))


SQL = r"""
WITH rules(verdict, host, path) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
  ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
u AS (SELECT page_id, row_number() OVER () AS rid,
  coalesce(translate(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
  coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path FROM pages),
m AS (SELECT u.rid, arg_max(r.host || r.path, length(r.host || r.path) * 10000 + length(r.host)) AS rule,
  arg_max(r.verdict, length(r.host || r.path) * 10000 + length(r.host)) AS verdict
  FROM u JOIN rules r ON (u.host = r.host OR ends_with(u.host, '.' || r.host)) AND starts_with(u.path, r.path) GROUP BY u.rid)
SELECT u.page_id, u.host, u.path, m.rule, coalesce(m.verdict, 'allow') AS verdict FROM u LEFT JOIN m USING (rid)
"""
