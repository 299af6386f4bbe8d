"""Sharding by jump consistent hashing, in DataFrame functions only.

A key walks through shard numbers 0 = b0 < b1 < ...: from b it jumps to floor((b + 1) / r), r in (0, 1] drawn from a
stream of hashes of (key, b). Its shard among n is the last number below n, so no ring table is kept and adding a shard
moves only the keys whose walk lands on it. A walk is cut after MAX_JUMPS jumps (its mean is ln n), which keeps that property.

Slots number a shard's rows from 0 without gaps. A shard can hold a sixteenth of all rows, so rows are numbered within
small hash buckets of a shard, and the buckets' counts, summed up, give each bucket its first slot.

Null texts have size 1 and the checksum of no bytes; null keys are hashed like a value of their own; repeated rows are
placed together and get a slot each. An empty table gives an empty result. Other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MAX_JUMPS = 64
ROWS_A_BUCKET = 4_096


def jump_shard(key: Column, shards: int) -> Column:
    """The shard of key among 0 .. shards - 1."""
    step = F.lit(2.0**31)

    def walk(s: Column, i: Column) -> Column:
        """One jump: draw from the present shard, and go there if it exists."""
        r = (F.shiftrightunsigned(F.xxhash64(key, s), 33) + F.lit(1)).cast("double") / step
        to = F.floor((s + F.lit(1)).cast("double") / r)
        return F.when(to < F.lit(shards), to.cast("bigint")).otherwise(s)

    return F.aggregate(F.sequence(F.lit(1), F.lit(min(MAX_JUMPS, max(shards, 1)))), F.lit(0).cast("bigint"), walk).cast("int")


def sharded(df: DataFrame, key: str, shards: int, payload: list[str], buckets: int) -> DataFrame:
    """payload, key, shard, grown_shard and slot of every row."""
    rows = df.select(
        *payload, F.col(key), jump_shard(F.col(key), shards).alias("shard"), jump_shard(F.col(key), shards + 1).alias("grown_shard"),
        F.pmod(F.xxhash64(F.col(key), F.lit("slot")), F.lit(buckets)).cast("int").alias("bucket"),
    )
    counts = rows.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    place = Window.partitionBy("shard", "bucket").orderBy(key, *payload)
    ranked = rows.withColumn("rank", F.row_number().over(place))
    return ranked.join(first, ["shard", "bucket"]).select(*payload, key, "shard", (F.col("first") + F.col("rank") - 1).cast("bigint").alias("slot"), "grown_shard")


def shard_documents(docs: DataFrame, shards: int = 16, rows_a_bucket: int = ROWS_A_BUCKET) -> DataFrame:
    rows = docs.select(
        F.col("doc_id"), (F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint") + 1).alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
    )
    buckets = max(1, -(-docs.count() // (rows_a_bucket * shards)))
    out = sharded(rows, "doc_id", shards, ["size", "text_crc32"], buckets)
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def query(spark, sf_dir: str) -> DataFrame:
    return shard_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
