"""The training-data pipeline: STAGES of operators of skyflux.llm over documents, and run() that applies them.

quality      documents that the quality classifier rejects go
near_dups    one document of each component of the Jaccard join stays, the one with the smallest doc_id
substrings   passages that a document with a smaller doc_id has go; a text that is changed keeps its other words, joined by one space
leaks        documents that hold a benchmark item go
packing      the pieces of what is left and their bins

Each stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept. All but the last return the columns of documents.
No stage can be told in SQL as a whole, so ORACLE_SQL is None and the stages are tested against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyflux.llm import op03_substring_dedup, op05_decontamination, op07_jaccard_join, op09_packing, op10_quality
from skyflux.llm.store import MADE, drop_all_but, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op10_quality.kept(docs, op10_quality.trusted_ids(spark, sf_dir))


def near_dups(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op07_jaccard_join.one_of_each(docs)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = op03_substring_dedup.deduplicated(docs)
    n_words, n_removed, kept_text = (F.col(c) for c in cut.columns[-3:])
    columns = {"text": F.when(n_removed > 0, kept_text).otherwise(F.col("text"))}
    if "n_chars" in docs.columns:
        columns["n_chars"] = F.when(n_removed > 0, F.length(kept_text).cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return cut.where((n_words == 0) | (n_removed < n_words)).select(*[columns.get(c, F.col(c)).alias(c) for c in docs.columns])


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op05_decontamination.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op09_packing.pack_documents(docs)


STAGES = [("quality", quality), ("near_dups", near_dups), ("substrings", substrings), ("leaks", leaks), ("packing", packing)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; every stage's output is written to the shared folder and read again, and what it was made from deleted."""
    docs, since = spark.read.parquet(f"{sf_dir}/documents.parquet"), len(MADE)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
        drop_all_but(docs, since)
    return STAGES[-1][1](spark, docs, sf_dir)
