"""Output paths and Parquet writers."""

from __future__ import annotations

import os
import re
import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CODEC = "zstd"


def output_path(path: str, input_root: str, output_root: str, suffix: str = ".pq") -> str:
    """The place of an input's output: the same relative path, without .bin.zip, .bin or any one extension, plus the suffix."""
    rel = os.path.relpath(path, input_root)
    for tail in (".bin.zip", ".bin"):
        if rel.endswith(tail):
            rel = rel[: -len(tail)]
            break
    else:
        rel = os.path.splitext(rel)[0]
    return os.path.join(output_root, rel + suffix)


def level_path(path: str, level: int) -> str:
    return path.replace("_lvl0", f"_lvl{level}")


def bare(path: str) -> str:
    """A path without the scheme that Spark puts before local ones."""
    return re.sub(r"^file:/+", "/", path)


def _folder(spark: SparkSession, path: str):
    """(file system, path) of Hadoop."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def remove(spark: SparkSession, path: str) -> None:
    fs, at = _folder(spark, path)
    fs.delete(at, True)


def parts_of(spark: SparkSession, path: str, by: str = "file_id") -> dict[str, str]:
    """The values of `by` that a table made by write_parts() has, and their folders, on any file system."""
    fs, at = _folder(spark, path)
    if not fs.exists(at):
        return {}
    names = [s.getPath().getName() for s in fs.listStatus(at) if s.isDirectory()]
    return {unquote(n[len(by) + 1 :]): f"{path}/{n}" for n in names if n.startswith(f"{by}=")}


def write_table(df: DataFrame, path: str, overwrite: bool = False, codec: str = CODEC) -> None:
    """Nothing is done where the table exists, unless overwrite; Spark's committer makes the files appear at once."""
    df.write.mode("overwrite" if overwrite else "ignore").option("compression", codec).parquet(path)


def write_parts(df: DataFrame, path: str, overwrite: bool = False, by: str = "file_id", sort: tuple[str, ...] = (), codec: str = CODEC) -> list[str]:
    """Adds a folder for each value of `by`; values that the table has already are left as they are, or replaced if overwrite. Returns the values written.

    Each part is sorted. Parts are made aside and moved into place one by one, each at once: a run that dies leaves whole parts only, and several runs
    (array tasks) can write to one table at a time."""
    spark = df.sparkSession
    there = parts_of(spark, path, by)
    if there and not overwrite:
        names = spark.createDataFrame([(v,) for v in there], f"`{by}` string")
        df = df.join(names, by, "left_anti")
    stage = f"{path}/_making-{uuid.uuid4().hex}"
    sorted_ = df.repartition(F.col(by)).sortWithinPartitions(by, *sort)
    sorted_.write.partitionBy(by).option("compression", codec).parquet(stage)
    fs, root = _folder(spark, path)
    made = []
    for value, folder in parts_of(spark, stage, by).items():
        _, source = _folder(spark, folder)
        _, target = _folder(spark, f"{path}/{source.getName()}")
        if fs.exists(target):
            if not overwrite:  # another run was faster
                continue
            fs.delete(target, True)
        if not fs.rename(source, target):
            raise OSError(f"{folder} can't be moved to {path}")
        made.append(value)
    fs.delete(_folder(spark, stage)[1], True)
    return sorted(made)
