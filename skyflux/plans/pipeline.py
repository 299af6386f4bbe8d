"""From receiver files to product tables, all files in one plan."""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.clean import to_lvl0
from ..functions.timefn import gps_time
from ..operators.detrend import clock_corrected, detrended, formatted, with_tec, without_rate
from ..operators.products import product_aggregates, with_products
from ..operators.resample import first_known, to_minutes, to_seconds
from ..sources.receivers import get_type, get_version, read_records
from ..sources.sinks import bare, output_path, parts_of, write_parts, write_table

ACCEPTED = ("bin", "binzip", "lvl0")
BIN = ["file_id", "prn", "minbin"]


@dataclass
class Products:
    """Tables of a run; None where the mode leaves them out. errors: file_id and what went wrong."""

    lvl2: DataFrame | None
    lvl3: DataFrame | None
    errors: DataFrame


def as_list(files) -> list[str]:
    """None, one path, or a list, tuple or set of them."""
    if files is None:
        return []
    if isinstance(files, (str, os.PathLike)):
        return [os.fspath(files)]
    if isinstance(files, (list, tuple, set)):
        return [os.fspath(f) for f in files]
    raise TypeError(f"expected a path or a list, tuple or set of paths, got {type(files)}")


def convert(spark: SparkSession, files) -> tuple[DataFrame, DataFrame]:
    """(lvl0, errors) of raw files."""
    records, errors = read_records(spark, as_list(files))
    return to_lvl0(timed(records)), errors


def timed(df: DataFrame) -> DataFrame:
    """datetime in place of week and seconds, where a table has both."""
    if not {"week", "towe"} <= set(df.columns):
        return df
    return df.withColumn("datetime", gps_time(F.col("week"), F.col("towe"))).drop("week", "towe")


def enriched(lvl0: DataFrame) -> DataFrame:
    """Full rate, with detrended phases, clock, TEC and the minutes' products. lvl0 has file_id and row_id."""
    return with_products(corrected(lvl0), BIN).drop("fs")


def corrected(lvl0: DataFrame) -> DataFrame:
    """Full rate, with all that both levels of products are made from, and fs."""
    return with_tec(clock_corrected(detrended(formatted(lvl0))))


def minutes(lvl0: DataFrame) -> DataFrame:
    """lvl3 without the full-rate join: one aggregation gives first known values and products."""
    return _minutes(corrected(lvl0))


def _minutes(full: DataFrame) -> DataFrame:
    df = full.drop("fs")
    at, keys = F.col("row_id"), ["file_id", "minbin", "prn"]
    firsts = [first_known(c, at).alias(c) for c in df.columns if c not in keys]
    return df.where("minbin IS NOT NULL AND prn IS NOT NULL").groupBy(*keys).agg(*firsts, *[c.alias(n) for n, c in product_aggregates(df.columns).items()])


def read_lvl0(spark: SparkSession, files: list[str]) -> DataFrame:
    """Parquet files by name of column; each file is one file_id. Files without row_id get one in the order of their rows."""
    df = spark.read.option("mergeSchema", "true").parquet(*files)
    if "file_id" not in df.columns:
        df = df.withColumn("file_id", F.col("_metadata.file_path"))
    if "row_id" not in df.columns:
        df = df.withColumn("row_id", F.col("_metadata.row_index"))
    return df


def readable(spark: SparkSession, files: list[str]) -> tuple[list[str], DataFrame]:
    """(files, errors): lvl0 files whose footers can be read. They are tried one by one only if they can't be read together."""
    bad = []
    try:
        read_lvl0(spark, files)
    except Exception:
        for f in files:
            try:
                read_lvl0(spark, [f])
            except Exception as e:  # one damaged file mustn't end the others; its error is a row
                bad.append((f, f"{type(e).__name__}: {str(e).splitlines()[0]}"))
    gone = {f for f, _ in bad}
    return [f for f in files if f not in gone], spark.createDataFrame(bad, "file_id string, error string")


def process(spark: SparkSession, files, mode: str = "both", workspace: str | None = None) -> Products:
    """mode: lvl2 (seconds), lvl3 (minutes) or both. Files of other kinds than bin, bin.zip and lvl0 are passed over.

    workspace: a folder that all machines share. With it lvl0 and the corrected full-rate table are written there once and everything is made from
    them; without it each product reads the files and repairs the phases anew."""
    if mode not in ("lvl2", "lvl3", "both"):
        raise ValueError(f"unknown mode {mode}")
    wanted = [f for f in as_list(files) if get_type(f) in ACCEPTED]
    ready, raw = [f for f in wanted if get_type(f) == "lvl0"], [f for f in wanted if get_type(f) != "lvl0"]
    parts, errors = [], spark.createDataFrame([], "file_id string, error string")
    if ready:
        ready, errors = readable(spark, ready)
        parts += [read_lvl0(spark, ready)] if ready else []
    if raw:
        lvl0, bad = convert(spark, raw)
        errors = errors.unionAll(bad)
        parts.append(lvl0)
    if not parts:
        return Products(None, None, errors)
    lvl0 = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=True)
    if workspace:
        write_table(lvl0, f"{workspace}/lvl0")
        write_table(errors, f"{workspace}/errors")
        lvl0, errors = (spark.read.parquet(f"{workspace}/{n}") for n in ("lvl0", "errors"))
    errors = errors.unionAll(without_rate(formatted(lvl0)))
    full = corrected(lvl0)
    if workspace:
        write_table(full, f"{workspace}/corrected")
        full = spark.read.parquet(f"{workspace}/corrected")
    return Products(to_seconds(with_products(full, BIN).drop("fs")) if mode != "lvl3" else None, _minutes(full) if mode != "lvl2" else None, errors)


LEVELS = {"lvl2": ("secbin", "prn"), "lvl3": ("minbin", "prn")}


def write_products(out: Products, root: str, overwrite: bool = False) -> list[str]:
    """Adds the run's products to the tables under root, a sorted part for each file; files that a table has already stay as they are, unless overwrite. Returns the tables' paths."""
    made = []
    for name, sort in LEVELS.items():
        if (df := getattr(out, name)) is not None:
            write_parts(df, f"{root}/{name}", overwrite, sort=sort)
            made.append(f"{root}/{name}")
    return made


def done(spark: SparkSession, root: str, levels: tuple[str, ...]) -> set[str]:
    """The files that all these levels' tables under root have."""
    every = [{bare(f) for f in parts_of(spark, f"{root}/{level}")} for level in levels]
    return set.intersection(*every) if every else set()


def chunk(files: list[str], n: int, k: int) -> list[str]:
    """The k-th of n contiguous parts; the first len % n parts have one more."""
    if not 0 <= k < n:
        raise ValueError(f"part {k} of {n}")
    size, more = divmod(len(files), n)
    lo = k * size + min(k, more)
    return files[lo : lo + size + (k < more)]


def missing_inputs(inputs: DataFrame, outputs: DataFrame) -> DataFrame:
    """Inputs (path, output) whose output isn't among outputs (path)."""
    return inputs.join(outputs.select(F.col("path").alias("output")), "output", "left_anti").select("path", "output")


def resolve_inputs(spark: SparkSession, files=None, root: str | None = None, glob: str = "*", infer_missing: bool = False, output_root: str | None = None, versions: set[str] | None = None, suffix: str = "_lvl0.pq", levels: tuple[str, ...] = ("lvl0",)) -> list[str]:
    """The files to work on: those given, else those under root that lack an output (infer_missing), else all under root; of some versions.

    An output is a part of each of these levels' tables under output_root (as write_parts() makes them), or a file with the input's relative path and the suffix."""
    from ..sources.stations import list_files

    if files is not None:
        return sorted(as_list(files))
    if root is None or infer_missing and output_root is None:
        raise ValueError("files, or root (with infer_missing also output_root), must be given")
    found = [bare(r["path"]) for r in list_files(spark, root, glob).select("path").toLocalIterator()]
    found = [f for f in found if versions is None or get_version(f) in versions]
    if infer_missing and found:
        there = done(spark, output_root, levels)
        fs = spark._jvm.org.apache.hadoop.fs.Path(output_root).getFileSystem(spark._jsc.hadoopConfiguration())
        plain = {output_path(f, root, output_root, suffix): f for f in found}
        there |= {f for name, f in plain.items() if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(name))}
        found = [f for f in found if f not in there]
    return sorted(found)
