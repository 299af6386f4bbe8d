"""Station tables, directory listings and level-3 archives."""

from __future__ import annotations

import io
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.geo import off_origin


def read_stations(spark: SparkSession, path: str) -> DataFrame:
    """ord (by falling latitude, then by line), s_name, s_lat, s_lon, s_code, s_version of the rows with usable coordinates."""
    raw = spark.read.option("encoding", "ISO-8859-1").schema("name string, lat string, lon string, code string, type string").csv(path, header=True, enforceSchema=True)
    return clean_stations(raw.withColumn("line", F.monotonically_increasing_id()))


def clean_stations(raw: DataFrame) -> DataFrame:
    """raw: line, name, lat, lon, code, type, as texts. A table of some dozens of rows, so one ordered window numbers it."""
    rows = raw.select("line", F.trim("name").alias("s_name"), F.expr("try_cast(trim(lat) AS double)").alias("s_lat"), F.expr("try_cast(trim(lon) AS double)").alias("s_lon"), F.trim("code").alias("code"), F.upper(F.trim("type")).alias("type"))
    rows = rows.dropna(subset=["s_lat", "s_lon"]).where(off_origin(F.col("s_lat"), F.col("s_lon")))
    code = F.when(F.lower("code") != "nan", F.col("code")).otherwise("")
    version = F.when(F.length("type") > 0, F.col("type")).otherwise("UNK")
    order = Window.orderBy(F.desc("s_lat"), "line")
    return rows.select((F.row_number().over(order) - 1).alias("ord"), "s_name", "s_lat", "s_lon", F.coalesce(code, F.lit("")).alias("s_code"), F.coalesce(version, F.lit("UNK")).alias("s_version"))


def list_files(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """path and modificationTime under a folder; contents aren't read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(root).select("path", "modificationTime")


def archive_rows(path: str, content: bytes) -> list[pd.DataFrame]:
    import h5py

    out = []
    with h5py.File(io.BytesIO(content), "r") as f:
        for group in f:
            for sat in f[group]:
                values = pd.Series(f[group][sat]["NOS1"][0]).astype(float)
                out.append(pd.DataFrame({"file_id": path, "group": group, "sat": sat, "index": range(len(values)), "NOS1": values}))
    return out


def read_level3(spark: SparkSession, paths: list[str]) -> DataFrame:
    """file_id, group, sat, index and NOS1 of HDF5 archives; needs h5py on the executors. A file that can't be read is one row with nulls."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for path, content in zip(frame["path"], frame["content"], strict=True):
                try:
                    yield from archive_rows(path, content)
                except Exception:  # one bad file mustn't end the others
                    yield pd.DataFrame({"file_id": [path], "group": [None], "sat": [None], "index": [None], "NOS1": [None]}, dtype=object)

    files = spark.read.format("binaryFile").load(paths).select("path", "content")
    return files.mapInPandas(run, "file_id string, group string, sat string, index long, NOS1 double")
