"""Receiver logs as DataFrames: fixed records, zipped or not, and texts.

Binary files are read as a whole by one task each (Spark's binaryFile source: up to 2 GiB) and given out in pieces. row_id is a record's place in its file
and file_id the file's path."""

from __future__ import annotations

import io
import os
import re
import struct
import zipfile
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dims import prn_of_number
from ..functions.timefn import gps_time
from ..schemas import ISMR, V324, V325, V326, V326_HEADER, V326_RECORDS, spark_fields

PIECE = 100_000
DIRTY = r"\bError\b|,,"


def get_version(path: str | os.PathLike) -> str | None:
    """From the first _v followed by digits anywhere in the path."""
    found = re.search(r"_v(\d+)", os.fspath(path))
    return f"v{found[1]}" if found else None


def get_type(path: str | os.PathLike) -> str | None:
    """binzip, bin, lvl0 to lvl3, pq or None, by the end of the name."""
    name = os.path.basename(os.fspath(path)).lower()
    ends = [((".bin.zip",), "binzip"), ((".bin",), "bin"), *[((f"_lvl{i}.pq", f"_lvl{i}.parquet"), f"lvl{i}") for i in range(4)], ((".pq", ".parquet"), "pq")]
    return next((kind for tails, kind in ends if name.endswith(tails)), None)


def parse_v325(raw: bytes) -> pd.DataFrame:
    return pd.DataFrame(np.frombuffer(raw, V325, len(raw) // V325.itemsize))


def parse_v326(raw: bytes) -> pd.DataFrame:
    week = struct.unpack_from(V326_HEADER, raw)[-1]
    rows = pd.DataFrame(np.frombuffer(raw, V326, max(0, len(raw) - V326_RECORDS) // V326.itemsize, min(V326_RECORDS, len(raw))))
    return rows.assign(week=np.int32(week))


PARSERS = {"v325": parse_v325, "v326": parse_v326}
FIELDS = {"v325": spark_fields(V325), "v326": spark_fields(V326) | {"week": "int"}}


def _unzipped(path: str, content: bytes) -> bytes:
    """The member named as the archive without .zip; else its only one."""
    if not path.lower().endswith(".zip"):
        return content
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        name = os.path.basename(path)[:-4]
        names = z.namelist()
        own = next((n for n in names if os.path.basename(n) == name), names[0] if len(names) == 1 else None)
        if own is None:
            raise ValueError(f"{path}: no member {name}")
        return z.read(own)


def read_binary(spark: SparkSession, paths: list[str], version: str) -> tuple[DataFrame, DataFrame]:
    """(records, errors): the records of all files that can be read, and (file_id, error) of the others."""
    if version not in PARSERS:
        raise ValueError(f"no reader for version {version}")
    return records_of(spark.read.format("binaryFile").load(paths).select("path", "content"), version)


def records_of(files: DataFrame, version: str) -> tuple[DataFrame, DataFrame]:
    """As read_binary(), of files that are rows: path and content."""
    fields, parse = FIELDS[version], PARSERS[version]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for path, content in zip(frame["path"], frame["content"], strict=True):
                try:
                    rows = parse(_unzipped(path, content))
                except Exception as e:  # one bad file mustn't end the others; its error is a row
                    yield pd.DataFrame({c: pd.Series([None], dtype=object) for c in fields} | {"file_id": path, "row_id": -1, "error": f"{type(e).__name__}: {e}"})
                    continue
                for lo in range(0, len(rows), PIECE):
                    piece = rows.iloc[lo : lo + PIECE]
                    yield piece[list(fields)].assign(file_id=path, row_id=np.arange(lo, lo + len(piece)), error=None)

    schema = ", ".join(f"{n} {t}" for n, t in fields.items()) + ", file_id string, row_id long, error string"
    out = files.select("path", "content").mapInPandas(run, schema)
    return out.where("error IS NULL").drop("error"), out.where("error IS NOT NULL").select("file_id", "error")


def read_v324(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Text with blanks between fields. row_id is the line's place in its task, after the task's number: in order within a file."""
    return v324_rows(spark.read.text(paths).select("value", F.input_file_name().alias("file_id")))


def v324_rows(lines: DataFrame) -> DataFrame:
    """Lines (value, file_id) as records."""
    part = F.split(F.trim("value"), r"\s+")
    lines = lines.where(F.length(F.trim("value")) > 0)
    kinds = {"week": "int", "cons": "smallint", "svid": "smallint", "elev": "int", "azim": "int"}
    cells = [F.expr(f"try_cast(get(_part, {i}) AS {kinds.get(n, 'double')})").alias(n) for i, n in V324.items()]
    return lines.select(part.alias("_part"), "file_id", F.monotonically_increasing_id().alias("row_id")).select(*cells, "file_id", "row_id")


def read_records(spark: SparkSession, paths: list[str]) -> tuple[DataFrame, DataFrame]:
    """(records, errors) of files of several versions, by the version in each path; a file of an unknown version is an error of its own."""
    by: dict[str | None, list[str]] = {}
    for p in paths:
        by.setdefault(get_version(p), []).append(p)
    unknown = [(p, f"no reader for version {v}") for v in by if v not in (*PARSERS, "v324") for p in by[v]]
    by = {v: own for v, own in by.items() if v in (*PARSERS, "v324")}
    good, bad = [], [spark.createDataFrame(unknown, "file_id string, error string")] if unknown else []
    if not by:
        good.append(spark.createDataFrame([], ", ".join(f"{n} {t}" for n, t in FIELDS["v325"].items()) + ", file_id string, row_id long"))
    for version, own in by.items():
        if version == "v324":
            good.append(read_v324(spark, own))
        else:
            rows, errors = read_binary(spark, own, version)
            good.append(rows)
            bad.append(errors)
    records = good[0]
    for other in good[1:]:
        records = records.unionByName(other, allowMissingColumns=True)
    errors = bad[0] if bad else spark.createDataFrame([], "file_id string, error string")
    for other in bad[1:]:
        errors = errors.unionAll(other)
    return records, errors


def clean_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Without lines that report an error or lack a field."""
    return lines.where(~F.col(column).rlike(DIRTY))


def read_sc4(spark: SparkSession, paths: list[str], headers: int = 2) -> DataFrame:
    """Fourth-generation measurements: a row for each signal. Lines that aren't data (headers, dirty ones) have no number in front and go."""
    return sc4_rows(spark.read.text(paths).select("value", F.input_file_name().alias("file_id")))


def sc4_rows(lines: DataFrame) -> DataFrame:
    """Lines (value, file_id) as measurements."""
    part = F.split("value", ",")
    names = {0: ("TOW", "double"), 1: ("WN", "int"), 2: ("SVID", "string"), 3: ("SIG", "string"), 5: ("PR", "double"), 6: ("Phase", "double"), 8: ("SNR", "double")}
    lines = clean_lines(lines).select(part.alias("_part"), "file_id")
    rows = lines.select(*[F.expr(f"try_cast(trim(get(_part, {i})) AS {t})").alias(n) for i, (n, t) in names.items()], "file_id").where("TOW IS NOT NULL AND WN IS NOT NULL")
    return rows.withColumn("datetime", gps_time(F.col("WN"), F.col("TOW")))


def sc4_wide(rows: DataFrame) -> DataFrame:
    """Signals of an epoch and satellite side by side, numbered by class: sig_1 .. sig_3, cph, rng and snr."""
    from ..functions.dims import SIGNALS, lookup

    slot = F.regexp_extract(lookup(F.col("SIG"), {s: c for s, (_, c) in SIGNALS.items()}), r"(\d)$", 1)
    wide = rows.withColumn("_slot", slot).groupBy("file_id", "datetime", F.col("SVID").alias("prn"))
    picks = [F.min_by(F.when(F.col("_slot") == str(i), F.col(c)), F.when(F.col("_slot") == str(i), F.col("SIG"))).alias(f"{n}{i}") for i in (1, 2, 3) for c, n in (("SIG", "sig_"), ("Phase", "cph"), ("PR", "rng"), ("SNR", "snr"))]
    return wide.agg(*picks)


def read_ismr(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The commercial receiver's minutes: datetime (start of the minute), PRN, angles, Phi60 and corrected S4."""
    return ismr_rows(spark.read.text(paths))


def ismr_rows(lines: DataFrame) -> DataFrame:
    """Lines (value) as minutes."""
    parts = lines.select(F.split("value", ",").alias("_part"))
    return ismr_products(parts.select(*[F.trim(F.get("_part", F.lit(i))).try_cast("double").alias(c) for i, c in enumerate(ISMR)]))


def corrected_s4(total, correction):
    """Square root of the difference of squares, 0 where it is negative."""
    return F.sqrt(F.greatest(F.pow(total, 2) - F.pow(correction, 2), F.lit(0.0)))


def ismr_products(rows: DataFrame) -> DataFrame:
    s4 = [corrected_s4(F.col(f"TotalS4_{i}"), F.col(f"CorrectionS4_{i}")).alias(f"S4L{i}") for i in (1, 2, 3)]
    return rows.select(gps_time(F.col("WN"), F.col("TOW"), -60.0).alias("datetime"), prn_of_number(F.col("SVID").cast("int")).alias("PRN"), "Elevation", "Azimuth", "Phi60_1", "Phi60_2", *s4, "TotalS4_1")
