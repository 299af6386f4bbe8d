"""The availability report: listings of the stations' folders, days with data, their gaps, and the figure."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timefn import months_before
from ..operators.availability import intervals, legacy_days, missing_days, sc4_days, station_labels
from ..sources.sinks import write_table
from ..sources.stations import list_files, read_stations


def tables(paths: DataFrame, stations: DataFrame, now, second: str, codes: dict[str, str], months: int = 3) -> dict[str, DataFrame]:
    """intervals, missing and labels since so many months before now. paths: path; stations as read_stations() gives them; now: a naive timestamp column."""
    cutoff = months_before(now, months)
    days = legacy_days(paths, stations, cutoff, second)
    if codes:
        days = days.unionByName(sc4_days(paths, stations, codes, cutoff)).distinct()
    return {"intervals": intervals(days, now), "missing": missing_days(days, stations, cutoff, now), "labels": station_labels(stations)}


def report(spark: SparkSession, root: str, stations: str, output: str, second: str, codes: dict[str, str], months: int = 3, now=None, glob: str = "*", overwrite: bool = True, figure: str | None = None) -> list[str]:
    """Writes the tables under output, and the figure to a local path if one is given (needs matplotlib); returns the tables' paths. Mail is left to the caller
    (sources.reports.status_mail)."""
    now = F.lit(now).cast("timestamp_ntz") if now is not None else F.localtimestamp()
    made = []
    for name, df in tables(list_files(spark, root, glob).select("path"), read_stations(spark, stations), now, second, codes, months).items():
        write_table(df, f"{output}/{name}", overwrite)
        made.append(f"{output}/{name}")
    if figure:
        from ..sources.reports import availability_figure

        ends = spark.range(1).select(months_before(now, months).alias("a"), now.alias("b")).first()
        availability_figure(spark.read.parquet(made[2]), spark.read.parquet(made[0]), ends["a"], ends["b"], figure)
    return made
