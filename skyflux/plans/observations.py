"""Driver tables seen as observations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Which constellation an event type stands for.
TYPES = {"click": "GPS", "view": "GAL", "purchase": "BDS", "signup": "GLO", "error": "SBS"}
SQL = """obs AS (SELECT event_id, ts, user_id, event_type, value, user_id % 37 AS svid,
  CASE event_type WHEN 'click' THEN 'GPS' WHEN 'view' THEN 'GAL' WHEN 'purchase' THEN 'BDS' WHEN 'signup' THEN 'GLO' WHEN 'error' THEN 'SBS' END AS cons,
  least(value, 60.0) AS db, date_trunc('day', ts)::TIMESTAMP AS day FROM events)"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..functions.dims import lookup
    from ..functions.timefn import floor_to

    e = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    return e.withColumns({"svid": F.col("user_id") % 37, "cons": lookup(F.col("event_type"), TYPES), "db": F.least("value", F.lit(60.0)), "day": floor_to("day", F.col("ts"))})


def r(x: Column, name: str, digits: int = 6) -> Column:
    """Rounded, without a negative zero."""
    return (F.round(x, digits) + F.lit(0.0)).alias(name)
