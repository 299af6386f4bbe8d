"""The Spark session that the engine expects."""

from __future__ import annotations

from pyspark.sql import SparkSession


def get_session(app: str = "skyflux", **conf: str) -> SparkSession:
    """A session with naive UTC times, adaptive plans and Arrow transfer; conf overrides (underscores stand for dots)."""
    builder = SparkSession.builder.appName(app)
    settings = {
        "spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true", "spark.sql.parquet.compression.codec": "zstd",
    }
    for key, value in (settings | {k.replace("_", "."): v for k, v in conf.items()}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
