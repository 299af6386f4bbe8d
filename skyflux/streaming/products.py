"""Minute products over arriving lvl0 files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.clean import zero_to_null
from ..operators.products import product_aggregates


def streamed_products(rows: DataFrame, ts: str, keys: list[str], width: str = "1 minute", late: str = "10 minutes") -> DataFrame:
    """S4 and the other aggregates that the columns allow, by key and window; rows later than `late` are dropped, windows appear once they are closed."""
    clean = zero_to_null(rows)
    grouped = clean.withWatermark(ts, late).groupBy(F.window(ts, width).alias("bin"), *keys)
    return grouped.agg(*[c.alias(n) for n, c in product_aggregates(clean.columns).items()]).select(F.col("bin.start").alias("bin"), *keys, *product_aggregates(clean.columns))
