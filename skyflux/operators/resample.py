"""Downsampling to one row for each key and bin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.timefn import floor_to


def first_known(column: str, order: Column) -> Column:
    """Aggregate: the first value in order that isn't null, whatever the partitions' order."""
    return F.min_by(F.when(F.col(column).isNotNull(), F.col(column)), F.when(F.col(column).isNotNull(), order))


def downsampled(df: DataFrame, keys: list[str], order: list[str], method: Callable[[str], Column] | None = None) -> DataFrame:
    """Each other column's first known value, or method(column), for every key without nulls."""
    at = F.struct(*order)
    pick = method or (lambda c: first_known(c, at))
    known = df.where(" AND ".join(f"`{k}` IS NOT NULL" for k in keys))
    return known.groupBy(*keys).agg(*[pick(c).alias(c) for c in df.columns if c not in keys])


def to_seconds(df: DataFrame) -> DataFrame:
    """lvl2: file_id, secbin and prn."""
    return downsampled(df.withColumn("secbin", floor_to("second", F.col("datetime"))), ["file_id", "secbin", "prn"], ["row_id"])


def to_minutes(df: DataFrame, method: Callable[[str], Column] | None = None) -> DataFrame:
    """lvl3: file_id, minbin and prn."""
    return downsampled(df, ["file_id", "minbin", "prn"], ["row_id"], method)
