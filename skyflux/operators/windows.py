"""Ordered operators over keys: all take (df, keys, order) and column names, and add columns by windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F


def ordered(keys: list[str], order: list[str]) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(*order)


def whole(keys: list[str]) -> WindowSpec:
    return Window.partitionBy(*keys)


def first_diff(x: Column, w: WindowSpec) -> Column:
    return x - F.lag(x).over(w)


def centered(w: WindowSpec, rows: int) -> WindowSpec:
    """The frame of a centred window of so many rows; an even one reaches further back."""
    return w.rowsBetween(-(rows // 2), (rows + 1) // 2 - 1)


def rolling_median(x: Column, w: WindowSpec, rows: int, least: int | None = None) -> Column:
    """Median of a centred window where it has enough values; nulls are skipped."""
    least = max(3, rows // 10) if least is None else least
    frame = centered(w, rows)
    return F.when(F.count(x).over(frame) >= least, F.percentile(x, F.lit(0.5)).over(frame))


def next_value(x: Column, w: WindowSpec) -> Column:
    return F.first(x, ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing))


def last_value(x: Column, w: WindowSpec) -> Column:
    return F.last(x, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))


def fill_both(x: Column, w: WindowSpec) -> Column:
    """Nulls take the next value, and after the last one the last."""
    return F.coalesce(next_value(x, w), last_value(x, w))


def fill_last(x: Column, w: WindowSpec) -> Column:
    return F.coalesce(last_value(x, w), next_value(x, w))


def lerp_both(x: Column, at: Column, w: WindowSpec) -> Column:
    """Nulls on the line between their neighbours' values over `at`; at the ends the nearest value."""
    known = F.when(x.isNotNull(), at)
    a, b, ta, tb = last_value(x, w), next_value(x, w), last_value(known, w), next_value(known, w)
    return F.coalesce(x, a + (b - a) * ((at - ta) / F.nullif(tb - ta, F.lit(0).cast("double"))), a, b)


def cumsum(x: Column, w: WindowSpec) -> Column:
    """Running sum; null where x is."""
    return F.when(x.isNotNull(), F.sum(x).over(w.rowsBetween(Window.unboundedPreceding, 0)))


def edge_gap_mask(df: DataFrame, keys: list[str], order: list[str], x: str, ts: str, fs: float, gap: float = 2.0, pad: float = 180.0, name: str = "edgegap") -> DataFrame:
    """True within pad seconds' rows of a key's ends, of gaps longer than gap seconds and of missing values of x; false for keys without values.

    A gap's mark is on the row behind it."""
    w, rows = ordered(keys, order), round(pad * fs)
    step = F.timestamp_diff("MICROSECOND", F.lag(ts).over(w), F.col(ts)) / 1e6
    ends = F.lag(ts).over(w).isNull() | F.lead(ts).over(w).isNull()
    mark = (ends | F.coalesce(step > gap, F.lit(False)) | F.col(x).isNull()).cast("int")
    any_value = F.count(x).over(whole(keys)) > 0
    return df.withColumn("_mark", mark).withColumn(name, (F.max("_mark").over(w.rowsBetween(-rows, rows)) == 1) & any_value).drop("_mark")


def islands(df: DataFrame, keys: list[str], order: list[str], x: str, name: str = "island") -> DataFrame:
    """Numbers the runs of null and non-null values, from 1."""
    w = ordered(keys, order)
    known = F.col(x).isNotNull()
    changed = F.coalesce((known != F.lag(known).over(w)).cast("int"), F.lit(1))
    return df.withColumn("_changed", changed).withColumn(name, F.sum("_changed").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_changed")


def without_jumps(df: DataFrame, keys: list[str], order: list[str], x: str, threshold: float, name: str) -> DataFrame:
    """Steps larger than threshold are taken out: each moves the rest of the series onto the value before it."""
    w = ordered(keys, order)
    d = first_diff(F.col(x), w)
    jump = F.when(F.abs(d) > threshold, d).otherwise(0.0)
    return df.withColumn("_jump", jump).withColumn(name, F.col(x) - F.sum("_jump").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_jump")


def regular_grid(df: DataFrame, keys: list[str], ts: str, x: str, step: str, order: list[str] | None = None) -> DataFrame:
    """keys, ts and x at every step from a key's first to its last time: the values there, time-weighted lines between.

    Values off the grid have no part, as in a reindex. Of several rows at one time the first in order counts (without an order the one with the smallest value)."""
    ends = df.groupBy(*keys).agg(F.min(ts).alias("_a"), F.max(ts).alias("_b"))
    grid = ends.select(*keys, F.explode(F.sequence("_a", "_b", F.expr(f"INTERVAL {step}"))).alias(ts))
    found = df.groupBy(*keys, ts).agg((F.min_by(x, F.struct(*order)) if order else F.min(x)).alias(x))
    w = ordered(keys, [ts])
    at = F.timestamp_diff("MICROSECOND", F.expr("TIMESTAMP_NTZ '1980-01-06 00:00:00'"), F.col(ts)).cast("double")
    full = grid.join(found, [*keys, ts], "left").withColumn("_at", at)
    return full.select(*keys, ts, F.coalesce(lerp_both(F.col(x), F.col("_at"), w), F.lit(None)).alias(x))


def time_steps(df: DataFrame, keys: list[str], order: list[str], ts: str, name: str = "dt") -> DataFrame:
    """Seconds since the row before."""
    return df.withColumn(name, F.timestamp_diff("MICROSECOND", F.lag(ts).over(ordered(keys, order)), F.col(ts)) / 1e6)


def first_of_each(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key."""
    return df.withColumn("_rn", F.row_number().over(ordered(keys, order))).where("_rn = 1").drop("_rn")


def trimmed(df: DataFrame, ts: str, minutes: int = 5) -> DataFrame:
    """Without so many minutes at both ends of the table's time range; the ends are scalars, not a join."""
    a, b = df.agg(F.min(ts).alias("a")).scalar(), df.agg(F.max(ts).alias("b")).scalar()
    gap = F.expr(f"INTERVAL {minutes} MINUTES")
    return df.where((F.col(ts) >= a + gap) & (F.col(ts) <= b - gap))
