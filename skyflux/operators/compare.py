"""Comparison with reference sensors, quiet references, correlation."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def compared(products: DataFrame, reference: DataFrame, keys: list[str], x: str, y: str, mask: Column | None = None) -> DataFrame:
    """Inner join on keys; columns of the reference that clash get the suffix _ref."""
    clash = {c: f"{c}_ref" for c in reference.columns if c in products.columns and c not in keys}
    both = products.join(reference.withColumnsRenamed(clash), keys)
    return both.where(mask) if mask is not None else both


def quality_mask(elevation: float = 30, samples: int = 590, slips: int = 10) -> Column:
    return (F.col("elev") > elevation) & (F.col("n_1") > samples) & (F.col("quality_1") == 0) & (F.col("n_cycleslip_1") < slips)


def r2_score(df: DataFrame, keys: list[str], truth: str, estimate: str, name: str = "r2") -> DataFrame:
    """1 - residual over total sum of squares of estimate against truth, by key (no fitted line). Rows with a null in either don't count.

    The total is taken from deviations, not from sums of squares, so large means don't cancel."""
    known = df.where(F.col(truth).isNotNull() & F.col(estimate).isNotNull())
    w = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    if keys:
        known = known.withColumn("_m", F.avg(truth).over(w))
    else:
        known = known.withColumn("_m", known.agg(F.avg(truth)).scalar())
    residual, total = F.sum(F.pow(F.col(truth) - F.col(estimate), 2)), F.sum(F.pow(F.col(truth) - F.col("_m"), 2))
    return known.groupBy(*keys).agg((1 - residual / F.nullif(total, F.lit(0.0))).alias(name), F.count("*").alias("n"))


def best_by_bin(scores: DataFrame, bin_column: str, member: str, score: str) -> DataFrame:
    """The member with the highest score of each bin; ties: the smallest member."""
    return scores.where(F.col(score).isNotNull()).groupBy(bin_column).agg(F.min_by(member, F.struct(-F.col(score), F.col(member))).alias(member), F.max(score).alias(score))


def quiet_reference(df: DataFrame, group: list[str], member: str, ts: str, value: str) -> DataFrame:
    """Among the members of a group that have a value at every one of its times, the one whose largest value is smallest."""
    times = df.groupBy(*group).agg(F.count_distinct(ts).alias("_all"))
    most = df.groupBy(*group, member).agg(F.max(value).alias("most"), F.count(value).alias("_n"))
    full = most.join(times, group) if group else most.withColumn("_all", times.select("_all").scalar())
    full = full.where("_n = _all AND most IS NOT NULL")
    return full.groupBy(*group).agg(F.min_by(member, F.struct("most", member)).alias(member), F.min("most").alias("most"))


def pivot_mean(df: DataFrame, keys: list[str], column: str, value: str, names: list[str]) -> DataFrame:
    return df.groupBy(*keys).pivot(column, names).agg(F.avg(value))


def sample_statistics(df: DataFrame, keys: list[str], value: str, strength: str, slip: str) -> DataFrame:
    """Per bin: sample deviation and count of a value, sum of slips, and deviation over mean of a strength."""
    return df.groupBy(*keys).agg(F.stddev_samp(value).alias("dphi"), F.count(value).alias("count"), F.sum(F.col(slip).cast("int")).alias("cycleslips"), (F.stddev_samp(strength) / F.avg(strength)).alias("s4"))


def bins_between(df: DataFrame, keys: list[str], ts_bin: str, step: str) -> DataFrame:
    """Every bin between a key's first and last, also those without rows."""
    ends = df.groupBy(*keys).agg(F.min(ts_bin).alias("_a"), F.max(ts_bin).alias("_b"))
    return ends.select(*keys, F.explode(F.sequence("_a", "_b", F.expr(f"INTERVAL {step}"))).alias(ts_bin))


def decorrelation(x: np.ndarray, level: float = 1 / np.e) -> float:
    """The first lag at which the autocorrelation falls below level, times 20 (over 700 values) or 10; nan under 10 values."""
    x = x[~np.isnan(x)]
    n = len(x)
    if n < 10:
        return float("nan")
    d = x - x.mean()
    f = np.fft.rfft(d, 2 * n)
    acf = np.fft.irfft(f * np.conj(f), 2 * n)[:n]
    if acf[0] == 0:
        return float("nan")
    below = np.flatnonzero(acf / acf[0] < level)
    return float((below[0] if len(below) else n - 1) * (20 if n > 700 else 10))


def decorrelation_time(df: DataFrame, keys: list[str], order: list[str], x: str, name: str = "tau") -> DataFrame:
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        value = decorrelation(rows.sort_values(order, kind="stable")[x].to_numpy(float))
        return pd.DataFrame([[*key, None if value != value else value]], columns=[*keys, name]).astype({name: object})

    kinds = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)
    return df.select(*dict.fromkeys([*keys, *order, x])).groupBy(*keys).applyInPandas(run, f"{kinds}, {name} double")
