"""Scintillation indices by satellite and bin."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.clean import linear


def s4(strength: Column) -> Column:
    """Aggregate: population deviation over mean of a linear strength; null without values or a positive mean."""
    mean = F.avg(strength)
    return F.when(mean > 0, F.stddev_pop(strength) / mean)


def s4_corrected(strength: Column) -> Column:
    """Aggregate: S4 without the part that noise alone would give; 0 where that is all of it."""
    mean = F.avg(strength)
    square = F.pow(F.stddev_pop(strength) / mean, 2) - 100 / mean * (1 + 500 / (19 * mean))
    return F.when(mean > 0, F.sqrt(F.greatest(square, F.lit(0.0))))


def sigma_phi(phase: Column) -> Column:
    return F.stddev_pop(phase)


def n_true(flag: Column) -> Column:
    return F.count_if(flag)


def any_true(flag: Column) -> Column:
    """1 or 0, and 0 without values."""
    return F.coalesce(F.max(flag.cast("int")), F.lit(0))


def product_aggregates(columns: list[str]) -> dict[str, Column]:
    """The products that a table's columns allow, by name."""
    out = {}
    for i in (1, 2, 3):
        if f"detrended_noclk_cph{i}" in columns:
            phase = F.col(f"detrended_noclk_cph{i}")
            out |= {f"sigma_phi_{i}": sigma_phi(phase), f"n_{i}": F.count(phase)}
        if f"cycleslips_cph{i}" in columns:
            out[f"n_cycleslip_{i}"] = n_true(F.col(f"cycleslips_cph{i}"))
        if f"edgegap_mask_cph{i}" in columns:
            out[f"quality_{i}"] = any_true(F.col(f"edgegap_mask_cph{i}"))
        if f"snr{i}" in columns:
            strength = linear(F.col(f"snr{i}").cast("double"))
            out |= {f"s4_{i}": s4(strength), f"s4_corrected_{i}": s4_corrected(strength)}
    return out


def products(df: DataFrame, keys: list[str], null_keys: bool = False, **more: Column) -> DataFrame:
    """One row for each key, also with other aggregates; rows with a null key have none, or with null_keys nulls are a key like others."""
    known = df if null_keys else df.where(" AND ".join(f"{k} IS NOT NULL" for k in keys))
    return known.groupBy(*keys).agg(*[c.alias(n) for n, c in (product_aggregates(df.columns) | more).items()])


def with_products(df: DataFrame, keys: list[str]) -> DataFrame:
    """Every row with its key's products: as a left join of products(), but in one exchange."""
    w = Window.partitionBy(*keys)
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    parts: dict[str, Column] = {}
    for i in (1, 2, 3):
        if f"detrended_noclk_cph{i}" in df.columns:
            phase = F.col(f"detrended_noclk_cph{i}")
            parts |= {f"sigma_phi_{i}": F.stddev_pop(phase).over(w), f"n_{i}": F.count(phase).over(w)}
        if f"cycleslips_cph{i}" in df.columns:
            parts[f"n_cycleslip_{i}"] = F.count_if(F.col(f"cycleslips_cph{i}")).over(w)
        if f"edgegap_mask_cph{i}" in df.columns:
            parts[f"quality_{i}"] = F.coalesce(F.max(F.col(f"edgegap_mask_cph{i}").cast("int")).over(w), F.lit(0))
        if f"snr{i}" in df.columns:
            strength = linear(F.col(f"snr{i}").cast("double"))
            mean, deviation = F.avg(strength).over(w), F.stddev_pop(strength).over(w)
            square = F.pow(deviation / mean, 2) - 100 / mean * (1 + 500 / (19 * mean))
            parts |= {f"s4_{i}": F.when(mean > 0, deviation / mean), f"s4_corrected_{i}": F.when(mean > 0, F.sqrt(F.greatest(square, F.lit(0.0))))}
    return df.withColumns({n: F.when(known, c) for n, c in parts.items()})
