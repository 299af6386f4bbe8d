"""Null rules and narrowing."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import UNUSED


def zero_to_null(df: DataFrame, pattern: str = r"^(cph|snr)\d+$") -> DataFrame:
    """Zeros in matching columns are missing values."""
    found = [c for c in df.columns if re.match(pattern, c)]
    return df.withColumns({c: F.nullif(F.col(c), F.lit(0).cast(df.schema[c].dataType)) for c in found}) if found else df


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN would survive aggregates that skip nulls; no table of the engine has any."""
    found = [f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in found}) if found else df


def finite(x: Column) -> Column:
    """x, null where it is infinite or no number."""
    return F.when(~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))), x)


def unsigned(x: Column, bits: int) -> Column:
    """x wrapped around into an unsigned number of so many bits."""
    return x.cast("bigint").bitwiseAND(F.lit(2**bits - 1)).cast("int")


def to_lvl0(df: DataFrame) -> DataFrame:
    """Without unused columns and empty slots; elevation and azimuth in their unsigned widths."""
    out = df.drop(*UNUSED).where(F.col("svid") != 255)
    return out.withColumns({c: unsigned(F.col(c), b) for c, b in (("elev", 8), ("azim", 16)) if c in out.columns})


def linear(db: Column) -> Column:
    """Decibels as a ratio."""
    return F.pow(F.lit(10.0), db / 10)


def metric_masks(df: DataFrame, elevation_over: float = 30, share: float = 0.98, slots=(1, 2)) -> DataFrame:
    """Nulls sigma_phi where its quality, elevation or sample count won't do, and s4 where elevation or count won't; rows stay."""
    most = df.agg(F.max("n_1").alias("n")).scalar() if "n_1" in df.columns else F.lit(None)
    out = {}
    for i in slots:
        high = (F.col("elev") > elevation_over) & (F.col("elev") < 91) & (F.col(f"n_{i}") / most > share)
        out[f"sigma_phi_{i}"] = F.when(high & (F.col(f"quality_{i}") == 0), F.col(f"sigma_phi_{i}"))
        out[f"s4_{i}"] = F.when(high, F.col(f"s4_{i}"))
    return df.withColumns(out)
