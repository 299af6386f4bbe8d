"""Naive GPS times: no zone and no leap seconds anywhere."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH = "TIMESTAMP_NTZ '1980-01-06 00:00:00'"


def gps_time(week: Column, seconds: Column, shift: float = 0.0) -> Column:
    """The time of a GPS week and seconds of it, to the microsecond."""
    micros = F.round((week.cast("bigint") * 604800 + seconds.cast("double") + shift) * 1e6).cast("bigint")
    return F.timestamp_add("MICROSECOND", micros, F.expr(EPOCH))


def floor_to(unit: str, ts: Column) -> Column:
    """Start of the second, minute, hour or day, still without a zone."""
    return F.date_trunc(unit, ts).cast("timestamp_ntz")


def parsed(text: Column, pattern: str) -> Column:
    """Naive time of a text, null where it doesn't fit."""
    return F.try_to_timestamp(text, F.lit(pattern)).cast("timestamp_ntz")


def months_before(now: Column, months: int = 3) -> Column:
    """Midnight of the day that many months before now."""
    return F.add_months(now.cast("date"), -months).cast("timestamp_ntz")


def seconds_between(a: Column, b: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", a, b) / 1e6
