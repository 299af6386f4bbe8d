"""Total electron content in TECU (1e16 electrons a square metre). Frequencies in Hz."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LIGHT = 299792458.0


def factor(f1: Column, f2: Column) -> Column:
    a, b = f1 * f1, f2 * f2
    return a * b / (40.3 * (a - b))


def carrier_tec(cycles1: Column, cycles2: Column, f1: Column, f2: Column) -> Column:
    return factor(f1, f2) * (cycles1 * (LIGHT / f1) - cycles2 * (LIGHT / f2)) / F.lit(1e16)


def code_tec(metres1: Column, metres2: Column, f1: Column, f2: Column) -> Column:
    return factor(f1, f2) * (metres2 - metres1) / F.lit(1e16)
