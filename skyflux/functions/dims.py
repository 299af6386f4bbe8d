"""Constellation, satellite and signal dimensions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Numeric constellation codes, letters of constellations.
CONSTELLATIONS = {0: "GPS", 1: "SBS", 2: "GAL", 3: "BDS", 6: "GLO"}
LETTERS = {"GPS": "G", "BDS": "C", "GAL": "E", "GLO": "R", "QZSS": "J", "IRNSS": "I", "SBAS": "S", "SBS": "S"}
#: A signal's frequency in MHz and its class.
SIGNALS = {
    "GPS_L1CA": (1575.42, "Sig1"), "GLO_L1CA": (1602.0, "Sig1"), "GEO_L1": (1575.42, "Sig1"), "QZS_L1CA": (1575.42, "Sig1"),
    "GAL_L1BC": (1575.42, "Sig1"), "GAL_E1": (1575.42, "Sig1"), "BDS_B1I": (1561.098, "Sig1"), "IRNSS_L5": (1176.45, "Sig1"),
    "GPS_L2C": (1227.60, "Sig2"), "GLO_L2C": (1246.00, "Sig2"), "GLO_L2CA": (1246.60, "Sig2"), "QZS_L2C": (1227.60, "Sig2"),
    "GAL_E5a": (1176.45, "Sig2"), "SBAS_L5": (1176.45, "Sig2"), "BDS_B2I": (1207.14, "Sig2"), "GEO_L5": (1176.45, "Sig2"),
    "GPS_L5": (1176.45, "Sig3"), "QZS_L5": (1176.45, "Sig3"), "GAL_E5b": (1207.14, "Sig3"), "BDS_B3I": (1268.52, "Sig3"),
    "GPS_L2PY": (1227.60, "Sig4"), "GPS_L1P": (1575.42, "Sig4"), "GLO_L1P": (1602.00, "Sig4"), "GLO_L2P": (1246.0, "Sig4"),
    "GAL_E5": (1191.795, "Sig4"), "GAL_E6BC": (1278.75, "Sig4"), "GLO_L3": (1202.025, "Sig4"),
}
#: The signals in a constellation's slots 1 to 3.
SLOTS = {
    "GPS": ("GPS_L1CA", "GPS_L2C", "GPS_L5"),
    "GLO": ("GLO_L1CA", "GLO_L2C", "GLO_L3"),
    "GAL": ("GAL_L1BC", "GAL_E5b", "GAL_E5b"),
    "BDS": ("BDS_B1I", "BDS_B2I", "BDS_B3I"),
    "QZSS": ("QZS_L1CA", "QZS_L2C", "QZS_L5"),
}
#: Ranges of satellite numbers (first, last, letter, subtracted).
SATELLITE_RANGES = [(1, 37, "G", 0), (38, 61, "R", 37), (63, 68, "R", 38), (71, 106, "E", 70), (120, 140, "S", 100), (141, 180, "C", 140), (181, 187, "J", 180), (198, 215, "J", 157), (223, 245, "J", 180)]
#: Fixed values of the older TEC: wavelengths in m of two signals, the factor, and the signals, by letter.
LEGACY_TEC = {
    "G": (0.19029367, 0.24421021, 9.529101453519065, "GPS_L1CA", "GPS_L2C"),
    "S": (0.19029367, 0.2548231345, 7.7713726, "GEO_L1", "GEO_L5"),
    "E": (0.19029367, 0.24834937, 8.766203502852782, "GAL_L1BC", "GAL_E5"),
    "C": (0.19203949, 0.24834937, 9.002159172072213, "BDS_B1I", "BDS_B3I"),
    "R": (0.18713637, 0.2406039, 9.76106837, "GLO_L1CA", "GLO_L2CA"),
}
#: Pairs of signals in order of preference.
PAIRS = [("GPS_L1CA", "GPS_L2C"), ("GPS_L1CA", "GPS_L2PY"), ("BDS_B1I", "BDS_B2I"), ("BDS_B1I", "BDS_B3I"), ("GLO_L1CA", "GLO_L2CA"), ("GAL_L1BC", "GAL_E5"), ("GAL_L1BC", "GAL_E5a"), ("GAL_L1BC", "GAL_E5b")]


def lookup(key: Column, table: dict) -> Column:
    """table[key], null where it has none; a literal map that is folded into the plan."""
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in table.items() for x in pair]), key)


def zfill2(number: Column) -> Column:
    """At least two digits; unlike lpad, longer numbers stay whole."""
    text = number.cast("int").cast("string")
    return F.when(F.length(text) < 2, F.lpad(text, 2, "0")).otherwise(text)


def prn(cons: Column, svid: Column) -> Column:
    return F.concat(lookup(cons, LETTERS), zfill2(svid))


def prn_of_number(number: Column) -> Column:
    """The satellite of a receiver's running number; '99' where no range holds it."""
    out = F.lit("99")
    for lo, hi, letter, less in reversed(SATELLITE_RANGES):
        out = F.when(number.between(lo, hi), F.concat(F.lit(letter), zfill2(number - less))).otherwise(out)
    return out


def numeric_constellations(df: DataFrame, column: str = "cons", by: str = "file_id") -> DataFrame:
    """Codes become names in every file (value of `by`, where the table has it) whose rows of the column are all numbers; known from the type, or
    for a text column from an aggregate by file that is joined back. Nothing runs while the plan is built."""
    if df.schema[column].dataType.typeName() != "string":
        return df.withColumn(column, lookup(F.col(column).cast("double").cast("int"), CONSTELLATIONS))
    numbers = F.bool_and(F.col(column).isNull() | F.col(column).try_cast("double").isNotNull())
    name = lookup(F.col(column).try_cast("double").cast("int"), CONSTELLATIONS)
    if by not in df.columns:
        return df.withColumn(column, F.when(df.agg(numbers.alias("all")).scalar(), name).otherwise(F.col(column)))
    kinds = df.groupBy(F.col(by).alias("_by")).agg(numbers.alias("_numbers"))
    both = df.join(kinds, F.col(by).eqNullSafe(F.col("_by")), "left")
    return both.withColumn(column, F.when(F.col("_numbers"), name).otherwise(F.col(column))).select(*df.columns)


def with_signals(df: DataFrame, cons: str = "cons") -> DataFrame:
    """sig_1 .. sig_3 (from the constellation, unless the table has them) and freq_1 .. freq_3 in MHz."""
    infer = "sig_1" not in df.columns
    out = df
    for slot in (1, 2, 3):
        if infer:
            out = out.withColumn(f"sig_{slot}", lookup(F.col(cons), {c: s[slot - 1] for c, s in SLOTS.items()}))
        if f"sig_{slot}" in out.columns:
            out = out.withColumn(f"freq_{slot}", lookup(F.col(f"sig_{slot}"), {s: f for s, (f, _) in SIGNALS.items()}))
    return out


def paired(df: DataFrame, pairs=tuple(PAIRS)) -> DataFrame:
    """the first pair of columns that a row has both of."""
    have = [p for p in pairs if p[0] in df.columns and p[1] in df.columns]
    none = F.lit(None).cast("struct<F1:double,F2:double>")
    both = F.coalesce(*[F.when(F.col(a).isNotNull() & F.col(b).isNotNull(), F.struct(F.col(a).cast("double").alias("F1"), F.col(b).cast("double").alias("F2"))) for a, b in have], none)
    return df.withColumn("_pair", both).select(*df.columns, "_pair.F1", "_pair.F2")
