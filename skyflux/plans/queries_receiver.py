"""Queries that run the pipeline's own parts, kernels and readers.

lineitem stands for a receiver's records: a line number is a satellite, sampled at 10 Hz in order of the rows' keys and values, with a jump after 30 s and a few missing phases.
part stands for raw records, written as the receivers write them and read again."""

from __future__ import annotations

import io
import struct
import zipfile

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from ..operators import detrend, windows
from ..plans import pipeline
from ..schemas import ISMR, V325, V326, V326_HEADER, V326_RECORDS
from ..sources import receivers
from .observations import SQL, events, r, table
from .queries_scalar import RANGE_CASES

KEY = ["file_id", "prn", "row_id"]
ORDER = ["l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_tax"]


def receiver(spark, sf):
    """lvl0 of two files, of two constellations."""
    line = table(spark, sf, "lineitem").select(*ORDER, "l_linenumber")
    rows = line.withColumn("row_id", (F.row_number().over(windows.ordered(["l_linenumber"], ORDER)) - 1).cast("bigint"))
    odd, n = F.col("l_linenumber") % 2, F.col("row_id")
    phase = 1000 + n * 0.5 + F.col("l_discount") * 0.01 + F.when(n >= 300, 50.0).otherwise(0.0)
    return rows.select(
        F.concat(F.lit("f"), odd).alias("file_id"), "row_id", F.timestamp_add("MILLISECOND", n * 100, F.expr("TIMESTAMP_NTZ '2024-05-10 00:00:00'")).alias("datetime"),
        (odd * 2).cast("smallint").alias("cons"), F.col("l_linenumber").cast("smallint").alias("svid"), F.lit(45).alias("elev"), F.lit(100).alias("azim"),
        (F.col("l_quantity") % 20 + 30).cast("smallint").alias("snr1"), F.when(F.col("l_orderkey") % 7001 == 17, 0.0).otherwise(phase).alias("cph1"),
        (800 + n * 0.4 + F.col("l_tax") * 0.01).alias("cph2"), (2e7 + n * 10 + F.col("l_tax")).alias("rng1"), (2e7 + n * 10 + F.col("l_discount")).alias("rng2"),
    )


W = "(PARTITION BY prn ORDER BY row_id)"
BACK = "(PARTITION BY prn ORDER BY row_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
AHEAD = "(PARTITION BY prn ORDER BY row_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
LEVEL0 = f"""rc AS (SELECT 'f' || (l_linenumber % 2)::VARCHAR AS file_id, CASE l_linenumber % 2 WHEN 0 THEN 'G0' ELSE 'E0' END || l_linenumber::VARCHAR AS prn, l_linenumber % 2 AS odd,
  l_orderkey, l_quantity, l_discount, l_tax, row_number() OVER (PARTITION BY l_linenumber ORDER BY {", ".join(ORDER)}) - 1 AS row_id FROM lineitem),
lv AS (SELECT *, CASE WHEN l_orderkey % 7001 <> 17 THEN 1000 + row_id * 0.5::DOUBLE + l_discount * 0.01::DOUBLE + CASE WHEN row_id >= 300 THEN 50.0::DOUBLE ELSE 0.0 END END AS cph1,
  800 + row_id * 0.4::DOUBLE + l_tax * 0.01::DOUBLE AS cph2, 2e7 + row_id * 10 + l_tax AS rng1, 2e7 + row_id * 10 + l_discount AS rng2,
  TIMESTAMP '2024-05-10' + to_milliseconds(row_id * 100) AS t, floor(l_quantity % 20 + 30) AS snr, 1575.42e6::DOUBLE AS f1, CASE odd WHEN 0 THEN 1227.6e6::DOUBLE ELSE 1207.14e6 END AS f2 FROM rc)"""


def _lines(x: str, source: str) -> str:
    """source with x on lines over its missing values as `line`."""
    return f"""(SELECT *, coalesce(x, va + (vb - va) * ((row_id - ra)::DOUBLE / nullif(rb - ra, 0)), va, vb) AS line FROM (SELECT *,
  last_value(x IGNORE NULLS) OVER {BACK} AS va, first_value(x IGNORE NULLS) OVER {AHEAD} AS vb, last_value(CASE WHEN x IS NOT NULL THEN row_id END IGNORE NULLS) OVER {BACK} AS ra,
  first_value(CASE WHEN x IS NOT NULL THEN row_id END IGNORE NULLS) OVER {AHEAD} AS rb FROM (SELECT *, {x} AS x FROM {source})))"""


def _slips(name: str, y: str, source: str) -> str:
    """name_s: source with the slips of y, as the kernel finds them at 10 Hz with a threshold of 1."""
    return f"""{name}_b AS (SELECT *, y - lag(y) OVER {W} AS d, count(*) OVER (PARTITION BY prn) AS n FROM (SELECT *, {y} AS y FROM {source})),
{name}_c AS (SELECT *, CASE WHEN count(d) OVER g >= 10 THEN median(d) OVER g END AS t0 FROM {name}_b WINDOW g AS (PARTITION BY prn ORDER BY row_id ROWS BETWEEN 50 PRECEDING AND 49 FOLLOWING)),
{name}_s AS (SELECT *, NOT coalesce(abs(d - coalesce(first_value(t0 IGNORE NULLS) OVER {AHEAD}, last_value(t0 IGNORE NULLS) OVER {BACK})) <= 1.0, false) AS slip FROM {name}_c)"""


def _repaired(name: str, y: str) -> str:
    """name: lv with y repaired (fixed)."""
    first = f"CASE WHEN row_id = 0 AND n > 1 THEN lead(CASE WHEN NOT slip THEN d END) OVER {W} WHEN NOT slip THEN d END"
    totals = f"(SELECT * EXCLUDE (y, d, t0), y AS y, d AS d, sum(slip::INTEGER) OVER (PARTITION BY prn) AS ns, first_value(y) OVER {W} AS y0, {first} AS step FROM {name}_s)"
    return f"""{_slips(name, y, "lv")}, {name} AS (SELECT file_id, prn, row_id, CASE WHEN ns::DOUBLE / n > 0.2 AND n > 10 THEN y ELSE y0 + sum(line) OVER {BACK} END AS fixed FROM {_lines("step", totals)})"""


_FACTOR = "(f1 * f1) * (f2 * f2) / (40.3 * (f1 * f1 - f2 * f2))"
#: Slips and masks of the first phase: lines over missing values, in radians; both constellations' first signals are L1.
MASKS = f"""{LEVEL0}, {_slips("ph", "2 * pi() * line", _lines("cph1", "lv"))},
mk AS (SELECT *, slip AND cph1 IS NOT NULL AS cycleslip, max((cph1 IS NULL OR row_id = 0 OR row_id = n - 1)::INTEGER) OVER (PARTITION BY prn ORDER BY row_id ROWS BETWEEN 1800 PRECEDING AND 1800 FOLLOWING) AS edge FROM ph_s)"""


def detrended_masks(spark, sf):
    """Slips and edge masks as the pipeline's kernel finds them."""
    d = detrend.detrended(detrend.formatted(receiver(spark, sf)))
    return d.select(*KEY, F.col("cycleslips_cph1").alias("cycleslip"), F.col("edgegap_mask_cph1").alias("edgegap"))


def tec_repaired(spark, sf):
    lvl0 = detrend.formatted(receiver(spark, sf)).select(*KEY, "cph1", "cph2", "rng1", "rng2", "freq_1", "freq_2", F.lit(10.0).alias("fs"))  # the map carries all that it is given
    t = detrend.with_tec(lvl0)
    return t.select(*KEY, r(F.col("tec_cph12"), "carrier", 4), r(F.col("tec_rng12"), "code", 4))


def file_stats(spark, sf):
    s = detrend.with_file_stats(detrend.formatted(receiver(spark, sf)))
    return s.select("file_id", "fs", r(F.col("_thr1"), "threshold_1", 9), r(F.col("_thr2"), "threshold_2", 9)).distinct()


def minute_products(spark, sf):
    """The pipeline from lvl0 to minutes."""
    m = pipeline.minutes(receiver(spark, sf))
    return m.select("file_id", "minbin", "prn", F.col("n_1").alias("n"), F.col("n_cycleslip_1").alias("slips"), F.col("quality_1").alias("quality"), r(F.col("s4_1"), "s4"), F.col("snr1").cast("int").alias("snr"), "sig_2")


def _files(spark, sf, version):
    """path and content of made files; every second one is zipped."""

    def write(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows, k = rows.sort_values("p_partkey"), int(key[0])
        out = np.zeros(len(rows), V325 if version == "v325" else V326)
        number = rows.p_partkey.to_numpy()
        out["towe"], out["cons"], out["svid"], out["elev"], out["azim"] = number % 4096, number % 7, number % 250, number % 200 - 100, number
        out["cph1"], out["rng2"] = rows.p_retailprice, rows.p_size
        head = b""
        if version == "v325":
            out["week"] = 2000 + k
        else:
            head = struct.pack(V326_HEADER, *([0] * 14), 2000 + k).ljust(V326_RECORDS, b"\0")
        name = f"/made/{k}_{version}.bin"
        content = head + out.tobytes()
        if k % 2:
            packed = io.BytesIO()
            with zipfile.ZipFile(packed, "w") as z:
                z.writestr(f"{k}_{version}.bin", content)
            content, name = packed.getvalue(), f"{name}.zip"
        return pd.DataFrame({"path": [name], "content": [content]})

    parts = table(spark, sf, "part").select("p_partkey", "p_retailprice", F.col("p_size").cast("double").alias("p_size"))
    return parts.groupBy((F.col("p_partkey") % 16).alias("k")).applyInPandas(write, "path string, content binary")


def _binary(version: str):
    def query(spark, sf):
        rows, _ = receivers.records_of(_files(spark, sf, version), version)
        small = [F.col(c).cast("int").alias(c) for c in ("cons", "svid", "elev")]
        return rows.select("file_id", "row_id", "week", F.col("towe").cast("double").alias("towe"), *small, "azim", "cph1", "rng2")

    return query


def _binary_sql(version: str) -> str:
    return f"""SELECT '/made/' || (p_partkey % 16)::VARCHAR || '_{version}.bin' || CASE WHEN p_partkey % 2 = 1 THEN '.zip' ELSE '' END AS file_id, row_number() OVER (PARTITION BY p_partkey % 16 ORDER BY p_partkey) - 1 AS row_id,
(2000 + p_partkey % 16)::INTEGER AS week, (p_partkey % 4096)::DOUBLE AS towe, (p_partkey % 7)::INTEGER AS cons, (p_partkey % 250)::INTEGER AS svid, (p_partkey % 200 - 100)::INTEGER AS elev, p_partkey::INTEGER AS azim, p_retailprice AS cph1, p_size::DOUBLE AS rng2 FROM part"""


def _line(cells: list, between: str):
    return F.concat_ws(between, *[F.lit(c) if isinstance(c, str) else c for c in cells])


def text_records(spark, sf):
    n = F.col("event_id").cast("string")
    line = _line(["2300", n, "x", "3", (F.col("user_id") % 60).cast("string"), "45", "100", "40", "41", F.concat(n, F.lit(".5")), "0", "bad", "0", "7", "0", "8"], "  ")
    lines = events(spark, sf).select(F.concat(F.when(F.col("event_id") % 5 == 0, "   ").otherwise(""), line).alias("value"), F.lit("a").alias("file_id"))
    return receivers.v324_rows(lines).select(F.col("towe").cast("bigint").alias("event_id"), "week", *[F.col(c).cast("int").alias(c) for c in ("cons", "svid")], "cph1", "cph2", "rng2")


def _measurements(spark, sf):
    phase = F.when(F.col("event_id") % 7 == 0, "Error").otherwise((F.col("value") * 2).cast("string"))
    signal = F.when(F.col("event_id") % 2 == 0, "GPS_L1CA").otherwise("GPS_L2C")
    line = _line([F.col("event_id").cast("string"), "2306", F.concat(F.lit("G"), "user_id"), signal, "Main", F.col("value").cast("string"), phase, "0", "45", "60"], ",")
    return receivers.sc4_rows(events(spark, sf).select(line.alias("value"), F.lit("m").alias("file_id")))


def sc4_records(spark, sf):
    return _measurements(spark, sf).drop("file_id")


def sc4_side_by_side(spark, sf):
    rows = _measurements(spark, sf).withColumn("datetime", F.date_trunc("hour", "datetime").cast("timestamp_ntz"))
    first = rows.groupBy("file_id", "datetime", "SVID", "SIG").agg(*[F.max(c).alias(c) for c in ("Phase", "PR", "SNR")])
    return receivers.sc4_wide(first).select("datetime", "prn", "sig_1", "cph1", "rng1", "sig_2", "cph2", "snr2")


MEASUREMENTS = """s AS (SELECT event_id::DOUBLE AS TOW, 2306 AS WN, 'G' || user_id::VARCHAR AS SVID, CASE event_id % 2 WHEN 0 THEN 'GPS_L1CA' ELSE 'GPS_L2C' END AS SIG, value AS PR, value * 2 AS Phase, 45.0::DOUBLE AS SNR,
TIMESTAMP '1980-01-06' + to_microseconds((2306 * 604800 + event_id) * 1000000) AS datetime FROM events WHERE event_id % 7 <> 0)"""
_WIDE = ", ".join(f"max({x}) FILTER (WHERE SIG = '{s}') AS {n}" for x, s, n in (("SIG", "GPS_L1CA", "sig_1"), ("Phase", "GPS_L1CA", "cph1"), ("PR", "GPS_L1CA", "rng1"), ("SIG", "GPS_L2C", "sig_2"), ("Phase", "GPS_L2C", "cph2"), ("SNR", "GPS_L2C", "snr2")))


def ismr_records(spark, sf):
    cells = {"WN": "2300", "TOW": (F.col("event_id") + 60).cast("string"), "SVID": (F.col("user_id") % 250).cast("string"), "TotalS4_1": (F.col("value") / 64).cast("string"), "CorrectionS4_1": "0.5", "Phi60_2": "x", "Azimuth": F.col("user_id").cast("string")}
    lines = events(spark, sf).select(_line([cells.get(c, "1") for c in ISMR], ",").alias("value"))
    return receivers.ismr_rows(lines).select("datetime", "PRN", "Azimuth", "Phi60_1", "Phi60_2", r(F.col("S4L1"), "S4L1"), "S4L2")


QUERIES = {
    "detrended_masks": (detrended_masks, f"WITH {MASKS} SELECT file_id, prn, row_id, cycleslip, edge = 1 AS edgegap FROM mk"),
    "tec_repaired": (tec_repaired, f"""WITH {LEVEL0}, {_repaired("tc", f"{_FACTOR} * (cph1 * (299792458.0 / f1) - cph2 * (299792458.0 / f2)) / 1e16")}, {_repaired("tr", f"{_FACTOR} * (rng2 - rng1) / 1e16")}
SELECT tc.file_id, prn, row_id, round(tc.fixed - avg(tc.fixed) OVER (PARTITION BY prn), 4) + 0.0 AS carrier, round(tr.fixed, 4) + 0.0 AS code FROM tc JOIN tr USING (prn, row_id)"""),
    "file_stats": (file_stats, f"WITH {LEVEL0}, n AS (SELECT file_id, prn, date_trunc('minute', t) AS m, count(*) AS n FROM lv GROUP BY ALL), k AS (SELECT file_id, max(n) AS n FROM n GROUP BY file_id), q AS (SELECT file_id, median(f2) AS f2 FROM lv GROUP BY file_id) SELECT file_id, CASE WHEN abs(n - 600) < 10 THEN 10.0::DOUBLE END AS fs, 1.0::DOUBLE AS threshold_1, round(f2 / 1575.42e6, 9) AS threshold_2 FROM k JOIN q USING (file_id)"),
    "minute_products": (minute_products, f"WITH {MASKS} SELECT file_id, date_trunc('minute', t)::TIMESTAMP AS minbin, prn, count(cph1) AS n, count(*) FILTER (WHERE cycleslip) AS slips, max(edge) AS quality, round(stddev_pop(pow(10.0, snr / 10)) / avg(pow(10.0, snr / 10)), 6) + 0.0 AS s4, arg_min(snr, row_id)::INTEGER AS snr, CASE left(prn, 1) WHEN 'G' THEN 'GPS_L2C' ELSE 'GAL_E5b' END AS sig_2 FROM mk GROUP BY file_id, minbin, prn"),
    "binary_v325": (_binary("v325"), _binary_sql("v325")),
    "binary_v326": (_binary("v326"), _binary_sql("v326")),
    "text_records": (text_records, "SELECT event_id, 2300 AS week, 3 AS cons, (user_id % 60)::INTEGER AS svid, event_id + 0.5::DOUBLE AS cph1, NULL::DOUBLE AS cph2, 8.0::DOUBLE AS rng2 FROM events"),
    "sc4_records": (sc4_records, f"WITH {MEASUREMENTS} SELECT * FROM s"),
    "sc4_side_by_side": (sc4_side_by_side, f"WITH {MEASUREMENTS} SELECT date_trunc('hour', datetime)::TIMESTAMP AS datetime, SVID AS prn, {_WIDE} FROM s GROUP BY date_trunc('hour', datetime)::TIMESTAMP, SVID"),
    "ismr_records": (ismr_records, f"SELECT TIMESTAMP '1980-01-06' + to_microseconds((2300 * 604800 + event_id) * 1000000) AS datetime, CASE {RANGE_CASES} ELSE '99' END AS PRN, user_id::DOUBLE AS Azimuth, 1.0::DOUBLE AS Phi60_1, NULL::DOUBLE AS Phi60_2, round(sqrt(greatest(pow(value / 64, 2) - 0.25, 0.0)), 6) + 0.0 AS S4L1, 0.0::DOUBLE AS S4L2 FROM (SELECT *, user_id % 250 AS n FROM events)"),
}
