"""Queries on projections, filters and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import clean, dims, geo, tec, timefn
from ..operators.detrend import without_unknown
from ..operators.windows import trimmed
from ..sources import receivers, stations
from .observations import SQL, events, r, table

SIGNAL_ROWS = ", ".join(f"('{c}', '{a}', '{b}', '{d}')" for c, (a, b, d) in dims.SLOTS.items())
FREQUENCY_ROWS = ", ".join(f"('{s}', {f}::DOUBLE)" for s, (f, _) in dims.SIGNALS.items())
RANGE_CASES = " ".join(f"WHEN n BETWEEN {a} AND {b} THEN '{c}' || CASE WHEN n - {d} < 10 THEN '0' ELSE '' END || (n - {d})::VARCHAR" for a, b, c, d in dims.SATELLITE_RANGES)


def prn_format(spark, sf):
    e = events(spark, sf)
    return e.select("event_id", "cons", dims.prn(F.col("cons"), F.col("user_id")).alias("prn"))


def numeric_constellation(spark, sf):
    e = table(spark, sf, "events").select("event_id", (F.col("user_id") % 7).cast("string").alias("cons"))
    return dims.numeric_constellations(e).select("event_id", "cons")


def glonass_filter(spark, sf):
    e = events(spark, sf).withColumn("svid", F.when(F.col("user_id") % 5 == 0, 255).otherwise(F.col("svid")))
    return without_unknown(e).select("event_id", "cons", "svid")


def gps_time(spark, sf):
    e = events(spark, sf)
    return e.select("event_id", timefn.gps_time(F.col("user_id") + 1000, F.col("value")).alias("t"), timefn.gps_time(F.col("user_id") + 1000, F.col("value"), -60.0).alias("minute_start"))


def floor_times(spark, sf):
    e = events(spark, sf)
    return e.select("event_id", *[timefn.floor_to(u, F.col("ts")).alias(u) for u in ("second", "minute", "day")])


def parse_times(spark, sf):
    e = table(spark, sf, "events").select("event_id", F.when(F.col("event_id") % 10 == 0, "20241301").otherwise(F.date_format("ts", "yyyyMMdd")).alias("d"), F.date_format("ts", "yyyyMMddHHmm").alias("m"))
    return e.select("event_id", timefn.parsed(F.col("d"), "yyyyMMdd").alias("day"), timefn.parsed(F.col("m"), "yyyyMMddHHmm").alias("minute"))


def recent_events(spark, sf):
    e = events(spark, sf)
    now = e.agg(F.max("ts").alias("t")).scalar()
    return e.where(F.col("ts") >= timefn.months_before(now, 3)).select("event_id", "ts")


def median_day(spark, sf):
    days = events(spark, sf).select(F.unix_date(F.col("ts").cast("date")).alias("d"))
    return days.agg(F.date_format(F.date_from_unix_date(F.floor(F.percentile("d", F.lit(0.5))).cast("int")), "yyyy-MM-dd").alias("label"))


def zero_to_null(spark, sf):
    e = events(spark, sf).select("event_id", F.floor("value").cast("int").alias("cph1"), (F.col("user_id") % 3).alias("snr2"), (F.col("user_id") % 3).alias("rng1"))
    return clean.zero_to_null(e.withColumn("cph1", F.col("cph1") % 4))


def signal_dimension(spark, sf):
    s = dims.with_signals(events(spark, sf).select("event_id", "cons"))
    return s.select("event_id", *[c for i in (1, 2, 3) for c in (f"sig_{i}", f"freq_{i}")])


def elev_wrap(spark, sf):
    e = events(spark, sf)
    return e.select("event_id", clean.unsigned(F.col("user_id") - 20, 8).alias("elev"), clean.unsigned(F.col("user_id") * 1000 - 20, 16).alias("azim"))


def lvl0_projection(spark, sf):
    e = events(spark, sf).select("event_id", F.when(F.col("user_id") % 9 == 0, 255).otherwise(F.col("svid")).alias("svid"), (F.col("user_id") % 91 - 1).alias("elev"), F.col("user_id").alias("azim"), F.lit(1).alias("sats"), F.lit(2).alias("pst1"))
    return clean.to_lvl0(e)


def linear_snr(spark, sf):
    return events(spark, sf).select("event_id", r(clean.linear(F.col("db") / 2), "lin", 4))


def finite_filter(spark, sf):
    e = events(spark, sf).select("event_id", clean.finite(F.log(F.greatest(F.col("value") - 20, F.lit(0.0)) + F.when(F.col("user_id") % 4 == 0, 0.0).otherwise(1.0))).alias("x"))
    return e.where("x IS NOT NULL AND x >= 0").select("event_id", r(F.col("x"), "x"))


def trim_range(spark, sf):
    return trimmed(events(spark, sf), "ts", 60).select("event_id", "ts")


def time_slice(spark, sf):
    e = events(spark, sf)
    a, b = F.lit("2024-01-05 00:00:00").cast("timestamp_ntz"), F.lit("2024-01-12 12:00:00").cast("timestamp_ntz")
    return e.where((F.col("ts") >= a) & (F.col("ts") < b) & F.col("event_type").isin("view", "click") & F.col("event_type").contains("i")).select("event_id", "event_type")


def numeric_prn_ranges(spark, sf):
    return table(spark, sf, "part").select("p_partkey", dims.prn_of_number((F.col("p_partkey") % 260).cast("int")).alias("prn"))


def ismr_s4(spark, sf):
    e = events(spark, sf)
    return e.select("event_id", r(receivers.corrected_s4(F.col("value") / 50, F.lit(0.5)), "s4"))


def pair_coalesce(spark, sf):
    e = events(spark, sf)
    a = e.select("event_id", *[F.when(F.col("user_id") % k != 0, F.col("value") + k).alias(n) for k, n in ((2, "GPS_L1CA"), (3, "GPS_L2C"), (5, "GPS_L2PY"), (7, "BDS_B1I"), (4, "BDS_B3I"))])
    return dims.paired(a).select("event_id", r(F.col("F1"), "f1"), r(F.col("F2"), "f2"))


def _position(e):
    return (F.col("user_id") * 7 % 120 - 60).cast("double"), (F.col("user_id") * 13 % 340 - 170).cast("double")


def haversine(spark, sf):
    e = events(spark, sf)
    lat, lon = _position(e)
    return e.select("event_id", r(geo.haversine_km(lat, lon, lat + F.col("value") / 100, lon - F.col("value") / 50), "km", 5))


def pierce_point(spark, sf):
    e = events(spark, sf)
    lat, lon = geo.pierce_point(*_position(e), F.col("user_id") % 80 + 10.0, F.col("event_id") % 360 + 0.0)
    return e.select("event_id", r(lat, "ipp_lat"), r(lon, "ipp_lon"))


def elevation_circle(spark, sf):
    n = table(spark, sf, "nation").select("n_nationkey", (F.col("n_nationkey") * 4.0 - 50).alias("lat"), (F.col("n_nationkey") * 10.0 - 120).alias("lon"))
    return geo.elevation_circle(n, points=36).select("n_nationkey", "point", r(F.col("circle_lat"), "circle_lat"), r(F.col("circle_lon"), "circle_lon"))


def dip_latitude(spark, sf):
    return events(spark, sf).select("event_id", r(geo.dip_latitude(F.col("user_id") % 170 - 85.0), "dip"))


_NAME = "concat('/data/', CASE WHEN user_id % 3 = 0 THEN 'receiver2' ELSE 'receiver3' END, '_20240511_0800_', CASE WHEN user_id % 2 = 0 THEN '756582.5000W' ELSE '87.16004E' END, '_', CASE WHEN user_id % 5 = 0 THEN '414055.0312N' WHEN user_id % 5 = 1 THEN 'x' ELSE '14.09419S' END, '_v325.bin.zip')"


def filename_coords(spark, sf):
    e = events(spark, sf).withColumn("name", F.expr(_NAME))
    lat, lon = geo.coordinates(F.col("name"))
    return e.select("event_id", r(lat, "lat"), r(lon, "lon"), F.regexp_extract("name", r"_v(\d+)", 1).alias("version"), F.when(F.lower("name").contains("receiver2"), "SC2").otherwise("SC3").alias("tag"))


def file_kinds(spark, sf):
    names = ["a.BIN.zip", "a.bin", "a_lvl0.pq", "a_lvl2.parquet", "a.pq", "a.txt"]
    kinds = {i: kind for i, n in enumerate(names) if (kind := receivers.get_type(n))}
    return events(spark, sf).select("event_id", dims.lookup((F.col("user_id") % 6).cast("int"), kinds).alias("kind"))


def file_versions(spark, sf):
    names = ["/d_v324/a.txt", "a_v325.bin", "/x_v326f/y_v325.bin.zip", "a.bin"]
    versions = {i: v for i, n in enumerate(names) if (v := receivers.get_version(n))}
    return events(spark, sf).select("event_id", dims.lookup((F.col("user_id") % 4).cast("int"), versions).alias("version"))


def log_line_clean(spark, sf):
    lines = table(spark, sf, "events").select("event_id", F.concat("event_type", F.when(F.col("event_id") % 4 == 0, ",,").when(F.col("event_id") % 4 == 1, " Error ").otherwise(","), F.col("user_id").cast("string")).alias("value"))
    return receivers.clean_lines(lines)


def station_dimension(spark, sf):
    raw = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("line"), F.concat(F.lit(" "), "s_name").alias("name"), F.when(F.col("s_suppkey") % 9 == 0, "x").otherwise((F.col("s_suppkey") % 17 - 8).cast("string")).alias("lat"), (F.col("s_nationkey") * 5 % 11).cast("string").alias("lon"), F.when(F.col("s_suppkey") % 4 == 0, "nan").otherwise(F.concat(F.lit("C"), "s_suppkey")).alias("code"), F.when(F.col("s_suppkey") % 5 == 0, "").otherwise("sc3 ").alias("type"))
    s = stations.clean_stations(raw)
    return s.select(F.col("ord").cast("bigint").alias("ord"), "s_name", "s_lat", "s_lon", "s_code", "s_version")


def tec_carrier(spark, sf):
    e = events(spark, sf)
    return e.select("event_id", r(tec.carrier_tec(F.col("value") * 1e4, F.col("value") * 7.8e3, F.lit(1575.42e6), F.lit(1227.60e6)), "tec", 4))


def tec_pseudorange(spark, sf):
    e = events(spark, sf)
    return e.select("event_id", r(tec.code_tec(F.col("value") + 2e7, F.col("value") * 1.5 + 2e7, F.lit(1575.42e6), F.lit(1227.60e6)), "tec", 4))


_HAV = "2 * 6371.0088 * atan2(sqrt(a), sqrt(1 - a))"
_PIERCE = """degrees(lat2) AS ipp_lat, degrees(lon1 + asin(sin(psi) * sin(az) / cos(lat2))) AS ipp_lon"""


def _pierce_sql(source: str, keep: str) -> str:
    return f"""p AS (SELECT *, pi() / 2 - el - asin(6371.0 / (6371.0 + 350.0) * cos(el)) AS psi FROM {source}),
q AS (SELECT *, asin(sin(lat1) * cos(psi) + cos(lat1) * sin(psi) * cos(az)) AS lat2 FROM p),
f AS (SELECT {keep}, {_PIERCE} FROM q)"""


QUERIES = {
    "prn_format": (prn_format, f"WITH {SQL} SELECT event_id, cons, CASE cons WHEN 'GPS' THEN 'G' WHEN 'BDS' THEN 'C' WHEN 'GAL' THEN 'E' WHEN 'GLO' THEN 'R' WHEN 'SBS' THEN 'S' END || CASE WHEN user_id < 10 THEN '0' ELSE '' END || user_id::VARCHAR AS prn FROM obs"),
    "numeric_constellation": (numeric_constellation, "SELECT event_id, CASE user_id % 7 WHEN 0 THEN 'GPS' WHEN 1 THEN 'SBS' WHEN 2 THEN 'GAL' WHEN 3 THEN 'BDS' WHEN 6 THEN 'GLO' END AS cons FROM events"),
    "glonass_filter": (glonass_filter, f"WITH {SQL} SELECT event_id, cons, CASE WHEN user_id % 5 = 0 THEN 255 ELSE svid END AS svid FROM obs WHERE NOT (cons = 'GLO' AND user_id % 5 = 0)"),
    "gps_time": (gps_time, "SELECT event_id, TIMESTAMP '1980-01-06' + to_microseconds(round(((user_id + 1000) * 604800 + value) * 1000000)::BIGINT) AS t, TIMESTAMP '1980-01-06' + to_microseconds(round(((user_id + 1000) * 604800 + value - 60) * 1000000)::BIGINT) AS minute_start FROM events"),
    "floor_times": (floor_times, "SELECT event_id, date_trunc('second', ts)::TIMESTAMP AS second, date_trunc('minute', ts)::TIMESTAMP AS minute, date_trunc('day', ts)::TIMESTAMP AS day FROM events"),
    "parse_times": (parse_times, "SELECT event_id, CASE WHEN event_id % 10 <> 0 THEN date_trunc('day', ts)::TIMESTAMP END AS day, date_trunc('minute', ts)::TIMESTAMP AS minute FROM events"),
    "recent_events": (recent_events, "SELECT event_id, ts FROM events WHERE ts >= (SELECT max(ts)::DATE - INTERVAL 3 MONTH FROM events)"),
    "median_day": (median_day, "SELECT strftime(DATE '1970-01-01' + floor(median(ts::DATE - DATE '1970-01-01'))::INTEGER, '%Y-%m-%d') AS label FROM events"),
    "zero_to_null": (zero_to_null, "SELECT event_id, nullif(floor(value)::INTEGER % 4, 0) AS cph1, nullif(user_id % 3, 0) AS snr2, user_id % 3 AS rng1 FROM events"),
    "signal_dimension": (signal_dimension, f"WITH {SQL}, s(cons, sig_1, sig_2, sig_3) AS (VALUES {SIGNAL_ROWS}), f(sig, mhz) AS (VALUES {FREQUENCY_ROWS}) SELECT event_id, s.sig_1, a.mhz AS freq_1, s.sig_2, b.mhz AS freq_2, s.sig_3, c.mhz AS freq_3 FROM obs LEFT JOIN s ON obs.cons = s.cons LEFT JOIN f a ON a.sig = s.sig_1 LEFT JOIN f b ON b.sig = s.sig_2 LEFT JOIN f c ON c.sig = s.sig_3"),
    "elev_wrap": (elev_wrap, "SELECT event_id, ((user_id - 20) & 255)::INTEGER AS elev, ((user_id * 1000 - 20) & 65535)::INTEGER AS azim FROM events"),
    "lvl0_projection": (lvl0_projection, "SELECT event_id, user_id % 37 AS svid, ((user_id % 91 - 1) & 255)::INTEGER AS elev, (user_id & 65535)::INTEGER AS azim FROM events WHERE user_id % 9 <> 0"),
    "linear_snr": (linear_snr, f"WITH {SQL} SELECT event_id, round(pow(10.0, db / 2 / 10), 4) + 0.0 AS lin FROM obs"),
    "finite_filter": (finite_filter, "WITH x AS (SELECT event_id, greatest(value - 20, 0.0) + CASE WHEN user_id % 4 = 0 THEN 0.0 ELSE 1.0 END AS y FROM events) SELECT event_id, round(ln(y), 6) + 0.0 AS x FROM x WHERE y > 0 AND (CASE WHEN y > 0 THEN ln(y) END) >= 0"),
    "trim_range": (trim_range, "SELECT event_id, ts FROM events WHERE ts BETWEEN (SELECT min(ts) + INTERVAL 60 MINUTE FROM events) AND (SELECT max(ts) - INTERVAL 60 MINUTE FROM events)"),
    "time_slice": (time_slice, "SELECT event_id, event_type FROM events WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-12 12:00:00' AND event_type IN ('view', 'click') AND event_type LIKE '%i%'"),
    "numeric_prn_ranges": (numeric_prn_ranges, f"SELECT p_partkey, CASE {RANGE_CASES} ELSE '99' END AS prn FROM (SELECT p_partkey, p_partkey % 260 AS n FROM part)"),
    "ismr_s4": (ismr_s4, "SELECT event_id, round(sqrt(greatest(pow(value / 50, 2) - 0.25, 0.0)), 6) + 0.0 AS s4 FROM events"),
    "pair_coalesce": (pair_coalesce, "WITH a AS (SELECT event_id, CASE WHEN user_id % 2 <> 0 THEN value + 2 END AS g1, CASE WHEN user_id % 3 <> 0 THEN value + 3 END AS g2, CASE WHEN user_id % 5 <> 0 THEN value + 5 END AS g3, CASE WHEN user_id % 7 <> 0 THEN value + 7 END AS b1, CASE WHEN user_id % 4 <> 0 THEN value + 4 END AS b3 FROM events) SELECT event_id, round(CASE WHEN g1 IS NOT NULL AND g2 IS NOT NULL THEN g1 WHEN g1 IS NOT NULL AND g3 IS NOT NULL THEN g1 WHEN b1 IS NOT NULL AND b3 IS NOT NULL THEN b1 END, 6) + 0.0 AS f1, round(CASE WHEN g1 IS NOT NULL AND g2 IS NOT NULL THEN g2 WHEN g1 IS NOT NULL AND g3 IS NOT NULL THEN g3 WHEN b1 IS NOT NULL AND b3 IS NOT NULL THEN b3 END, 6) + 0.0 AS f2 FROM a"),
    "haversine": (haversine, f"WITH p AS (SELECT event_id, (user_id * 7 % 120 - 60)::DOUBLE AS lat, (user_id * 13 % 340 - 170)::DOUBLE AS lon, value FROM events), q AS (SELECT event_id, pow(sin((radians(lat + value / 100) - radians(lat)) / 2), 2) + cos(radians(lat)) * cos(radians(lat + value / 100)) * pow(sin(radians((lon - value / 50) - lon) / 2), 2) AS a FROM p) SELECT event_id, round({_HAV}, 5) + 0.0 AS km FROM q"),
    "pierce_point": (pierce_point, "WITH o AS (SELECT event_id, radians((user_id * 7 % 120 - 60)::DOUBLE) AS lat1, radians((user_id * 13 % 340 - 170)::DOUBLE) AS lon1, radians(user_id % 80 + 10.0::DOUBLE) AS el, radians((event_id % 360)::DOUBLE) AS az FROM events), " + _pierce_sql("o", "event_id") + " SELECT event_id, round(ipp_lat, 6) + 0.0 AS ipp_lat, round(ipp_lon, 6) + 0.0 AS ipp_lon FROM f"),
    "elevation_circle": (elevation_circle, "WITH o AS (SELECT n_nationkey, point, radians((n_nationkey * 4 - 50)::DOUBLE) AS lat1, radians((n_nationkey * 10 - 120)::DOUBLE) AS lon1, radians(30::DOUBLE) AS el, radians(point * (360.0::DOUBLE / 35)) AS az FROM nation, (SELECT unnest(range(36))::INTEGER AS point)), " + _pierce_sql("o", "n_nationkey, point") + " SELECT n_nationkey, point, round(ipp_lat, 6) + 0.0 AS circle_lat, round(ipp_lon, 6) + 0.0 AS circle_lon FROM f"),
    "dip_latitude": (dip_latitude, "SELECT event_id, round(degrees(atan(0.5 * tan(radians((user_id % 170 - 85)::DOUBLE)))), 6) + 0.0 AS dip FROM events"),
    "filename_coords": (filename_coords, f"""WITH n AS (SELECT event_id, {_NAME} AS name FROM events), m AS (SELECT event_id, name, nullif(regexp_extract(name, '_([0-9]+(?:\\.[0-9]+)?)([EW])_([0-9]+(?:\\.[0-9]+)?)([NS])', 1), '')::DOUBLE AS lo, regexp_extract(name, '_([0-9]+(?:\\.[0-9]+)?)([EW])_([0-9]+(?:\\.[0-9]+)?)([NS])', 2) AS lh, nullif(regexp_extract(name, '_([0-9]+(?:\\.[0-9]+)?)([EW])_([0-9]+(?:\\.[0-9]+)?)([NS])', 3), '')::DOUBLE AS la, regexp_extract(name, '_([0-9]+(?:\\.[0-9]+)?)([EW])_([0-9]+(?:\\.[0-9]+)?)([NS])', 4) AS th FROM n)
SELECT event_id, round(CASE WHEN la > 90 THEN la / 1e4 ELSE la END * CASE WHEN th = 'S' THEN -1 ELSE 1 END, 6) + 0.0 AS lat, round(CASE WHEN lo > 180 THEN lo / 1e4 ELSE lo END * CASE WHEN lh = 'W' THEN -1 ELSE 1 END, 6) + 0.0 AS lon, regexp_extract(name, '_v(\\d+)', 1) AS version, CASE WHEN lower(name) LIKE '%receiver2%' THEN 'SC2' ELSE 'SC3' END AS tag FROM m"""),
    "file_kinds": (file_kinds, "SELECT event_id, CASE user_id % 6 WHEN 0 THEN 'binzip' WHEN 1 THEN 'bin' WHEN 2 THEN 'lvl0' WHEN 3 THEN 'lvl2' WHEN 4 THEN 'pq' END AS kind FROM events"),
    "file_versions": (file_versions, "SELECT event_id, CASE user_id % 4 WHEN 0 THEN 'v324' WHEN 1 THEN 'v325' WHEN 2 THEN 'v326' END AS version FROM events"),
    "log_line_clean": (log_line_clean, "WITH l AS (SELECT event_id, concat(event_type, CASE event_id % 4 WHEN 0 THEN ',,' WHEN 1 THEN ' Error ' ELSE ',' END, user_id::VARCHAR) AS value FROM events) SELECT * FROM l WHERE NOT regexp_matches(value, '\\bError\\b|,,')"),
    "station_dimension": (station_dimension, "SELECT row_number() OVER (ORDER BY s_suppkey % 17 - 8 DESC, s_suppkey) - 1 AS ord, trim(s_name) AS s_name, (s_suppkey % 17 - 8)::DOUBLE AS s_lat, (s_nationkey * 5 % 11)::DOUBLE AS s_lon, CASE WHEN s_suppkey % 4 = 0 THEN '' ELSE 'C' || s_suppkey::VARCHAR END AS s_code, CASE WHEN s_suppkey % 5 = 0 THEN 'UNK' ELSE 'SC3' END AS s_version FROM supplier WHERE s_suppkey % 9 <> 0 AND NOT (s_suppkey % 17 = 8 AND s_nationkey * 5 % 11 = 0)"),
    "tec_carrier": (tec_carrier, "SELECT event_id, round((1575.42e6 * 1575.42e6) * (1227.60e6 * 1227.60e6) / (40.3 * (1575.42e6 * 1575.42e6 - 1227.60e6 * 1227.60e6)) * (value * 1e4 * (299792458.0 / 1575.42e6) - value * 7.8e3 * (299792458.0 / 1227.60e6)) / 1e16, 4) + 0.0 AS tec FROM events"),
    "tec_pseudorange": (tec_pseudorange, "SELECT event_id, round((1575.42e6 * 1575.42e6) * (1227.60e6 * 1227.60e6) / (40.3 * (1575.42e6 * 1575.42e6 - 1227.60e6 * 1227.60e6)) * ((value * 1.5 + 2e7) - (value + 2e7)) / 1e16, 4) + 0.0 AS tec FROM events"),
}
