"""Queries on ordered series: user_id is the key, (ts, event_id) the order. Sampling is one row a second by definition here (fs = 1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import filters, legacy, windows
from ..operators.detrend import clock_corrected, clock_medians
from ..operators.repair import repaired
from .observations import SQL, events, r

KEY, ORDER = ["user_id"], ["ts", "event_id"]
W = "(PARTITION BY user_id ORDER BY ts, event_id)"
FORWARD = "(PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
BACK = "(PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
#: The series with holes: values of every sixth event are missing.
HOLES = "CASE WHEN event_id % 6 <> 0 THEN value END"


def _w():
    return windows.ordered(KEY, ORDER)


def _holes():
    return F.when(F.col("event_id") % 6 != 0, F.col("value"))


def first_diff(spark, sf):
    return events(spark, sf).select("event_id", r(windows.first_diff(F.col("value"), _w()), "d"))


def rolling_median(spark, sf):
    return events(spark, sf).withColumn("x", _holes()).select("event_id", r(windows.rolling_median(F.col("x"), _w(), 10), "m"))


def fill_both(spark, sf):
    e = events(spark, sf).withColumn("x", _holes())
    return e.select("event_id", r(windows.fill_both(F.col("x"), _w()), "bfill"), r(windows.fill_last(F.col("x"), _w()), "ffill"))


def lerp_both(spark, sf):
    e = events(spark, sf).withColumns({"x": _holes(), "rn": F.row_number().over(_w()).cast("double")})
    return e.select("event_id", r(windows.lerp_both(F.col("x"), F.col("rn"), _w()), "x"))


def running_sum(spark, sf):
    e = events(spark, sf).withColumn("x", _holes())
    return e.select("event_id", r(windows.cumsum(F.col("x"), _w()), "s", 4))


def slip_repair(spark, sf):
    e = repaired(events(spark, sf), KEY, ORDER, "value", 1.0, 60.0)
    return e.select("event_id", r(F.col("repaired"), "repaired", 4), "slip")


def slip_repair_holes(spark, sf):
    e = repaired(events(spark, sf).withColumn("x", F.when(F.col("event_id") % 40 != 0, F.col("value"))), KEY, ORDER, "x", 1.0, 80.0)
    return e.select("event_id", r(F.col("repaired"), "repaired", 4), "slip")


def _repair_sql(y: str, threshold: float) -> str:
    return f"""WITH a AS (SELECT event_id, user_id, ts, {y} AS y, row_number() OVER {W} AS rn, count(*) OVER (PARTITION BY user_id) AS n FROM events),
b AS (SELECT *, y - lag(y) OVER {W} AS d FROM a),
c AS (SELECT *, CASE WHEN count(d) OVER f >= 3 THEN median(d) OVER f END AS t0 FROM b WINDOW f AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 5 PRECEDING AND 4 FOLLOWING)),
e AS (SELECT *, coalesce(first_value(t0 IGNORE NULLS) OVER {FORWARD}, last_value(t0 IGNORE NULLS) OVER {BACK}) AS t FROM c),
g AS (SELECT *, NOT coalesce(abs(d - t) <= {threshold}, false) AS slip FROM e),
h AS (SELECT *, sum(slip::INTEGER) OVER (PARTITION BY user_id) AS ns, CASE WHEN NOT slip THEN d END AS c0, first_value(y) OVER {W} AS y0 FROM g),
i AS (SELECT *, CASE WHEN rn = 1 AND n > 1 THEN lead(c0) OVER {W} ELSE c0 END AS c1 FROM h),
j AS (SELECT *, last_value(c1 IGNORE NULLS) OVER {BACK} AS va, first_value(c1 IGNORE NULLS) OVER {FORWARD} AS vb, last_value(CASE WHEN c1 IS NOT NULL THEN rn END IGNORE NULLS) OVER {BACK} AS ra, first_value(CASE WHEN c1 IS NOT NULL THEN rn END IGNORE NULLS) OVER {FORWARD} AS rb FROM i),
k AS (SELECT *, coalesce(c1, va + (vb - va) * ((rn - ra)::DOUBLE / nullif(rb - ra, 0)), va, vb) AS c2 FROM j)
SELECT event_id, round(CASE WHEN ns::DOUBLE / n > 0.2 AND n > 10 THEN y ELSE y0 + sum(c2) OVER {BACK} END, 4) + 0.0 AS repaired, slip FROM k"""


def edge_gap_mask(spark, sf):
    e = windows.edge_gap_mask(events(spark, sf).withColumn("x", F.when(F.col("event_id") % 50 != 0, F.col("value"))), KEY, ORDER, "x", "ts", 1.0, gap=200_000.0, pad=3.0)
    return e.select("event_id", "edgegap")


def islands(spark, sf):
    e = windows.islands(events(spark, sf).withColumn("x", _holes()), KEY, ORDER, "x")
    return e.select("event_id", F.col("island").cast("bigint").alias("island"))


def jump_removal(spark, sf):
    e = windows.without_jumps(events(spark, sf), KEY, ORDER, "value", 70.0, "x")
    return e.select("event_id", r(F.col("x"), "x", 4))


def time_steps(spark, sf):
    return windows.time_steps(events(spark, sf), KEY, ORDER, "ts").select("event_id", r(F.col("dt"), "dt"))


def first_rows(spark, sf):
    return windows.first_of_each(events(spark, sf), ["user_id", "day"], ORDER).select("user_id", "day", "event_id")


def regular_grid(spark, sf):
    e = events(spark, sf).groupBy("user_id", "day").agg(F.min("value").alias("value"))
    return windows.regular_grid(e, KEY, "day", "value", "1 DAY").select("user_id", "day", r(F.col("value"), "value"))


def iir_cascade(spark, sf):
    return filters.highpassed(events(spark, sf).select("event_id", "user_id", "ts", "value"), KEY, ORDER, "value", 10.0).select("event_id", r(F.col("filtered"), "filtered", 5))


def _iir_sql(fs: float) -> str:
    (b1, a1), (b2, a2), (b3, a3) = filters.sections(fs)

    def step(x: str, x1: str, x2: str, y1: str, y2: str, b, a) -> str:
        return f"{float(b[0])!r} * {x} + {float(b[1])!r} * {x1} + {float(b[2])!r} * {x2} - {float(a[1])!r} * {y1} - {float(a[2])!r} * {y2}"

    u, v = step("x", "x1", "x2", "u1", "u2", b1, a1), step("u", "u1", "u2", "v1", "v2", b2, a2)
    y = step("v", "v1", "v2", "y1", "y2", b3, a3)
    return f"""WITH RECURSIVE s AS (SELECT event_id, user_id, value AS x, row_number() OVER {W} AS rn FROM events),
f AS (SELECT user_id, 0::BIGINT AS rn, 0::BIGINT AS event_id, 0.0::DOUBLE AS x1, 0.0::DOUBLE AS x2, 0.0::DOUBLE AS u1, 0.0::DOUBLE AS u2, 0.0::DOUBLE AS v1, 0.0::DOUBLE AS v2, 0.0::DOUBLE AS y1, 0.0::DOUBLE AS y2 FROM (SELECT DISTINCT user_id FROM s)
UNION ALL SELECT user_id, rn, event_id, x AS x1, x1 AS x2, u AS u1, u1 AS u2, v AS v1, v1 AS v2, ({y})::DOUBLE AS y1, y1 AS y2
FROM (SELECT *, ({v})::DOUBLE AS v FROM (SELECT f.user_id, s.rn, s.event_id, s.x, x1, x2, u1, u2, v1, v2, y1, y2, ({u.replace("* x ", "* s.x ")})::DOUBLE AS u FROM f JOIN s ON s.user_id = f.user_id AND s.rn = f.rn + 1)))
SELECT event_id, round(y1, 5) + 0.0 AS filtered FROM f WHERE rn > 0"""


def clock_median(spark, sf):
    """Over all series of an hour, two slots a row; the elevation is made up."""
    e = events(spark, sf).withColumns({"hour": F.date_trunc("hour", "ts").cast("timestamp_ntz"), "v1": F.col("value") / 1575.42, "v2": F.when(F.col("cons") != "SBS", F.col("value") * 1.3 / 1227.6), "elev": F.col("user_id") % 95})
    c = clock_medians(e, ["hour"], ["v1", "v2"], (F.col("elev") > 0) & (F.col("elev") < 90))
    return c.select("hour", r(F.col("clock_term"), "clock_term", 9))


def clock_correct(spark, sf):
    e = events(spark, sf).withColumns({"file_id": F.col("event_type"), "datetime": F.date_trunc("hour", "ts").cast("timestamp_ntz"), "cph1": F.col("value"), "detrended_cph1": F.col("value"), "freq_1": F.lit(1575.42), "elev": F.col("user_id") % 95})
    return clock_corrected(e).select("event_id", r(F.col("detrended_noclk_cph1"), "x", 5))


def group_median(spark, sf):
    """A time's median without SBS beside every row; the first times of a file count for nothing."""
    e = events(spark, sf).withColumns({"file_id": F.col("user_id") % 5, "datetime": F.date_trunc("hour", "ts").cast("timestamp_ntz"), "dphi": F.col("value")})
    return legacy.reference_removed(e, skip=3).select("event_id", r(F.col("dphi_ref"), "m"), r(F.col("dphi_true"), "x"))


def slip_repair_next(spark, sf):
    e = legacy.repaired_by_next(events(spark, sf).select("event_id", "user_id", "ts", "value"), KEY, ORDER, "value", 1.0, 60.0)
    return e.select("event_id", r(F.col("repaired"), "repaired", 4), "slip")


_NEXT_SQL = _repair_sql("value", 60.0).replace("coalesce(c1, va + (vb - va) * ((rn - ra)::DOUBLE / nullif(rb - ra, 0)), va, vb)", "coalesce(c1, vb, va)").replace("ns::DOUBLE / n > 0.2 AND n > 10", "false")


QUERIES = {
    "first_diff": (first_diff, f"SELECT event_id, round(value - lag(value) OVER {W}, 6) + 0.0 AS d FROM events"),
    "rolling_median": (rolling_median, f"WITH x AS (SELECT *, {HOLES} AS x FROM events) SELECT event_id, round(CASE WHEN count(x) OVER f >= 3 THEN median(x) OVER f END, 6) + 0.0 AS m FROM x WINDOW f AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 5 PRECEDING AND 4 FOLLOWING)"),
    "fill_both": (fill_both, f"WITH x AS (SELECT *, {HOLES} AS x FROM events), y AS (SELECT event_id, first_value(x IGNORE NULLS) OVER {FORWARD} AS f, last_value(x IGNORE NULLS) OVER {BACK} AS b FROM x) SELECT event_id, round(coalesce(f, b), 6) + 0.0 AS bfill, round(coalesce(b, f), 6) + 0.0 AS ffill FROM y"),
    "lerp_both": (lerp_both, f"WITH x AS (SELECT *, {HOLES} AS x, row_number() OVER {W} AS rn FROM events), y AS (SELECT event_id, x, rn, first_value(x IGNORE NULLS) OVER {FORWARD} AS vb, last_value(x IGNORE NULLS) OVER {BACK} AS va, first_value(CASE WHEN x IS NOT NULL THEN rn END IGNORE NULLS) OVER {FORWARD} AS rb, last_value(CASE WHEN x IS NOT NULL THEN rn END IGNORE NULLS) OVER {BACK} AS ra FROM x) SELECT event_id, round(coalesce(x, va + (vb - va) * ((rn - ra)::DOUBLE / nullif(rb - ra, 0)), va, vb), 6) + 0.0 AS x FROM y"),
    "running_sum": (running_sum, f"WITH x AS (SELECT *, {HOLES} AS x FROM events) SELECT event_id, round(CASE WHEN x IS NOT NULL THEN sum(x) OVER {BACK} END, 4) + 0.0 AS s FROM x"),
    "slip_repair": (slip_repair, _repair_sql("value", 60.0)),
    "slip_repair_holes": (slip_repair_holes, _repair_sql("CASE WHEN event_id % 40 <> 0 THEN value END", 80.0)),
    "edge_gap_mask": (edge_gap_mask, f"WITH a AS (SELECT *, CASE WHEN event_id % 50 <> 0 THEN value END AS x FROM events), b AS (SELECT *, (lag(ts) OVER {W} IS NULL OR lead(ts) OVER {W} IS NULL OR coalesce(epoch_us(ts) - epoch_us(lag(ts) OVER {W}) > 200000 * 1000000::BIGINT, false) OR x IS NULL)::INTEGER AS m, count(x) OVER (PARTITION BY user_id) AS n FROM a) SELECT event_id, (max(m) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)) = 1 AND n > 0 AS edgegap FROM b"),
    "islands": (islands, f"WITH a AS (SELECT *, {HOLES} IS NOT NULL AS k FROM events), b AS (SELECT *, coalesce((k <> lag(k) OVER {W})::INTEGER, 1) AS c FROM a) SELECT event_id, (sum(c) OVER {BACK})::BIGINT AS island FROM b"),
    "jump_removal": (jump_removal, f"WITH a AS (SELECT *, value - lag(value) OVER {W} AS d FROM events), b AS (SELECT *, CASE WHEN abs(d) > 70 THEN d ELSE 0.0 END AS j FROM a) SELECT event_id, round(value - sum(j) OVER {BACK}, 4) + 0.0 AS x FROM b"),
    "time_steps": (time_steps, f"SELECT event_id, round((epoch_us(ts) - epoch_us(lag(ts) OVER {W})) / 1e6, 6) + 0.0 AS dt FROM events"),
    "first_rows": (first_rows, f"WITH {SQL} SELECT user_id, day, arg_min(event_id, ts) AS event_id FROM obs GROUP BY user_id, day"),
    "regular_grid": (regular_grid, f"""WITH {SQL}, d AS (SELECT user_id, day, min(value) AS value FROM obs GROUP BY user_id, day), e AS (SELECT user_id, min(day) AS a, max(day) AS b FROM d GROUP BY user_id),
g AS (SELECT user_id, unnest(generate_series(a, b, INTERVAL 1 DAY)) AS day FROM e), j AS (SELECT g.user_id, g.day, d.value, epoch(g.day) AS t FROM g LEFT JOIN d ON g.user_id = d.user_id AND g.day = d.day),
k AS (SELECT *, last_value(value IGNORE NULLS) OVER p AS va, last_value(CASE WHEN value IS NOT NULL THEN t END IGNORE NULLS) OVER p AS ta, first_value(value IGNORE NULLS) OVER f AS vb, first_value(CASE WHEN value IS NOT NULL THEN t END IGNORE NULLS) OVER f AS tb FROM j WINDOW p AS (PARTITION BY user_id ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), f AS (PARTITION BY user_id ORDER BY day ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
SELECT user_id, day, round(coalesce(value, va + (vb - va) * ((t - ta) / nullif(tb - ta, 0))), 6) + 0.0 AS value FROM k"""),
    "iir_cascade": (iir_cascade, _iir_sql(10.0)),
    "clock_median": (clock_median, f"WITH {SQL}, v AS (SELECT date_trunc('hour', ts)::TIMESTAMP AS hour, value / 1575.42 AS v FROM obs WHERE user_id % 95 BETWEEN 1 AND 89 UNION ALL SELECT date_trunc('hour', ts)::TIMESTAMP, value * 1.3 / 1227.6 FROM obs WHERE user_id % 95 BETWEEN 1 AND 89 AND cons <> 'SBS') SELECT hour, round(median(v), 9) + 0.0 AS clock_term FROM v GROUP BY hour"),
    "clock_correct": (clock_correct, f"WITH {SQL}, v AS (SELECT *, date_trunc('hour', ts) AS hour FROM obs), c AS (SELECT event_type, hour, median(value / 1575.42) AS t FROM v WHERE user_id % 95 BETWEEN 1 AND 89 GROUP BY event_type, hour) SELECT event_id, round(value - t * 1575.42, 5) + 0.0 AS x FROM v LEFT JOIN c USING (event_type, hour)"),
    "group_median": (group_median, f"WITH {SQL}, n AS (SELECT *, user_id % 5 AS f, date_trunc('hour', ts) AS hour FROM obs), m AS (SELECT f, hour, CASE WHEN row_number() OVER (PARTITION BY f ORDER BY hour) > 3 THEN m END AS m FROM (SELECT f, hour, median(value) AS m FROM n WHERE cons <> 'SBS' GROUP BY f, hour)) SELECT event_id, round(m, 6) + 0.0 AS m, round(value - m, 6) + 0.0 AS x FROM n LEFT JOIN m USING (f, hour)"),
    "slip_repair_next": (slip_repair_next, _NEXT_SQL),
}
