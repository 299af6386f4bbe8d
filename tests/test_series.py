"""Repair, filter and mask kernels, and their window forms."""

import math
import tracemalloc

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from pyspark.sql import functions as F
from pyspark.sql.group import GroupedData
from pyspark.sql.pandas.types import to_arrow_schema

from skyflux.operators import blocks, filters, windows
from skyflux.operators.detrend import detrended, edge_gap
from skyflux.operators.repair import repair, repair_by_bins, repaired
from skyflux.plans import queries_receiver


def ramp(n=100, at=50, step=40.0):
    y = 0.5 * np.arange(n)
    y[at:] += step
    return y


SERIES = {
    "ramp and step": ramp(),
    "null within": np.where(np.arange(100) == 20, np.nan, ramp()),
    "null first": np.where(np.arange(100) == 0, np.nan, ramp()),
    "many slips": np.where(np.arange(60) % 2 == 0, 100.0, 0.0) + np.random.default_rng(1).normal(0, 30, 60),
    "short": np.array([0.0, 50, 0, 50, 0, 50, 0, 50]),
    "run of nulls": np.where((np.arange(80) > 30) & (np.arange(80) < 41), np.nan, ramp(80, 60)),
    "one row": np.array([3.0]),
    "all null": np.full(12, np.nan),
}


def test_known_slips():
    y, slip = repair(SERIES["ramp and step"], 1, 1)
    assert np.flatnonzero(slip).tolist() == [0, 50] and y[0] == 0.5 and y[99] == 50.0
    y, slip = repair(SERIES["null within"], 1, 1)
    assert np.flatnonzero(slip).tolist() == [0, 20, 21, 50] and not np.isnan(y).any()
    y, slip = repair(SERIES["null first"], 1, 1)
    assert np.isnan(y).all() and np.flatnonzero(slip).tolist() == [0, 1, 50]
    y, slip = repair(SERIES["many slips"], 1, 1)
    assert slip.mean() > 0.2 and np.array_equal(y, SERIES["many slips"])
    y, slip = repair(SERIES["short"], 1, 1)
    assert slip.mean() > 0.2 and not np.array_equal(y, SERIES["short"])


def test_windows_equal_kernel(spark):
    rows = [(k, i, None if v != v else float(v)) for k, y in SERIES.items() for i, v in enumerate(y)]
    df = repaired(spark.createDataFrame(rows, "k string, i int, y double"), ["k"], ["i"], "y", 1, 1.0).toPandas()
    for k, y in SERIES.items():
        own = df[df.k == k].sort_values("i")
        want, slip = repair(y, 1, 1)
        assert own.slip.tolist() == slip.tolist(), k
        np.testing.assert_allclose(own.repaired.to_numpy(float), want, atol=1e-9, err_msg=k)


@pytest.mark.parametrize("fs", [10.0, 20.0, 50.0])
def test_filter(fs):
    def gain(f):
        z = np.exp(-2j * np.pi * f / fs)
        return abs(np.prod([(b[0] + b[1] * z + b[2] * z * z) / (1 + a[1] * z + a[2] * z * z) for b, a in filters.sections(fs)]))

    assert abs(gain(0.1) - 0.7075) < 2e-3 and gain(0.05) < 0.02 and gain(0.2) > 0.999
    x = np.random.default_rng(0).normal(size=1000)
    want = x
    for b, a in filters.sections(fs):
        y = np.zeros(len(x))
        for n in range(len(x)):
            y[n] = b[0] * want[n] + sum(b[k] * want[n - k] for k in (1, 2) if n >= k) - sum(a[k] * y[n - k] for k in (1, 2) if n >= k)
        want = y
    np.testing.assert_allclose(filters.highpass(x, fs), want, atol=1e-9)
    assert abs(filters.highpass(np.full(int(400 * fs), 7.0), fs)[-1]) < 1e-6
    assert len(filters.highpass(np.zeros(0), fs)) == 0


@pytest.mark.parametrize("n", [1, 2, 9, 400, 5000, 40_000])
def test_blocks_equal_kernels(monkeypatch, n):
    """Series in blocks, with gaps longer than a block, values beyond numbers and slips, give what the kernels for series in memory give."""
    monkeypatch.setattr(blocks, "BLOCK", 512)
    monkeypatch.setattr(blocks, "HELD", 1024)
    rng = np.random.default_rng(n)
    for kind in ("plain", "gaps", "first", "slips", "infinite", "none"):
        y = 0.5 * np.arange(n) + rng.normal(0, 0.01, n) + 40.0 * (np.arange(n) > n // 2)
        if kind == "gaps":
            y[rng.random(n) < 0.02] = np.nan
            y[n // 4 : n // 2] = np.nan
        elif kind == "first":
            y[: n // 5] = np.nan
        elif kind == "slips":
            y += 30.0 * (rng.random(n) < 0.3)
        elif kind == "infinite":
            y[n // 3 : n // 3 + 2] = np.inf
        elif kind == "none":
            y[:] = np.nan
        x = blocks.Values(values=y)
        np.testing.assert_array_equal(blocks.lines(x, 2.0).read(0, n), pd.Series(y).interpolate(limit_direction="both").to_numpy() * 2.0, err_msg=kind)
        for series in (y, pd.Series(y).interpolate(limit_direction="both").to_numpy()):
            want, slip = repair(series, 10.0, 1.0)
            got, marks = blocks.repair(blocks.Values(values=series), 10.0, 1.0)
            np.testing.assert_array_equal(marks.read(0, n), slip, err_msg=kind)
            np.testing.assert_allclose(got.read(0, n), want, rtol=1e-12, err_msg=kind)
            np.testing.assert_allclose(blocks.highpass(got, 10.0).read(0, n), filters.highpass(want, 10.0), atol=1e-8, err_msg=kind)
            if not np.isnan(want).all():
                np.testing.assert_allclose(blocks.without_mean(got).read(0, n), want - np.nanmean(want), atol=1e-8, err_msg=kind)


def test_long_series_in_little_memory(spark):
    """Both maps get a satellite's rows in batches in their order, whatever order they come in, and edges of blocks are no edges of the series."""
    n = 70_000
    rows = spark.range(n).select(F.lit("f").alias("file_id"), F.lit("G01").alias("prn"), F.col("id").alias("row_id"), F.timestamp_add("MILLISECOND", F.col("id") * 100, F.expr("TIMESTAMP_NTZ '2024-05-10 00:00:00'")).alias("datetime"), F.when(F.col("id") != 40_000, F.col("id") * 0.5 + 50.0 * (F.col("id") >= 300).cast("int")).alias("cph1"), F.lit(1575.42).alias("freq_1"))
    rows = rows.withColumn("minbin", F.date_trunc("minute", "datetime").cast("timestamp_ntz")).orderBy(F.xxhash64("row_id"))
    got = detrended(rows).toPandas().sort_values("row_id")
    assert np.flatnonzero(got.cycleslips_cph1).tolist() == [0, 300]
    assert np.flatnonzero(got.edgegap_mask_cph1).tolist() == [*range(1801), *range(40_000 - 1800, 40_001 + 1800), *range(n - 1801, n)]
    assert got.detrended_cph1.isna().sum() == 1 and got.detrended_cph1.iloc[65_000:66_000].abs().max() < 1e-3


def test_long_sums():
    """A repaired value is the sum of its steps to a unit in the last place, however many there are."""
    y = np.random.default_rng(2).normal(0, 1000, 200_000)
    steps = y[1:] - y[:-1]
    for got in (blocks.repair(blocks.Values(values=y), 10.0, 1e9)[0].read(0, len(y)), repair(y, 10.0, 1e9)[0]):
        for at in (1000, 65_535, 65_536, 150_000, 199_999):
            want = math.fsum([y[0], steps[0], *steps[:at]])
            assert abs(got[at] - want) <= np.spacing(1000.0)


def _maps(monkeypatch, query, spark):
    """(map, columns that it gets) of each grouped map in a query's plan."""
    found, plain = [], GroupedData.applyInArrow

    def spied(self, run, schema):
        found.append((run, to_arrow_schema(self._df.schema)))
        return plain(self, run, schema)

    monkeypatch.setattr(GroupedData, "applyInArrow", spied)
    query(spark, "/root/testdata/sf0.001")
    return found


def _series(schema, n, size=10_000):
    for lo in range(0, n, size):
        at = np.arange(lo, min(lo + size, n))
        known = {"file_id": ["f"] * len(at), "prn": ["G01"] * len(at), "row_id": at, "datetime": at * 100_000, "fs": np.full(len(at), 10.0), "_thr1": np.ones(len(at)), "_thr2": np.ones(len(at))}
        own = [at * 0.5 if c.name.startswith(("cph", "rng", "tec")) else known.get(c.name) for c in schema]
        yield pa.RecordBatch.from_arrays([pa.nulls(len(at), c.type) if x is None else pa.array(x).cast(c.type) for x, c in zip(own, schema, strict=True)], schema=schema)


def _peak(run, schema, n):
    """Bytes of Python's and numpy's memory while a map runs over a series of n rows."""
    tracemalloc.start()
    try:
        assert sum(batch.num_rows for batch in run(_series(schema, n))) == n
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


@pytest.mark.parametrize("query, maps", [("tec_repaired", 1), ("minute_products", 2)])
def test_memory_does_not_grow_with_series(monkeypatch, spark, query, maps):
    found = _maps(monkeypatch, getattr(queries_receiver, query), spark)
    assert len(found) == maps
    for run, schema in found:
        assert _peak(run, schema, 900_000) < 1.3 * _peak(run, schema, 300_000)


def test_tec_carries_only_its_columns(monkeypatch, spark):
    """All columns that a map gets are sorted, sent to Python and kept until the series ends."""
    [(_, schema)] = _maps(monkeypatch, queries_receiver.tec_repaired, spark)
    assert set(schema.names) == {"file_id", "prn", "row_id", "fs", "freq_1", "freq_2", "cph1", "cph2", "rng1", "rng2", "tec_cph12", "tec_rng12"}


def test_edge_gap():
    t = np.arange(6000) / 10.0
    t[3000:] += 3
    mask = edge_gap(t, np.zeros(6000, bool), 10.0, pad=10.0)
    assert np.flatnonzero(mask).tolist() == [*range(101), *range(2900, 3101), *range(5899, 6000)]
    assert edge_gap(np.arange(5.0), np.zeros(5, bool), 1.0).all()


def test_equaliser_and_slopes():
    x = np.concatenate([np.full(700, 2.0), [np.nan], np.full(10, 1.0)])
    y = filters.equalised(x)
    np.testing.assert_allclose(y[:700], 2.0)
    assert np.isnan(y[700]) and np.allclose(y[701:], 12.0)
    times = pd.date_range("2024-01-01", periods=50, freq="1s")
    z = np.arange(50.0)
    z[20:] += 1e5
    np.testing.assert_allclose(filters.without_slopes(times, z, 5e4), np.arange(50.0))
    np.testing.assert_allclose(filters.without_slopes(times, np.where(np.arange(50) > 0, z, np.nan), 5e4)[1:], np.arange(1.0, 50.0))


def test_repair_by_bins():
    times = pd.date_range("2024-01-01", periods=600, freq="100ms")
    y = 0.5 * np.arange(600)
    y[300:] += 100
    out, slip = repair_by_bins(times, y)
    assert slip[300] and slip.sum() <= 2
    np.testing.assert_allclose(np.diff(out), 0.5)
    assert not repair_by_bins(times[:50], y[:50])[1].any()


def test_windows_without_rows(spark):
    empty = spark.createDataFrame([], "k string, i int, y double")
    assert repaired(empty, ["k"], ["i"], "y", 1, 1.0).count() == 0
    assert windows.islands(empty, ["k"], ["i"], "y").count() == 0
