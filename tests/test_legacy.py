"""Older generations, availability over paths, reports and the command line."""

import datetime as dt

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from skyflux.functions.dims import LEGACY_TEC
from skyflux.operators import availability, compare, legacy
from skyflux.sources import reports

NTZ = "timestamp_ntz"


def series(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_oldest_generation(spark):
    start = dt.datetime(2024, 1, 1)
    rows = [("f", "G01", start + dt.timedelta(milliseconds=100 * i), None if i == 7 else 0.5 * i + (50.0 if i > 300 else 0)) for i in range(900)]
    df = series(spark, rows, f"file_id string, prn string, datetime {NTZ}, cph double")
    got = legacy.detrended_by_bins(df, ["file_id", "prn"], "datetime", "cph", 10.0, threshold=5.0).orderBy("datetime").toPandas()
    assert got.dphi.isna().sum() == 1 and got.cycleslips[301] and got.cycleslips.sum() <= 3
    assert abs(got.dphi[600:].astype(float)).max() < 2


def test_middle_generation():
    y = 0.5 * np.arange(100)
    y[50:] += 40
    out, slip = legacy.repaired_filling(y, 1, 1)
    assert np.flatnonzero(slip).tolist() == [0, 50]
    np.testing.assert_allclose(np.diff(out), 0.5)


def test_constellation_tec(spark):
    l1, l2, k, s1, s2 = LEGACY_TEC["G"]
    start, rows = dt.datetime(2024, 1, 1), []
    for i in range(30):
        t = start + dt.timedelta(seconds=i)
        rows += [("f", "G07", s1, t, (100 + 0.01 * i) / l1, 20.0 + i), ("f", "G07", s2, t, (100 + 0.02 * i) / l2, 10.0)]
    rows.append(("f", "X1", "?", start, 1.0, 1.0))
    df = series(spark, rows, f"file_id string, SVID string, SIG string, datetime {NTZ}, Phase double, PR double")
    got = legacy.tec_by_constellation(df).orderBy("datetime").toPandas()
    assert len(got) == 30
    np.testing.assert_allclose(got.CTEC.astype(float), k * (10 + np.arange(30)))
    np.testing.assert_allclose(np.diff(got.PTEC.astype(float)), k * 0.01, atol=1e-6)


def test_reference(spark):
    start = dt.datetime(2024, 1, 1)
    rows = [("f", start + dt.timedelta(seconds=i), c, float(i + k)) for i in range(10) for k, c in enumerate(("GPS", "GAL", "GLO", "SBS"))]
    got = legacy.reference_removed(series(spark, rows, f"file_id string, datetime {NTZ}, cons string, dphi double"), skip=4).toPandas()
    assert got.dphi_ref.isna().sum() == 16 and set(got.dphi_true.dropna()) == {-1.0, 0.0, 1.0, 2.0}


def test_station_enrichment(spark):
    stations = spark.createDataFrame([(0, 41.40551, -75.65826, "US-PA1", 50.0), (1, 10.0, 10.0, "XX", 1.0)], "ord int, s_lat double, s_lon double, s_code string, dip0 double")
    rows = spark.createDataFrame([("/d/receiver3_20240511_0800_756582.5000W_414055.0312N_v325.bin.zip", 1.0), ("/d/none.bin", 2.0)], "file_id string, x double")
    got = legacy.enriched_by_station(rows, stations).collect()
    assert len(got) == 1 and got[0]["code"] == "US-PA1" and got[0]["dip0"] == 50.0 and abs(got[0]["lat0"] - 41.4055) < 1e-3


def test_availability(spark):
    names = ["/a/receiver3_20240511_0800_87.16004W_14.09419N_v326f.bin.zip", "/a/receiver3_20240511_0900_87.16004W_14.09419N_v326f.bin.zip", "/a/RECEIVER2/receiver2_20240512_0000_87.16004W_14.09419N.dat.zip", "/a/receiver3_20231301_0800_87.1W_14.0N_v325.bin.zip", "/a/receiver3_20240513_0800_0.0W_0.0N_v325.bin.zip", "/a/readme.txt"]
    paths = spark.createDataFrame([(n,) for n in names], "path string")
    stations = spark.createDataFrame([(0, 14.094, -87.16, "SC3", "H1", "A"), (1, 14.094, -87.16, "SC3", "H2", "B"), (2, 14.094, -87.16, "SC2", "H3", "C")], "ord int, s_lat double, s_lon double, s_version string, s_code string, s_name string")
    cut, now = F.lit("2024-05-11 12:00:00").cast(NTZ), F.lit("2024-05-13 06:00:00").cast(NTZ)
    days = availability.legacy_days(paths, stations, cut, "receiver2")
    assert sorted((r["ord"], r["day"].day) for r in days.collect()) == [(0, 11), (2, 12)]
    assert availability.missing_days(days, stations, cut, now).count() == 7
    assert {r["end"] for r in availability.intervals(days, F.lit("2024-05-12 06:00:00").cast(NTZ)).collect()} == {dt.datetime(2024, 5, 12), dt.datetime(2024, 5, 12, 6)}
    assert "[SC3] H1, A (14.094°N, 87.160°W)" in {r["label"] for r in availability.station_labels(stations).collect()}


def test_compare(spark):
    a = spark.createDataFrame([(i, float(i), 40, 600, 0, 1) for i in range(20)], "k int, x double, elev int, n_1 int, quality_1 int, n_cycleslip_1 int")
    b = spark.createDataFrame([(i, i + 0.5, 1) for i in range(10, 30)], "k int, y double, elev int")
    both = compare.compared(a, b, ["k"], "x", "y", compare.quality_mask())
    assert both.count() == 10 and "elev_ref" in both.columns
    y, x = np.arange(10, 20) + 0.5, np.arange(10, 20)
    assert abs(compare.r2_score(both, [], "y", "x").first()["r2"] - (1 - ((y - x) ** 2).sum() / ((y - y.mean()) ** 2).sum())) < 1e-12
    assert compare.quiet_reference(both.withColumn("m", F.col("k") % 2), [], "m", "k", "x").count() <= 1
    t = np.arange(1000)
    assert compare.decorrelation(np.sin(t / 20)) > 0 and np.isnan(compare.decorrelation(t[:5].astype(float)))


def test_reports():
    mail = reports.status_mail("a@example.org", ["b@example.org"], "s", "text", b"\x89PNG")
    assert "cid:figure" in mail.as_string() and mail["To"] == "b@example.org"


def test_command_line(spark, tmp_path, capsys):
    from skyflux.__main__ import main

    from .test_pipeline import receiver_file

    (tmp_path / "in").mkdir()
    receiver_file(tmp_path / "in" / "a_v325.bin")
    assert main(["process", "--root", str(tmp_path / "in"), "--output", str(tmp_path / "out"), "--mode", "lvl3"]) == 0
    assert spark.read.parquet(str(tmp_path / "out" / "lvl3")).count() > 0 and "lvl3" in capsys.readouterr().out
    assert main(["convert", str(tmp_path / "in" / "a_v325.bin"), "--output", str(tmp_path / "out"), "--tasks", "2", "--task", "1"]) == 0
    assert pd.Timestamp("2024-01-01").year == 2024
