"""Readers on files that the tests make."""

import struct
import zipfile

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from skyflux import schemas
from skyflux.functions.clean import to_lvl0
from skyflux.sources import receivers, sinks, stations


def records(dtype, n=250, seed=0):
    rng = np.random.default_rng(seed)
    out = np.zeros(n, dtype)
    for name in dtype.names:
        kind = dtype[name].kind
        out[name] = rng.normal(size=n) * 100 if kind == "f" else rng.integers(0, 100, n)
    out["elev"][:3] = -1
    out["svid"][5:8] = 255
    return out


def v326_bytes(rows, week=2300):
    header = struct.pack(schemas.V326_HEADER, *([0] * 14), week)
    return header.ljust(schemas.V326_RECORDS, b"\0") + rows.tobytes()


def test_names():
    assert receivers.get_version("/a/x_v326f.bin.zip") == "v326" and receivers.get_version("/a/x.bin") is None
    kinds = {"a.BIN.ZIP": "binzip", "a.bin": "bin", "a_lvl0.pq": "lvl0", "a_lvl3.parquet": "lvl3", "a.pq": "pq", "a.txt": None}
    assert {n: receivers.get_type(n) for n in kinds} == kinds
    assert sinks.output_path("/in/a/x_v325.bin.zip", "/in", "/out", "_lvl0.pq") == "/out/a/x_v325_lvl0.pq"
    assert sinks.output_path("/in/x.bin", "/in", "/out") == "/out/x.pq" and sinks.output_path("/in/x.dat", "/in", "/out") == "/out/x.pq"


def test_binary_round_trip(spark, tmp_path):
    a, b = records(schemas.V325), records(schemas.V326, seed=1)
    (tmp_path / "one_v325.bin").write_bytes(a.tobytes() + b"\1\2\3")
    with zipfile.ZipFile(tmp_path / "two_v326f.bin.zip", "w") as z:
        z.writestr("two_v326f.bin", v326_bytes(b))
    (tmp_path / "bad_v325.bin.zip").write_bytes(b"not a zip")
    rows, errors = receivers.read_records(spark, [str(p) for p in sorted(tmp_path.iterdir())])
    got = rows.toPandas().sort_values(["file_id", "row_id"])
    one, two = got[got.file_id.str.contains("one")], got[got.file_id.str.contains("two")]
    for name in schemas.V325.names:
        np.testing.assert_array_equal(one[name].to_numpy(float), a[name].astype(float))
    for name in schemas.V326.names:
        np.testing.assert_array_equal(two[name].to_numpy(float), b[name].astype(float))
    assert (two.week == 2300).all() and two.cph3.isna().all()
    assert errors.count() == 1 and "bad" in errors.first()["file_id"]
    lvl0 = to_lvl0(rows).toPandas()
    assert len(lvl0) == len(a) + len(b) - 6 and (lvl0.elev == 255).sum() == 6 and "sats" not in lvl0 and "pst3" in lvl0
    _, errors = receivers.read_records(spark, [str(tmp_path / "one_v325.bin"), "/x/y_v999.bin", "/x/z.bin"])
    assert {r["file_id"]: r["error"] for r in errors.collect()} == {"/x/y_v999.bin": "no reader for version v999", "/x/z.bin": "no reader for version None"}
    with pytest.raises(ValueError):
        receivers.read_binary(spark, ["/x/y_v999.bin"], "v999")


def test_text_readers(spark, tmp_path):
    (tmp_path / "a_v324.txt").write_text("".join(f"  2300 {i}.5 9 0 {i} 45 100 40 41 1.5 0 2.5 0 3.5 0 4.5\n" for i in range(5)))
    t = receivers.read_v324(spark, [str(tmp_path / "a_v324.txt")]).orderBy("row_id").toPandas()
    assert t.svid.tolist() == [0, 1, 2, 3, 4] and t.towe.tolist() == [0.5, 1.5, 2.5, 3.5, 4.5] and (t.rng2 == 4.5).all()
    good = "293400.000,2306,G10,GPS_L2C,Main,20928167.858000,85697380.178385,-1114.756836,45.437500,60"
    (tmp_path / "m.txt").write_text("head\nTOW,WN\n" + good + "\n" + good.replace("GPS_L2C", "GPS_L1CA") + "\nError in line\n1,2,,3\n")
    s = receivers.read_sc4(spark, [str(tmp_path / "m.txt")])
    assert s.count() == 2 and str(s.first()["datetime"]) == "2024-03-20 09:30:00"
    w = receivers.sc4_wide(s).first()
    assert w["sig_1"] == "GPS_L1CA" and w["sig_2"] == "GPS_L2C" and w["sig_3"] is None and w["cph2"] == 85697380.178385
    row = dict.fromkeys(schemas.ISMR, "1") | {"WN": "2300", "TOW": "120", "SVID": "38", "TotalS4_1": "0.5", "CorrectionS4_1": "0.3", "TotalS4_2": "0.1", "CorrectionS4_2": "0.3", "Phi60_2": "x"}
    (tmp_path / "r.ismr").write_text(",".join(row[c] for c in schemas.ISMR) + "\n")
    i = receivers.read_ismr(spark, [str(tmp_path / "r.ismr")]).first()
    assert i["PRN"] == "R01" and i["S4L1"] == pytest.approx(0.4) and i["S4L2"] == 0 and i["Phi60_2"] is None and str(i["datetime"]).endswith("00:01:00")


def test_stations(spark, tmp_path):
    (tmp_path / "s.csv").write_bytes("Station Location,Latitude,Longitude,Code,Type\nAñ,1.5,2,AA,sc3\nB,60,3,nan,\nC,0,0,X,SC2\nD,x,1,Y,SC2\n".encode("latin1"))
    s = stations.read_stations(spark, str(tmp_path / "s.csv")).orderBy("ord").toPandas()
    assert s.s_name.tolist() == ["B", "Añ"] and s.s_code.tolist() == ["", "AA"] and s.s_version.tolist() == ["UNK", "SC3"]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "f.txt").write_text("x")
    assert stations.list_files(spark, str(tmp_path / "in"), "*.txt").count() == 1


def test_sink_keeps_what_exists(spark, tmp_path):
    sinks.write_table(spark.range(3).toDF("x"), str(tmp_path / "t"))
    sinks.write_table(spark.range(9).toDF("x"), str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 3
    sinks.write_table(spark.range(9).toDF("x"), str(tmp_path / "t"), overwrite=True)
    assert spark.read.parquet(str(tmp_path / "t")).count() == 9


def test_parts_are_added_and_kept(spark, tmp_path):
    """A second run adds its files and leaves those there, also if both write at once; overwrite replaces a file's part alone."""
    path = str(tmp_path / "t")

    def rows(**files):
        return spark.createDataFrame([(f, i, v) for f, v in files.items() for i in (3, 1, 2)], "file_id string, i int, x int")

    assert sinks.write_parts(rows(a=1, b=1), path, sort=("i",)) == ["a", "b"]
    assert sinks.write_parts(rows(b=2, c=2), path, sort=("i",)) == ["c"]

    def now():
        return {r["file_id"]: r["x"] for r in spark.read.parquet(path).groupBy("file_id").agg(F.max("x").alias("x")).collect()}

    assert now() == {"a": 1, "b": 1, "c": 2} and spark.read.parquet(path).count() == 9
    assert sinks.write_parts(rows(b=3), path, True) == ["b"] and now() == {"a": 1, "b": 3, "c": 2}
    odd = "file:/x/y z=1%.bin"
    sinks.write_parts(spark.createDataFrame([(odd, 1, 9)], "file_id string, i int, x int"), path)
    assert set(sinks.parts_of(spark, path)) == {"a", "b", "c", odd} and now()[odd] == 9
    one = next((tmp_path / "t" / "file_id=a").glob("part-*"))
    assert pd.read_parquet(one).i.tolist() == [1, 2, 3]
    assert not list((tmp_path / "t").glob("_making*"))


def test_level3_without_a_reader_or_a_damaged_file(spark, tmp_path):
    (tmp_path / "x.h5").write_bytes(b"no archive")
    got = stations.read_level3(spark, [str(tmp_path / "x.h5")]).collect()
    assert len(got) == 1 and got[0]["group"] is None and got[0]["NOS1"] is None


def test_numbers_are_told_by_file(spark):
    from skyflux.functions.dims import numeric_constellations

    rows = [("a", "0"), ("a", "2"), ("a", None), ("b", "GPS"), ("b", "0"), (None, "6")]
    got = numeric_constellations(spark.createDataFrame(rows, "file_id string, cons string")).collect()
    assert sorted(map(tuple, got), key=str) == sorted([("a", "GPS"), ("a", "GAL"), ("a", None), ("b", "GPS"), ("b", "0"), (None, "GLO")], key=str)


def test_repeated_times_stay(spark):
    """Seconds of single precision coincide late in the week; rows are told apart by row_id."""
    towe = (np.float32(600000) + np.arange(20, dtype=np.float32) / 20).astype(np.float32)
    assert len(np.unique(towe)) == 16
    assert len(pd.unique(towe)) == 16
