"""The whole plan on a made receiver file, against a plain pandas reading of the rules."""

import numpy as np
import pandas as pd
import pytest

from skyflux.operators.filters import highpass
from skyflux.operators.repair import repair
from skyflux.plans import pipeline
from skyflux.schemas import V325

FS, MINUTES = 10, 4


def receiver_file(path, seed=0):
    rng = np.random.default_rng(seed)
    n = FS * 60 * MINUTES
    sats = [(0, 7), (0, 12), (2, 3), (5, 1), (1, 20)]
    rows = np.zeros(n * len(sats), V325)
    rows["week"] = 2300
    for k, (cons, svid) in enumerate(sats):
        own = rows[k :: len(sats)]
        own["towe"], own["cons"], own["svid"] = 1000 + np.arange(n) / FS, cons, svid
        own["elev"], own["azim"] = 40 + k, 100
        t = np.arange(n) / FS
        for i, f in ((1, 1575.42), (2, 1227.6)):
            own[f"cph{i}"] = 1e6 + 30 * t + 0.02 * f / 1000 * np.sin(2 * np.pi * (0.4 + k / 10) * t) + rng.normal(0, 0.001, n)
            own[f"snr{i}"] = rng.integers(38, 46, n)
            own[f"rng{i}"] = 2e7 + 10 * t + rng.normal(0, 0.1, n)
        own["cph1"][1200:] += 500
        own["snr1"][50] = 0
    rows["cph2"][3] = 0
    path.write_bytes(rows.tobytes())
    return rows


def expected(rows):
    """Minute products of each satellite, written straight from the rules."""
    df = pd.DataFrame(rows)
    df["t"] = pd.Timestamp("1980-01-06") + pd.to_timedelta(df.week.astype(float) * 604800 + df.towe.astype(float), unit="s")
    df["prn"] = df.cons.map({0: "G", 1: "S", 2: "E"}) + df.svid.astype(str).str.zfill(2)
    df["minute"] = df.t.dt.floor("1min")
    freq = {1: df.cons.map({0: 1575.42, 2: 1575.42}), 2: df.cons.map({0: 1227.6, 2: 1207.14})}
    for i in (1, 2):
        df[f"cph{i}"] = df[f"cph{i}"].replace(0, np.nan)
        df[f"det{i}"], df[f"slip{i}"] = np.nan, False
        threshold = freq[i].median() / 1575.42
        for _, g in df[df.prn.notna()].groupby("prn"):
            x = g[f"cph{i}"]
            if x.notna().any():
                y, slip = repair(x.interpolate(limit_direction="both").to_numpy() * 2 * np.pi, FS, threshold)
                df.loc[g.index, f"det{i}"] = np.where(x.isna(), np.nan, highpass(y, FS))
                df.loc[g.index, f"slip{i}"] = slip & x.notna().to_numpy()
        df[f"v{i}"] = df[f"det{i}"] / freq[i]
    clock = df[df.prn.notna()].melt("t", ["v1", "v2"]).groupby("t").value.median()
    out = {}
    for i in (1, 2):
        df[f"noclk{i}"] = df[f"det{i}"] - df.t.map(clock) * freq[i]
        lin = 10 ** (df[f"snr{i}"].replace(0, np.nan) / 10)
        keys = [df.minute, df.prn]
        out[f"sigma_phi_{i}"] = df[f"noclk{i}"].groupby(keys).std(ddof=0)
        out[f"n_{i}"] = df[f"noclk{i}"].groupby(keys).count()
        out[f"n_cycleslip_{i}"] = df[f"slip{i}"].groupby(keys).sum()
        out[f"s4_{i}"] = lin.groupby(keys).std(ddof=0) / lin.groupby(keys).mean()
    return pd.DataFrame(out)


@pytest.fixture(scope="module")
def made(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("raw")
    rows = receiver_file(root / "receiver3_20240511_0800_756582.5000W_414055.0312N_v325.bin")
    (root / "bad_v326.bin").write_bytes(b"short")
    return root, rows, pipeline.process(spark, [str(p) for p in root.iterdir()] + ["x.txt"])


def test_minutes(made):
    _, rows, out = made
    lvl3 = out.lvl3.toPandas().set_index(["minbin", "prn"]).sort_index()
    want = expected(rows).sort_index()
    assert set(lvl3.index) == set(want.index) and len(lvl3) == (MINUTES + (1000 % 60 > 0)) * 4
    for c in want:
        np.testing.assert_allclose(lvl3[c].loc[want.index].to_numpy(float), want[c].to_numpy(float), rtol=1e-6, atol=1e-9, err_msg=c)
    assert (lvl3.groupby("prn").n_cycleslip_1.first() >= 1).all()
    assert lvl3.quality_1.isin([0, 1]).all() and (lvl3.s4_1 >= lvl3.s4_corrected_1).all()
    assert lvl3.tec_cph12[[i[1] == "G07" for i in lvl3.index]].notna().all() and abs(lvl3.tec_cph12.mean()) < 1e3
    assert "secbin" not in lvl3 and lvl3.tec_cph13.isna().all()


def test_seconds_and_errors(made):
    _, rows, out = made
    lvl2 = out.lvl2.toPandas()
    assert len(lvl2) == 4 * 60 * MINUTES and {"secbin", "sigma_phi_1", "sig_1", "freq_2", "v1", "clock_term"} <= set(lvl2)
    errors = out.errors.toPandas()
    assert len(errors) == 1 and "bad" in errors.file_id[0]


def test_each_file_is_on_its_own(spark, tmp_path):
    """Unknown versions, damaged files and unknown rates are rows of errors; the others' products are complete. With a workspace all is the same."""
    receiver_file(tmp_path / "good_v325.bin")
    (tmp_path / "odd_v999.bin").write_bytes(b"x" * 500)
    (tmp_path / "torn_lvl0.pq").write_bytes(b"PAR1 no more")
    rows = receiver_file(tmp_path / "slow_v325.bin")[: 5 * 100]
    (tmp_path / "slow_v325.bin").write_bytes(rows.tobytes())
    files = [str(p) for p in sorted(tmp_path.iterdir())]
    alone = pipeline.process(spark, str(tmp_path / "good_v325.bin")).lvl3.count()
    for work in (None, str(tmp_path / "work")):
        out = pipeline.process(spark, files, "lvl3", work)
        errors = {r["file_id"].rsplit("/", 1)[1]: r["error"] for r in out.errors.collect()}
        assert set(errors) == {"odd_v999.bin", "torn_lvl0.pq", "slow_v325.bin"} and "rate" in errors["slow_v325.bin"] and "v999" in errors["odd_v999.bin"]
        lvl3 = out.lvl3.toPandas()
        assert lvl3.file_id.str.contains("good").sum() == alone and (lvl3[lvl3.file_id.str.contains("good")].n_1 > 0).any()


def test_runs_add_up(spark, tmp_path, capsys):
    """Two runs, and two array tasks, on different files: all products are there, nothing is done twice, and a real convert leaves nothing to do."""
    from skyflux.__main__ import main

    (tmp_path / "in").mkdir()
    for i in range(4):
        receiver_file(tmp_path / "in" / f"r{i}_v325.bin", seed=i)
    files = sorted(str(p) for p in (tmp_path / "in").iterdir())
    root, out = str(tmp_path / "in"), str(tmp_path / "out")

    def there(level):
        return sorted(f.rsplit("/", 1)[1] for f in pipeline.parts_of(spark, f"{out}/{level}"))

    assert main(["process", files[0], "--output", out, "--mode", "lvl3"]) == 0
    assert main(["process", files[1], "--output", out, "--mode", "lvl3"]) == 0
    before = spark.read.parquet(f"{out}/lvl3").count()
    for k in (0, 1):
        assert main(["process", "--root", root, "--output", out, "--mode", "lvl3", "--tasks", "2", "--task", str(k)]) == 0
    assert "nothing to do" in capsys.readouterr().out
    assert there("lvl3") == [f"r{i}_v325.bin" for i in range(4)] and spark.read.parquet(f"{out}/lvl3").count() == 2 * before
    assert not [p for p in (tmp_path / "out").iterdir() if p.name.startswith("_work")]
    assert main(["convert", files[2], "--output", out]) == 0
    got = pipeline.resolve_inputs(spark, root=root, infer_missing=True, output_root=out)
    assert [g.rsplit("/", 1)[1] for g in got] == ["r0_v325.bin", "r1_v325.bin", "r3_v325.bin"]
    assert main(["convert", "--root", root, "--infer-missing", "--output", out]) == 0 and there("lvl0") == there("lvl3")
    assert main(["convert", "--root", root, "--infer-missing", "--output", out]) == 0 and "nothing to do" in capsys.readouterr().out


def test_availability_report(spark, tmp_path):
    """Listing, days, gaps and labels from folders, as the command makes them."""
    from skyflux.__main__ import main
    from skyflux.plans.availability import report

    at = tmp_path / "in" / "receiver3"
    at.mkdir(parents=True)
    for day in ("20240510", "20240512"):
        (at / f"receiver3_{day}_0800_87.16004W_14.09419N_v326f.bin.zip").write_text("x")
    (tmp_path / "in" / "20240511").mkdir()
    (tmp_path / "in" / "20240511" / "abcd_data.txt").write_text("x")
    (tmp_path / "s.csv").write_text("name,lat,lon,code,type\nA,14.094,-87.16,H1,SC3\nB,50,10,H2,SC4\n")
    paths = report(spark, str(tmp_path / "in"), str(tmp_path / "s.csv"), str(tmp_path / "out"), "receiver2", {"abcd": "H2"}, 3, pd.Timestamp("2024-05-13 06:00:00").to_pydatetime())
    spans, missing, labels = (spark.read.parquet(p).toPandas() for p in paths)
    assert sorted(zip(spans.ord, spans.start.dt.day, strict=True)) == [(0, 11), (1, 10), (1, 12)] and len(labels) == 2
    assert len(missing) == 2 * 90 - 3 + 2
    assert main(["availability", "--root", str(tmp_path / "in"), "--stations", str(tmp_path / "s.csv"), "--output", str(tmp_path / "now"), "--codes", "abcd=H2"]) == 0
    assert spark.read.parquet(str(tmp_path / "now" / "labels")).count() == 2


def test_unknown_rate_gives_nulls(spark, tmp_path):
    rows = receiver_file(tmp_path / "a_v325.bin")[: 5 * 100]
    (tmp_path / "a_v325.bin").write_bytes(rows.tobytes())
    out = pipeline.process(spark, str(tmp_path / "a_v325.bin"), "lvl3").lvl3.toPandas()
    assert len(out) and out.sigma_phi_1.isna().all() and out.tec_cph12.isna().all() and (out.n_1 == 0).all() and (out.quality_1 == 0).all()


def test_written_and_read_again(spark, made, tmp_path):
    root, _, out = made
    lvl0, _ = pipeline.convert(spark, [str(p) for p in root.iterdir() if "receiver3" in p.name])
    lvl0.drop("file_id", "row_id").coalesce(1).write.parquet(str(tmp_path / "a_lvl0.parquet"))
    again = pipeline.process(spark, str(tmp_path / "a_lvl0.parquet"), "lvl3").lvl3
    a = again.orderBy("minbin", "prn").select("minbin", "prn", "s4_1", "n_1").toPandas()
    b = out.lvl3.orderBy("minbin", "prn").select("minbin", "prn", "s4_1", "n_1").toPandas()
    assert a.equals(b) or np.allclose(a.s4_1, b.s4_1)
    paths = pipeline.write_products(out, str(tmp_path / "out"))
    assert spark.read.parquet(paths[1]).count() == len(b)


def test_inputs(spark, tmp_path):
    assert pipeline.as_list(None) == [] and pipeline.as_list("a") == ["a"]
    with pytest.raises(TypeError):
        pipeline.as_list(3)
    with pytest.raises(ValueError):
        pipeline.process(spark, [], "lvl9")
    assert [pipeline.chunk(list("abcdefghij"), 4, k) for k in range(4)] == [list("abc"), list("def"), list("gh"), list("ij")]
    with pytest.raises(ValueError):
        pipeline.chunk([], 2, 2)
    assert pipeline.process(spark, ["a.txt"]).lvl3 is None
    (tmp_path / "in").mkdir()
    (tmp_path / "out").mkdir()
    for n in ("a_v325.bin", "b_v325.bin", "c_v326.bin"):
        (tmp_path / "in" / n).write_text("x")
    (tmp_path / "out" / "a_v325_lvl0.pq").write_text("x")
    got = pipeline.resolve_inputs(spark, root=str(tmp_path / "in"), infer_missing=True, output_root=str(tmp_path / "out"), versions={"v325"})
    assert [g.rsplit("/", 1)[1] for g in got] == ["b_v325.bin"]
    with pytest.raises(ValueError):
        pipeline.resolve_inputs(spark)


def test_stream(spark, tmp_path):
    from skyflux.streaming.products import streamed_products

    rows = [(f"G0{i % 2}", (pd.Timestamp("2024-01-01") + pd.Timedelta(seconds=10 * i)).to_pydatetime(), float(30 + i % 3)) for i in range(60)]
    spark.createDataFrame(rows, "prn string, ts timestamp, snr1 double").coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("prn string, ts timestamp, snr1 double").parquet(str(tmp_path / "in"))
    q = streamed_products(stream, "ts", ["prn"], late="1 minute").writeStream.outputMode("append").format("memory").queryName("minute_products").option("checkpointLocation", str(tmp_path / "cp")).start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    got = spark.table("minute_products").toPandas()
    assert len(got) >= 14 and (got.s4_1 > 0).all()
