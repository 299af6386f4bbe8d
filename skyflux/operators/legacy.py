"""Older algorithm generations, kept for comparison with earlier products. All are grouped maps over one satellite of one file."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dims import LEGACY_TEC
from .filters import equalised, highpass, without_slopes
from .repair import repair, repair_by_bins

L1_MHZ = 1575.42


def _mapped(df: DataFrame, keys: list[str], run, new: list[tuple[str, str]]) -> DataFrame:
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields) + "".join(f", `{n}` {t}" for n, t in new)
    return df.groupBy(*keys).applyInPandas(run, kinds)


def repaired_filling(y: np.ndarray, fs: float, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """The middle generation: as repair(), but a slip takes the next good step (after the last one the last), and all series are repaired."""
    s = pd.Series(np.asarray(y, float))
    _, slip = repair(y, fs, threshold)
    step = s.diff().where(~slip)
    if len(step) > 1:
        step.iloc[0] = step.iloc[1]
    step = step.bfill().ffill()
    return (s.iloc[0] + step.cumsum()).to_numpy() if len(s) else s.to_numpy(), slip


def repaired_by_next(df: DataFrame, keys: list[str], order: list[str], y: str, fs: float, threshold: float, name: str = "repaired", slip: str = "slip") -> DataFrame:
    """The series of every key by repaired_filling(), and the mask of slips."""
    names = df.columns

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(order, kind="stable")
        series, mask = repaired_filling(rows[y].to_numpy(float), fs, threshold)
        return rows.assign(**{name: series, slip: mask})[[*names, name, slip]]

    return _mapped(df, keys, run, [(name, "double"), (slip, "boolean")])


def paired_signals(rows: DataFrame, keys: list[str], signal: str, value: str, first: str, second: str) -> DataFrame:
    """keys, a and b: the largest value of two signals at keys that have both."""
    one, two = (rows.where(F.col(signal) == s).groupBy(*keys).agg(F.max(value).alias(n)) for s, n in ((first, "a"), (second, "b")))
    return one.join(two, keys)


def detrended_by_bins(df: DataFrame, keys: list[str], ts: str, phase: str, fs: float, threshold: float = 10.0, equalise: bool = False) -> DataFrame:
    """The oldest generation: dphi (high-passed radians after repair against 10 s medians, equalised if asked for) and cycleslips. Rows without a phase
    get null and false."""
    names = df.columns

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(ts, kind="stable").reset_index(drop=True)
        known = rows[phase].notna().to_numpy()
        out, slips = np.full(len(rows), np.nan), np.zeros(len(rows), bool)
        if known.sum() > 1:
            times = pd.DatetimeIndex(rows.loc[known, ts])
            y, s = repair_by_bins(times, rows.loc[known, phase].to_numpy(float) * 2 * np.pi, threshold)
            filtered = highpass(np.nan_to_num(y), fs)
            out[known], slips[known] = equalised(filtered, fs) if equalise else filtered, s
        rows["dphi"] = pd.Series(out).astype(object).where(~np.isnan(out), None)
        rows["cycleslips"] = slips
        return rows[[*names, "dphi", "cycleslips"]]

    return _mapped(df, keys, run, [("dphi", "double"), ("cycleslips", "boolean")])


def regridded(df: DataFrame, keys: list[str], ts: str, x: str, step_ms: int = 50) -> DataFrame:
    """keys, ts and x on a regular grid from the first to the last time, with lines in time over missing values. See windows.regular_grid() for the plan form."""
    from .windows import regular_grid

    return regular_grid(df, keys, ts, x, f"{step_ms} MILLISECONDS")


def reference_removed(df: DataFrame, ts: str = "datetime", x: str = "dphi", cons: str = "cons", skip: int = 1000) -> DataFrame:
    """dphi_ref: the median of x over all satellites but SBAS at a time, null for a file's first `skip` times; dphi_true: x without it."""
    from pyspark.sql import Window

    times = df.where(~F.col(cons).isin("SBS", "SBAS")).groupBy("file_id", ts).agg(F.median(x).alias("dphi_ref"))
    w = Window.partitionBy("file_id").orderBy(ts)
    times = times.withColumn("dphi_ref", F.when(F.row_number().over(w) > skip, F.col("dphi_ref")))
    return df.join(times, ["file_id", ts], "left").withColumn("dphi_true", F.col(x) - F.col("dphi_ref"))


def tec_by_constellation(rows: DataFrame) -> DataFrame:
    """file_id, SVID, datetime, PTEC (phases without jumps) and CTEC (codes) from measurements with a row for each signal, at times that have both signals."""
    tables = {g: v for g, v in LEGACY_TEC.items()}

    def run(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        constants = tables.get(str(key[1])[:1])
        names = ["file_id", "SVID", "datetime", "PTEC", "CTEC"]
        if constants is None:
            return pd.DataFrame(columns=names)
        l1, l2, factor, s1, s2 = constants
        part = part.sort_values("datetime", kind="stable").drop_duplicates(["SIG", "datetime"])
        one, two = (part[part.SIG == s].set_index("datetime") for s in (s1, s2))
        both = one.index.intersection(two.index)
        if len(both) < 3:
            return pd.DataFrame(columns=names)
        m1 = pd.Series(without_slopes(one.index, one.Phase.to_numpy(float) * l1, 5e4), one.index)[both]
        m2 = pd.Series(without_slopes(two.index, two.Phase.to_numpy(float) * l2, 5e4), two.index)[both]
        phase = (factor * (m2 - m1)).dropna()
        phase = pd.Series(without_slopes(phase.index, phase.to_numpy(), 0.3), phase.index).reindex(both)
        code = factor * (one.PR[both] - two.PR[both])
        return pd.DataFrame({"file_id": key[0], "SVID": key[1], "datetime": both, "PTEC": phase.to_numpy(), "CTEC": code.to_numpy()}).astype({"PTEC": object, "CTEC": object}).where(lambda d: d.notna(), None)

    return rows.select("file_id", "SVID", "SIG", "datetime", "Phase", "PR").groupBy("file_id", "SVID").applyInPandas(run, "file_id string, SVID string, datetime timestamp_ntz, PTEC double, CTEC double")


def enriched_by_station(products: DataFrame, stations: DataFrame, tolerance_km: float = 1.0) -> DataFrame:
    """Rows of files whose name has coordinates within tolerance_km of a station, with code, lat0 and lon0, and dip0 where stations has it;
    rows with a null go. products has file_id; stations as sources.stations gives them."""
    from ..functions.geo import coordinates
    from .availability import nearest_by_km

    name = F.element_at(F.split("path", "/"), -1)
    lat, lon = coordinates(name)
    files = products.select(F.col("file_id").alias("path")).distinct().select("path", lat.alias("lat"), lon.alias("lon")).where("lat IS NOT NULL")
    near = nearest_by_km(files, stations)
    extra = ["s_code"] + (["dip0"] if "dip0" in stations.columns else [])
    known = files.join(near.where(F.col("distance") <= tolerance_km), "path").join(stations.select("ord", *extra), "ord")
    known = known.select(F.col("path").alias("file_id"), F.col("s_code").alias("code"), F.col("lat").alias("lat0"), F.col("lon").alias("lon0"), *extra[1:])
    return products.join(known, "file_id").dropna()
