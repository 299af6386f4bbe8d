"""Sampling rate, detrended phases and the common clock term of lvl0 tables.

Keys are file_id and prn; order within them is row_id, a record's place in its file: times alone aren't unique, since the receivers' seconds are
single precision."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F

from ..functions.timefn import floor_to
from . import blocks
from .blocks import Batches, Values

KEY, ORDER, L1_MHZ = ["file_id", "prn"], "row_id", 1575.42
GAP_S, PAD_S = 2.0, 180.0


def slots(df: DataFrame) -> list[int]:
    return [i for i in (1, 2, 3) if f"cph{i}" in df.columns]


def rate_of(rows: Column) -> Column:
    """Hz from the most rows that a satellite has in a minute; null if it is none of the known rates."""
    out = F.lit(None).cast("double")
    for n, hz in ((3000, 50.0), (2400, 40.0), (1200, 20.0), (600, 10.0)):
        out = F.when(F.abs(rows - n) < 10, hz).otherwise(out)
    return out


def sampling_rate(df: DataFrame) -> DataFrame:
    """file_id and fs."""
    counts = df.where("prn IS NOT NULL").groupBy("file_id", "minbin", "prn").agg(F.count("*").alias("n"))
    return counts.groupBy("file_id").agg(rate_of(F.max("n")).alias("fs"))


def with_file_stats(df: DataFrame) -> DataFrame:
    """fs and, for each slot, the threshold 1 rad times the median frequency over L1's."""
    freq = df.groupBy("file_id").agg(*[(F.median(f"freq_{i}") / L1_MHZ).alias(f"_thr{i}") for i in slots(df)])
    return df.join(sampling_rate(df).join(freq, "file_id", "right"), "file_id", "left")


def edge_gap(seconds: np.ndarray, missing: np.ndarray, fs: float, gap: float = GAP_S, pad: float = PAD_S, first: bool = True, last: bool = True) -> np.ndarray:
    """Rows within pad seconds of the ends (if they are the series' first and last rows), of gaps and of missing values."""
    n, k = len(seconds), round(pad * fs)
    mark = missing.copy()
    mark[:1] |= first
    mark[-1:] |= last
    mark[1:] |= np.diff(seconds) > gap
    near = np.concatenate([[0], np.cumsum(mark)])
    at = np.arange(n)
    return near[np.minimum(at + k + 1, n)] - near[np.maximum(at - k, 0)] > 0


def detrended(df: DataFrame) -> DataFrame:
    """detrended_cph{i} (rad), cycleslips_cph{i} and edgegap_mask_cph{i}. df has datetime, minbin, prn, freq_{i} and cph{i}.

    A map over each (file_id, prn) in order, in blocks: some 300,000 rows at 20 Hz in four hours, but of any length. Files without a known rate get nulls and false."""
    own = slots(df)
    plain, df = df.columns, with_file_stats(df)
    names = df.columns
    new = [(f"{n}_cph{i}", t) for i in own for n, t in (("detrended", "double"), ("cycleslips", "boolean"), ("edgegap_mask", "boolean"))]

    def found(raw: Values, micros: Values, fs: float | None, threshold: float | None) -> tuple[Values, Values, Values] | None:
        """(detrended, slips, mask) of a phase; None where there are none."""
        if fs is None or not any(np.isfinite(raw.read(lo, hi)).any() for lo, hi in raw.blocks()):
            return None
        y, slip = blocks.repair(blocks.lines(raw, 2 * np.pi), fs, threshold if threshold is not None else np.nan)
        out, reach, n = blocks.highpass(y, fs), round(PAD_S * fs) + 1, raw.n
        mask, known, slips = Values(bool), Values(), Values(bool)
        for lo, hi in raw.blocks():
            a, e = max(lo - reach, 0), min(hi + reach, n)
            missing = ~np.isfinite(raw.read(a, e))
            mask.add(edge_gap(micros.read(a, e) / 1e6, missing, fs, first=a == 0, last=e == n)[lo - a : hi - a])
            missing = missing[lo - a : hi - a]
            known.add(np.where(missing, np.nan, out.read(lo, hi)))
            slips.add(slip.read(lo, hi) & ~missing)
        return known, slips, mask

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, micros, raw = Batches(), Values(np.int64), {i: Values() for i in own}
        for batch in batches:
            if not micros.n:
                fs, thresholds = batch.column("fs")[0].as_py(), {i: batch.column(f"_thr{i}")[0].as_py() for i in own}
            rows.add(batch)
            micros.add(_integers(batch.column("datetime")))
            for i in own:
                raw[i].add(_floats(batch.column(f"cph{i}")))
        results = [found(raw[i], micros, fs, thresholds[i]) for i in own] if micros.n else []
        for lo, hi, batch in rows:
            columns = batch.select(names).columns
            for one in results:
                if one is None:
                    columns += [pa.nulls(hi - lo, pa.float64()), *[pa.array(np.zeros(hi - lo, bool))] * 2]
                else:
                    columns += [pa.array(x.read(lo, hi), from_pandas=True) for x in one]
            yield pa.RecordBatch.from_arrays(columns, [*names, *[n for n, _ in new]])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields) + "".join(f", {n} {t}" for n, t in new)
    return _in_order(df.where("prn IS NOT NULL")).applyInArrow(run, kinds).select(*plain, "fs", *[n for n, _ in new])


def _in_order(df: DataFrame) -> GroupedData:
    """The rows by KEY, sorted by ORDER within; they come in batches."""
    return df.repartition(*KEY).sortWithinPartitions(*KEY, ORDER).groupBy(*KEY)


def _floats(column: pa.Array) -> np.ndarray:
    """Nulls are NaN."""
    return column.cast(pa.float64()).to_numpy(zero_copy_only=False)


def _integers(times: pa.Array) -> np.ndarray:
    """Microseconds; nulls are the least number, as NaT is."""
    return pc.fill_null(times.cast(pa.timestamp("us", times.type.tz)).cast(pa.int64()), -(2**63)).to_numpy(zero_copy_only=False)


def clock_medians(df: DataFrame, keys: list[str], values: list[str], eligible: Column, name: str = "clock_term") -> DataFrame:
    """The median over all eligible rows and all values of a key."""
    long = df.where(eligible).select(*keys, F.explode(F.array(*values)).alias("_v")).where("_v IS NOT NULL")
    return long.groupBy(*keys).agg(F.median("_v").alias(name))


def clock_corrected(df: DataFrame) -> DataFrame:
    """v{i} (detrended over frequency), clock_term and detrended_noclk_cph{i}. The term of a time is the median of all satellites' v with 0 < elev < 90
    at that time, and holds for all its rows."""
    own = slots(df)
    out = df.withColumns({f"v{i}": F.col(f"detrended_cph{i}") / F.col(f"freq_{i}") for i in own})
    clock = clock_medians(out, ["file_id", "datetime"], [f"v{i}" for i in own], (F.col("elev") > 0) & (F.col("elev") < 90))
    out = out.join(clock, ["file_id", "datetime"], "left")
    return out.withColumns({f"detrended_noclk_cph{i}": F.col(f"detrended_cph{i}") - F.col("clock_term") * F.col(f"freq_{i}") for i in own})


def with_tec(df: DataFrame, threshold: float = 1.0) -> DataFrame:
    """tec_cph1j (repaired, without its mean) and tec_rng1j (repaired) for j = 2, 3, where the table has the phases. df has fs.

    A map in blocks, as detrended(); files without a known rate and satellites without values get nulls."""
    from ..functions.tec import carrier_tec, code_tec

    pairs = [j for j in (2, 3) if {"cph1", f"cph{j}"} <= set(df.columns)]
    if not pairs:
        return df
    f1 = F.col("freq_1") * 1e6
    for j in pairs:
        fj = F.col(f"freq_{j}") * 1e6
        df = df.withColumn(f"tec_cph1{j}", carrier_tec(F.col("cph1"), F.col(f"cph{j}"), f1, fj))
        df = df.withColumn(f"tec_rng1{j}", code_tec(F.col("rng1"), F.col(f"rng{j}"), f1, fj))
    names = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, n, known = Batches(), 0, dict.fromkeys([f"{kind}{j}" for j in (1, *pairs) for kind in ("cph", "rng")], False)
        series = {f"tec_{kind}1{j}": Values() for j in pairs for kind in ("cph", "rng")}
        for batch in batches:
            fs = batch.column("fs")[0].as_py() if not n else fs
            n += batch.num_rows
            rows.add(batch)
            for c in known:
                known[c] = known[c] or not np.isnan(_floats(batch.column(c))).all()
            for c, x in series.items():
                x.add(_floats(batch.column(c)))
        results = {}
        for j in pairs:
            for kind in ("cph", "rng"):
                if fs is not None and known[f"{kind}1"] and known[f"{kind}{j}"]:
                    y, _ = blocks.repair(series[f"tec_{kind}1{j}"], fs, threshold)
                    results[f"tec_{kind}1{j}"] = blocks.without_mean(y) if kind == "cph" else y
        for lo, hi, batch in rows:
            found = {c: pa.array(results[c].read(lo, hi), from_pandas=True) if c in results else pa.nulls(hi - lo, pa.float64()) for c in series}
            yield pa.RecordBatch.from_arrays([found[c] if c in found else batch.column(c) for c in names], names)

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return _in_order(df).applyInArrow(run, kinds)


def without_unknown(df: DataFrame) -> DataFrame:
    """Without rows of the satellite number that stands for none in GLONASS."""
    return df.where(~F.coalesce((F.col("cons") == "GLO") & (F.col("svid") == 255), F.lit(False)))


def without_rate(df: DataFrame) -> DataFrame:
    """file_id and error of the files whose sampling rate isn't known, which get no products; df as formatted() gives it."""
    return sampling_rate(df).where("fs IS NULL").select("file_id", F.lit("sampling rate not known").alias("error"))


def restored_rows(df: DataFrame, found: DataFrame, row: str) -> DataFrame:
    """All rows of df with what was found for some of them, by row."""
    return df.join(found, row, "left")


def formatted(df: DataFrame) -> DataFrame:
    """lvl0 with names of constellations, minbin, prn, signals, frequencies, and nulls for zero phases and strengths."""
    from ..functions.clean import zero_to_null
    from ..functions.dims import numeric_constellations, prn, with_signals

    out = without_unknown(numeric_constellations(df))
    out = out.withColumns({"minbin": floor_to("minute", F.col("datetime")), "prn": prn(F.col("cons"), F.col("svid"))})
    return zero_to_null(with_signals(out))
