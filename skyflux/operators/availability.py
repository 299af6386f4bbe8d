"""Stations, nearest-station joins and data availability."""

from __future__ import annotations

from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geo import MEAN_EARTH_KM, degrees_of, haversine_km, let, off_origin, places_of, position_label
from ..functions.timefn import floor_to, parsed

TOLERANCE_DEG, TOLERANCE_KM = 0.02, 1.0
CELL_DEG = 0.021  # a little wider than the tolerance, so that rounding at a border costs no pair


def _floors(coordinates: list[Column], size: float) -> Column:
    return F.array(*[F.floor(c / size) for c in coordinates])


def _around(cell: Column, dimensions: int) -> Column:
    """A cell and its neighbours in all dimensions."""
    return F.array(*[F.array(*[F.get(cell, F.lit(d)) + step for d, step in enumerate(steps)]) for steps in product((-1, 0, 1), repeat=dimensions)])


def _in_space(lat: Column, lon: Column) -> list[Column]:
    """Kilometres from the earth's middle; no pole and no date line."""
    p, q = F.radians(lat), F.radians(lon)
    return [MEAN_EARTH_KM * F.cos(p) * F.cos(q), MEAN_EARTH_KM * F.cos(p) * F.sin(q), MEAN_EARTH_KM * F.sin(p)]


def nearest(files: DataFrame, stations: DataFrame, distance: Column, tolerance: float, cell: float, on: Column | None = None, key: str = "path", keep: tuple[str, ...] = (), in_space: bool = False) -> DataFrame:
    """(key, keep, station ord, distance) of the nearest station within the tolerance; ties: the smallest ord.

    An equi-join on grid cells at least as wide as the tolerance (of degrees, or of kilometres in space), so no pair outside of neighbouring cells is made.
    files: key, lat, lon and keep, which the key decides; stations: ord, s_lat, s_lon."""
    spot = (lambda a, b: _in_space(F.col(a), F.col(b))) if in_space else (lambda a, b: [F.col(a), F.col(b)])
    cells = stations.withColumn("_c", _floors(spot("s_lat", "s_lon"), cell)).withColumn("_c", F.explode(_around(F.col("_c"), 3 if in_space else 2)))
    here = files.withColumn("_c", _floors(spot("lat", "lon"), cell))
    both = here.join(cells, "_c").withColumn("distance", distance).where(F.col("distance") <= tolerance)
    if on is not None:
        both = both.where(on)
    return both.groupBy(key, *keep).agg(F.min_by("ord", F.struct("distance", "ord")).alias("ord"), F.min("distance").alias("distance"))


def degrees_apart() -> Column:
    return F.sqrt(F.pow(F.col("lat") - F.col("s_lat"), 2) + F.pow(F.col("lon") - F.col("s_lon"), 2))


def kilometres_apart() -> Column:
    return haversine_km(F.col("lat"), F.col("lon"), F.col("s_lat"), F.col("s_lon"))


def nearest_by_km(files: DataFrame, stations: DataFrame, tolerance: float = TOLERANCE_KM, key: str = "path", distance: Column | None = None) -> DataFrame:
    """By great-circle distance, anywhere: cells are cubes in space, and a chord is no longer than its arc."""
    return nearest(files, stations, kilometres_apart() if distance is None else distance, tolerance, 1.001 * tolerance, key=key, in_space=True)


def legacy_files(paths: DataFrame, second: str) -> DataFrame:
    """path, version, ts, lat, lon of the second and third generation's files; names that don't fit are left out.

    A name has parts between underscores: the receiver's, eight digits of a day, four of a time, a longitude, a latitude; it ends with .zip.
    second: what the paths of the second generation contain, in lower case."""
    name = F.element_at(F.split(F.regexp_replace("path", r"\\", "/"), "/"), -1)

    def read(parts: Column) -> Column:
        dated = F.filter(places_of(parts), lambda i: (i >= 3) & F.get(parts, i - 2).rlike(r"^\d{8}$") & F.get(parts, i - 1).rlike(r"^\d{4}$"))
        return let(F.get(dated, F.lit(0)), lambda i: F.struct(
            parsed(F.concat(F.get(parts, i - 2), F.get(parts, i - 1)), "yyyyMMddHHmm").alias("ts"), degrees_of(F.get(parts, i + 1), 90, "S").alias("lat"), degrees_of(F.get(parts, i), 180, "W").alias("lon")))

    of = let(F.split(name, "_"), read)
    version = F.when(F.lower("path").contains(second), "SC2").otherwise("SC3").alias("version")
    # one row of an exploded array of one: a border that keeps filters from copying the parsing
    out = paths.where(name.endswith(".zip")).select("path", version, F.explode(F.array(of)).alias("f")).select("path", "version", "f.*")
    return out.where(F.col("ts").isNotNull() & F.col("lat").isNotNull() & off_origin(F.col("lat"), F.col("lon")))


def legacy_days(paths: DataFrame, stations: DataFrame, cutoff: Column, second: str) -> DataFrame:
    """(ord, day) with files since the cutoff's midnight: a file belongs to the nearest station of its version."""
    files = legacy_files(paths, second).where(F.col("ts") >= floor_to("day", cutoff))
    # what decides the station and the day; files of one place and day are one row from here on
    places = files.select("version", "lat", "lon", floor_to("day", F.col("ts")).alias("day")).distinct().withColumn("path", F.struct("version", "lat", "lon", "day"))
    near = nearest(places, stations, degrees_apart(), TOLERANCE_DEG, CELL_DEG, F.col("version") == F.col("s_version"))
    return near.select("ord", "path.day").distinct()


def sc4_days(paths: DataFrame, stations: DataFrame, codes: dict[str, str], cutoff: Column) -> DataFrame:
    """(ord, day) of fourth-generation files: the first four letters of a name give a station code, the folder above the day."""
    from ..functions.dims import lookup

    parts = F.split(F.regexp_replace("path", r"\\", "/"), "/")
    name = F.element_at(parts, -1)
    files = paths.where(F.size(parts) > 1).select(lookup(F.lower(F.substring(name, 1, 4)), codes).alias("code"), parsed(F.element_at(parts, -2), "yyyyMMdd").alias("day"), F.length(name).alias("n"))
    first = stations.groupBy(F.col("s_code").alias("code")).agg(F.min("ord").alias("ord"))
    return files.where((F.col("n") >= 10) & (F.col("day") >= floor_to("day", cutoff))).join(first, "code").select("ord", "day").distinct()


def intervals(days: DataFrame, now: Column) -> DataFrame:
    """(ord, start, end): a day's interval ends at now at the latest."""
    return days.where(F.col("day") < now).select("ord", F.col("day").alias("start"), F.least(F.col("day") + F.expr("INTERVAL 1 DAY"), now).alias("end"))


def missing_days(days: DataFrame, stations: DataFrame, cutoff: Column, now: Column) -> DataFrame:
    """(ord, day) of days from the cutoff to now without data."""
    every = stations.select("ord", F.explode(F.sequence(floor_to("day", cutoff), floor_to("day", now), F.expr("INTERVAL 1 DAY"))).alias("day"))
    return every.join(days, ["ord", "day"], "left_anti")


def station_labels(stations: DataFrame) -> DataFrame:
    code = F.when(F.col("s_code") != "", F.col("s_code")).otherwise("N/A")
    return stations.select("ord", F.concat(F.lit("["), "s_version", F.lit("] "), code, F.lit(", "), "s_name", F.lit(" "), position_label(F.col("s_lat"), F.col("s_lon"))).alias("label"))


def missing_fraction(df: DataFrame, index: list[str], value: str, threshold: float = 900) -> DataFrame:
    """The share of indexes whose largest value isn't over the threshold; null for an empty table."""
    most = df.groupBy(*index).agg(F.max(value).alias("most"))
    return most.agg((1 - F.avg(F.coalesce((F.col("most") > threshold).cast("double"), F.lit(0.0)))).alias("missing"))
