"""Trips between detectors: matching, counts, travel-time modes, speeds, vehicle classes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import speed_kmh
from .grids import floor_ts, window_count


def match_trips(sightings: DataFrame, edges: DataFrame, max_s: int = 3600) -> DataFrame:
    """link_code, device, ts and value (seconds) of each trip.

    A device seen at a link's origin at t makes a trip to its earliest sighting at the destination in the open
    interval (t, t + max_s), unless it is seen at the origin again at or before that. Equal trips are one. Per link
    and device the rows of both ends are put in one sequence, and a range frame finds what follows: no pair of
    rows is joined.
    """
    ends = edges.select("link_code", F.explode(F.array(F.struct(F.col("origin_code").alias("station_code"), F.lit(True).alias("is_origin")), F.struct(F.col("destination_code").alias("station_code"), F.lit(False).alias("is_origin")))).alias("e"))
    ends = ends.select("link_code", "e.station_code", "e.is_origin")
    seen = sightings.select("station_code", "device", "ts").distinct().join(ends, "station_code")
    seen = seen.withColumn("us", F.unix_micros(F.col("ts").cast("timestamp")))
    w = Window.partitionBy("link_code", "device").orderBy("us").rangeBetween(1, max_s * 1_000_000 - 1)
    finish = F.min(F.when(~F.col("is_origin"), F.col("us"))).over(w)
    again = F.min(F.when(F.col("is_origin"), F.col("us"))).over(w)
    trips = seen.withColumns({"finish": finish, "again": again}).where("is_origin AND finish IS NOT NULL AND (again IS NULL OR again > finish)")
    return trips.select("link_code", "device", "ts", ((F.col("finish") - F.col("us")) / 1e6).alias("value")).distinct()


def trip_count(trips: DataFrame, period: int) -> DataFrame:
    """A2: dense counts of trips by link."""
    return window_count(trips, period, ["link_code"])


def travel_time_mode(trips: DataFrame, period: int, step: int = 5, width: int = 30, most_windows: int | None = None) -> DataFrame:
    """link_code, ts (centre of the window) and value, the mode of the travel times of each window.

    Bins begin at the floor of the window's least time and every step after it up to the ceiling of the greatest, and
    hold [begin, begin + width); the fullest counts, the lowest of equals, and its begin plus half a width is the
    value. Each time is put into the bins that hold it, so that counting is one grouping. Windows without trips have
    no row. most_windows: only the first so many windows of a link (L1).
    """
    if 86400 % period == 0:  # windows of any midnight are those of the first one
        begun = trips.withColumn("_first", F.date_trunc("day", "ts"))
    else:
        begun = trips.join(trips.groupBy("link_code").agg(F.date_trunc("day", F.min("ts")).alias("_first")), "link_code")
    t = begun.withColumn("window", floor_ts("ts", period, F.col("_first"))).drop("_first")
    bounds = t.groupBy("link_code", "window").agg(F.floor(F.min("value")).alias("lo"), F.ceil(F.max("value")).alias("hi"))
    if most_windows is not None:
        bounds = bounds.withColumn("_n", F.row_number().over(Window.partitionBy("link_code").orderBy("window"))).where(F.col("_n") <= most_windows).drop("_n")
    t = t.join(bounds, ["link_code", "window"])
    last = F.floor((F.least(F.col("value"), F.col("hi").cast("double")) - F.col("lo")) / step)
    first = F.greatest(F.floor((F.col("value") - F.col("lo") - width) / step) + 1, F.lit(0))
    bins = t.where(first <= last).select("link_code", "window", "lo", F.explode(F.sequence(first.cast("long"), last.cast("long"))).alias("i"))
    counts = bins.groupBy("link_code", "window", (F.col("lo") + F.col("i") * step).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy("link_code", "window").agg(F.min_by("bin", F.struct(-F.col("n"), F.col("bin"))).alias("bin"))
    return best.select("link_code", F.timestamp_micros(F.unix_micros("window") + period // 2 * 1_000_000).alias("ts"), (F.col("bin") + width / 2).cast("double").alias("value"))


def link_speed(mode: DataFrame, edges: DataFrame) -> DataFrame:
    """Mode rows of links with a length as km/h."""
    return mode.join(edges.where("length_m IS NOT NULL").select("link_code", "length_m"), "link_code").select("link_code", "ts", speed_kmh(F.col("length_m"), F.col("value")).alias("value"))


def fast_trips(trips: DataFrame, edges: DataFrame, min_kmh: float = 100) -> DataFrame:
    """Trips of at least min_kmh on links with a length."""
    joined = trips.join(edges.where("length_m IS NOT NULL").select("link_code", "length_m"), "link_code")
    return joined.where(speed_kmh(F.col("length_m"), F.col("value")) >= min_kmh).drop("length_m")


def split_heavy_light(counts: DataFrame, edges: DataFrame) -> DataFrame:
    """Heavy and light vehicles of counts (station_code, ts, value).

    edges (destination_code, factor, hv_perc): the mean of factor times hv_perc over the edges into a station is its
    share of heavy vehicles in percent, 0 without edges.
    """
    share = edges.groupBy(F.col("destination_code").alias("station_code")).agg(F.avg(F.col("factor") * F.col("hv_perc")).alias("hv"))
    out = counts.join(share, "station_code", "left").withColumn("heavy", F.floor(F.col("value") * F.coalesce("hv", F.lit(0.0)) / 100))
    return out.withColumn("light", F.col("value") - F.col("heavy")).drop("hv")


def update_link_geometry(edges: DataFrame, shapes: DataFrame) -> DataFrame:
    """Edges with the geometry of shapes (link_code, geometry) where there is one, and its planar length."""
    new = shapes.select("link_code", F.col("geometry").alias("_g"))
    out = edges.join(new, "link_code", "left").withColumn("geometry", F.coalesce("_g", "geometry")).drop("_g")
    return out.withColumn("length_m", F.coalesce(line_length(F.col("geometry")), F.col("length_m")))


def line_length(points):
    """Planar length of an array of struct<x, y>; NULL for NULL, 0 for fewer than two points."""
    legs = F.zip_with(points, F.slice(points, 2, F.greatest(F.size(points), F.lit(1))), lambda a, b: F.coalesce(F.sqrt((b.x - a.x) * (b.x - a.x) + (b.y - a.y) * (b.y - a.y)), F.lit(0.0)))
    return F.aggregate(legs, F.lit(0.0), lambda s, d: s + d)
