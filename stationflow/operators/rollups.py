"""Hourly averages, daily sums, and sums of parents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import direction_of, lane_direction, name_without_lane
from .grids import gap_s, seconds



def hourly_average(m: DataFrame, now: Column, min_points: int = 5, key: Sequence[str] = ("station_code", "type_name")) -> DataFrame:
    """A5: means over (start, end] hours of at least min_points rows, at the end.

    Only hours that the series covers: up to the hour of its last row, or of now where that row is less than an hour
    old. A row on the first row's full hour belongs to the hour before, which isn't covered.
    """
    t = m.withColumn("end", (F.ceil(seconds("ts") / 3600) * 3600).cast("long"))
    hours = t.groupBy(*key, "end").agg(F.avg("value").alias("value"), F.count("value").alias("n"))
    bounds = m.groupBy(*key).agg(F.min("ts").alias("lo"), F.max("ts").alias("hi"))
    n = seconds(now)
    covered = F.when(n - seconds("hi") < 3600, n).otherwise(seconds("hi"))
    out = hours.join(bounds, list(key)).where((F.col("n") >= min_points) & (F.col("end") > F.floor(seconds("lo") / 3600) * 3600) & (F.col("end") <= F.floor(covered / 3600) * 3600))
    return out.select(*key, F.timestamp_seconds("end").alias("ts"), "value")


def next_midnight(ts: Column | str) -> Column:
    return F.date_trunc("day", ts) + F.make_dt_interval(days=F.lit(1))


def daily_sum(m: DataFrame, key: Sequence[str] = ("station_code", "type_name")) -> DataFrame:
    """Sums of days, at 00:00 of the next one."""
    return m.groupBy(*key, next_midnight("ts").alias("ts")).agg(F.sum("value").alias("value"))


def daily_total(m: DataFrame, parts: Sequence[str], total: str, key: Sequence[str] = ("station_code",)) -> DataFrame:
    """Daily sums over the types in parts together, as type total; the daily sums of each type with it."""
    single = daily_sum(m, [*key, "type_name"])
    whole = single.where(F.col("type_name").isin(list(parts))).groupBy(*key, "ts").agg(F.sum("value").alias("value"))
    return single.unionByName(whole.withColumn("type_name", F.lit(total)))


def parent_sum(daily: DataFrame, stations: DataFrame) -> DataFrame:
    """children's sums added for each parent, type and timestamp."""
    parents = stations.where("parent_code IS NOT NULL").select("station_code", "parent_code")
    return daily.join(parents, "station_code").groupBy(F.col("parent_code").alias("station_code"), "type_name", "ts").agg(F.sum("value").alias("value"))


# What a direction keeps of its lane's embedded metadata.
KEPT_METADATA = "autostrada string, iddirezione string, idspira string, metro string"


def combine_directions(stations: DataFrame) -> DataFrame:
    """One station for each direction of lane stations `road:id:lane`, from the lane with the smallest code.

    Lanes may have origin and metadata (JSON): the direction has the lane's origin, and of its metadata the embedded
    a22_metadata object with KEPT_METADATA, NULL where there is none.
    """
    for c in ("origin", "metadata"):
        if c not in stations.columns:
            stations = stations.withColumn(c, F.lit(None).cast("string"))
    inner = F.from_json(F.get_json_object("metadata", "$.a22_metadata"), KEPT_METADATA, {"mode": "PERMISSIVE"})
    s = stations.withColumns({"road_id": F.substring_index("station_code", ":", 2), "direction": F.lower(F.coalesce(F.nullif(direction_of(F.col("name")), F.lit("")), lane_direction(F.substring_index("station_code", ":", -1))))})
    one = s.groupBy("road_id", "direction").agg(F.min_by(F.struct("name", "x", "y", "origin", "metadata"), "station_code").alias("f"))
    one = one.select(F.concat_ws(":", "road_id", "direction").alias("station_code"), name_without_lane(F.col("f.name")).alias("name"), "f.x", "f.y", "f.origin", "f.metadata", F.col("road_id").alias("parent_code"))
    filled = F.struct(*(F.coalesce(inner[c.split()[0]], F.lit("")).alias(c.split()[0]) for c in KEPT_METADATA.split(", ")))
    return one.withColumn("metadata", F.when(inner.isNotNull(), F.to_json(F.struct(filled.alias("a22_metadata")))))


def common_prefix(names: Column) -> Column:
    """The longest prefix of all strings of a sorted array: that of its first and last one."""
    a, b = F.element_at(names, 1), F.element_at(names, -1)
    n = F.least(F.length(a), F.length(b))
    same = F.filter(F.sequence(F.lit(0), n), lambda i: F.substr(a, F.lit(1), i) == F.substr(b, F.lit(1), i))
    return F.substr(a, F.lit(1), F.array_max(same))


def combine_locations(directions: DataFrame) -> DataFrame:
    """A10: one station for each parent of directions: mean coordinates, longest common prefix of the names without blanks at its end, origin of the smallest code."""
    if "origin" not in directions.columns:
        directions = directions.withColumn("origin", F.lit(None).cast("string"))
    each = directions.groupBy(F.col("parent_code").alias("location")).agg(F.avg("x").alias("x"), F.avg("y").alias("y"), F.min("name").alias("lo"), F.max("name").alias("hi"), F.min_by("origin", "station_code").alias("origin"))
    return each.select(F.col("location").alias("station_code"), F.rtrim(common_prefix(F.array("lo", "hi"))).alias("name"), "x", "y", "origin")


def check_daily_totals(m: DataFrame, light: str, heavy: str, buses: str, total: str, equivalent: str) -> DataFrame:
    """Station days with all five types whose total or equivalent doesn't follow from the classes."""
    wide = m.where(F.col("type_name").isin(light, heavy, buses, total, equivalent)).groupBy("station_code", "ts").pivot("type_name", [light, heavy, buses, total, equivalent]).agg(F.sum("value"))
    c = {n: F.col(f"`{n}`") for n in (light, heavy, buses, total, equivalent)}
    off = (c[light] + c[heavy] + c[buses] != c[total]) | (c[light] + 2.5 * c[heavy] + 2.5 * c[buses] != c[equivalent])
    return wide.where(off)


def profile_dataset(df: DataFrame, provider: str, licence: str) -> DataFrame:
    """Sorted distinct providers (an array or a scalar; missing: Unknown) and licences, and the number of rows."""
    kind = dict(df.dtypes)[provider]
    each = F.col(provider) if kind.startswith("array") else F.array(provider)
    missing = each.isNull() | (F.size(F.filter(each, lambda x: x.isNotNull())) == 0)
    named = df.select(F.when(missing, F.array(F.lit("Unknown"))).otherwise(each).alias("p"), F.col(licence).alias("l"))
    return named.agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("p")))).alias("providers"),
        F.array_sort(F.collect_set("l")).alias("licences"),
        F.count(F.lit(1)).alias("records"),
    )


def distinct_periods(m: DataFrame) -> DataFrame:
    """A34."""
    return m.select("period").distinct()


def first_base(m: DataFrame) -> DataFrame:
    """The earliest timestamp of each station and type."""
    return m.groupBy("station_code", "type_name").agg(F.min("ts").alias("ts"))


def recompute_from(m: DataFrame, out: DataFrame, floor: Column) -> DataFrame:
    """station_code and start: the latest of the first data day, the last output day less one, and floor."""
    first = m.groupBy("station_code").agg(F.date_trunc("day", F.min("ts")).alias("first"))
    done = out.groupBy("station_code").agg((F.date_trunc("day", F.max("ts")) - F.make_dt_interval(days=F.lit(1))).alias("done"))
    return first.join(done, "station_code", "left").select("station_code", F.greatest("first", "done", floor).alias("start"))


def pending_windows(m: DataFrame, base_period: int, agg_period: int, key: Sequence[str] = ("station_code", "type_name")) -> DataFrame:
    """From and to of series whose last aggregate is more than agg_period behind their last base row.

    From the last aggregate, or, without one, the first base row of the station (of all its types), to the midnight of
    the last base row; windows that would be empty are left out.
    """
    base, agg = F.col("period") == base_period, F.col("period") == agg_period
    each = m.groupBy(*key).agg(F.min(F.when(base, F.col("ts"))).alias("first"), F.max(F.when(base, F.col("ts"))).alias("last"), F.max(F.when(agg, F.col("ts"))).alias("done"))
    begins = each.groupBy(key[0]).agg(F.min("first").alias("begin"))
    out = each.where("last IS NOT NULL").where(F.col("done").isNull() | (gap_s("last", "done") > agg_period)).join(begins, key[0])
    out = out.select(*key, F.coalesce("done", "begin").alias("from_ts"), F.date_trunc("day", "last").alias("to_ts"))
    return out.where("from_ts < to_ts")


def pending_parent_windows(m: DataFrame, stations: DataFrame) -> DataFrame:
    """For each parent and type with newer children: from its own last row (or the oldest child's) to the newest child's."""
    own = m.groupBy("station_code", "type_name").agg(F.max("ts").alias("done"))
    kids = m.join(stations.where("parent_code IS NOT NULL").select("station_code", "parent_code"), "station_code")
    kids = kids.groupBy(F.col("parent_code").alias("station_code"), "type_name").agg(F.min("ts").alias("first"), F.max("ts").alias("to_ts"))
    return kids.join(own, ["station_code", "type_name"], "left").select("station_code", "type_name", F.coalesce("done", "first").alias("from_ts"), "to_ts").where("to_ts > from_ts")


