"""Stations and data sets: listings, states, metadata, task runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import municipality
from .grids import gap_s, seconds


def list_stations(stations: DataFrame, types: Sequence[str] | None = None, origin: str | None = None, active: bool | None = True) -> DataFrame:
    """Stations of the types and origin that are active, by code."""
    out = stations
    if types is not None:
        out = out.where(F.col("station_type").isin(list(types)))
    if origin is not None:
        out = out.where(F.col("origin") == origin)
    if active is not None:
        out = out.where(F.col("active") == active)
    return out.orderBy("station_code")


def active_stations(stations: DataFrame, m: DataFrame, rules: DataFrame, now: Column) -> DataFrame:
    """U8: stations with active set: whether their newest value of the type of their rule (station_type, type_name, max_age_s) is younger than it allows.

    Stations of types without a rule stay as they are.
    """
    r = rules.select(F.col("station_type").alias("_type"), F.col("type_name").alias("_name"), F.col("max_age_s").alias("_age"))
    ruled = stations.join(r, stations.station_type == r["_type"], "left")
    newest = m.groupBy(F.col("station_code").alias("_code"), F.col("type_name").alias("_n")).agg(F.max("ts").alias("_ts"))
    out = ruled.join(newest, (ruled.station_code == newest["_code"]) & (ruled["_name"] == newest["_n"]), "left")
    fresh = F.coalesce(gap_s(now, "_ts") < F.col("_age"), F.lit(False))
    flagged = out.withColumn("_fresh", F.when(F.col("_type").isNull(), F.col("active")).otherwise(fresh))
    each = flagged.groupBy("station_code").agg(F.bool_or("_fresh").alias("_active"))
    return stations.drop("active").join(each, "station_code").withColumnRenamed("_active", "active").select(*stations.columns)


def upsert_stations(old: DataFrame, new: DataFrame) -> DataFrame:
    """All stations of both; the new values where they aren't NULL."""
    b = new.withColumnsRenamed({c: f"_n_{c}" for c in new.columns})
    out = old.join(b, old.station_code == b["_n_station_code"], "full")
    return out.select(*(F.coalesce(f"_n_{c}", old[c]).alias(c) if c in new.columns else old[c] for c in old.columns))


def new_stations(listing: DataFrame, known: DataFrame) -> DataFrame:
    """Listed stations that aren't known."""
    return listing.join(known.select("station_code"), "station_code", "left_anti")


def merge_profile(meta: DataFrame, profile: DataFrame, last_sync: Column) -> DataFrame:
    """Metadata with the providers, licences and records of profile (dataset) where the data set changed after last_sync."""
    p = profile.select("dataset", *(F.col(c).alias(f"_{c}") for c in ("providers", "licences", "records")))
    out = meta.join(p, "dataset", "left")
    changed = F.coalesce(F.col("last_update") > last_sync, F.lit(False)) & F.col("_records").isNotNull()
    return out.withColumns({c: F.when(changed, F.col(f"_{c}")).otherwise(F.col(c)) for c in ("providers", "licences", "records")}).drop("_providers", "_licences", "_records")


def run_summary(runs: DataFrame) -> DataFrame:
    """Of each task the last run's start, duration in seconds and status, and the seconds from the end of the last run of another status to it."""
    w = Window.partitionBy("task").orderBy(F.col("start").desc())
    out = runs.withColumns({"_n": F.row_number().over(w), "_status": F.first("status").over(w)})
    return out.groupBy("task").agg(
        F.max("start").alias("last_start"),
        F.max(F.when(F.col("_n") == 1, gap_s("end", "start"))).alias("duration_s"),
        F.max(F.when(F.col("_n") == 1, F.col("status"))).alias("status"),
        (F.max(seconds("end")) - F.max(F.when(F.col("status") != F.col("_status"), seconds("end")))).alias("since_other_s"),
    )


def municipalities(df: DataFrame) -> DataFrame:
    """The place name of address rows with city, town, village, hamlet."""
    return df.withColumn("municipality", municipality(F.col("city"), F.col("town"), F.col("village"), F.col("hamlet")))


def holiday_calendar(events: DataFrame, first: Column, last: Column) -> DataFrame:
    """Days from first to last: is_school (a school holiday or a weekend) and is_holiday (a public one or a Sunday), from events (kind, begin, end)."""
    day = F.make_dt_interval(days=F.lit(1))
    days = events.sparkSession.range(1).select(F.explode(F.sequence(first.cast("date"), last.cast("date"), day)).alias("date"))
    each = events.select("kind", F.explode(F.sequence(F.col("begin").cast("date"), F.col("end").cast("date"), day)).alias("date"))
    flags = each.groupBy("date").agg(F.bool_or(F.col("kind") == "school").alias("s"), F.bool_or(F.col("kind") == "holiday").alias("h"))
    out = days.join(flags, "date", "left")
    return out.select("date", (F.coalesce("s", F.lit(False)) | (F.weekday("date") >= 5)).cast("int").alias("is_school"), (F.coalesce("h", F.lit(False)) | (F.weekday("date") == 6)).cast("int").alias("is_holiday"))
