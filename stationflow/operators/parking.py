"""Car parks: occupancy, calendar features, overlays, forecast documents and errors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import hour_slot, remaining
from .grids import floor_ts, interpolate_at, seconds


def _from_capacity(m: DataFrame, stations: DataFrame) -> DataFrame:
    single = F.col("station_type") == "ParkingSensor"
    capacity = F.when(single, 1.0).otherwise(F.expr("try_cast(get_json_object(metadata, '$.capacity') AS double)"))
    s = stations.select("station_code", capacity.alias("_capacity")).where("_capacity > 0")
    return m.join(s, "station_code").withColumn("value", remaining(F.col("_capacity"), F.col("value"))).drop("_capacity")


def occupied_to_free(m: DataFrame, stations: DataFrame) -> DataFrame:
    """P5: free places of occupied ones; stations without a positive capacity are left out, single sensors have 1."""
    return _from_capacity(m, stations)


def free_to_occupied(m: DataFrame, stations: DataFrame) -> DataFrame:
    """Occupied places of free ones, by the same rules."""
    return _from_capacity(m, stations)


def calendar_features(df: DataFrame, slots: int = 24) -> DataFrame:
    """Slot of the day, weekday (Monday 0), month."""
    return df.withColumns({"slot": hour_slot(F.col("ts"), slots), "weekday": F.weekday("ts"), "month": F.month("ts")})


def periodic_features(df: DataFrame) -> DataFrame:
    """Am, weekday, day of month, weekend, month, quarter."""
    return df.withColumns({"am": F.hour("ts") < 12, "weekday": F.weekday("ts"), "day": F.dayofmonth("ts"), "weekend": F.weekday("ts") >= 5, "month": F.month("ts"), "quarter": F.quarter("ts")})


def min_downsample(m: DataFrame, minutes: int = 60, key: Sequence[str] = ("station_code",)) -> DataFrame:
    """The least value of each step of so many minutes."""
    return m.groupBy(*key, floor_ts("ts", minutes * 60).alias("ts")).agg(F.min("value").alias("value"))


def hourly_precip(m: DataFrame) -> DataFrame:
    """Sums of hours."""
    return m.groupBy("station_code", F.date_trunc("hour", "ts").alias("ts")).agg(F.sum("value").alias("value"))


def dedupe_daily(df: DataFrame) -> DataFrame:
    """The code of each date that was updated last."""
    return df.groupBy("date").agg(F.max_by("code", F.struct("updated", "code")).alias("code"))


def overlay_days(df: DataFrame, days: DataFrame, as_bool: bool = False, name: str = "overlay") -> DataFrame:
    """Id of the day in days (date, id), 0 without; as_bool: whether there is one, as 0 or 1."""
    d = days.groupBy(F.col("date").alias("_d")).agg(F.min("id").alias("_id"))
    out = df.withColumn("_d", F.to_date("ts")).join(d, "_d", "left")
    value = F.when(F.col("_id").isNotNull(), 1).otherwise(0) if as_bool else F.coalesce("_id", F.lit(0))
    return out.withColumn(name, value).drop("_d", "_id")


def rain_flag(df: DataFrame, meteo: DataFrame, name: str = "rain") -> DataFrame:
    """1 if a code between 5 and 20 (both excluded) was observed in the row's hour or the one before, from 7 to 22 o'clock."""
    wet = meteo.where("code > 5 AND code < 20").select(F.date_trunc("hour", "ts").alias("_h"))
    wet = wet.unionByName(wet.select((F.col("_h") + F.make_dt_interval(hours=F.lit(1))).alias("_h"))).distinct().withColumn("_wet", F.lit(1))
    out = df.withColumn("_h", F.date_trunc("hour", "ts")).join(wet, "_h", "left")
    return out.withColumn(name, F.when(F.hour("ts").between(7, 22), F.coalesce("_wet", F.lit(0))).otherwise(0)).drop("_h", "_wet")


def forecast_at(fc: DataFrame, minutes: int, key: Sequence[str] = ("station_code",)) -> DataFrame:
    """Of each station the last step (start, end, value) that ends before so many minutes after its first start, else the first."""
    first = F.min("start").over(Window.partitionBy(*key))
    rows = fc.withColumn("_before", seconds("end") < seconds(first) + minutes * 60)
    pick = F.coalesce(F.max_by(F.struct("start", "end", "value"), F.when(F.col("_before"), F.col("end"))), F.min_by(F.struct("start", "end", "value"), "start"))
    return rows.groupBy(*key).agg(pick.alias("s")).select(*key, "s.*")


def forecast_of(fc: DataFrame, station: str) -> DataFrame:
    """All steps of one car park in order."""
    return fc.where(F.col("station_code") == station).orderBy("start")


def ensemble(preds: DataFrame) -> DataFrame:
    """Least, mean and greatest prediction of the models, to a tenth."""
    one = lambda f: F.bround(f("value"), 1)
    return preds.groupBy("station_code", "ts").agg(one(F.min).alias("lo"), one(F.avg).alias("mean"), one(F.max).alias("hi"))


def forecast_mae(pred: DataFrame, truth: DataFrame, max_gap_s: int = 14400) -> DataFrame:
    """Mean absolute error of predictions (station_code, ts, mean) at the times of truth (station_code, ts, value), its share of the greatest truth, and how many had no prediction."""
    at = interpolate_at(truth, pred, ["station_code"], value="mean", name="predicted", max_gap_s=max_gap_s)
    out = at.groupBy("station_code").agg(F.avg(F.abs(F.col("predicted") - F.col("value"))).alias("mae"), F.max(F.when(F.col("predicted").isNotNull(), F.col("value"))).alias("max_truth"), F.count_if(F.col("predicted").isNull()).alias("skipped"), F.count("predicted").alias("used"))
    return out.withColumn("mae_percent", F.try_divide(F.col("mae"), F.col("max_truth")) * 100)


def forecast_rmse(runs: DataFrame, truth: DataFrame, now: Column, start_of_day: str, newest_days: int = 2, oldest_days: int = 30) -> DataFrame:
    """Error of each step over runs (station_code, start, array mean; 300 s steps) of the last 30 to 2 days that began at the time of day.

    Runs with a missing truth or prediction are left out as a whole.
    """
    fits = (F.date_format("start", "HH:mm:ss") == start_of_day) & (F.col("start") >= now - F.make_dt_interval(days=F.lit(oldest_days))) & (F.col("start") <= now - F.make_dt_interval(days=F.lit(newest_days)))
    steps = runs.where(fits).select("station_code", "start", F.posexplode("mean").alias("step", "predicted"))
    steps = steps.withColumn("ts", F.timestamp_micros(F.unix_micros("start") + F.col("step").cast("long") * 300_000_000))
    both = steps.join(truth.select("station_code", "ts", "value"), ["station_code", "ts"], "left").withColumn("e2", F.pow(F.col("predicted") - F.col("value"), F.lit(2.0)))
    whole = both.groupBy("station_code", "start").agg(F.bool_and(F.col("e2").isNotNull()).alias("ok")).where("ok").drop("ok")
    return both.join(whole, ["station_code", "start"]).groupBy("station_code", "step").agg(F.sqrt(F.avg("e2")).alias("rmse"))


def forecast_document(fc: DataFrame, run: Sequence[str] = ("station_code",)) -> DataFrame:
    """One JSON document for each car park (and run, where fc has its columns): the columns of run and, in order, the steps {ts, lo, mean, hi, rmse}, NaN as null.

    A document holds one forecast; documents are rows, which Spark writes as lines of JSON in as many files as there are partitions.
    """
    step = F.struct(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("ts"), *(F.when(~F.isnan(c), F.col(c)).alias(c) for c in ("lo", "mean", "hi", "rmse")))
    each = fc.groupBy(*run).agg(F.array_sort(F.collect_list(step)).alias("timeseries"))
    return each.select(*run, F.to_json(F.struct(*run, "timeseries"), {"ignoreNullFields": "false"}).alias("document"))
