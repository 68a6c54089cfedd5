"""Air quality: ratings, calibration of raw sensors, sensor histories."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import finite, no2_rating

# Type names, in the order of the calibration's conditions.
NO2, NO, O3, CO, PM10, PM25, RH, T = "NO2-Alphasense", "NO-Alphasense", "O3", "CO", "PM10", "PM2.5", "RH", "temperature-internal"
HOT = 35.0


def no2_inputs(m: DataFrame, types: Sequence[str], origins: Sequence[str], period: int = 3600) -> DataFrame:
    """Rows of the given types and origins with the period."""
    return m.where(F.col("type_name").isin(list(types)) & F.col("origin").isin(list(origins)) & (F.col("period") == period))


def rate_no2(m: DataFrame) -> DataFrame:
    """Ratings as string_value; rows whose value is negative or missing are dropped."""
    return m.withColumn("string_value", no2_rating(F.col("value"))).where("string_value IS NOT NULL")


def widen(m: DataFrame, types: Sequence[str], key: Sequence[str] = ("station_code", "ts")) -> DataFrame:
    """One row for each time, one column for each type (its last value by created_on)."""
    order = F.struct("created_on", "value") if "created_on" in m.columns else F.col("value")
    return m.groupBy(*key).pivot("type_name", list(types)).agg(F.max_by("value", order))


def attach_sensor(m: DataFrame, history: DataFrame) -> DataFrame:
    """Rows with the sensor_id that was at their station then.

    history: station_code and an array history of struct<id, start, end>. A row belongs to the first entry whose end is
    at or after it; it is dropped if that begins later or has no id, or if there is no such entry. Entries become
    ranges of ends that don't overlap, so each row meets one of them.
    """
    each = history.select("station_code", F.posexplode("history").alias("i", "h")).select("station_code", "i", F.nullif(F.col("h.id"), F.lit("")).alias("sensor_id"), F.col("h.start").cast("timestamp").alias("start"), F.coalesce(F.nullif(F.col("h.end").cast("string"), F.lit("")).cast("timestamp"), F.lit("9999-12-31").cast("timestamp")).alias("end"))
    w = Window.partitionBy("station_code").orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    each = each.withColumn("after", F.max("end").over(w)).where("after IS NULL OR end > after")
    h = each.withColumnRenamed("station_code", "_s")
    inside = (m.station_code == F.col("_s")) & (m.ts <= F.col("end")) & (F.col("after").isNull() | (m.ts > F.col("after")))
    return m.join(h, inside).where("sensor_id IS NOT NULL AND start <= ts").select(m["*"], "sensor_id")


def calibrate(wide: DataFrame, params: DataFrame, key: Sequence[str] = ("station_code", "ts", "sensor_id")) -> DataFrame:
    """Processed values of raw ones: key, type_name (with `_processed`) and value.

    wide: key and a column for each type. params: sensor_id, type_name, temperature (`hightemp` from 35 degrees on, else
    `lowtemp`), calc_version and a to f. A type is calibrated if its companions are there (and, for particles, unless it
    is hot with PM10 above 100, or cooler with a humidity above 97); values that aren't numbers are dropped, negative
    ones become 0.
    """
    types = [t for t in (NO2, NO, PM10, PM25, O3, CO) if t in wide.columns]
    c = lambda name: F.col(f"`{name}`") if name in wide.columns else F.lit(None).cast("double")
    rows = wide.where(c(T).isNotNull())
    each = F.array(*(F.struct(F.lit(t).alias("t"), c(t).cast("double").alias("v")) for t in types))
    long = rows.select("*", F.explode(each).alias("_raw")).where("_raw.v IS NOT NULL").withColumns({"_t": F.col("_raw.t"), "_v": F.col("_raw.v"), "_hot": F.when(c(T) >= HOT, "hightemp").otherwise("lowtemp")})
    p = params.select(F.col("sensor_id").alias("_sensor"), F.col("type_name").alias("_type"), F.col("temperature").alias("_temp"), F.col("calc_version").cast("int").alias("_ver"), *(F.col(x).cast("double").alias(f"_{x}") for x in "abcdef"))
    joined = long.join(p, (long.sensor_id == p["_sensor"]) & (long["_t"] == p["_type"]) & (long["_hot"] == p["_temp"]))
    k = {x: F.col(f"_{x}") for x in "abcdef"}
    v, t4 = F.col("_v"), F.pow(c(T), F.lit(4.0))
    ozone = F.when(F.col("_ver") == 1, F.pow(c(O3), F.lit(0.1))).otherwise(c(O3))
    nitrogen = k["a"] + k["b"] * v * v + k["c"] * v + k["d"] * ozone + k["e"] * t4
    dust = k["a"] + k["b"] * F.pow(v, F.lit(0.7)) + k["c"] * F.pow(c(RH), F.lit(0.75)) + k["d"] * F.pow(c(T), F.lit(0.3))
    dust_fits = ~((c(T) >= HOT) & (c(PM10) > 100)) & ~((c(T) < HOT) & (c(RH) > 97))
    o3 = k["a"] + k["b"] * F.pow(v, F.lit(0.44)) + k["c"] * F.pow(c(NO2), F.lit(0.58)) + k["d"] * F.pow(c(RH), F.lit(0.54)) + k["e"] * F.pow(c(T), F.lit(1.2))
    co = k["a"] + k["b"] * v + k["c"] * F.pow(c(T), F.lit(0.1)) + k["d"] * F.pow(c(RH), F.lit(0.1))
    type_ = F.col("_t")
    value = (
        F.when(type_.isin(NO2, NO), nitrogen)
        .when(type_.isin(PM10, PM25) & dust_fits & c(PM10).isNotNull(), dust)
        .when(type_ == O3, o3)
        .when(type_ == CO, co)
    )
    return joined.select(*key, F.concat("_t", F.lit("_processed")).alias("type_name"), F.greatest(finite(value), F.when(finite(value).isNotNull(), 0.0)).alias("value")).where("value IS NOT NULL")


def elaboration_state(m: DataFrame, processed: Column) -> DataFrame:
    """For each station the range to compute: from the least of its types' last processed rows (or first raw one) to the last raw row."""
    each = m.groupBy("station_code", "type_name").agg(F.max(F.when(processed, F.col("ts"))).alias("done"), F.max(F.when(~processed, F.col("ts"))).alias("raw"), F.min(F.when(~processed, F.col("ts"))).alias("first"))
    return each.groupBy("station_code").agg(F.coalesce(F.min("done"), F.min("first")).alias("start"), F.max("raw").alias("end"))
