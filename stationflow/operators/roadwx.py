"""Road weather: preparing observations and forecasts, blending them, reading back road forecasts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import missing_zero, not_negative, pressure_pa, road_condition, road_condition_label, water_mm, wind_ms
from .grids import gap_s

RELAX_S = 4 * 3600  # fixed value: time in which what an observation adds falls to 1/e


def clean_observation(df: DataFrame) -> DataFrame:
    """Rows (station_code, ts, prec_qta, stato_meteo, temp_aria, temp_rugiada, temp_suolo, vento_vel) with condition, confidence and missing values.

    The condition is read from the raw zeros, which are missing values afterwards.
    """
    out = df.withColumn("_rc", road_condition(F.col("stato_meteo"), F.col("temp_suolo"), F.col("temp_rugiada")))
    zeros = {c: missing_zero(F.col(c)) for c in ("temp_aria", "temp_rugiada", "temp_suolo", "vento_vel")}
    return out.withColumns(zeros | {"sc": F.col("_rc.code"), "confidence": F.col("_rc.confidence"), "pi": (F.col("prec_qta") > 0).cast("int")}).drop("_rc")


def overall_confidence(df: DataFrame, key: Sequence[str] = ("station_code",)) -> DataFrame:
    """0 if any row's confidence is 0, else 1."""
    return df.groupBy(*key).agg(F.min("confidence").alias("confidence"))


def clamp_radiation(df: DataFrame, columns: Sequence[str] = ("ir", "sf")) -> DataFrame:
    """Negative radiation as 0."""
    return df.withColumns({c: not_negative(F.col(c)) for c in columns})


def normalise_forecast(df: DataFrame) -> DataFrame:
    """Wind in m/s, pressure in Pa, water of rain and snow as qp."""
    return df.withColumns({"ws": wind_ms(F.col("ws")), "ap": pressure_pa(F.col("ap")), "qp": water_mm(F.col("ra"), F.col("sn"))})


def deaccumulate(fc: DataFrame, key: Sequence[str] = ("station_code",)) -> DataFrame:
    """What falls from each row to the next one (ra, sn, qp; not below 0) and its type pi: 1 rain, 2 snow.

    Totals below 0 are the series' largest one. A type follows the total that grew, else the sign of the temperature.
    """
    w = Window.partitionBy(*key).orderBy("ts")
    whole = Window.partitionBy(*key)
    out = fc.withColumns({c: F.when(F.col(c) < 0, F.max(c).over(whole)).otherwise(F.col(c)) for c in ("ra", "sn")})
    out = out.withColumn("qp", water_mm(F.col("ra"), F.col("sn")))
    step = {c: F.col(c) - F.lag(c, 1).over(w) for c in ("ra", "sn", "qp")}
    rain, snow = F.coalesce(step["ra"], F.lit(0.0)), F.coalesce(step["sn"], F.lit(0.0))
    kind = F.when(rain > 0, 1).when(snow > 0, 2).when(F.col("at") > 0, 1).otherwise(2)
    return out.withColumns({f"_d_{c}": F.greatest(F.coalesce(x, F.lit(0.0)), F.lit(0.0)) for c, x in step.items()} | {"pi": kind}).withColumns({c: F.col(f"_d_{c}") for c in step}).drop(*(f"_d_{c}" for c in step))


def sst_at_sun(df: DataFrame, sun: DataFrame) -> DataFrame:
    """Sub-surface temperature (sst) only in the rows at sunrise or sunset.

    sun: station_code, date, sunrise and sunset timestamps on the rows' grid; 06:00 and 20:00 where a day has no row.
    """
    s = sun.select("station_code", F.col("date").alias("_d"), F.col("sunrise"), F.col("sunset"))
    out = df.withColumn("_d", F.to_date("ts")).join(s, ["station_code", "_d"], "left")
    at = lambda h: F.date_trunc("day", "ts") + F.make_dt_interval(hours=F.lit(h))
    hit = (F.col("ts") == F.coalesce("sunrise", at(6))) | (F.col("ts") == F.coalesce("sunset", at(20)))
    return out.withColumn("sst", F.when(hit, F.col("sst"))).drop("_d", "sunrise", "sunset")


def blend_obs_forecast(obs: DataFrame, fc: DataFrame, key: Sequence[str] = ("station_code",)) -> DataFrame:
    """At, td and ws of forecast rows on a common grid: observations while they last, then relaxed to the forecast.

    obs: key, ts, at, td, ws and at_valid, td_valid, ws_valid. A column that has an invalid observation isn't blended.
    After the last observation the difference to the forecast there fades with a constant of four hours. Wind below
    the forecast rises to it by a factor instead, linear over four hours. Dew point stays below air temperature.
    """
    names = ("at", "td", "ws")
    ok = obs.groupBy(*key).agg(*(F.min(F.coalesce(F.col(f"{c}_valid"), F.lit(False)).cast("int")).alias(f"_ok_{c}") for c in names), F.max("ts").alias("_end"))
    o = obs.select(*key, "ts", *(F.col(c).alias(f"_o_{c}") for c in names))
    out = fc.join(o, [*key, "ts"], "left").join(ok, list(key), "left")
    whole = Window.partitionBy(*key)
    last = F.col("ts") == F.col("_end")
    out = out.withColumns({f"_lo_{c}": F.max(F.when(last, F.col(f"_o_{c}"))).over(whole) for c in names} | {f"_lf_{c}": F.max(F.when(last, F.col(c))).over(whole) for c in names})
    age = gap_s("ts", "_end")
    new = {}
    for c in names:
        difference = F.col(f"_lf_{c}") - F.col(f"_lo_{c}")
        faded = F.col(c) - F.exp(-age / RELAX_S) * difference
        if c == "ws":
            seen, told = F.when(F.col("_lo_ws") == 0, 1.0).otherwise(F.col("_lo_ws")), F.when(F.col("_lf_ws") < 0.01, 1.0).otherwise(F.col("_lf_ws"))
            factor = seen / told
            within = age < RELAX_S
            faded = F.when(~within, F.col(c)).when(F.col("_lo_ws") < F.col("_lf_ws"), F.col(c) * (factor + (1 - factor) * age / RELAX_S)).otherwise(faded)
        use = F.coalesce(F.col(f"_ok_{c}") == 1, F.lit(False))
        new[c] = F.when(use & (age <= 0), F.coalesce(F.col(f"_o_{c}"), F.col(c))).when(use & difference.isNotNull(), faded).otherwise(F.col(c))
    out = out.withColumns(new)
    drop = [f"{p}_{c}" for p in ("_o", "_lo", "_lf", "_ok") for c in names]
    return out.withColumn("td", F.least("td", "at")).drop(*drop, "_end")


def gate_precip(obs: DataFrame, fc: DataFrame, key: Sequence[str] = ("station_code",)) -> DataFrame:
    """Precipitation rate qp of the forecast times the observed flag pi, where there is an observation; sc of it, else 1."""
    o = obs.select(*key, "ts", F.col("pi").alias("_pi"), F.col("sc").alias("_sc"))
    return fc.join(o, [*key, "ts"], "left").withColumns({"qp": F.when(F.col("_pi").isNotNull(), F.col("qp") * F.col("_pi")).otherwise(F.col("qp")), "sc": F.coalesce(F.col("_sc"), F.lit(1))}).drop("_pi", "_sc")


def roadcast_entries(rc: DataFrame, last_obs: DataFrame, steps: int = 45) -> DataFrame:
    """Rows of the hours after a station's first forecast that lie after its last observation, typed forecast-60, forecast-120 and so on."""
    first = rc.groupBy("station_code").agg(F.min("ts").alias("_first"))
    hours = first.select("station_code", F.explode(F.sequence(F.lit(1), F.lit(steps))).alias("_h"), "_first")
    hours = hours.withColumn("ts", F.timestamp_micros(F.unix_micros("_first") + F.col("_h").cast("long") * 3_600_000_000))
    out = hours.join(rc, ["station_code", "ts"]).join(last_obs.select("station_code", F.col("ts").alias("_last")), "station_code", "left")
    out = out.where("_last IS NULL OR ts > _last")
    return out.withColumns({"type_name": F.concat(F.lit("forecast-"), (F.col("_h") * 60).cast("string")), "condition": road_condition_label(F.concat(F.lit("RC"), F.col("rc").cast("string")))}).drop("_h", "_first", "_last")


def subsample_roadcast(rc: DataFrame, minutes: int = 20, around: int = 10, key: Sequence[str] = ("station_code",)) -> DataFrame:
    """Rows at multiples of `minutes` with the most frequent condition from `around` minutes before to (not at) as many after; of equals the lowest, 0 not counted."""
    step, reach = minutes * 60, around * 60
    t = F.unix_seconds(F.col("ts").cast("timestamp"))
    # a row at t counts for grid points g with g - reach <= t < g + reach
    first, last = F.floor((t - reach) / step) + 1, F.floor((t + reach) / step)
    votes = rc.where("rc <> 0 AND rc IS NOT NULL").where(first <= last).select(*key, F.explode(F.sequence(first.cast("long"), last.cast("long"))).alias("_g"), F.bround("rc", 0).cast("int").alias("_code"))
    votes = votes.groupBy(*key, "_g", "_code").agg(F.count(F.lit(1)).alias("_n")).groupBy(*key, "_g").agg(F.min_by("_code", F.struct(-F.col("_n"), F.col("_code"))).alias("_top"))
    points = rc.withColumn("_g", (t / step).cast("long")).where(F.pmod(t, F.lit(step)) == 0)
    return points.join(votes, [*key, "_g"], "left").withColumn("rc", F.coalesce("_top", "rc")).drop("_g", "_top")


def round_columns(df: DataFrame, spec: dict[str, int]) -> DataFrame:
    """Columns rounded half to even to their digits."""
    return df.withColumns({c: F.bround(F.col(c), n) for c, n in spec.items()})
