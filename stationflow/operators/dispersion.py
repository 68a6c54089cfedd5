"""Inputs and outputs of dispersion runs: stability, surface layer, concentrations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import concentration_band, finite, mean_angle, mixing_height, monin_obukhov, net_radiation, pg_stability

# Von Karman constant, gravity, heat capacity, air density, Bowen ratio.
KARMAN, GRAVITY, HEAT, DENSITY, BOWEN = 0.4, 9.81, 1004.0, 1.29, 0.8


def hourly_meteo(m: DataFrame) -> DataFrame:
    """Hourly means of radiation, wind, temperature and humidity of each weather station, and the earliest timestamp."""
    return m.groupBy("station_code", F.date_trunc("hour", "ts").alias("hour")).agg(
        F.min("ts").alias("ts"),
        F.bround(F.avg("radiation"), 1).alias("radiation"),
        F.bround(F.avg("wind_speed"), 1).alias("wind_speed"),
        F.bround(mean_angle(F.col("wind_direction")), 2).alias("wind_direction"),
        F.bround(F.avg("temperature"), 2).alias("temperature"),
        F.bround(F.avg("humidity"), 1).alias("humidity"),
    )


def stability_params(df: DataFrame, missing_radiation: str = "night") -> DataFrame:
    """Stability class, mixing height and Monin-Obukhov length."""
    out = df.withColumn("stability", pg_stability(F.col("radiation"), F.col("wind_speed"), F.col("ts"), missing_radiation))
    return out.withColumns({"mixing_height": mixing_height(F.col("stability")), "mol": monin_obukhov(F.col("stability"))})


def surface_layer(df: DataFrame) -> DataFrame:
    """P25: net radiation, sensible heat, friction and convective velocity, mechanical mixing height of rows with stability_params."""
    third = F.lit(1.0 / 3.0)
    kelvin = F.col("temperature") + 273.15
    out = df.withColumn("net_radiation", F.bround(net_radiation(F.col("radiation"), F.col("ts")), 1))
    out = out.withColumn("heat", F.bround(0.9 * F.col("net_radiation") / (1 + 1 / BOWEN), 1))
    out = out.withColumn("ustar", F.bround(F.pow(F.abs(-(KARMAN * GRAVITY * F.col("heat") * F.col("mol")) / (HEAT * DENSITY * kelvin)), third), 3))
    free = F.pow(F.abs(GRAVITY * F.col("heat") * F.col("mixing_height") / (HEAT * DENSITY * kelvin)), third)
    free = F.when(F.col("mixing_height") > 0, free).otherwise(0.0)
    out = out.withColumn("wstar", F.bround(F.when(F.col("heat") >= 0, free).otherwise(-free), 3))
    return out.withColumn("mechanical_height", F.bround(F.greatest(F.lit(50.0), 2400 * F.pow("ustar", F.lit(1.5))), 0))


def dispersion_inputs(emis: DataFrame, meteo: DataFrame, domains: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Emissions and weather rows of each domain (domain_id, traffic_station, weather_station), and the domains that lack either."""
    e = domains.join(emis.withColumnRenamed("station_code", "traffic_station"), "traffic_station")
    w = meteo.withColumnsRenamed({"station_code": "weather_station", "ts": "weather_ts"})
    both = e.join(w, (e.weather_station == w.weather_station) & (F.date_trunc("hour", e.ts) == F.date_trunc("hour", w.weather_ts))).drop(w.weather_station)
    return both, domains.join(both.select("domain_id").distinct(), "domain_id", "left_anti")


def scale_concentration(conc: DataFrame, emis: DataFrame) -> DataFrame:
    """Unit concentrations times the sum of emissions of their domain and time, per second and in grams; NaN and infinities are NULL."""
    total = emis.groupBy("domain_id", "ts").agg(F.sum("value").alias("_e"))
    return conc.join(total, ["domain_id", "ts"], "left").withColumn("value", finite(F.col("value") * F.col("_e") / 3600 / 1000)).drop("_e")


def banded(conc: DataFrame) -> DataFrame:
    """The band that each concentration reaches."""
    return conc.withColumn("band", concentration_band(F.col("value")))


def poi_values(grid: DataFrame, poi: DataFrame, x0: float, y0: float, dx: float, dy: float) -> DataFrame:
    """For points (poi_id, x, y) the value of the cell of the grid (x, y: its corner) that they lie in."""
    cell = lambda c, o, d: F.floor((F.col(c) - o) / d)
    g = grid.withColumns({"_i": cell("x", x0 - dx / 2, dx), "_j": cell("y", y0 - dy / 2, dy)}).drop("x", "y")
    return poi.withColumns({"_i": cell("x", x0, dx), "_j": cell("y", y0, dy)}).join(g, ["_i", "_j"]).drop("_i", "_j")


def daily_concentration(conc: DataFrame, met: DataFrame) -> DataFrame:
    """Daily means over hours with valid weather (ustar above 0, heat not -999) of each receptor, and their number; -99 without any."""
    ok = (F.col("ustar") > 0) & (F.col("heat") != -999)
    rows = conc.join(met.select("ts", "ustar", "heat"), "ts", "left").withColumn("_ok", F.coalesce(ok, F.lit(False)))
    return rows.groupBy("receptor", F.to_date("ts").alias("date")).agg(F.coalesce(F.avg(F.when(F.col("_ok"), F.col("value"))), F.lit(-99.0)).alias("value"), F.count_if("_ok").alias("hours"))
