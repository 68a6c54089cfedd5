"""Traffic emissions: fleet and coefficient joins, factors, sums, ratings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import copert_factor, emission_impact, signed_slope, vehicle_class

CLASSES = ("LIGHT_VEHICLES", "HEAVY_VEHICLES", "BUSES")


def with_km(df: DataFrame, km: DataFrame) -> DataFrame:
    """KM of the table km (Station, km) by station, or else the row's own."""
    k = km.select(F.col("Station").alias("_s"), F.col("km").alias("_km"))
    return df.join(k, df.Station == k["_s"], "left").withColumn("KM", F.coalesce("_km", "KM")).drop("_s", "_km")


def with_slope(df: DataFrame, geometry: DataFrame, sloped: Sequence[str]) -> DataFrame:
    """RoadSlope at the rounded km, as the lane drives it; NULL for categories that aren't in sloped."""
    g = geometry.select(F.col("KM").cast("double").alias("_km"), F.col("RoadSlope").alias("_slope"))
    out = df.join(g, F.bround(df.KM.cast("double"), 0) == g["_km"], "left")
    return out.withColumn("RoadSlope", signed_slope(F.col("_slope"), F.col("Lane"), F.col("Category").isin(list(sloped)))).drop("_km", "_slope")


def with_fleet(df: DataFrame, fleet: DataFrame) -> DataFrame:
    """A row for each fuel and Euro class of the category, with its part of the transits.

    A fleet has a row for each class, and categories are so few that a shuffle by them would make a task of each: it is broadcast.
    """
    f = fleet.select("Category", "Fuel", "ID_Euro", F.col("PercvsADT").alias("_share"))
    return df.join(F.broadcast(f), "Category").withColumn("Transits", F.col("Transits") * F.col("_share")).drop("_share")


def with_coefficients(df: DataFrame, coefficients: DataFrame) -> DataFrame:
    """Coefficients by location, category, fuel, Euro class and slope; a NULL slope meets a NULL slope. They are broadcast, as the fleet is."""
    keys = ["Location", "Category", "Fuel", "ID_Euro", "RoadSlope"]
    c = coefficients.withColumnsRenamed({k: f"_c_{k}" for k in keys})
    test = None
    for k in keys:
        one = df[k].eqNullSafe(c[f"_c_{k}"]) if k == "RoadSlope" else df[k] == c[f"_c_{k}"]
        test = one if test is None else test & one
    return df.join(F.broadcast(c), test).drop(*(f"_c_{k}" for k in keys))


def emissions(df: DataFrame) -> DataFrame:
    """Factor EF and emission E of rows with Speed, Transits and coefficients."""
    names = ["MinSpeed", "MaxSpeed", "Alpha", "Beta", "Gamma", "Delta", "Epsilon", "Zita", "Hta", "EuroReductionFactor", "FuelReductionFactor"]
    return df.withColumn("EF", copert_factor(F.col("Speed"), *(F.col(n) for n in names))).withColumn("E", F.col("EF") * F.col("Transits"))


# The keys that emissions are added up by.
AGGREGATED = ["date", "time", "Location", "Station", "Lane", "Category", "Pollutant", "Period", "KM"]


def aggregate_emissions(df: DataFrame, keys: Sequence[str] = AGGREGATED) -> DataFrame:
    """Transits (rounded half to even) and emissions of each key."""
    return df.groupBy(*keys).agg(F.bround(F.sum("Transits"), 0).cast("long").alias("Transits"), F.sum("E").alias("E"))


def only_validated(traffic: DataFrame, validation: DataFrame) -> DataFrame:
    """Rows of stations and times whose validation is 1."""
    return traffic.join(validation.where("value = 1").select("station_code", "ts"), ["station_code", "ts"], "left_semi")


def sum_emissions(m: DataFrame) -> DataFrame:
    """Sums over vehicle types by station, time and pollutant (the second part of the type's name), and a row of its impact as string_value."""
    sums = m.groupBy("station_code", "ts", F.get(F.split("type_name", "-"), F.lit(1)).alias("pollutant")).agg(F.sum("value").alias("value"))
    total = sums.select("station_code", "ts", F.concat("pollutant", F.lit("-emissions")).alias("type_name"), "value", F.lit(None).cast("string").alias("string_value"))
    impact = sums.select("station_code", "ts", F.concat("pollutant", F.lit("-emissions-impact")).alias("type_name"), F.lit(None).cast("double").alias("value"), emission_impact(F.col("pollutant"), F.col("value")).alias("string_value"))
    return total.unionByName(impact)


def rate_emission_impact(df: DataFrame) -> DataFrame:
    """Impact of rows of pollutant and value."""
    return df.withColumn("impact", emission_impact(F.col("pollutant"), F.col("value")))


def traffic_entries(m: DataFrame) -> DataFrame:
    """A row for each station, time and vehicle class with nr_of_vehicles and average_speed; of several measures the one that was created first."""
    kind = F.when(F.lower("type_name").startswith("nr."), "count").when(F.lower("type_name").contains("speed"), "speed")
    rows = m.withColumns({"vehicle_class": vehicle_class(F.col("type_name")), "kind": kind}).where("vehicle_class IS NOT NULL AND kind IS NOT NULL")
    first = lambda k: F.min_by(F.when(F.col("kind") == k, F.col("value")), F.when(F.col("kind") == k, F.struct("created_on", "value")))
    return rows.groupBy("station_code", "ts", "vehicle_class").agg(first("count").alias("nr_of_vehicles"), first("speed").alias("average_speed"))


def weather_entries(m: DataFrame, types: Sequence[str]) -> DataFrame:
    """A row for each station and time, a column for each type with the value that was created last."""
    return m.groupBy("station_code", "ts").pivot("type_name", list(types)).agg(F.max_by("value", F.struct("created_on", "value")))


def emission_pivot(df: DataFrame) -> DataFrame:
    """Sums by vehicle class of each time, station and pollutant, 0 where there are none."""
    names = [c.lower() for c in CLASSES]
    out = df.groupBy("ts", "station_code", "pollutant").pivot("vehicle_class", list(CLASSES)).agg(F.sum("value"))
    return out.withColumnsRenamed(dict(zip(CLASSES, names))).fillna(0.0, names)


def emissions_by_station(m: DataFrame) -> DataFrame:
    """Emissions of lanes (road:station:lane) added for each station, time, class and pollutant."""
    station = F.get(F.split("station_code", ":"), F.lit(1))
    return m.groupBy(station.alias("station"), "ts", "vehicle_class", "pollutant").agg(F.sum("value").alias("value"))
