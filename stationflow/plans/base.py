"""How queries are registered, and the tables that they take their measurements from."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# events as measurements: a user is a station, an event's kind is a type
M = "m AS (SELECT CAST(user_id AS VARCHAR) AS station_code, event_type AS type_name, ts, value, event_id FROM events)"


def query(sql: str | None = None) -> Callable:
    """Registers a query under its function's name; sql (after WITH m AS ...) gives the same rows."""

    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")  # timestamps of the tables have no zone
            return f(spark, sf_dir)

        run.__name__, run.__doc__ = f.__name__, f.__doc__
        QUERIES[f.__name__] = run
        if sql:
            ORACLES[f.__name__] = f"WITH {M}\n{sql}" if not sql.lstrip().startswith(",") else f"WITH {M}{sql}"
        return run

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(F.col("user_id").cast("string").alias("station_code"), F.col("event_type").alias("type_name"), F.col("ts").cast("timestamp").alias("ts"), "value", F.lit(3600).alias("period"), "event_id", F.col("ts").cast("timestamp").alias("created_on"))


def epoch(c: Column | str, name: str = "ts") -> Column:
    return F.unix_seconds((F.col(c) if isinstance(c, str) else c).cast("timestamp")).alias(name)


def r6(c: Column | str, name: str) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6).alias(name)
