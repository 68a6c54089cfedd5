"""Latest values, change sets and purges of the measurement store."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schema import KEY


def where_measurements(m: DataFrame, **conditions) -> DataFrame:
    """Rows that meet all conditions. A list means one of; a name with `metadata__a__b` reaches into the JSON column metadata."""
    for name, wanted in conditions.items():
        column, *path = name.split("__")
        c = F.get_json_object(column, "$." + ".".join(path)) if path else F.col(column)
        m = m.where(c.isin(list(wanted)) if isinstance(wanted, (list, tuple, set)) else c.eqNullSafe(F.lit(wanted)))
    return m


def latest(m: DataFrame, key: Sequence[str] = KEY, since: Column | None = None) -> DataFrame:
    """The newest row of each series; of equal timestamps the lowest value, NULL last."""
    if since is not None:
        m = m.where(F.col("ts") >= since)
    w = Window.partitionBy(*key).orderBy(F.col("ts").desc(), F.col("value").asc_nulls_last())
    return m.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def earliest(m: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """L2: the oldest row of each series."""
    w = Window.partitionBy(*key).orderBy(F.col("ts").asc(), F.col("value").asc_nulls_last())
    return m.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def limit_per_series(df: DataFrame, n: int, key: Sequence[str] = KEY, order: str = "ts") -> DataFrame:
    """L1: the first n rows of each series by time."""
    w = Window.partitionBy(*key).orderBy(order)
    return df.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= n).drop("_n")


def usable_stations(m: DataFrame, now: Column, min_points: int = 10, max_age_days: int = 7) -> DataFrame:
    """Stations with more than min_points points of which the newest is at most max_age_days old."""
    each = m.groupBy("station_code").agg(F.count(F.lit(1)).alias("points"), F.max("ts").alias("newest"))
    return each.where((F.col("points") > min_points) & (F.col("newest") >= now - F.make_dt_interval(days=F.lit(max_age_days))))


def change_set(new: DataFrame, old: DataFrame, lo: Column, hi: Column, key: Sequence[str] = KEY, ext_key: bool = False, eps: float = 0.0, reference_updates: bool = False) -> DataFrame:
    """Rows of key, ts, value and op (insert, update, delete) that turn old into new within [lo, hi].

    A timestamp that old doesn't have is inserted, one whose value differs by more than eps (or by being NULL) is
    updated, one that new lacks is deleted. ext_key compares timestamp and value together, so nothing is updated;
    reference_updates leaves updates out. Rows of new with another key than old's, or outside of [lo - 1 minute,
    hi + 1 minute], fail when they are computed.
    """
    minute = F.make_dt_interval(mins=F.lit(1))
    fits = (F.col("ts") >= lo - minute) & (F.col("ts") <= hi + minute)
    new = new.select(*key, "ts", F.when(fits, F.col("value")).otherwise(F.raise_error(F.lit("a row lies outside of the recomputed range")).cast("double")).alias("new_value"))
    on = [*key, "ts"]
    old = old.where((F.col("ts") >= lo) & (F.col("ts") <= hi)).select(*on, F.col("value").alias("old_value"))
    new, old = new.withColumn("_new", F.lit(True)), old.withColumn("_old", F.lit(True))
    if ext_key:
        a, b = new.withColumnRenamed("new_value", "value"), old.withColumnRenamed("old_value", "value")
        on = [*on, "value"]
        both = null_safe_join(a, b, on, "full")
        op = F.when(F.col("_old").isNull(), "insert").when(F.col("_new").isNull(), "delete")
        return both.withColumn("op", op).where("op IS NOT NULL").select(*on, "op")
    both = null_safe_join(new, old, on, "full")
    differs = (F.abs(F.col("new_value") - F.col("old_value")) > eps) | (F.col("new_value").isNull() != F.col("old_value").isNull())
    op = F.when(F.col("_old").isNull(), "insert").when(F.col("_new").isNull(), "delete")
    if not reference_updates:
        op = op.when(differs, "update")
    return both.withColumn("op", op).where("op IS NOT NULL").select(*on, F.when(F.col("op") == "delete", F.col("old_value")).otherwise(F.col("new_value")).alias("value"), "op")


def null_safe_join(a: DataFrame, b: DataFrame, on: Sequence[str], how: str) -> DataFrame:
    """Equi-join on columns of the same name in which NULL equals NULL; the columns are there once."""
    b = b.withColumnsRenamed({c: f"_r_{c}" for c in on})
    test = None
    for c in on:
        one = a[c].eqNullSafe(b[f"_r_{c}"])
        test = one if test is None else test & one
    return a.join(b, test, how).withColumns({c: F.coalesce(a[c], b[f"_r_{c}"]) for c in on}).drop(*(f"_r_{c}" for c in on))


def apply_changes(old: DataFrame, changes: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Old after the changes, as key, ts and value."""
    on = [*key, "ts"]
    kept = old.select(*on, "value").join(changes.select(*on), on, "left_anti")
    return kept.unionByName(changes.where("op <> 'delete'").select(*on, "value"))


def diff_latest(new: DataFrame, old: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """All keys of either side with both timestamps and values."""
    a = new.select(*key, F.col("ts").alias("new_ts"), F.col("value").alias("new_value"))
    b = old.select(*key, F.col("ts").alias("old_ts"), F.col("value").alias("old_value"))
    return a.join(b, list(key), "full")


def refresh_latest(cache: DataFrame, m: DataFrame, key: Sequence[str] = KEY, since: Column | None = None) -> DataFrame:
    """The cache after an upsert of the latest rows of m, with op (insert, update, keep); nothing is deleted."""
    d = diff_latest(latest(m, key, since), cache, key)
    there = F.col("new_ts").isNotNull()
    changed = there & (~F.col("new_ts").eqNullSafe(F.col("old_ts")) | ~F.col("new_value").eqNullSafe(F.col("old_value")))
    op = F.when(F.col("old_ts").isNull() & there, "insert").when(changed, "update").otherwise("keep")
    take = lambda c: F.when(there, F.col(f"new_{c}")).otherwise(F.col(f"old_{c}")).alias(c)
    return d.select(*key, take("ts"), take("value"), op.alias("op"))


def purge_series(m: DataFrame, selector: Column, since: Column | None = None, key: Sequence[str] = KEY) -> tuple[DataFrame, DataFrame]:
    """The history without selected rows from since on (all of them without it), and the latest rows of what is left."""
    gone = selector if since is None else selector & (F.col("ts") >= since)
    left = m.where(~F.coalesce(gone, F.lit(False)))
    return left, latest(left, key)


def reset_latest(cache: DataFrame, selector: Column, ts: Column) -> DataFrame:
    """Selected timestamps after the cut-off are set to it."""
    return cache.withColumn("ts", F.when(F.coalesce(selector, F.lit(False)) & (F.col("ts") > ts), ts).otherwise(F.col("ts")))


def union_types(*frames: DataFrame) -> DataFrame:
    """Rows of all frames; columns that one lacks are NULL."""
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out
