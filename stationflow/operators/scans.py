"""Scans of series, whole or cut into buckets of time or blocks of rows, so that no task reads more of a series than one of them.

Without a bucket (bucket_s None) each series is one window's partition, which is right where there are many series and
a task can hold each of them: what comes before is evaluated once. With buckets a series may be of any length, and
what comes before is evaluated twice, for the buckets' summaries and for the rows.

What a bucket needs to know of others is one row, which travels through a small window over the buckets' summaries. It
is put among the bucket's rows and not joined to them, so that keys may be NULL and rows stay where they are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK_ROWS = 50_000


def bucketed(df: DataFrame, bucket_s: int, ts: str = "ts") -> DataFrame:
    """Adds _bucket, the number of the bucket of time that a row is in."""
    return df.withColumn("_bucket", F.floor(F.unix_micros(F.col(ts).cast("timestamp")) / (bucket_s * 1_000_000)).cast("long"))


def told(df: DataFrame, facts: DataFrame, by: Sequence[str], name: str) -> DataFrame:
    """df with the struct column `name` of facts, which has each value of `by` once (NULL where it has none)."""
    rows = df.withColumn("_told", F.lit(False)).unionByName(facts.select(*by, name, F.lit(True).alias("_told")), allowMissingColumns=True)
    return rows.withColumn(name, F.first(name, ignorenulls=True).over(Window.partitionBy(*by))).where("NOT _told").drop("_told")


def nearest_known(df: DataFrame, key: Sequence[str], state: str, upto: Sequence[Column], back: Sequence[Column], late: Column, early: Column, bucket_s: int | None = None) -> DataFrame:
    """Adds _b and _a: the last value of the column `state` that isn't NULL up to each row, and the first one from it on.

    Rows of a series are taken in the order of `upto` for _b and in that of `back`, which goes against time, for _a.
    late and early have the greatest value on the row that a bucket's last and first value is taken from. df needs ts.
    """
    if bucket_s is None:
        w = [Window.partitionBy(*key).orderBy(*o).rowsBetween(Window.unboundedPreceding, 0) for o in (upto, back)]
        return df.withColumns({"_b": F.last(state, ignorenulls=True).over(w[0]), "_a": F.last(state, ignorenulls=True).over(w[1])})
    d, by = bucketed(df, bucket_s), [*key, "_bucket"]
    some = F.col(state).isNotNull()
    ends = d.groupBy(*by).agg(F.max_by(state, F.when(some, late)).alias("_last"), F.max_by(state, F.when(some, early)).alias("_first"))
    before, after = (Window.partitionBy(*key).orderBy(o).rowsBetween(Window.unboundedPreceding, -1) for o in (F.asc("_bucket"), F.desc("_bucket")))
    ends = ends.withColumns({"_in": F.last("_last", ignorenulls=True).over(before), "_out": F.last("_first", ignorenulls=True).over(after)})
    rows = d.withColumn("_edge", F.lit(0))
    for c, edge in (("_in", -1), ("_out", 1)):
        rows = rows.unionByName(ends.where(F.col(c).isNotNull()).select(*by, F.col(c).alias(state), F.lit(edge).alias("_edge")), allowMissingColumns=True)
    w = [Window.partitionBy(*by).orderBy(e, *o).rowsBetween(Window.unboundedPreceding, 0) for e, o in ((F.asc("_edge"), upto), (F.desc("_edge"), back))]
    return rows.withColumns({"_b": F.last(state, ignorenulls=True).over(w[0]), "_a": F.last(state, ignorenulls=True).over(w[1])}).where("_edge = 0").drop("_edge", "_bucket")


def numbered(df: DataFrame, key: Sequence[str], bucket_s: int, name: str = "_row", order: Sequence[str] = ("ts",)) -> DataFrame:
    """Adds the row's number (from 1) in its series, and _bucket."""
    d, by = bucketed(df, bucket_s), [*key, "_bucket"]
    before = Window.partitionBy(*key).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = d.groupBy(*by).agg(F.count(F.lit(1)).alias("_n")).select(*by, F.struct(F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("n")).alias("_before"))
    own = d.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order)).cast("long"))
    return told(own, sizes, by, "_before").withColumn(name, F.col(name) + F.col("_before.n")).drop("_before")


def within(df: DataFrame, key: Sequence[str], reach: int, *steps: dict, bucket_s: int | None = None, block: int = BLOCK_ROWS) -> DataFrame:
    """Adds columns that look at up to `reach` rows before each row: name to a function of a window of the rows in order.

    A step's columns may use those of the steps before it.

    Rows are dealt in blocks by their numbers. A block has the rows that come before it as well, as many as are looked
    at, so a row is in one or two blocks.
    """
    if bucket_s is None:
        w = Window.partitionBy(*key).orderBy("ts")
        for step in steps:
            df = df.withColumns({name: f(w) for name, f in step.items()})
        return df
    block = max(block, reach, 1)
    d = numbered(df, key, bucket_s)
    own = F.floor((F.col("_row") - 1) / block).cast("long")
    d = d.withColumn("_block", F.explode(F.sequence(own, F.floor((F.col("_row") - 1 + reach) / block).cast("long"))))
    w = Window.partitionBy(*key, "_block").orderBy("_row")
    for step in steps:
        d = d.withColumns({name: f(w) for name, f in step.items()})
    return d.where(F.col("_block") == own).drop("_row", "_block", "_bucket")


def runs(df: DataFrame, key: Sequence[str], value: str, bucket_s: int | None = None) -> DataFrame:
    """Adds _run, which tells runs of equal values (or of NULL) of a series apart, _len (the run's rows), _at (its rows so far) and _bucket."""
    d, by = (bucketed(df, bucket_s) if bucket_s else df.withColumn("_bucket", F.lit(0).cast("long"))), [*key, "_bucket"]
    w = Window.partitionBy(*by).orderBy("ts")
    new = F.when(F.col(value).eqNullSafe(F.lag(value).over(w)) & (F.row_number().over(w) > 1), 0).otherwise(1)
    own = d.withColumn("_new", new).withColumn("_no", F.sum("_new").over(w)).drop("_new")
    r = Window.partitionBy(*by, "_no")
    own = own.withColumns({"_len": F.count(F.lit(1)).over(r), "_at": F.row_number().over(r.orderBy("ts"))})
    if bucket_s is None:
        return own.withColumn("_run", F.struct("_bucket", "_no")).drop("_no")
    # only a bucket's first and last run go on in others
    each = own.groupBy(*by, "_no").agg(F.count(F.lit(1)).alias("_len"), F.first(F.struct(F.col(value).alias("v"))).alias("_v"))
    last = F.max("_no").over(Window.partitionBy(*by))
    edges = each.withColumn("_of", last).where("_no = 1 OR _no = _of")
    s = Window.partitionBy(*key).orderBy("_bucket", "_no")
    goes_on = (F.lag("_bucket").over(s) < F.col("_bucket")) & F.lag("_v").over(s).eqNullSafe(F.col("_v"))
    edges = edges.withColumn("_cut", F.when(goes_on, 0).otherwise(1)).withColumn("_chain", F.sum("_cut").over(s))
    c = Window.partitionBy(*key, "_chain")
    first = c.orderBy("_bucket", "_no")
    edges = edges.withColumns({"_all": F.sum("_len").over(c), "_past": F.coalesce(F.sum("_len").over(first.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)), "_id": F.first(F.struct("_bucket", "_no")).over(first)})
    facts = edges.select(*by, "_no", F.struct("_all", "_past", "_id").alias("_edge"))
    out = told(own, facts, [*by, "_no"], "_edge")
    return out.withColumns({"_run": F.coalesce("_edge._id", F.struct("_bucket", "_no")), "_len": F.coalesce("_edge._all", "_len"), "_at": F.col("_at") + F.coalesce("_edge._past", F.lit(0))}).drop("_edge", "_no")


def least_of_run(df: DataFrame, key: Sequence[str], value: Column, name: str, bucket_s: int | None = None) -> DataFrame:
    """Adds the least value of each run of runs(), of which a bucket sends its own."""
    if bucket_s is None:
        return df.withColumn(name, F.min(value).over(Window.partitionBy(*key, "_run")))
    d = df.withColumn("_least", value)
    each = d.groupBy(*key, "_run", "_bucket").agg(F.min("_least").alias("_m"))
    all_ = F.min("_m").over(Window.partitionBy(*key, "_run"))
    facts = each.select(*key, "_run", "_bucket", F.struct(all_.alias("m")).alias("_all"))
    return told(d, facts, [*key, "_run", "_bucket"], "_all").withColumn(name, F.col("_all.m")).drop("_all", "_least")
