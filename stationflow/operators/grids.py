"""Regular grids: dense window counts, resampling, interpolation, as-of joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scans import nearest_known, within


def seconds(c: Column | str) -> Column:
    """Epoch seconds with fraction."""
    return F.unix_micros(F.col(c).cast("timestamp") if isinstance(c, str) else c.cast("timestamp")) / 1e6


def gap_s(later: Column | str, earlier: Column | str) -> Column:
    """Seconds from earlier to later, exact to the microsecond."""
    micros = lambda c: F.unix_micros((F.col(c) if isinstance(c, str) else c).cast("timestamp"))
    return (micros(later) - micros(earlier)) / 1e6


def at_seconds(c: Column) -> Column:
    return F.timestamp_micros((c * 1_000_000).cast("long"))


def floor_ts(ts: Column | str, step: int, origin: Column | None = None) -> Column:
    """The begin of the step (in seconds) that holds ts, counted from origin (the epoch by default)."""
    c = F.unix_micros(F.col(ts).cast("timestamp") if isinstance(ts, str) else ts.cast("timestamp"))
    base = F.lit(0).cast("long") if origin is None else F.unix_micros(origin.cast("timestamp"))
    return F.timestamp_micros(base + F.floor((c - base) / (step * 1_000_000)) * (step * 1_000_000))


def grid(m: DataFrame, step: int, key: Sequence[str], start: Column | None = None, end: Column | None = None) -> DataFrame:
    """Every step from start (midnight of the first row) to end (the last row's) of each series, as ts."""
    first = F.date_trunc("day", F.min("ts")) if start is None else start
    bounds = m.groupBy(*key).agg(first.alias("_lo"), (F.max("ts") if end is None else end).alias("_hi"))
    steps = F.sequence(F.lit(0).cast("long"), F.floor((gap_s("_hi", "_lo")) / step).cast("long"))
    return bounds.where("_hi >= _lo").select(*key, "_lo", F.explode(steps).alias("_i")).select(*key, F.timestamp_micros(F.unix_micros("_lo") + F.col("_i") * (step * 1_000_000)).alias("ts"))


def window_count(m: DataFrame, period: int, key: Sequence[str] = ("station_code",), start: Column | None = None) -> DataFrame:
    """Rows in [t, t + period) for every step from the first row's midnight to the last row, at the centre; 0 for empty ones."""
    g = grid(m, period, key, start)
    lo = m.groupBy(*key).agg((F.date_trunc("day", F.min("ts")) if start is None else start).alias("_lo"))
    counts = m.join(lo, list(key)).withColumn("ts", floor_ts("ts", period, F.col("_lo"))).groupBy(*key, "ts").agg(F.count(F.lit(1)).alias("value"))
    centre = F.timestamp_micros(F.unix_micros("ts") + period // 2 * 1_000_000)
    return g.join(counts, [*key, "ts"], "left").select(*key, centre.alias("ts"), F.coalesce("value", F.lit(0)).alias("value"))


def _merged(probe: DataFrame, series: DataFrame, key: Sequence[str], value: str) -> DataFrame:
    """Rows of both sides in one frame: _p says which are the probe's, _s is struct<ts, v> of the series' rows."""
    a = probe.withColumns({"_p": F.lit(True), "_s": F.lit(None).cast("struct<ts: timestamp, v: double>")})
    b = series.where(F.col(value).isNotNull()).select(*key, "ts", F.lit(False).alias("_p"), F.struct(F.col("ts").cast("timestamp").alias("ts"), F.col(value).cast("double").alias("v")).alias("_s"))
    return a.unionByName(b, allowMissingColumns=True)


def _asof(probe: DataFrame, series: DataFrame, key: Sequence[str], value: str, bucket_s: int | None) -> DataFrame:
    """_b and _a: the rows of the series at or before and at or after each row of the probe; of equal times, that of the largest value."""
    at, v = F.unix_micros(F.col("ts").cast("timestamp")), F.col("_s.v")
    # rows of the series at the probe's own time come before it, so they are looked for on that side
    both = nearest_known(_merged(probe, series, key, value), key, "_s", [F.asc("ts"), F.asc("_p"), v.asc()], [F.desc("ts"), F.desc("_p"), v.asc()], F.struct(at, v), F.struct(-at, v), bucket_s).where("_p")
    exact = F.col("_b.ts") == F.col("ts")
    return both.withColumn("_a", F.when(exact, F.col("_b")).otherwise(F.col("_a"))).drop("_p", "_s")


def asof_pad(probe: DataFrame, series: DataFrame, key: Sequence[str] = (), value: str = "value", name: str = "value_asof", max_age_s: int | None = None, bucket_s: int | None = None) -> DataFrame:
    """The last value at or before each probe row, not older than max_age_s."""
    out = _asof(probe, series, key, value, bucket_s)
    fresh = F.lit(True) if max_age_s is None else gap_s("ts", F.col("_b.ts")) <= max_age_s
    return out.withColumn(name, F.when(fresh, F.col("_b.v"))).drop("_a", "_b")


def asof_nearest(probe: DataFrame, series: DataFrame, key: Sequence[str] = (), value: str = "value", name: str = "value_nearest", within_s: int | None = 300, bucket_s: int | None = None) -> DataFrame:
    """The value nearest in time, less than within_s away; of two at the same distance the later one."""
    back, ahead = gap_s("ts", F.col("_b.ts")), gap_s(F.col("_a.ts"), "ts")
    near = F.when(F.col("_b").isNull() | (ahead <= back), F.col("_a")).otherwise(F.col("_b"))
    gap = F.abs(gap_s(F.col("_n.ts"), "ts"))
    out = _asof(probe, series, key, value, bucket_s).withColumn("_n", near)
    return out.withColumn(name, F.when(F.lit(True) if within_s is None else gap < within_s, F.col("_n.v"))).drop("_a", "_b", "_n")


def interpolate_at(probe: DataFrame, series: DataFrame, key: Sequence[str] = (), value: str = "value", name: str = "value_at", max_gap_s: int = 14400, bucket_s: int | None = None) -> DataFrame:
    """Linear between the rows on both sides; NULL where one is missing or they are more than max_gap_s apart."""
    whole = gap_s(F.col("_a.ts"), F.col("_b.ts"))
    line = F.col("_b.v") + F.coalesce(F.try_divide(gap_s("ts", F.col("_b.ts")), whole), F.lit(0.0)) * (F.col("_a.v") - F.col("_b.v"))
    return _asof(probe, series, key, value, bucket_s).withColumn(name, F.when(whole <= max_gap_s, line)).drop("_a", "_b")


def interpolate_linear(g: DataFrame, key: Sequence[str], value: str = "value", trailing: str = "hold", bucket_s: int | None = None) -> DataFrame:
    """Gaps of a series on a grid: linear inside, the last value at the end (or NULL), NULL at the begin."""
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    s = F.when(F.col(value).isNotNull(), F.struct(at.alias("t"), F.col(value).cast("double").alias("v")))
    out = nearest_known(g.withColumn("_s", s), key, "_s", [F.asc("ts")], [F.desc("ts")], at, -at, bucket_s)
    line = F.col("_b.v") + (F.unix_micros(F.col("ts").cast("timestamp")) - F.col("_b.t")) / (F.col("_a.t") - F.col("_b.t")) * (F.col("_a.v") - F.col("_b.v"))
    end = F.col("_b.v") if trailing == "hold" else F.lit(None).cast("double")
    filled = F.when(F.col(value).isNotNull(), F.col(value)).when(F.col("_a").isNull(), end).when(F.col("_b").isNotNull(), line)
    return out.withColumn(value, filled).drop("_s", "_a", "_b")


def resample_mean(m: DataFrame, step: int = 300, key: Sequence[str] = ("station_code",)) -> DataFrame:
    """Mean of each step that has rows."""
    return m.groupBy(*key, floor_ts("ts", step).alias("ts")).agg(F.avg("value").alias("value"))


def resample_nearest(m: DataFrame, step: int = 300, key: Sequence[str] = ("station_code",)) -> DataFrame:
    """The nearest value at each step between the first and the last row."""
    g = grid(m, step, key, start=floor_ts(F.min("ts"), step))
    return asof_nearest(g, m, key, name="value", within_s=None)


def densify(fc: DataFrame, step: int, key: Sequence[str], columns: dict[str, str]) -> DataFrame:
    """Rows every step seconds between neighbours, linear; columns: name to `tenth`, `whole`, `floor` or `exact` rounding.

    Rows themselves stay as they are. A gap is filled at its begin plus multiples of step.
    """
    w = Window.partitionBy(*key).orderBy("ts")
    nxt = {f"_n_{c}": F.lead(c).over(w) for c in columns} | {"_n_ts": F.lead("ts").over(w)}
    out = fc.withColumns(nxt)
    gap = gap_s("_n_ts", "ts")
    inner = F.greatest(F.ceil(F.coalesce(gap, F.lit(0.0)) / step) - 1, F.lit(0)).cast("long")
    out = out.withColumn("_i", F.explode(F.sequence(F.lit(0).cast("long"), inner)))
    rounding = {"tenth": lambda c: F.bround(c, 1), "whole": lambda c: F.bround(c, 0), "floor": F.floor, "exact": lambda c: c}
    share = F.try_divide(F.col("_i") * step, gap)
    filled = {c: F.when(F.col("_i") == 0, F.col(c)).otherwise(rounding[how](F.col(c) + share * (F.col(f"_n_{c}") - F.col(c)))) for c, how in columns.items()}
    return out.withColumns(filled | {"ts": F.timestamp_micros(F.unix_micros("ts") + F.col("_i") * (step * 1_000_000))}).drop("_i", *nxt)


def lag_features(g: DataFrame, lags: Sequence[int] = (1, 2, 12, 288, 2016), key: Sequence[str] = ("station_code",), value: str = "value", bucket_s: int | None = None) -> DataFrame:
    """Earlier values of a series on a grid, by rows."""
    lag = lambda n: lambda w: F.lag(value, n).over(w)
    return within(g, key, max(lags, default=0), {f"lag_{n}": lag(n) for n in lags}, bucket_s=bucket_s)


def running_mean(g: DataFrame, rows: int = 2016, key: Sequence[str] = ("station_code",), value: str = "value", name: str = "running_mean", bucket_s: int | None = None) -> DataFrame:
    """Mean over the row and so many before it, without NULL.

    From sums up to each row of a block, less those up to the row before the frame: a frame of its own would be added
    up anew for every row.
    """
    upto = lambda x: lambda w: F.sum(x).over(w.rowsBetween(Window.unboundedPreceding, 0))
    before = lambda c: lambda w: F.lag(c, rows + 1, 0).over(w)
    sums = {"_s": upto(F.coalesce(F.col(value), F.lit(0)).cast("double")), "_n": upto(F.when(F.col(value).isNotNull(), 1).otherwise(0))}
    back = {"_s0": before("_s"), "_n0": before("_n")}
    return within(g, key, rows + 1, sums, back, bucket_s=bucket_s).withColumn(name, F.try_divide(F.col("_s") - F.col("_s0"), F.col("_n") - F.col("_n0"))).drop(*sums, *back)


def lag_set(per_hour: int = 1, strategy: str = "fine") -> list[int]:
    """Lags that follow the week: all of the first day, then around each day (`fine`), or all of the week (`full`)."""
    day = 24 * per_hour
    if strategy == "full":
        return list(range(1, 7 * day + 1))
    return list(range(1, day + 1)) + [n for d in range(2, 8) for n in (d * day - 1, d * day, d * day + 1)]


def weekly_lags(g: DataFrame, per_hour: int = 1, strategy: str = "fine", key: Sequence[str] = ("station_code",), value: str = "value", bucket_s: int | None = None) -> DataFrame:
    """The array `lags` of the values that lag_set() tells, in its order, for each row of a series on a grid."""
    lags = lag_set(per_hour, strategy)
    columns = {f"_lag_{n}": (lambda w, n=n: F.lag(value, n).over(w)) for n in lags}
    return within(g, key, max(lags), columns, bucket_s=bucket_s).withColumn("lags", F.array(*columns)).drop(*columns)
