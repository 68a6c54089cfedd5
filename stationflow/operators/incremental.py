"""Work ranges of incremental runs, checkpoints, and handlers of users."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .grids import gap_s

CAMERAS_FROM = "2024-07-10"  # fixed value: cameras have no valid data before


def start_dates(stations: DataFrame, out: DataFrame, checkpoints: DataFrame, min_date: Column) -> DataFrame:
    """I4: station_code and start: the later of the last output and the checkpoint, or min_date; cameras not before CAMERAS_FROM."""
    done = out.groupBy("station_code").agg(F.max("ts").alias("done"))
    at = checkpoints.groupBy("station_code").agg(F.max("checkpoint_ts").alias("at"))
    camera = F.get_json_object("metadata", "$.sensor_type") == "camera"
    start = F.coalesce(F.greatest("done", "at"), min_date.cast("timestamp"))
    each = stations.join(done, "station_code", "left").join(at, "station_code", "left")
    return each.select("station_code", F.when(camera, F.greatest(start, F.lit(CAMERAS_FROM).cast("timestamp"))).otherwise(start).alias("start"))


def cap_lookback(starts: DataFrame, days: int) -> DataFrame:
    """No start more than so many days before the latest one."""
    newest = starts.agg(F.max("start").alias("_max"))  # one row
    return starts.crossJoin(F.broadcast(newest)).withColumn("start", F.greatest("start", F.col("_max") - F.make_dt_interval(days=F.lit(days)))).drop("_max")


def batches(ranges: DataFrame, step_s: int, newest: Column | None = None) -> DataFrame:
    """Each range (lo, hi) in steps: from_ts and to_ts; the last one ends at hi, or at newest if that is earlier."""
    hi = F.col("hi") if newest is None else F.least("hi", newest)
    n = F.ceil((gap_s(hi, "lo")) / step_s).cast("long")
    each = ranges.withColumn("_hi", hi).where(n > 0).select("*", F.explode(F.sequence(F.lit(0).cast("long"), n - 1)).alias("_i"))
    at = lambda k: F.timestamp_micros(F.unix_micros("lo") + (F.col("_i") + k) * (step_s * 1_000_000))
    return each.select(*(c for c in ranges.columns if c not in ("lo", "hi")), at(0).alias("from_ts"), F.least(at(1), F.col("_hi")).alias("to_ts"))


def advance_checkpoint(checkpoints: DataFrame, ends: DataFrame, now: Column, ttl_s: int | None = None) -> DataFrame:
    """Checkpoints (job, station_code, checkpoint_ts, expires_at) after a batch that ended at ends (job, station_code, end).

    A checkpoint never goes back by a day; expired ones are gone.
    """
    live = checkpoints.where(F.col("expires_at").isNull() | (F.col("expires_at") > now))
    e = ends.groupBy("job", "station_code").agg(F.max("end").alias("_end"))
    out = live.join(e, ["job", "station_code"], "full")
    newer = F.col("checkpoint_ts").isNull() | (F.to_date("_end") > F.to_date("checkpoint_ts"))
    expires = F.lit(None).cast("timestamp") if ttl_s is None else F.timestamp_micros(F.unix_micros(now) + ttl_s * 1_000_000)
    moved = F.col("_end").isNotNull() & newer
    return out.select("job", "station_code", F.when(moved, F.col("_end")).otherwise(F.col("checkpoint_ts")).alias("checkpoint_ts"), F.when(moved, expires).otherwise(F.col("expires_at")).alias("expires_at"))


def new_rows(source: DataFrame, stored: DataFrame, cap_days: int = 60) -> DataFrame:
    """Rows after the last stored timestamp of their station, at most cap_days further; all rows of stations without one."""
    last = stored.groupBy(F.col("station_code").alias("_s")).agg(F.max("ts").alias("_last"))
    out = source.join(last, source.station_code == last["_s"], "left")
    fresh = F.col("_last").isNull() | ((F.col("ts") > F.col("_last")) & (F.col("ts") <= F.col("_last") + F.make_dt_interval(days=F.lit(cap_days))))
    return out.where(fresh).drop("_s", "_last")


def begins(f: pd.DataFrame, by: Sequence[str]) -> np.ndarray:
    """The places of a frame, in order of by, at which other values of by begin; nulls are equal."""
    new = np.zeros(len(f), bool)
    new[:1] = True
    for c in by:
        v, none = f[c].to_numpy(), f[c].isna().to_numpy()
        new[1:] |= ~((v[1:] == v[:-1]) | (none[1:] & none[:-1]))
    return np.flatnonzero(new)


def whole(frames: Iterator[pd.DataFrame], by: Sequence[str]) -> Iterator[pd.DataFrame]:
    """Frames that come in order of by, cut anew so that all rows of equal by are in one of them."""
    held: list[pd.DataFrame] = []
    for f in frames:
        if f.empty:
            continue
        last = int(begins(f, by)[-1])
        ended = held and (last > 0 or len(begins(pd.concat([held[-1].tail(1), f.head(1)]), by)) > 1)
        if last > 0 or ended:
            yield pd.concat([*held, f.iloc[:last]], ignore_index=True)
            held = []
        held.append(f.iloc[last:])
    if held:
        yield pd.concat(held, ignore_index=True)


def follow_station(m: DataFrame, stations: DataFrame, fn: Callable, schema: str, slice_days: int = 5, many: bool = False) -> DataFrame:
    """fn(pandas rows with their station's columns) for each station and slice of so many days, so that no station is held whole.

    What fn returns for a station's slices is to be put together by a grouping of the result. many: as in follow_type().
    """
    s = stations.select("station_code", *(F.col(c).alias(f"station_{c}") for c in stations.columns if c != "station_code"))
    return follow_type(m.join(s, "station_code"), fn, schema, slice_days, ["station_code"], many)


def follow_type(m: DataFrame, fn: Callable, schema: str, slice_days: int = 5, key: Sequence[str] = ("station_code", "type_name"), many: bool = False) -> DataFrame:
    """fn(pandas rows) for each station, type and slice of so many days.

    A task gets its slices in order, in frames of many, so that no slice costs a frame of Spark's own. With many, fn is
    asked once for each such frame, in which slices are whole and tell their number as `_slice`; otherwise for each slice.
    """
    part = F.floor(F.unix_seconds(F.col("ts").cast("timestamp")) / (slice_days * 86400))
    by = [*key, "_slice"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in whole(frames, by):
            at = [*begins(f, by), len(f)]
            rows = f.drop(columns="_slice")
            done = [fn(f)] if many else [fn(rows.iloc[a:b].reset_index(drop=True)) for a, b in zip(at[:-1], at[1:])]
            done = [x for x in done if len(x)]
            if done:
                out = pd.concat(done, ignore_index=True)
                # a column of nulls alone has lost its kind, and Spark takes no NaN for a text
                empty = [c for c in out if out[c].isna().all()]
                yield out.astype({c: object for c in empty}).assign(**{c: None for c in empty})

    return m.withColumn("_slice", part).repartition(*by).sortWithinPartitions(*by).mapInPandas(run, schema)
