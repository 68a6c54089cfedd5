"""Streaming forms of window sums, dense counts and averages, change sets, the latest cache and trip matching."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.store import apply_changes, change_set, refresh_latest
from ..sources.versioned import VersionedTarget


def stream_window(source: DataFrame, value: Column, period: str, key: Sequence[str] = ("station_code",), delay: str = "1 day") -> DataFrame:
    """An aggregate of each tumbling window; rows that are later than delay are lost. Windows appear when they are closed."""
    w = F.window("ts", period)
    out = source.withWatermark("ts", delay).groupBy(*key, w).agg(value.alias("value"))
    return out.select(*key, F.col("window.start").alias("start"), F.col("window.end").alias("ts"), "value")


def stream_counts(source: DataFrame, period: int, key: str = "station_code", delay: str = "1 day") -> DataFrame:
    """Key, ts (the window's centre) and value, the rows of each window of period seconds; empty windows between others give 0.

    Windows begin at midnight (UTC) and every period after it, where a day is a multiple of the period. A window appears
    when the watermark has passed it; empty ones appear together with the next that isn't. State is the number of the
    next window and the counts of open ones.
    """
    if 86400 % period:
        raise ValueError("a day must be a multiple of the period")
    kind = dict(source.dtypes)[key]
    rows = source.withWatermark("ts", delay).select(key, "ts", F.floor(F.unix_seconds("ts") / period).alias("window"))

    def count(of: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        following, windows, counts = state.get if state.exists else (None, [], [])
        open_ = dict(zip(windows, counts))
        for f in frames:
            for w, n in f.window.value_counts().items():
                if following is None or w >= following:  # others came after their window was closed
                    open_[int(w)] = open_.get(int(w), 0) + int(n)
        mark = state.getCurrentWatermarkMs() // 1000
        closed = sorted(w for w in open_ if (w + 1) * period <= mark)
        if closed:
            first = closed[0] if following is None else following
            at = range(first, closed[-1] + 1)
            yield pd.DataFrame({key: [of[0]] * len(at), "ts": [pd.Timestamp(w * period + period // 2, unit="s") for w in at], "value": [open_.pop(w, 0) for w in at]})
            following = closed[-1] + 1
        state.update((following, sorted(open_), [open_[w] for w in sorted(open_)]))
        if open_:
            state.setTimeoutTimestamp(max((min(open_) + 1) * period * 1000, state.getCurrentWatermarkMs() + 1))

    return rows.groupBy(key).applyInPandasWithState(count, f"{key} {kind}, ts timestamp, value long", "following long, windows array<long>, counts array<long>", "append", GroupStateTimeout.EventTimeTimeout)


def stream_hourly_average(source: DataFrame, min_points: int = 5, key: Sequence[str] = ("station_code", "type_name"), delay: str = "1 day") -> DataFrame:
    """Means over (start, end] hours of at least min_points rows, at the end, when the watermark has passed them."""
    end = F.timestamp_seconds((F.ceil(F.unix_micros("ts") / 3_600_000_000) * 3600).cast("long"))
    # an hour's rows carry its end as event time, so that a row on the full hour closes the hour that it belongs to
    rows = source.withWatermark("ts", delay).withColumn("end", end)
    hours = rows.groupBy(*key, F.window("ts", "1 hour", startTime="1 microsecond").alias("w")).agg(F.avg("value").alias("value"), F.count("value").alias("n"), F.max("end").alias("end"))
    return hours.where(F.col("n") >= min_points).select(*key, F.col("end").alias("ts"), "value")


def stream_merge(source: DataFrame, read: Callable[[DataFrame], DataFrame], write: Callable[[DataFrame, DataFrame], None], key: Sequence[str] = ("station_code",)) -> DataStreamWriter:
    """Each micro-batch of (key, ts, value) is a recomputed range of the target.

    read(keys) gives the target's rows of the batch's keys (or more), write(keys, rows) replaces those of the same keys
    by the rows after the change set; other keys aren't touched, so a target in folders by key is rewritten in the
    folders that the batch has. A batch that is tried again gives the same target. write() must not replace what read()
    reads before it has read it all (a dynamic partition overwrite stages its files).
    """

    def merge(batch: DataFrame, _: int) -> None:
        bounds = batch.agg(F.min("ts").alias("lo"), F.max("ts").alias("hi")).first()  # one row
        if bounds.lo is None:
            return
        keys = batch.select(*key).distinct()
        old = read(keys).join(keys, list(key), "left_semi")
        write(keys, apply_changes(old, change_set(batch, old, F.lit(bounds.lo), F.lit(bounds.hi), key), key))

    return source.writeStream.foreachBatch(merge)


def stream_latest(source: DataFrame, read: Callable[[DataFrame], DataFrame], write: Callable[[DataFrame, DataFrame], None], key: Sequence[str] = ("station_code",)) -> DataStreamWriter:
    """The cache of latest rows (key, ts, value) after each micro-batch; read() and write() are those of stream_merge().

    Only keys whose row changes are written. Rows that are older than the cached one change nothing.
    """

    def upsert(batch: DataFrame, _: int) -> None:
        keys = batch.select(*key).distinct()
        old = read(keys).join(keys, list(key), "left_semi").select(*key, "ts", "value")
        # the cached row competes as a row of the batch, so that a late row doesn't replace it
        new = refresh_latest(old, batch.select(*key, "ts", "value").unionByName(old), key).where("op <> 'keep'").drop("op")
        if not new.isEmpty():
            write(new.select(*key), new)

    return source.writeStream.foreachBatch(upsert)


def stream_into(source: DataFrame, target: VersionedTarget, writer: str, change: Callable[[DataFrame, DataFrame], DataFrame]) -> DataStreamWriter:
    """I10, U1, U2 exactly once: each micro-batch is a version of the target, by its number, which a restarted stream keeps.

    change(rows, batch) returns what the rows of the batch's buckets become, as latest_rows() and recomputed_range() do.
    """
    return source.writeStream.foreachBatch(lambda batch, number: target.apply(batch, change, writer, number) and None)


def latest_rows(key: Sequence[str]) -> Callable[[DataFrame, DataFrame], DataFrame]:
    """U2 as a change of stream_into(): each key's latest row (key, ts, value), of equal times that of the largest value."""

    def change(rows: DataFrame, batch: DataFrame) -> DataFrame:
        both = rows.select(*key, "ts", "value").unionByName(batch.select(*key, "ts", "value"))
        return both.groupBy(*key).agg(F.max(F.struct("ts", "value")).alias("r")).select(*key, "r.ts", "r.value")

    return change


def recomputed_range(key: Sequence[str]) -> Callable[[DataFrame, DataFrame], DataFrame]:
    """U1 as a change of stream_into(): the batch is a recomputed range (of its own times) of its keys; other keys stay."""

    def change(rows: DataFrame, batch: DataFrame) -> DataFrame:
        bounds = batch.agg(F.min("ts").alias("lo"), F.max("ts").alias("hi")).first()  # one row
        if bounds.lo is None:
            return rows
        keys = batch.select(*key).distinct()
        old = rows.join(keys, list(key), "left_semi")
        new = apply_changes(old, change_set(batch, old, F.lit(bounds.lo), F.lit(bounds.hi), key), key)
        return rows.join(keys, list(key), "left_anti").unionByName(new.select(*rows.columns))

    return change


TRIP = "link_code string, device string, ts timestamp, value double"
STATE = "devices array<string>, times array<long>, origins array<boolean>"


def stream_match(source: DataFrame, edges: DataFrame, max_s: int = 3600, delay: str = "10 minutes", buckets: int = 1024) -> DataFrame:
    """Trips as match_trips() finds them, each when the watermark has passed all that could change it.

    edges are joined as a static table, which is broadcast. State is kept for each link and bucket of devices (by hash):
    sightings at either end that are not older than max_s before the watermark. A call costs milliseconds, however few
    rows it gets, so the devices of a bucket share one, and their sightings are matched as one sorted sequence.
    """
    ends = edges.select("link_code", F.explode(F.array(F.struct(F.col("origin_code").alias("station_code"), F.lit(True).alias("is_origin")), F.struct(F.col("destination_code").alias("station_code"), F.lit(False).alias("is_origin")))).alias("e")).select("link_code", "e.*")
    seen = source.withWatermark("ts", delay).join(F.broadcast(ends), "station_code")
    # without a time nothing is a trip; ts is passed on as it lets Spark drop what is too late
    seen = seen.where("ts IS NOT NULL").select("link_code", F.pmod(F.xxhash64("device"), F.lit(buckets)).alias("bucket"), "device", "ts", F.unix_micros("ts").alias("time"), "is_origin")
    wait = max_s * 1_000_000

    def match(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        parts = [pd.DataFrame(dict(zip(("device", "time", "is_origin"), state.get)))] if state.exists else []
        parts += [f[["device", "time", "is_origin"]] for f in frames]
        # of a device's equal times the end comes first, so that all that follows a start is after it
        rows = pd.concat(parts).drop_duplicates().sort_values(["device", "time", "is_origin"], ignore_index=True)
        device, time, origin = rows.device.factorize(use_na_sentinel=False)[0], rows.time.to_numpy("int64"), rows.is_origin.to_numpy(bool)
        mark, n = state.getCurrentWatermarkMs() * 1000, len(rows)

        def following(of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """The place of each row's next one of these, and whether the device has it."""
            at = np.append(np.minimum.accumulate(np.where(of, np.arange(n), n)[::-1])[::-1], n)[1:]
            return np.minimum(at, n - 1), (at < n) & (device[np.minimum(at, n - 1)] == device)

        (end, ends_), (again, begins) = following(~origin), following(origin)
        decided = origin & (time + wait <= mark)
        # the next start cuts a trip off if it isn't after its finish
        trip = decided & ends_ & (time[end] < time + wait) & ~(begins & (time[again] <= time[end]))
        open_ = origin & ~decided
        # ends are kept for open starts of their device before them, and for starts that are still to come, after the watermark
        first = np.full(device.max() + 1, mark)
        np.minimum.at(first, device[open_], time[open_])
        kept = open_ | (~origin & (time > first[device]))
        if kept.any():
            left = rows[kept]
            state.update((left.device.tolist(), left.time.tolist(), left.is_origin.tolist()))
            due = int((time[open_] if open_.any() else time[kept]).min()) + wait
            state.setTimeoutTimestamp(max(-(-due // 1000), state.getCurrentWatermarkMs() + 1))
        else:
            state.remove()
        if trip.any():
            yield pd.DataFrame({"link_code": key[0], "device": rows.device[trip], "ts": pd.to_datetime(time[trip], unit="us"), "value": (time[end][trip] - time[trip]) / 1e6})

    return seen.groupBy("link_code", "bucket").applyInPandasWithState(match, TRIP, STATE, "append", GroupStateTimeout.EventTimeTimeout)
