"""Trips, counts and latest rows of streams on keyed values, lists, maps and timers, and trips as a join of two streams.

These need the RocksDB state store (rocksdb() sets it for the streams that are started within). Entries of maps are
stored by themselves and lists are appended to, so a sighting doesn't rewrite what its key has already; timers of event
time drop what the watermark has passed.
"""

from __future__ import annotations

import contextlib
from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"  # fixed value: Spark's name of it


@contextlib.contextmanager
def rocksdb(spark: SparkSession) -> Iterator[None]:
    """Streams that are started within keep their state in RocksDB; the session's setting comes back afterwards."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.unset(PROVIDER) if before is None else spark.conf.set(PROVIDER, before)


class Trips(StatefulProcessor):
    """Sightings of a device at a link's ends, in microseconds. A start is decided when the watermark has passed all that may end it.

    Every call of a state goes to Spark and back, so a key has one list, to which a batch's sightings are added at once,
    and one timer: when the oldest one of them is decided. It takes all that the watermark has passed.
    """

    def __init__(self, max_us: int):
        self.max_us = max_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getListState("seen", "at long, origin boolean")
        self.due = handle.getValueState("due", "ms long")

    def _wake(self, oldest: int, mark: int) -> None:
        ms = max(-(-(oldest + self.max_us) // 1000), mark + 1)
        if not self.due.exists() or ms < self.due.get()[0]:
            self.due.update((ms,))
            self.handle.registerTimer(ms)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = sorted({r for f in rows for r in zip(f["at"].tolist(), f.is_origin.tolist())})
        if new:
            self.seen.appendList(new)
            self._wake(new[0][0], timerValues.getCurrentWatermarkInMs())
        return iter(())

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        mark = timerValues.getCurrentWatermarkInMs()
        seen = {(r[0], r[1]) for r in self.seen.get()}
        starts, ends = (sorted(at for at, origin in seen if origin == at_start) for at_start in (True, False))
        done = bisect_right(starts, mark * 1000 - self.max_us)
        rows = []
        for i, s in enumerate(starts[:done]):
            at = bisect_right(ends, s)
            finish = ends[at] if at < len(ends) and ends[at] < s + self.max_us else None
            if finish is not None and (i + 1 == len(starts) or starts[i + 1] > finish):
                rows.append((*key, pd.Timestamp(s, unit="us"), (finish - s) / 1e6))
        # a start that comes later is after the watermark
        first = starts[done] if done < len(starts) else mark * 1000
        kept = sorted([(s, True) for s in starts[done:]] + [(e, False) for e in ends if e > first])
        if kept != sorted(seen):
            self.seen.put(kept) if kept else self.seen.clear()
        self.due.clear()
        if kept:
            self._wake(kept[0][0], mark)
        if rows:
            yield pd.DataFrame(rows, columns=["link_code", "device", "ts", "value"])

    def close(self) -> None:
        pass


TRIP = "link_code string, device string, ts timestamp, value double"


def _sighted(source: DataFrame, edges: DataFrame, delay: str) -> DataFrame:
    """Sightings (station_code, device, ts) at either end of links; edges are a static table."""
    ends = edges.select("link_code", F.explode(F.array(F.struct(F.col("origin_code").alias("station_code"), F.lit(True).alias("is_origin")), F.struct(F.col("destination_code").alias("station_code"), F.lit(False).alias("is_origin")))).alias("e")).select("link_code", "e.*")
    return source.withWatermark("ts", delay).join(ends, "station_code").select("link_code", "device", "ts", "is_origin")


def trips_with_state(source: DataFrame, edges: DataFrame, max_s: int = 3600, delay: str = "10 minutes") -> DataFrame:
    """Trips as match_trips() finds them, each when the watermark has passed all that could change it."""
    seen = _sighted(source, edges, delay).withColumn("at", F.unix_micros("ts"))
    return seen.groupBy("link_code", "device").transformWithStateInPandas(Trips(max_s * 1_000_000), TRIP, "append", "EventTime")


def trips_by_join(source: DataFrame, edges: DataFrame, max_s: int = 3600, delay: str = "10 minutes") -> DataFrame:
    """The same trips as an interval join of two streams, starts and the sightings that follow them within max_s.

    Of a start's followers, the first at the destination ends the trip unless another start isn't after it. Both sides
    have a watermark and the join a bound of time, so Spark drops what can't be joined any more.
    """
    starts = _sighted(source, edges, delay).where("is_origin").select(F.col("link_code").alias("l"), F.col("device").alias("d"), F.col("ts").alias("start"))
    after = _sighted(source, edges, delay)
    near = (F.col("link_code") == F.col("l")) & (F.col("device") == F.col("d")) & (F.col("ts") > F.col("start")) & (F.col("ts") < F.col("start") + F.make_dt_interval(secs=F.lit(max_s)))
    each = starts.join(after, near).groupBy("l", "d", "start").agg(F.min(F.when(~F.col("is_origin"), F.col("ts"))).alias("finish"), F.min(F.when(F.col("is_origin"), F.col("ts"))).alias("next"))
    found = each.where("finish IS NOT NULL AND (next IS NULL OR next > finish)")
    return found.select(F.col("l").alias("link_code"), F.col("d").alias("device"), F.col("start").alias("ts"), ((F.unix_micros("finish") - F.unix_micros("start")) / 1e6).alias("value"))


class Counts(StatefulProcessor):
    """Counts of windows by number: a map of open windows and the number of the next one; a timer closes each window."""

    def __init__(self, key: str, period: int):
        self.key, self.period = key, period

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getMapState("open", "at long", "n long")
        self.next = handle.getValueState("next", "at long")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        following = self.next.get()[0] if self.next.exists() else None
        for frame in rows:
            for w, n in frame.window.value_counts().items():
                if following is None or w >= following:  # others came after their window was closed
                    k = (int(w),)
                    self.open.updateValue(k, ((self.open.getValue(k)[0] if self.open.containsKey(k) else 0) + int(n),))
                    self.handle.registerTimer((int(w) + 1) * self.period * 1000)
        return iter(())

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        w = expiredTimerInfo.getExpiryTimeInMs() // 1000 // self.period - 1  # timers of a key expire in order
        if self.open.containsKey((w,)):
            n = self.open.getValue((w,))[0]
            self.open.removeKey((w,))
            at = range(self.next.get()[0] if self.next.exists() else w, w + 1)
            self.next.update((w + 1,))
            yield pd.DataFrame({self.key: [key[0]] * len(at), "ts": [pd.Timestamp(k * self.period + self.period // 2, unit="s") for k in at], "value": [0] * (len(at) - 1) + [n]})

    def close(self) -> None:
        pass


def counts_with_state(source: DataFrame, period: int, key: str = "station_code", delay: str = "1 day") -> DataFrame:
    """Key, ts (the window's centre) and value of dense counts, as stream_counts() has them; a window appears when the watermark has passed it."""
    if 86400 % period:
        raise ValueError("a day must be a multiple of the period")
    rows = source.withWatermark("ts", delay).select(key, "ts", F.floor(F.unix_seconds("ts") / period).alias("window"))
    return rows.groupBy(key).transformWithStateInPandas(Counts(key, period), f"{key} {dict(source.dtypes)[key]}, ts timestamp, value long", "append", "EventTime")


class Latest(StatefulProcessor):
    """The latest row of a key: one value, which a row changes only if it isn't older."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "at long, value double")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held = tuple(self.last.get()) if self.last.exists() else None
        best = held
        for frame in rows:
            for at, value in zip(frame["at"].tolist(), frame.value.tolist()):
                if best is None or (at, value) > best:
                    best = (at, value)
        if best != held:
            self.last.update(best)
            yield pd.DataFrame([(*key, pd.Timestamp(best[0], unit="us"), best[1])], columns=["station_code", "type_name", "ts", "value"])

    def close(self) -> None:
        pass


def latest_with_state(source: DataFrame) -> DataFrame:
    """station_code, type_name, ts, value of each key whose latest row changes (of equal times the largest value counts), in update mode."""
    rows = source.where("ts IS NOT NULL AND value IS NOT NULL").select("station_code", "type_name", F.unix_micros("ts").alias("at"), "value")
    return rows.groupBy("station_code", "type_name").transformWithStateInPandas(Latest(), "station_code string, type_name string, ts timestamp, value double", "update", "None")
