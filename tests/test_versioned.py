"""Versioned targets: batches that fail, are tried again, or meet another writer."""

import datetime as dt
import glob

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from stationflow.sources.versioned import Conflict, VersionedTarget
from stationflow.streaming import latest_rows, recomputed_range, stream_into

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "station_code string, ts timestamp, value double"


def frame(spark, *rows):
    return spark.createDataFrame([(k, T0 + dt.timedelta(minutes=t), float(v)) for k, t, v in rows], SCHEMA)


def held(target, version=None):
    return sorted((r.station_code, int((r.ts - T0).total_seconds()) // 60, r.value) for r in target.read(version).collect())


@pytest.fixture
def target(spark, tmp_path):
    return VersionedTarget(spark, str(tmp_path / "t"), SCHEMA, ["station_code"], 4)


def test_batches_are_applied_once(spark, target):
    change = latest_rows(["station_code"])
    assert held(target) == [] and target.version() == 0
    assert target.apply(frame(spark, ("a", 1, 1), ("b", 1, 1), ("c", 3, 1)), change, "w", 0)
    assert target.apply(frame(spark, ("a", 0, 9), ("b", 2, 7)), change, "w", 1)
    assert not target.apply(frame(spark, ("a", 50, 50)), change, "w", 1) and not target.apply(frame(spark, ("a", 50, 50)), change, "w", 0)
    assert held(target) == [("a", 1, 1.0), ("b", 2, 7.0), ("c", 3, 1.0)] and held(target, 1) == [("a", 1, 1.0), ("b", 1, 1.0), ("c", 3, 1.0)]
    assert target.apply(frame(spark, ("a", 50, 50)), change, "other", 0) and ("a", 50, 50.0) in held(target)
    assert target.apply(frame(spark).limit(0), change, "w", 2) and len(held(target)) == 3


def test_a_batch_that_fails_changes_nothing(spark, target):
    change = latest_rows(["station_code"])
    target.apply(frame(spark, ("a", 1, 1), ("b", 1, 1)), change, "w", 0)
    before = held(target)
    with pytest.raises(Exception):  # while it writes
        target.apply(frame(spark, ("a", 5, 5)), lambda r, b: change(r, b).withColumn("value", F.expr("raise_error('x')").cast("double")), "w", 1)
    publish = target._publish

    def lost(*_):
        raise OSError("the driver is lost")

    target._publish = lost
    with pytest.raises(OSError):  # after it has written
        target.apply(frame(spark, ("a", 5, 5)), change, "w", 1)
    target._publish = publish
    assert held(target) == before and target.version() == 1
    assert target.apply(frame(spark, ("a", 5, 5)), change, "w", 1) and held(target) == [("a", 5, 5.0), ("b", 1, 1.0)]
    folders = len(glob.glob(f"{target.path}/data-*"))
    gone = target.vacuum(keep=1)
    assert gone and len(glob.glob(f"{target.path}/data-*")) == folders - len(gone) and held(target) == [("a", 5, 5.0), ("b", 1, 1.0)]


def test_another_writer_is_faster(spark, target):
    change, publish, met = latest_rows(["station_code"]), target._publish, []

    def late(version, manifest):
        if not met:
            met.append(version)
            target._publish = publish
            target.apply(frame(spark, ("a", 9, 9)), change, "other", 0)
        publish(version, manifest)

    target._publish = late
    assert target.apply(frame(spark, ("a", 5, 5), ("b", 5, 5)), change, "w", 0)
    assert target.version() == 2 and held(target) == [("a", 9, 9.0), ("b", 5, 5.0)]
    with pytest.raises(Conflict):
        target._publish(2, {})


def test_only_touched_buckets_are_written(spark, target):
    keys = [f"k{i}" for i in range(40)]
    change = recomputed_range(["station_code"])
    target.apply(frame(spark, *((k, t, t) for k in keys for t in (0, 10, 20))), change, "w", 0)
    first = target.manifest()["folders"]
    target.apply(frame(spark, ("k7", 5, 99), ("k7", 15, 98)), change, "w", 1)
    second = target.manifest()["folders"]
    assert sum(first[b] != second[b] for b in first) == 1
    assert [r[1:] for r in held(target) if r[0] == "k7"] == [(0, 0.0), (5, 99.0), (15, 98.0), (20, 20.0)] and len(held(target)) == 121
    with pytest.raises(ValueError):
        target.apply(frame(spark, ("k7", 5, 1)), lambda rows, b: b.withColumn("station_code", F.explode(F.array(*map(F.lit, keys)))), "w", 2)


def test_a_stream_that_is_lost_and_restarted(spark, target, tmp_path):
    for i in range(3):
        frame(spark, ("a", i, i), ("b", 2 * i, -i)).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    source = lambda: spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    publish, calls = target._publish, []

    def once(version, manifest):
        calls.append(version)
        if len(calls) == 2:
            raise OSError("the driver is lost")
        publish(version, manifest)
        if len(calls) == 3:
            raise OSError("lost between the version and the stream's own commit")

    target._publish = once
    for attempt in range(3):
        q = stream_into(source(), target, "s", latest_rows(["station_code"])).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
        if attempt < 2:
            with pytest.raises(StreamingQueryException):
                q.awaitTermination()
        else:
            q.awaitTermination()
    assert held(target) == [("a", 2, 2.0), ("b", 4, -2.0)] and target.version() == 3
