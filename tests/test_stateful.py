"""Streams with keyed state and joins of streams: rows out of order, restarts, and state that the watermark bounds."""

import datetime as dt
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F
from stationflow.operators import trips
from stationflow.streaming import stateful

T0 = dt.datetime(2024, 1, 1)
SEEN = "station_code string, device string, ts timestamp"


def sightings(n=60):
    rng = random.Random(4)
    out = [(rng.choice("ab"), rng.choice("xy"), T0 + dt.timedelta(seconds=60 * i + rng.randint(-500, 500), microseconds=rng.randint(0, 999))) for i in range(n)]
    return out + [out[3], out[7]]


def run(spark, path, make, schema, rows, parts, name, mode="append"):
    """Feeds parts of the rows, each in a run of the stream of its own with the same checkpoint, one file a batch."""
    for i in range(parts):
        for k in (0, 1):
            part = rows[i * len(rows) // parts : (i + 1) * len(rows) // parts][k::2]
            spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"{path}/in")
        source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/in")
        batches = []
        with stateful.rocksdb(spark):
            q = make(source).writeStream.outputMode(mode).foreachBatch(lambda b, i: batches.append(b.collect())).option("checkpointLocation", f"{path}/state").trigger(availableNow=True).start()
            q.awaitTermination()
        for b in batches:
            yield from b
        name.append(q.lastProgress)


@pytest.mark.parametrize("make", [stateful.trips_with_state, stateful.trips_by_join])
def test_trips_over_restarts(spark, tmp_path, make):
    rows = sightings()
    far = [("z", "x", T0 + dt.timedelta(days=1)), ("a", "x", T0 + dt.timedelta(days=1)), ("a", "x", T0 + dt.timedelta(days=1, seconds=1))]
    edges = spark.createDataFrame([("l", "a", "b", 1.0)], "link_code string, origin_code string, destination_code string, length_m double")
    progress = []
    got = sorted((r.device, r.ts, r.value) for r in run(spark, str(tmp_path), lambda s: make(s, edges, 1200, "1 hour"), SEEN, rows + far, 3, progress))
    batch = spark.createDataFrame(rows, SEEN)
    want = sorted((r.device, r.ts, r.value) for r in trips.match_trips(batch, edges, 1200).collect())
    assert got == want and len(want) > 8
    left = sum(o["numRowsTotal"] for o in progress[-1]["stateOperators"])
    assert left <= 25  # of 65 sightings: what came after the watermark, and counters of the store


def test_dense_counts_over_restarts(spark, tmp_path):
    rng = random.Random(8)
    rows = [(rng.choice("pq"), T0 + dt.timedelta(minutes=rng.choice([10 * i, 10 * i, 10 * i - 25]))) for i in range(1, 60) if i % 20 < 14]
    rows += [(k, T0 + dt.timedelta(days=1)) for k in "pq"] + [(k, T0 + dt.timedelta(days=1, minutes=1)) for k in "pq"]
    got = {(r.station_code, r.ts): r.value for r in run(spark, str(tmp_path), lambda s: stateful.counts_with_state(s, 1800, delay="2 hours"), "station_code string, ts timestamp", rows, 2, [])}
    want = {}
    for k in "pq":
        own = [int((t - T0).total_seconds()) // 1800 for c, t in rows if c == k and t < T0 + dt.timedelta(hours=22)]
        want |= {(k, T0 + dt.timedelta(seconds=1800 * w + 900)): own.count(w) for w in range(min(own), max(own) + 1)}
    assert got == want and 0 in want.values()


def test_latest_rows(spark, tmp_path):
    rng = random.Random(2)
    rows = [(rng.choice("pq"), rng.choice("tu"), T0 + dt.timedelta(seconds=rng.randint(0, 90)), float(rng.randint(0, 9))) for _ in range(40)] + [("p", "t", None, 1.0)]
    changes = list(run(spark, str(tmp_path), stateful.latest_with_state, "station_code string, type_name string, ts timestamp, value double", rows, 2, [], "update"))
    got, want = {}, {}
    for r in changes:
        assert got.get((r.station_code, r.type_name), (T0 - dt.timedelta(1), 0)) < (r.ts, r.value)
        got[r.station_code, r.type_name] = (r.ts, r.value)
    for s, t, at, v in rows:
        if at is not None:
            want[s, t] = max(want.get((s, t), (at, v)), (at, v))
    assert got == want


def test_a_device_has_one_timer_and_one_list():
    class State:
        def __init__(self):
            self.held, self.calls = [], 0

        def __getattr__(self, name):
            def call(*args):
                self.calls += 1
                if name in ("appendList", "put"):
                    self.held = (self.held if name == "appendList" else []) + list(args[0])
                elif name in ("update", "clear"):
                    self.held = list(args)
                return {"get": self.held[0] if self.held and not isinstance(self.held[0], tuple) else iter(self.held), "exists": bool(self.held)}.get(name)

            return call

    class Handle:
        def __init__(self):
            self.timers = set()

        def getListState(self, name, schema):
            return State()

        def getValueState(self, name, schema):
            state = State()
            state.get = lambda: state.held[0]
            return state

        def registerTimer(self, ms):
            self.timers.add(ms)

    class At:
        def __init__(self, ms):
            self.getCurrentWatermarkInMs = self.getExpiryTimeInMs = lambda: ms

    p, handle = stateful.Trips(10_000_000), Handle()
    p.init(handle)
    seen = [(k * 1_000_000, k % 2 == 0) for k in range(200)]
    list(p.handleInputRows(("l", "x"), iter([pd.DataFrame(seen, columns=["at", "is_origin"])]), At(0)))
    assert handle.timers == {10_000} and p.seen.calls == 1
    out = [r for f in p.handleExpiredTimer(("l", "x"), At(100_000), At(10_000)) for r in f.value]
    assert out == [1.0] * 46 and min(p.seen.held) == (92_000_000, True) and max(handle.timers) == 102_000
