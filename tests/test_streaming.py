"""Streams give what batches give."""

import datetime as dt
import random

from pyspark.sql import functions as F
from stationflow.operators import trips
from stationflow.streaming import stream_counts, stream_latest, stream_match, stream_merge, stream_window

T0 = dt.datetime(2024, 1, 1)


def feed(spark, tmp_path, rows, schema, parts=3):
    path = str(tmp_path / "in")
    rows = sorted(rows, key=lambda r: r[-1])
    for i in range(parts):
        spark.createDataFrame(rows[i * len(rows) // parts : (i + 1) * len(rows) // parts], schema).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def drain(writer, tmp_path):
    q = writer.option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    q.awaitTermination()


def test_window_sums(spark, tmp_path):
    rows = [("s", float(i), T0 + dt.timedelta(minutes=7 * i)) for i in range(60)]
    src = feed(spark, tmp_path, rows, "station_code string, value double, ts timestamp")
    drain(stream_window(src, F.sum("value"), "1 hour", delay="1 minute").writeStream.format("memory").queryName("sums").outputMode("append"), tmp_path)
    got = {r.start: r.value for r in spark.table("sums").collect()}
    want = {}
    for _, v, t in rows:
        want[t.replace(minute=0)] = want.get(t.replace(minute=0), 0) + v
    assert got and all(want[k] == v for k, v in got.items()) and len(got) >= len(want) - 1


def test_trips(spark, tmp_path):
    seen = [(c, d, T0 + dt.timedelta(seconds=s)) for d in ("x", "y") for c, s in (("a", 0), ("b", 50), ("a", 4000), ("a", 4100), ("b", 4200), ("b", 7700 + len(d)), ("a", 9000), ("z", 30000))]
    seen += [("a", "w", T0 + dt.timedelta(seconds=90000)), ("b", "w", T0 + dt.timedelta(seconds=200000))]
    edges = spark.createDataFrame([("l", "a", "b", 1.0)], "link_code string, origin_code string, destination_code string, length_m double")
    src = feed(spark, tmp_path, seen, "station_code string, device string, ts timestamp")
    drain(stream_match(src, edges).writeStream.format("memory").queryName("trips").outputMode("append"), tmp_path)
    got = sorted((r.device, r.ts, r.value) for r in spark.table("trips").collect())
    batch = spark.createDataFrame(seen, "station_code string, device string, ts timestamp")
    want = sorted((r.device, r.ts, r.value) for r in trips.match_trips(batch, edges).collect())
    assert got == want and len(want) == 4


def test_trips_of_many_devices_share_calls(spark, tmp_path):
    """Times of many devices in any order, equal ones and repeated ones too; state has a row for a bucket, not for a device."""
    rng = random.Random(4)
    seen = [(rng.choice("ab"), f"d{rng.randrange(300)}", T0 + dt.timedelta(seconds=300 * rng.randrange(200))) for _ in range(6000)]
    seen += seen[:500] + [("a", None, T0), ("b", None, T0 + dt.timedelta(minutes=5)), ("z", "d0", T0 + dt.timedelta(days=9))] + [("a", "last", T0 + dt.timedelta(days=9))] * 2
    edges = spark.createDataFrame([("l", "a", "b"), ("m", "b", "a")], "link_code string, origin_code string, destination_code string")
    src = feed(spark, tmp_path, seen, "station_code string, device string, ts timestamp")
    q = stream_match(src, edges, buckets=8).writeStream.format("memory").queryName("many").outputMode("append").option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    q.awaitTermination()
    got = sorted((r.link_code, str(r.device), r.ts, r.value) for r in spark.table("many").collect())
    want = sorted((r.link_code, str(r.device), r.ts, r.value) for r in trips.match_trips(spark.createDataFrame(seen, "station_code string, device string, ts timestamp"), edges).collect())
    assert got == want and len(want) > 500 and ("l", "None", T0, 300.0) in want
    assert 0 < max(o["numRowsTotal"] for p in q.recentProgress for o in p["stateOperators"]) <= 16


def test_an_end_waits_for_a_start_that_comes_later(spark, tmp_path):
    at = lambda c, s: (c, "x", T0 + dt.timedelta(seconds=s))
    schema, path = "station_code string, device string, ts timestamp", str(tmp_path / "in")
    for rows in ([at("z", 10000)], [at("b", 10900), at("a", 12000)], [at("a", 10500)], [at("z", 90000)]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
    edges = spark.createDataFrame([("l", "a", "b"), ("n", "z", "y")], "link_code string, origin_code string, destination_code string")
    src = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
    drain(stream_match(src, edges).writeStream.format("memory").queryName("late").outputMode("append"), tmp_path)
    assert [(r.ts, r.value) for r in spark.table("late").collect()] == [(T0 + dt.timedelta(seconds=10500), 400.0)]


def test_merge(spark, tmp_path):
    schema = "station_code string, value double, ts timestamp"
    state = {"now": [("s", 9.0, T0 + dt.timedelta(minutes=1)), ("s", 1.0, T0 + dt.timedelta(minutes=500)), ("other", 5.0, T0)]}
    src = feed(spark, tmp_path, [("s", float(i), T0 + dt.timedelta(minutes=2 * i)) for i in range(4)], schema, parts=1)
    read = lambda keys: spark.createDataFrame(state["now"], schema)

    def write(keys, rows):
        gone = {r.station_code for r in keys.collect()}
        state.update(now=[x for x in state["now"] if x[0] not in gone] + [(r.station_code, r.value, r.ts) for r in rows.collect()])

    drain(stream_merge(src, read, write), tmp_path)
    assert sorted(v for _, v, _ in state["now"]) == [0.0, 1.0, 1.0, 2.0, 3.0, 5.0]


def test_latest_cache(spark, tmp_path):
    schema = "station_code string, value double, ts timestamp"
    state = {"old": (9.0, T0 + dt.timedelta(minutes=90)), "late": (7.0, T0 + dt.timedelta(days=1))}
    rows = [(c, float(i), T0 + dt.timedelta(minutes=20 * i)) for i in range(6) for c in ("old", "late", "new")]
    read = lambda keys: spark.createDataFrame([(c, v, t) for c, (v, t) in state.items()], schema)
    write = lambda keys, rows: state.update({r.station_code: (r.value, r.ts) for r in rows.collect()})
    drain(stream_latest(feed(spark, tmp_path, rows, schema), read, write), tmp_path)
    assert state == {"old": (5.0, rows[-1][2]), "new": (5.0, rows[-1][2]), "late": (7.0, T0 + dt.timedelta(days=1))}


def test_dense_counts(spark, tmp_path):
    rows = [("s", 1.0, T0 + dt.timedelta(minutes=m)) for m in (5, 6, 70, 400, 401, 700)]
    src = feed(spark, tmp_path, rows, "station_code string, value double, ts timestamp")
    drain(stream_counts(src, 3600, delay="1 minute").writeStream.format("memory").queryName("counts").outputMode("append"), tmp_path)
    got = {(r.ts - T0).total_seconds() / 3600 - 0.5: r.value for r in spark.table("counts").collect()}
    assert got == {0: 2, 1: 1, 2: 0, 3: 0, 4: 0, 5: 0, 6: 2}
