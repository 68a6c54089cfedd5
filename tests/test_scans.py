"""Scans in buckets and blocks give what a scan of the whole series gives."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from stationflow.operators import grids, quality, scans

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "station_code string, ts timestamp, value double, id long"


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


@pytest.fixture(scope="module", params=[1])
def data(request):
    rng = random.Random(request.param)
    out = []
    for k in ("a", "b", None):
        times = sorted(rng.sample(range(0, 400), 90)) + [5000, 5001]
        for t in times:
            out.append((k, at(t), rng.choice([None, 1.0, 1.0, 1.0, 2.0, float(t)])))
    return [(*r, i) for i, r in enumerate(out)]


@pytest.fixture(scope="module")
def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA).repartition(3)


def by_key(data):
    out = {}
    for r in sorted(data, key=lambda r: r[1]):
        out.setdefault(r[0], []).append(r)
    return out.values()


@pytest.mark.parametrize("bucket", [None, 1, 7, 10**6])
def test_asof_over_buckets(spark, data, frame, bucket):
    rng = random.Random(9)
    probe = [(rng.choice(["a", "b", None]), at(rng.choice([rng.randint(-20, 450), rng.randint(4990, 5010)])), i) for i in range(120)]
    p = spark.createDataFrame(probe, "station_code string, ts timestamp, probe long")
    pad = {r.probe: r.v for r in grids.asof_pad(p, frame, ["station_code"], name="v", bucket_s=bucket).collect()}
    near = {r.probe: r.v for r in grids.asof_nearest(p, frame, ["station_code"], name="v", within_s=50, bucket_s=bucket).collect()}
    line = {r.probe: r.v for r in grids.interpolate_at(p, frame, ["station_code"], name="v", max_gap_s=60, bucket_s=bucket).collect()}
    assert len(pad) == len(near) == len(line) == len(probe)
    for k, t, i in probe:
        own = [r for r in data if r[0] == k and r[2] is not None]
        before, after = [r for r in own if r[1] <= t], [r for r in own if r[1] >= t]
        b, a = max(before, key=lambda r: r[1], default=None), min(after, key=lambda r: r[1], default=None)
        assert pad[i] == (b and b[2])
        far = lambda r: abs((r[1] - t).total_seconds())
        n = a if b is None or a is not None and far(a) <= far(b) else b
        assert near[i] == (n[2] if n is not None and far(n) < 50 else None)
        gap = (a[1] - b[1]).total_seconds() if a and b else None
        want = None if gap is None or gap > 60 else b[2] if gap == 0 else b[2] + (t - b[1]).total_seconds() / gap * (a[2] - b[2])
        assert line[i] == (want if want is None else pytest.approx(want))


def test_equal_times_take_the_largest_value(spark):
    s = spark.createDataFrame([("a", at(t), v) for t, v in ((5, 1.0), (5, 9.0), (5, 3.0), (50, 2.0), (50, 8.0), (50, 4.0))], "station_code string, ts timestamp, value double")
    p = spark.createDataFrame([("a", at(t)) for t in (0, 5, 10, 45, 60)], "station_code string, ts timestamp")
    for bucket in (None, 1, 20, 1000):
        got = sorted((r.ts, r.v) for r in grids.asof_nearest(p, s, ["station_code"], name="v", within_s=None, bucket_s=bucket).collect())
        assert [v for _, v in got] == [9.0, 9.0, 9.0, 8.0, 8.0]


@pytest.mark.parametrize("bucket", [None, 3, 40])
def test_gaps_over_buckets(data, frame, bucket):
    got = {r.id: r.value for r in grids.interpolate_linear(frame, ["station_code"], bucket_s=bucket).collect()}
    for rows in by_key(data):
        known = [(r[1], r[2]) for r in rows if r[2] is not None]
        for r in rows:
            before, after = [x for x in known if x[0] <= r[1]], [x for x in known if x[0] >= r[1]]
            want = r[2] if r[2] is not None else before[-1][1] if not after and before else None
            if r[2] is None and before and after:
                (bt, bv), (nt, nv) = before[-1], after[0]
                want = bv + (r[1] - bt) / (nt - bt) * (nv - bv)
            assert got[r[3]] == (want if want is None else pytest.approx(want))


@pytest.mark.parametrize("bucket", [None, 1, 9, 150])
def test_runs_over_buckets(data, frame, bucket):
    found = {r.id: (r._len, r._at, str(r._run)) for r in scans.runs(frame, ["station_code"], "value", bucket).collect()}
    hit = lambda ts: (ts - T0).total_seconds() >= 200
    marked = frame.withColumn("ts", F.expr("ts + interval 5 hours 56 minutes 40 seconds"))  # 06:00 is at 200 s
    stuck = {r.id: r.value for r in quality.null_stuck(marked, 4, bucket_s=bucket).collect()}
    filled = {r.id: r.value for r in quality.fill_stuck(frame, 3, per_hour=1, bucket_s=bucket).collect()}
    for rows in by_key(data):
        runs = []
        for i, r in enumerate(rows):
            if i and rows[i - 1][2] == r[2]:
                runs[-1].append(r)
            else:
                runs.append([r])
        place = {r[3]: i for i, r in enumerate(rows)}
        assert len({found[run[0][3]][2] for run in runs}) == len(runs)
        for run in runs:
            first = next((i for i, r in enumerate(run, 1) if hit(r[1]) and i >= 4), None)
            for i, r in enumerate(run, 1):
                assert found[r[3]][:2] == (len(run), i) and found[r[3]][2] == found[run[0][3]][2]
                assert stuck[r[3]] == (None if first and i > first - 4 else r[2])
                donors = [rows[place[r[3]] - n][2] for n in (168, 24) if place[r[3]] >= n]
                want = next((d for d in donors if d is not None and d > 0), None)
                assert filled[r[3]] == (want if len(run) >= 3 and r[2] is not None else r[2])


@pytest.mark.parametrize("bucket,block", [(None, 5), (2, 5), (50, 17)])
def test_rows_before(data, frame, bucket, block):
    lag = lambda n: lambda w: F.lag("value", n).over(w)
    got = {r.id: (r.x, r.y) for r in scans.within(frame, ["station_code"], 12, {"x": lag(1), "y": lag(12)}, bucket_s=bucket, block=block).collect()}
    mean = {r.id: r.running_mean for r in grids.running_mean(frame, 6, bucket_s=bucket).collect()}
    assert len(got) == len(mean) == len(data)
    for rows in by_key(data):
        for i, r in enumerate(rows):
            assert got[r[3]] == (rows[i - 1][2] if i >= 1 else None, rows[i - 12][2] if i >= 12 else None)
            known = [x[2] for x in rows[max(0, i - 6) : i + 1] if x[2] is not None]
            assert mean[r[3]] == (pytest.approx(sum(known) / len(known)) if known else None)


def test_no_task_reads_more_than_a_bucket(spark):
    """One series of 20,000 rows in 200 buckets: the windows over rows are dealt by bucket, and only summaries by series."""
    s = spark.range(20_000).select(F.lit("hot").alias("station_code"), F.timestamp_seconds(F.col("id")).alias("ts"), F.when(F.col("id") % 3 == 0, F.col("id").cast("double")).alias("value"))
    out = grids.interpolate_linear(s, ["station_code"], bucket_s=100)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        sizes = [r.n for r in out.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n"), F.sum("value")).collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(sizes) == 20_000 and len(sizes) >= 12 and max(sizes) < 5000
