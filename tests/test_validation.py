"""Validation of traffic: who lends history, which day a flag depends on, and histories that follow day by day."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from stationflow.operators import moments, quality

TRAFFIC = "station string, lane long, time timestamp, value double"
HISTORY = "station string, lane long, date date, total_traffic double"


def day(i, month=3):
    return dt.date(2024, month, 1) + dt.timedelta(days=i)


def none(spark):
    return spark.createDataFrame([], "date date")


@pytest.fixture(scope="module")
def places(spark):
    return spark.createDataFrame([(s, float(k)) for k, s in enumerate("ABCDEFG")], "station string, km double")


@pytest.mark.parametrize("batch", ["A", "AD", "ABD"])
def test_all_stations_with_a_place_lend_history(spark, places, batch):
    history = spark.createDataFrame([(s, 1, day(i), v) for s, v in (("B", 1.0), ("D", 901.0)) for i in range(20)], HISTORY)
    wanted = spark.createDataFrame([(s, "NORD", 3, "Feriale") for s in batch], "station string, direction string, month int, day_type string").join(places, "station")
    known = quality.History.of(history, none(spark))
    got = {r.station: r.m1 for r in known.compared(wanted, places, 3, 10).collect()}
    assert got["A"] == 451.0 and all(got[s] == {"B": 1.0, "D": 901.0}[s] for s in batch[1:])
    lanes = quality.lane_history(quality.day_type(history, none(spark)), wanted, 3, 10, places)
    assert {r.station: r["mean"] for r in quality.history_stats(lanes).collect()} == got


def rows(spark, places, days, **options):
    """Flags of traffic: B, C and D are near A on the 5th, others only on the 4th."""
    rng = random.Random(3)
    at = lambda d, s: dt.datetime(2024, 3, d, 10 + ord(s) % 3)
    there = {4: "ABCDEFG", 5: "ADEFG", 6: "ABG"}
    traffic = [(s, 1 + k % 4, at(d, s), 40.0 + 13 * ord(s) % 50 + d) for d in days for k in range(2) for s in there[d]]
    history = spark.createDataFrame([(s, lane, day(i), rng.uniform(50, 90)) for s in "ABDE" for lane in (1, 2, 3, 4, 5) for i in range(0, 5)], HISTORY)
    out = quality.validate_traffic(spark.createDataFrame(traffic, TRAFFIC), history, places, none(spark), history_shift_days=0, **options)
    return {(r.station, r.lane, r.time): tuple(r)[4:] for r in out.collect()}


def test_flags_of_a_day_do_not_depend_on_other_days(spark, places):
    alone, both = rows(spark, places, [5]), rows(spark, places, [4, 5])
    assert alone and {k: v for k, v in both.items() if k[2].day == 5} == alone


def test_only_dates_that_both_have(spark, places):
    assert {k[2].day for k in rows(spark, places, [4, 5, 6])} == {4, 5}


def test_history_that_follows_day_by_day(spark, places, tmp_path):
    rng = random.Random(7)
    every = [(s, lane, day(i), None if rng.random() < 0.05 else round(rng.uniform(0, 500), 1)) for s in "ABCD" for lane in range(1, 6) for i in range(90) if rng.random() < 0.9 and (s, lane) != ("C", 2)]
    every += [("E", 1, day(i), 5.0) for i in range(3)] + [("E", 2, day(i), 0.0) for i in range(3)] + every[:40]
    frame = lambda some: spark.createDataFrame(some, HISTORY)
    whole = quality.History.of(frame(every), none(spark))
    first = [(s, lane, d, (v or 0.0) * 7 + 1 if d == day(11) else v) for s, lane, d, v in every if d < day(60)] + [("F", 1, day(70), 3.0)]
    known = quality.History.of(frame(first), none(spark))
    for chunk in ([r for r in every if day(60) <= r[2] < day(61) or r[2] == day(11)], [r for r in every if r[2] >= day(61)] + [("F", 1, day(70), 8.0)]):
        known = known.updated(frame(chunk), none(spark))
    whole = quality.History.of(frame(every + [("F", 1, day(70), 8.0)]), none(spark))
    for name, key in (("moments", whole.KEY), ("counts", ("station", *quality.DAY)), ("days", ("station", "lane", "date"))):
        a, b = ({tuple(r[k] for k in key): r.asDict() for r in getattr(h, name).collect()} for h in (known, whole))
        assert set(a) == set(b) and len(a) > 10
        for k in a:
            assert a[k] == {c: pytest.approx(v, rel=1e-9, abs=1e-6) if isinstance(v, float) else v for c, v in b[k].items()}
    traffic = spark.createDataFrame([(s, lane, dt.datetime(2024, 3, 1 + i, 8), 100.0 + 10 * lane + i) for s in "ABCDEFG" for lane in (1, 2, 3, 4) for i in range(12)], TRAFFIC)
    flags = lambda h: sorted(map(repr, quality.validate_traffic(traffic, h, places, none(spark)).collect()))
    assert flags(known) == flags(whole) and len(flags(whole)) == 7 * 4 * 12


def test_a_history_is_read_not_computed_again(spark):
    """Of three days' updates nothing is left in the tasks of what follows: no grouping, join or shuffle of the past."""
    known = quality.History.of(spark.createDataFrame([("A", lane, day(i), 5.0 + i) for lane in (1, 2) for i in range(20)], HISTORY), none(spark))
    for i in (19, 20, 21):
        known = known.updated(spark.createDataFrame([("A", lane, day(i), 7.0) for lane in (1, 2)], HISTORY), none(spark))
    for table in (known.days, known.moments, known.counts):
        plan = table._jdf.queryExecution().executedPlan().toString()
        assert not any(step in plan for step in ("Exchange", "Aggregate", "Join", "Union")), plan
    assert known.days.count() == 44 and known.counts.agg(F.sum("rows")).first()[0] == 44


def test_moments_merge_and_part(spark):
    rng = random.Random(1)
    values = [(rng.choice("abc"), rng.gauss(1e6, 1)) for _ in range(300)] + [("d", 5.0), ("d", None)]
    frame = lambda some: spark.createDataFrame(some, "k string, x double").groupBy("k").agg(*moments.moments("x", "x"), F.count(F.lit(1)).alias("rows"))
    stats = lambda m: {r.k: [-1 if x is None else x for x in (r.rows, r.m, r.s, r.p)] for r in m.select("k", "rows", moments.average("x").alias("m"), moments.deviation("x").alias("s"), moments.deviation("x", sample=False).alias("p")).collect()}
    near = lambda got, want: set(got) == set(want) and all(got[k] == pytest.approx(want[k], rel=1e-6) for k in want)
    whole, a, b = frame(values), frame(values[:100]), frame(values[100:])
    assert near(stats(moments.combined(a, b, ["k"], ["x"], ["rows"])), stats(whole)) and stats(whole)["d"] == [2, 5.0, -1, 0.0]
    assert near(stats(moments.combined(whole, b, ["k"], ["x"], ["rows"], -1)), stats(a))
    assert moments.combined(whole, whole, ["k"], ["x"], ["rows"], -1).count() == 0


def test_lane_history_is_shuffled_once_to_its_stations(spark, places):
    history = spark.createDataFrame([(s, lane, day(i), float(ord(s) + lane + i)) for s in "ABCDEFG" for lane in (1, 2, 3) for i in range(5 + ord(s) % 9)], HISTORY)
    history = quality.day_type(history, none(spark))
    wanted = places.crossJoin(spark.createDataFrame([(d, 3, k) for d in ("NORD", "SUD") for k in ("Feriale", "Festivo")], "direction string, month int, day_type string"))
    lanes = quality.lane_history(history, wanted, 2, 20, places)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for make in (quality.history_stats, quality.lane_ratio_stats):
            plan = make(lanes)._jdf.queryExecution().executedPlan()
            # what stands above the union of own and lent days has one exchange
            above = plan.toString().split("\n")
            union = next(k for k, line in enumerate(above) if "Union" in line)
            assert sum("Exchange" in line for line in above[:union]) == 1
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_ratios_of_days_with_one_lane(spark):
    rows = [("s", 1, 0, 4.0), ("s", 2, 0, 2.0), ("s", 1, 1, 0.0), ("s", 2, 2, 5.0), ("s", 1, 3, 9.0), ("s", 2, 3, 3.0)]  # a first lane's zero alone is no divisor
    rows += [("t", 1, 0, 4.0), ("t", 2, 0, 2.0), ("t", 2, 1, 0.0), ("u", 1, 0, 1.0), ("u", 2, 1, 1.0), ("v", 2, 0, 1.0), ("w", 1, 0, 1.0), ("w", 2, 0, 1.0), ("w", 3, 1, 1.0)]
    lanes = spark.createDataFrame([(s, "NORD", 3, "Feriale", lane, day(d), v) for s, lane, d, v in rows], "station string, direction string, month int, day_type string, lane long, date date, mean_v double")
    got = {r.station: (r["mean"], r["std"]) for r in quality.lane_ratio_stats(lanes).collect()}
    assert got == {"s": (2.5, pytest.approx(0.5**0.5)), "u": (None, None)}
