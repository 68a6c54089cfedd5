"""Edge rows of the operators."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from stationflow import functions as fn
from stationflow import sources
from stationflow.operators import air, catalog, dispersion, emissions, forecast, grids, incremental, parking, quality, roadwx, rollups, store, trips

T0 = dt.datetime(2024, 1, 1)


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


def series(spark, rows, value="double"):
    return spark.createDataFrame([("s", at(t), v) for t, v in rows], f"station_code string, ts timestamp, value {value}")


def values(df, *cols):
    return [tuple(r) for r in df.select(*cols).collect()]


def one(spark, column):
    return spark.range(1).select(column.alias("c")).first().c


def test_window_count_edges(spark):
    m = series(spark, [(0, 1.0), (3599, 1.0), (3600, 1.0), (3 * 3600, 1.0)])
    got = sorted(values(grids.window_count(m, 3600), "ts", "value"))
    assert got == [(at(1800), 2), (at(5400), 1), (at(9000), 0), (at(12600), 1)]
    odd = grids.window_count(series(spark, [(100, 1.0), (86000, 1.0)]), 50000)
    assert sorted(values(odd, "ts", "value")) == [(at(25000), 1), (at(75000), 1)]


def test_mode_ties_and_width(spark):
    t = spark.createDataFrame([("l", "d", at(10), v) for v in (100.0, 129.9, 200.0, 229.0)] + [("l", "d", at(90000), 50.0)], "link_code string, device string, ts timestamp, value double")
    got = sorted(values(trips.travel_time_mode(t, 86400), "ts", "value"))
    assert got == [(at(43200), 115.0), (at(129600), 65.0)]
    assert trips.travel_time_mode(t, 86400, most_windows=1).count() == 1


def test_mode_needs_no_row_for_empty_windows(spark):
    t = spark.createDataFrame([("l", "d", at(0), 10.0), ("l", "d", at(7200), 10.0)], "link_code string, device string, ts timestamp, value double")
    assert trips.travel_time_mode(t, 3600).count() == 2 and trips.trip_count(t, 3600).count() == 3


def test_match_trips_edges(spark):
    edges = spark.createDataFrame([("l", "a", "b", 1000.0)], "link_code string, origin_code string, destination_code string, length_m double")

    def match(*seen):
        s = spark.createDataFrame([(c, "d", at(t)) for c, t in seen], "station_code string, device string, ts timestamp")
        return sorted((r.ts, r.value) for r in trips.match_trips(s, edges).collect())

    assert match(("a", 0), ("b", 0)) == [] and match(("a", 0), ("b", 3600)) == []
    assert match(("a", 0), ("b", 3599), ("b", 3599), ("b", 20)) == [(at(0), 20.0)]
    assert match(("a", 0), ("a", 10), ("b", 20)) == [(at(10), 10.0)]
    assert match(("a", 0), ("a", 20), ("b", 20)) == []
    assert match(("a", 0), ("b", 20), ("a", 21)) == [(at(0), 20.0)]


def test_hourly_average_edges(spark):
    rows = [(0, 9.0)] + [(3600 + 60 * i, 1.0) for i in range(5)] + [(7200, 3.0)] + [(7300 + i, 5.0) for i in range(4)] + [(10900 + i, 7.0) for i in range(5)]
    m = series(spark, rows).withColumn("type_name", F.lit("x"))
    late = rollups.hourly_average(m, F.lit(at(99999)))
    # the row at 3600 belongs to the hour that ends there; the first full hour is not used, the last isn't complete
    assert sorted(values(late, "ts", "value")) == [(at(7200), pytest.approx(7 / 5))]
    soon = rollups.hourly_average(m, F.lit(at(14400)))
    assert sorted(values(soon, "ts", "value")) == [(at(7200), pytest.approx(7 / 5)), (at(14400), 7.0)]


def test_asof_edges(spark):
    probe = series(spark, [(0, 0.0), (100, 0.0), (400, 0.0), (1000, 0.0)]).drop("value")
    s = series(spark, [(50, 1.0), (150, 2.0), (400, None), (699, 3.0)])
    near = grids.asof_nearest(probe, s, ["station_code"], within_s=300)
    assert sorted(values(near, "ts", "value_nearest")) == [(at(0), 1.0), (at(100), 2.0), (at(400), 2.0), (at(1000), None)]
    assert sorted(values(grids.asof_pad(probe, s, ["station_code"], max_age_s=100), "ts", "value_asof"))[0] == (at(0), None)
    between = grids.interpolate_at(probe, s, ["station_code"], max_gap_s=549)
    assert sorted(values(between, "ts", "value_at")) == [(at(0), None), (at(100), 1.5), (at(400), pytest.approx(2 + 250 / 549)), (at(1000), None)]
    assert sorted(values(grids.interpolate_at(probe, s, ["station_code"], max_gap_s=548), "ts", "value_at"))[2][1] is None
    assert sorted(values(grids.interpolate_at(s.select("station_code", "ts"), s, ["station_code"]), "ts", "value_at"))[1] == (at(150), 2.0)


def test_interpolation_ends(spark):
    g = series(spark, [(0, None), (1, 1.0), (2, None), (3, 3.0), (4, None)])
    assert sorted(values(grids.interpolate_linear(g, ["station_code"]), "ts", "value")) == [(at(0), None), (at(1), 1.0), (at(2), 2.0), (at(3), 3.0), (at(4), 3.0)]
    assert grids.lag_set(1) == [*range(1, 25), 47, 48, 49, 71, 72, 73, 95, 96, 97, 119, 120, 121, 143, 144, 145, 167, 168, 169] and len(grids.lag_set(1, "full")) == 168


def test_change_set_edges(spark):
    new = series(spark, [(0, 1.0), (60, 2.0), (120, 3.5), (180, None)])
    old = series(spark, [(60, 2.0), (120, 3.0), (180, 4.0), (240, 5.0), (9999, 6.0)])
    lo, hi = F.lit(at(0)), F.lit(at(300))
    got = sorted(values(store.change_set(new, old, lo, hi, ["station_code"]), "ts", "value", "op"))
    assert got == [(at(0), 1.0, "insert"), (at(120), 3.5, "update"), (at(180), None, "update"), (at(240), 5.0, "delete")]
    assert [r.op for r in store.change_set(new, old, lo, hi, ["station_code"], reference_updates=True).collect()].count("update") == 0
    assert sorted(r.op for r in store.change_set(new, old, lo, hi, ["station_code"], ext_key=True).collect()) == ["delete", "delete", "delete", "insert", "insert", "insert"]
    after = store.apply_changes(old, store.change_set(new, old, lo, hi, ["station_code"]), ["station_code"])
    assert store.change_set(new, after, lo, hi, ["station_code"]).count() == 0 and after.count() == 5
    with pytest.raises(Exception, match="outside"):
        store.change_set(new, old, F.lit(at(200)), hi, ["station_code"]).collect()
    none = new.limit(0)
    assert store.change_set(none, old, lo, hi, ["station_code"]).count() == 4


def test_latest_and_cache(spark):
    m = series(spark, [(0, 1.0), (9, None), (9, 2.0), (9, 3.0)])
    assert values(store.latest(m, ["station_code"]), "ts", "value") == [(at(9), 2.0)]
    cache = spark.createDataFrame([("s", at(9), None), ("t", at(1), None)], "station_code string, ts timestamp, value double")
    got = {r.station_code: (r.value, r.op) for r in store.refresh_latest(cache, m.unionByName(spark.createDataFrame([("u", at(5), 7.0)], m.schema)), ["station_code"]).collect()}
    assert got == {"s": (2.0, "update"), "t": (None, "keep"), "u": (7.0, "insert")}


def test_thresholds(spark):
    rate = lambda v: one(spark, fn.no2_rating(F.lit(v)))
    assert [rate(v) for v in (340.0, 339.9, 230.0, 120.0, 90.0, 40.0, 39.9, 0.0, -1.0)] == ["extremely poor", "very poor", "very poor", "poor", "moderate", "fair", "good", "good", None]
    impact = lambda p, v: one(spark, fn.emission_impact(F.lit(p), F.lit(v)))
    assert [impact("NOx", 120.0), impact("NOx", 120.1), impact("NOx", 60.0), impact("CO2", 35000.1), impact("SO2", 1.0)] == ["medium", "high", "low", "medium", "undefined"]
    free = lambda c, v: one(spark, fn.remaining(F.lit(c).cast("double"), F.lit(v)))
    assert [free(10, 3.7), free(10, 12.0), free(0, 1.0), free(None, 1.0)] == [6, 0, None, None]
    band = lambda v: one(spark, fn.concentration_band(F.lit(v)))
    assert [band(0.9), band(1.0), band(99.0), band(500.0)] == [None, 1, 50, 100]


def test_road_condition_tree(spark):
    rc = lambda *a: tuple(one(spark, fn.road_condition(*(F.lit(x) for x in a))))
    assert [rc(4, 1.0, 0.0), rc(5, -1.0, 0.0), rc(4, 0.0, 0.0), rc(6, 1.0, 0.0), rc(6, -1.0, 0.0), rc(6, 0.0, 1.0)] == [(2, 1), (8, 1), (2, 0), (6, 1), (3, 1), (3, 0)]
    assert [rc(1, 0.0, 0.0), rc(1, 1.0, 2.0), rc(1, 2.0, 1.0)] == [(1, 0), (5, 1), (1, 1)]
    assert one(spark, fn.road_condition_label(F.lit("RC8"))) == "Icing rain"


def test_stability(spark):
    cls = lambda r, w, day="2024-01-15", **k: one(spark, fn.pg_stability(F.lit(r).cast("double"), F.lit(w), F.lit(day).cast("timestamp"), **k))
    assert [cls(540, 2.0), cls(540, 2.5), cls(700, 2.5), cls(400, 3.5), cls(540, 4.5), cls(270, 5.5), cls(540, 9.0), cls(10, 1.0)] == ["A", "B", "A", "B", "B", "C", "C", "D"]
    assert [cls(0, 3.0), cls(0, 5.0), cls(0, 5.1), cls(0, 9.0, "2024-07-01"), cls(0, 2.0, "2024-04-01"), cls(0, 3.0, "2024-04-01")] == ["F", "E", "D", "D", "F", "E"]
    assert cls(None, 3.0) == "F" and cls(None, 3.0, missing_radiation="null") is None


def test_wind_direction(spark):
    df = spark.createDataFrame([(350.0,), (10.0,), (float("nan"),)], "d double")
    assert df.agg(fn.mean_angle(F.col("d")).alias("a")).first().a % 360 == pytest.approx(0, abs=1e-9)


def test_names(spark):
    name = F.lit("A KM. 227+600 (corsia di marcia nord, direzione nord)")
    assert one(spark, fn.direction_of(name)) == "nord" and one(spark, fn.name_without_lane(name)) == "A KM. 227+600 (direzione nord)"
    lanes = spark.createDataFrame([("R1:1:1", "P KM. 1 (corsia di marcia nord, direzione nord)", 1.0, 2.0), ("R1:1:2", "P KM. 1 (corsia di sorpasso nord, direzione nord)", 3.0, 4.0), ("R1:1:3", "P KM. 1 (corsia di marcia sud, direzione sud)", 5.0, 6.0)], "station_code string, name string, x double, y double")
    dirs = rollups.combine_directions(lanes)
    assert sorted(values(dirs, "station_code", "x", "parent_code")) == [("R1:1:nord", 1.0, "R1:1"), ("R1:1:sud", 5.0, "R1:1")]
    assert values(rollups.combine_locations(dirs), "station_code", "name", "x") == [("R1:1", "P KM. 1 (direzione", 3.0)]
    assert one(spark, fn.code_part(F.lit("a:b"), 1)) is None and one(spark, fn.code_part(F.lit("a:b:c"), 1)) == "b"


def test_attach_sensor_gaps(spark):
    m = series(spark, [(0, 1.0), (86400, 1.0), (86401, 1.0), (3 * 86400, 1.0), (5 * 86400, 1.0), (9 * 86400, 1.0)])
    h = spark.sql("SELECT 's' AS station_code, array(named_struct('id','a','start','2024-01-01','end','2024-01-02'), named_struct('id','','start','2024-01-02','end','2024-01-03'), named_struct('id','c','start','2024-01-05','end','2024-01-07')) AS history")
    assert sorted(values(air.attach_sensor(m, h), "ts", "sensor_id")) == [(at(0), "a"), (at(86400), "a"), (at(5 * 86400), "c")]


def test_calibration_edges(spark):
    p = spark.createDataFrame([("x", t, temp, 1, 1.0, 1.0, 0.0, 0.0, 0.0, 0.0) for t in (air.CO, air.PM10, air.O3) for temp in ("hightemp", "lowtemp")], "sensor_id string, type_name string, temperature string, calc_version int, a double, b double, c double, d double, e double, f double")
    cols = f"sensor_id string, station_code string, ts timestamp, `{air.CO}` double, `{air.PM10}` double, `{air.RH}` double, `{air.T}` double, `{air.NO2}` double, `{air.O3}` double"
    wide = spark.createDataFrame([("x", "s", at(0), -9.0, 101.0, 50.0, 35.0, None, 1.0), ("x", "s", at(1), 2.0, 32.0, 98.0, 10.0, None, None), ("x", "s", at(2), 2.0, -1.0, 50.0, 10.0, None, None), ("x", "s", at(3), 2.0, 1.0, 50.0, None, None, None)], cols)
    got = sorted((r.ts, r.type_name, r.value) for r in air.calibrate(wide, p).collect())
    assert got == [(at(0), "CO_processed", 0.0), (at(1), "CO_processed", 3.0), (at(2), "CO_processed", 3.0)]


def test_layer3_and_flags(spark):
    def valid(*vs):
        df = spark.createDataFrame([("s", "N", at(i), float(v)) for i, v in enumerate(vs)], "station string, direction string, time timestamp, value double")
        return [r.is_valid for r in quality.layer3(df).orderBy("time").collect()]

    assert valid(50, 0, 7) == [True, False, True] and valid(49, 0, 7) == [True, True, True]
    assert valid(0, 0, 0, 5) == [True] * 4 and valid(0, 0, 0, 0, 5) == [False] * 4 + [True] and valid(5, 0, 0, 0, 0) == [True] + [False] * 4
    flag = lambda z, lo, hi: one(spark, quality.zflag(F.lit(z).cast("double"), lo, hi))
    assert [flag(-2.5, -2.5, None), flag(-2.6, -2.5, None), flag(9.0, -2.5, None), flag(5.1, -5, 5), flag(None, -1, 1), flag(float("nan"), None, None)] == [True, False, True, False, None, False]
    ok = lambda a, b, c: one(spark, quality.overall_validity(*(F.lit(x).cast("boolean") for x in (a, b, c))))
    assert [ok(True, None, True), ok(False, True, True), ok(False, False, True), ok(None, None, True), ok(None, None, None), ok(True, None, False), ok(False, None, True)] == [1, 1, 0, 1, 999, 0, 0]


def test_history_stats_borrow_from_neighbours(spark):
    day = lambda i, month=1: dt.date(2024, month, 1 + i)
    h = [("a", 1, day(i), "Feriale", 100.0 + i) for i in range(10)] + [("a", 5, day(0), "Feriale", 9999.0)] + [("b", 1, day(i), "Feriale", 5.0) for i in range(9)]
    h += [("a", 1, day(i, 7), "Feriale", 1000.0 + i) for i in range(12)] + [("d", lane, day(i), "Feriale", 10.0 * lane) for i in range(5) for lane in (1, 2)]
    history = spark.createDataFrame(h, "station string, lane long, date date, day_type string, total_traffic double")
    wanted = spark.createDataFrame([(s, km, "NORD", m, "Feriale") for s, km in (("a", 1.0), ("b", 2.0), ("c", None), ("d", 3.0)) for m in (1, 7)], "station string, km double, direction string, month int, day_type string")
    lanes = quality.lane_history(history, wanted, 1)
    got = {(r.station, r.month): r for r in quality.history_stats(lanes).collect()}
    # months apart, lane 5 left out; b has nine rows, so it and its nearest are averaged; in July only a has any
    assert got["a", 1]["mean"] == 104.5 and got["a", 7]["mean"] == 1005.5 and not got["d", 1].borrowed and got["d", 1]["mean"] == 30.0
    assert got["b", 1].borrowed and got["b", 1]["mean"] == pytest.approx((sum((100.0 + i + 5.0) / 2 for i in range(9)) + 109.0) / 10)
    assert got["b", 7].borrowed and got["b", 7]["mean"] == 1005.5 and ("c", 1) not in got
    ratios = {(r.station, r.month): (r["mean"], r["std"]) for r in quality.lane_ratio_stats(lanes).collect()}
    assert ratios == {("d", 1): (0.5, 0.0)}


def test_pending_windows_boundary(spark):
    m = [("a", "x", at(0), 600), ("a", "x", at(86400), 600), ("a", "x", at(0), 86400), ("b", "x", at(0), 600), ("b", "x", at(86401), 600), ("b", "x", at(0), 86400), ("c", "x", at(3600), 600), ("c", "y", at(90000), 600), ("d", "x", at(3600), 600)]
    got = rollups.pending_windows(spark.createDataFrame(m, "station_code string, type_name string, ts timestamp, period int"), 600, 86400)
    assert sorted(values(got, "station_code", "type_name", "from_ts", "to_ts")) == [("b", "x", at(0), at(86400)), ("c", "y", at(3600), at(86400))]


def test_origin_and_metadata_of_combined_stations(spark):
    meta = '{"a22_metadata": "{\\"metro\\": \\"5\\", \\"autostrada\\": \\"A\\", \\"x\\": \\"y\\"}"}'
    lanes = spark.createDataFrame([("R:1:1", " P (corsia di marcia nord, direzione nord)", 1.0, 2.0, "o1", meta), ("R:1:3", " Q (corsia di marcia sud, direzione sud)", 1.0, 2.0, "o3", None)], "station_code string, name string, x double, y double, origin string, metadata string")
    dirs = rollups.combine_directions(lanes)
    assert sorted(values(dirs, "station_code", "origin", "metadata")) == [("R:1:nord", "o1", '{"a22_metadata":{"autostrada":"A","iddirezione":"","idspira":"","metro":"5"}}'), ("R:1:sud", "o3", None)]
    assert values(rollups.combine_locations(dirs.withColumn("name", F.concat(F.lit("  "), "name"))), "name", "origin") == [("", "o1")]


def test_stuck_runs(spark):
    rows = lambda vs, h=6: [(h * 3600 + 60 * i, float(v)) for i, v in enumerate(vs)]
    null = lambda vs, h=6: [r.value for r in quality.null_stuck(series(spark, rows(vs, h))).orderBy("ts").collect()]
    assert null([1, 1, 1, 1, 1, 2]) == [1, 1, 1, 1, 1, 2] and null([1, 1, 1, 1, 1, 1, 2]) == [None] * 6 + [2]
    late = [r.value for r in quality.null_stuck(series(spark, [(6 * 3600 - 60 * (8 - i), 1.0) for i in range(9)])).orderBy("ts").collect()]
    assert late == [1.0] * 3 + [None] * 6
    fill = lambda vs: [r.value for r in quality.fill_stuck(series(spark, rows(vs))).orderBy("ts").collect()]
    assert fill([3] * 11 + [4]) == [3] * 11 + [4] and fill([3] * 12) == [None] * 12
    donors = [float(i + 1) for i in range(24)]
    assert fill(donors + [99.0] * 12)[24:] == donors[:12]


def test_observation_checks(spark):
    def accepted(*rows, **k):
        df = spark.createDataFrame([("s", at(t), st, sst) for t, st, sst in rows], "station_code string, ts timestamp, st double, sst double")
        return quality.accept_observation(df, **k).first()

    assert accepted((0, 1.0, 1.0), (14400, 1.0, None)).accepted and not accepted((0, 1.0, 1.0), (14401, 1.0, None)).has_company
    assert not accepted((0, 1.0, 1.0)).has_two and not accepted((0, None, 1.0), (1, None, 1.0), (2, 1.0, 1.0), (3, 1.0, 1.0)).has_early
    assert accepted((0, None, 1.0), (1, None, 1.0), (2, 1.0, 1.0), (3, 1.0, 1.0), reference_precedence=True).accepted
    obs = spark.createDataFrame([("s", at(t), 5.0, 9.0, 3.0, 1.0, sst) for t, sst in ((0, 5.0), (15000, 99.0), (15000, 99.0), (15060, 7.0), (15120, 200.0))], "station_code string, ts timestamp, at double, td double, ws double, st double, sst double")
    got = quality.qc_observation(obs, F.lit(at(20000))).orderBy("ts").collect()
    assert [(r.ts, r.td, r.sst) for r in got] == [(at(15000), 5.0, None), (at(15060), 5.0, 7.0), (at(15120), 5.0, 7.0)]
    fc = spark.createDataFrame([("s", at(3600 * i), 1.0, 1.0, float(i), 0.0, 1.0, 1.0, 9.0 if i == 2 else 1.0) for i in range(3)], "station_code string, ts timestamp, at double, td double, ra double, sn double, ws double, ap double, cc double")
    report = quality.qc_forecast(fc, obs.select("station_code", "ts")).first()
    assert report.clouds == 1 and report.missing == report.falling == report.spacing == 0 and report.overlaps and not report.usable


def test_emission_formula(spark):
    f = lambda v, **k: one(spark, fn.copert_factor(F.lit(v), F.lit(10.0), F.lit(100.0), *(F.lit(k.get(n, 0.0)) for n in ("a", "b", "g", "d", "e", "z", "h", "euro", "fuel"))))
    assert f(50.0, a=1.0, h=2.0) == 1250.0 and f(500.0, b=1.0, h=1.0) == 100.0 and f(1.0, b=1.0, h=1.0, euro=0.5, fuel=0.5) == 2.5 and f(1.0) is None
    c = spark.createDataFrame([("M", "L", "p", 1, None, 1.0), ("M", "L", "p", 1, 2.0, 5.0)], "Location string, Category string, Fuel string, ID_Euro int, RoadSlope double, Alpha double")
    rows = spark.createDataFrame([("M", "L", "p", 1, None)], "Location string, Category string, Fuel string, ID_Euro int, RoadSlope double")
    assert [r.Alpha for r in emissions.with_coefficients(rows, c).collect()] == [1.0]
    slope = lambda lane, has: one(spark, fn.signed_slope(F.lit(2.0), F.lit(lane), F.lit(has)))
    assert [slope(1, True), slope(3, True), slope(1, False)] == [-2.0, 2.0, None]
    km = emissions.with_km(spark.createDataFrame([(1, 5.0), (2, 6.0)], "Station int, KM double"), spark.createDataFrame([(1, 9.6)], "Station int, km double"))
    sloped = emissions.with_slope(km.withColumns({"Lane": F.lit(1), "Category": F.lit("H")}), spark.createDataFrame([(10, 0.5)], "KM int, RoadSlope double"), ["H"])
    assert sorted(values(sloped, "Station", "KM", "RoadSlope")) == [(1, 9.6, -0.5), (2, 6.0, None)]


def test_road_weather(spark):
    grid = lambda **cols: spark.createDataFrame([("s", at(30 * i), *(float(v[i]) for v in cols.values())) for i in range(len(next(iter(cols.values()))))], "station_code string, ts timestamp, " + ", ".join(f"{c} double" for c in cols))
    fc = grid(at=[10, 10, 10, 10], td=[5, 5, 5, 5], ws=[2, 2, 2, 2])
    obs = grid(at=[12, 12], td=[20, 20], ws=[1, 1]).withColumns({f"{c}_valid": F.lit(c != "td") for c in ("at", "td", "ws")})
    got = roadwx.blend_obs_forecast(obs, fc).orderBy("ts").collect()
    assert [r["at"] for r in got][:2] == [12.0, 12.0] and 11.9 < got[2]["at"] < 12.0 and [r.td for r in got] == [5.0] * 4 and got[1].ws == 1.0 and 1.0 < got[3].ws < 1.01
    assert [r.qp for r in roadwx.gate_precip(obs.select("station_code", "ts", F.lit(0).alias("pi"), F.lit(2).alias("sc")), fc.withColumn("qp", F.lit(3.0))).orderBy("ts").collect()] == [0.0, 0.0, 3.0, 3.0]
    sun = spark.createDataFrame([("s", T0.date(), at(30), at(90))], "station_code string, date date, sunrise timestamp, sunset timestamp")
    assert [r.sst for r in roadwx.sst_at_sun(fc.withColumn("sst", F.lit(1.0)), sun).orderBy("ts").collect()] == [None, 1.0, None, 1.0]
    assert one(spark, fn.pressure_pa(F.lit(699.0))) == 101325.0 and one(spark, fn.pressure_pa(F.lit(1000.0))) == 100000.0
    assert roadwx.overall_confidence(spark.createDataFrame([("s", 1), ("s", 0)], "station_code string, confidence int")).first().confidence == 0


def test_dispersion(spark):
    emis = spark.createDataFrame([("t", at(0), 7.2)], "station_code string, ts timestamp, value double")
    meteo = spark.createDataFrame([("w", at(0), 1.0)], "station_code string, ts timestamp, wind_speed double")
    domains = spark.createDataFrame([(1, "t", "w"), (2, "t", "none")], "domain_id int, traffic_station string, weather_station string")
    both, lacking = dispersion.dispersion_inputs(emis, meteo, domains)
    assert [r.domain_id for r in both.collect()] == [1] and [r.domain_id for r in lacking.collect()] == [2]
    conc = spark.createDataFrame([(1, at(0), float("inf"))], "domain_id int, ts timestamp, value double")
    assert dispersion.scale_concentration(conc, both.select("domain_id", "ts", "value")).first().value is None


def test_increments(spark):
    lo = spark.createDataFrame([("s", at(0), at(250))], "station_code string, lo timestamp, hi timestamp")
    assert sorted(values(incremental.batches(lo, 100), "from_ts", "to_ts")) == [(at(0), at(100)), (at(100), at(200)), (at(200), at(250))]
    assert incremental.batches(lo, 100, F.lit(at(0))).count() == 0
    cp = spark.createDataFrame([("j", "s", at(90000), None), ("j", "x", at(0), at(10))], "job string, station_code string, checkpoint_ts timestamp, expires_at timestamp")
    ends = spark.createDataFrame([("j", "s", at(80000)), ("j", "t", at(5))], "job string, station_code string, end timestamp")
    got = {r.station_code: r.checkpoint_ts for r in incremental.advance_checkpoint(cp, ends, F.lit(at(100))).collect()}
    assert got == {"s": at(90000), "t": at(5)}
    st = spark.createDataFrame([("c", '{"sensor_type": "camera"}'), ("l", "{}")], "station_code string, metadata string")
    got = {r.station_code: r.start for r in incremental.start_dates(st, series(spark, [(0, 1.0)]), cp, F.lit("2020-01-01").cast("timestamp")).collect()}
    assert got == {"c": dt.datetime(2024, 7, 10), "l": dt.datetime(2020, 1, 1)}


def test_parking(spark):
    fc = spark.createDataFrame([("s", at(300 * i), at(300 * i + 300), float(i)) for i in range(4)], "station_code string, start timestamp, end timestamp, value double")
    assert [parking.forecast_at(fc, m).first().value for m in (1, 11, 999)] == [0.0, 1.0, 3.0]
    assert [r.value for r in parking.forecast_of(fc, "s").collect()] == [0.0, 1.0, 2.0, 3.0]
    runs = spark.createDataFrame([("s", dt.datetime(2024, 1, 1), [1.0, 2.0]), ("s", dt.datetime(2024, 1, 2), [1.0, None])], "station_code string, start timestamp, mean array<double>")
    truth = spark.createDataFrame([("s", d + dt.timedelta(seconds=300 * i), 4.0) for d in (dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)) for i in range(2)], "station_code string, ts timestamp, value double")
    assert sorted(values(parking.forecast_rmse(runs, truth, F.lit("2024-01-10").cast("timestamp"), "00:00:00"), "step", "rmse")) == [(0, 3.0), (1, 2.0)]
    assert one(spark, fn.weather_code(F.lit("c"))) == 2


@pytest.mark.parametrize("kind", ["linear", "trees"])
def test_recursive_forecast_equals_a_loop(spark, kind):
    import numpy as np

    rng = np.random.default_rng(1)
    past = (10 + 3 * np.sin(np.arange(40) / 3) + rng.normal(0, 0.3, 40)).tolist()
    names = ["lag_1", "lag_2", "running_mean", "slot"]
    signals = series(spark, [(300 * i, v) for i, v in enumerate(past)]).withColumn("slot", F.minute("ts").cast("double"))
    train = forecast.training_set(signals, F.lit("2025-01-01").cast("timestamp"), (1, 2), 2016)
    model = forecast.fit_linear(train, names, (), False) if kind == "linear" else forecast.fit_ensemble(train, names, 1, (), False, 3)[0]
    future = series(spark, [(300 * i, None) for i in range(40, 46)]).drop("value").withColumn("slot", F.minute("ts").cast("double"))
    got = [r.value for r in forecast.forecast_recursive(signals, model, names, 6, lags=(1, 2), future=future).orderBy("ts").collect()]
    want, mean = list(past), sum(past) / len(past)
    for i in range(40, 46):
        row = spark.createDataFrame([("s", want[-1], want[-2], mean, float(5 * i % 60))], "station_code string, lag_1 double, lag_2 double, running_mean double, slot double")
        want.append(model.transform(row).first().prediction)
    assert got == pytest.approx(want[40:]) and len(set(got)) > 1


def test_lots_have_models_of_their_own(spark):
    rows = [(c, at(3600 * i), float(f * (i % 24) + e)) for c, f, e in (("a", 1.0, 100.0), ("b", -3.0, 500.0)) for i in range(24 * 15)]
    m = spark.createDataFrame(rows, "station_code string, ts timestamp, value double")
    got = {(r.station_code, r.ts.hour): r for r in forecast.forecast_lots(m, lags=(24,)).collect()}
    assert len(got) == 48 and all(abs(got["a", h].free - (100 + h)) <= 2 and abs(got["b", h].free - (500 - 3 * h)) <= 4 for h in range(24))
    assert got["a", 5].hi - got["a", 5].lo < got["b", 5].hi - got["b", 5].lo


def test_catalog(spark):
    days = spark.sql("SELECT 'school' AS kind, DATE '2024-01-01' AS begin, DATE '2024-01-02' AS end UNION ALL SELECT 'holiday', DATE '2024-01-01', DATE '2024-01-01'")
    got = sorted(values(catalog.holiday_calendar(days, F.lit("2024-01-01"), F.lit("2024-01-07")), "date", "is_school", "is_holiday"))
    assert [(s, h) for _, s, h in got] == [(1, 1), (1, 0), (0, 0), (0, 0), (0, 0), (1, 0), (1, 1)]
    addresses = spark.createDataFrame([(None, None, "v", "h")], "city string, town string, village string, hamlet string")
    assert catalog.municipalities(addresses).first().municipality == "v"
    edges = spark.sql("SELECT 'l' AS link_code, CAST(NULL AS array<struct<x: double, y: double>>) AS geometry, 9D AS length_m")
    shapes = spark.sql("SELECT 'l' AS link_code, array(named_struct('x', 0D, 'y', 0D), named_struct('x', 3D, 'y', 4D), named_struct('x', 3D, 'y', 5D)) AS geometry")
    assert trips.update_link_geometry(edges, shapes).first().length_m == 6.0 and trips.update_link_geometry(edges, shapes.limit(0)).first().length_m == 9.0


def test_sources(spark, tmp_path):
    (tmp_path / "01__103__P 1.csv").write_text("2024-01-01 00:00:00.5,7\n")
    assert [(r.station_code, r.name, r.occ) for r in sources.read_station_csv(spark, f"{tmp_path}/*.csv").collect()] == [("103", "P 1", 7)]
    (tmp_path / "f.xml").write_text("<f><prediction-list><prediction><forecast-time>2024-01-01T00:00:00Z</forecast-time><at>1.5</at><cc>3</cc></prediction></prediction-list></f>")
    row = sources.read_prediction_xml(spark, f"{tmp_path}/f.xml").first()
    assert row["at"] == 1.5 and row.cc == 3.0 and row.ra is None
    for y in (2018, 2020):
        (tmp_path / f"fc_info_{y}.csv").write_text(f"Category\nc{y}\n")
    fleet = sources.with_year(sources.read_dim_csv(spark, f"{tmp_path}/fc_info_*.csv", "Category string"))
    assert [r.Category for r in sources.latest_year_file(fleet, 2019).collect()] == ["c2018"]
    with pytest.raises(ValueError):
        sources.latest_year_file(fleet, 2017)
    m = series(spark, [(i * 86400 * 20, float(i)) for i in range(5)])
    sources.write_by_month(m, f"{tmp_path}/months")
    assert sorted(p.name for p in (tmp_path / "months/year=2024").iterdir()) == ["month=1", "month=2", "month=3"]
    sources.write_batched(m.coalesce(1), f"{tmp_path}/few", 2)
    assert len(list((tmp_path / "few").glob("*.parquet"))) == 3
    sources.write_csv(m, f"{tmp_path}/csv")
    assert sources.read_dim_csv(spark, f"{tmp_path}/csv", "station_code string, ts timestamp, value double").count() == 5
    full = m.selectExpr("station_code", "'t' station_type", "'o' origin", "'n' type_name", "600 period", "ts", "value", "CAST(NULL AS string) string_value", "CAST(NULL AS string) json_value", "ts created_on")
    full.write.parquet(f"{tmp_path}/m")
    assert sources.read_measurements(spark, f"{tmp_path}/m", ["n"], F.lit(at(86400 * 20)), F.lit(at(86400 * 60))).count() == 2
