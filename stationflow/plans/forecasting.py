"""Queries on car parks and forecasts: events of a type stand for a car park."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import forecast, grids, lots, network, parking
from .base import epoch, measurements, query, r6, table

HOURLY = """, h AS (SELECT type_name AS station_code, date_trunc('hour', ts) AS t, min(value) AS v FROM m GROUP BY 1, 2)
"""


def _hourly(spark, sf):
    return measurements(spark, sf).groupBy(F.col("type_name").alias("station_code"), F.date_trunc("hour", "ts").alias("ts")).agg(F.min("value").alias("value"))


@query("SELECT event_id, greatest(trunc(c_acctbal - value), 0)::BIGINT AS value FROM m JOIN customer ON station_code = CAST(c_custkey AS VARCHAR) WHERE c_acctbal > 0")
def occupied_to_free(spark, sf):
    """Balances of customers as capacities."""
    stations = table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("station_code"), F.lit("ParkingStation").alias("station_type"), F.to_json(F.struct(F.col("c_acctbal").cast("string").alias("capacity"))).alias("metadata"))
    m = measurements(spark, sf)
    return parking.occupied_to_free(m, stations).select("event_id", "value")


@query("SELECT epoch_us(ts) // 1000000 AS ts, event_id, coalesce(o.id, 0) AS overlay FROM m LEFT JOIN (SELECT DATE '2024-01-06' AS d, 7 AS id) o ON d = CAST(ts AS DATE)")
def overlay_days(spark, sf):
    """J23, F3."""
    days = spark.sql("SELECT DATE '2024-01-06' AS date, 7 AS id")
    return parking.overlay_days(measurements(spark, sf), days).select(epoch("ts"), "event_id", "overlay")


@query(
    """, w AS (SELECT DISTINCT date_trunc('hour', ts) AS t FROM m WHERE type_name = 'error' AND event_id % 30 > 5 AND event_id % 30 < 20)
SELECT event_id, CASE WHEN hour(ts) BETWEEN 7 AND 22 AND (date_trunc('hour', ts) IN (SELECT t FROM w) OR date_trunc('hour', ts) - INTERVAL 1 HOUR IN (SELECT t FROM w)) THEN 1 ELSE 0 END AS rain FROM m"""
)
def rain_flag(spark, sf):
    """Errors as weather codes."""
    m = measurements(spark, sf)
    meteo = m.where("type_name = 'error'").select("ts", (F.col("event_id") % 30).alias("code"))
    return parking.rain_flag(m, meteo).select("event_id", "rain")


@query("SELECT epoch(date_trunc('hour', ts))::BIGINT AS ts, type_name AS station_code, round_even(min(v), 1) AS lo, round_even(avg(v), 1) AS mean, round_even(max(v), 1) AS hi FROM (SELECT *, value * 1.047197551196598::DOUBLE AS v FROM m) GROUP BY 1, 2")
def ensemble(spark, sf):
    """Values of an hour as predictions of several models."""
    m = measurements(spark, sf).select(F.col("type_name").alias("station_code"), F.date_trunc("hour", "ts").alias("ts"), (F.col("value") * 1.047197551196598).alias("value"))
    return parking.ensemble(m).select(epoch("ts"), "station_code", "lo", "mean", "hi")


@query(
    """, p AS (SELECT station_code, ts, value FROM m WHERE type_name = 'purchase'), v AS (SELECT station_code, ts, value AS mean FROM m WHERE type_name = 'view'),
b AS (SELECT p.station_code, p.ts, p.value, v.ts AS bt, mean AS bv FROM p ASOF LEFT JOIN v ON p.station_code = v.station_code AND p.ts >= v.ts),
a AS (SELECT p.station_code, p.ts, v.ts AS nt, mean AS av FROM p ASOF LEFT JOIN v ON p.station_code = v.station_code AND p.ts <= v.ts),
e AS (SELECT station_code, b.value, CASE WHEN epoch_us(nt) - epoch_us(bt) <= 86400e6 THEN CASE WHEN nt = bt THEN bv ELSE bv + (epoch_us(ts) - epoch_us(bt)) / (epoch_us(nt) - epoch_us(bt))::DOUBLE * (av - bv) END END AS q FROM b JOIN a USING (station_code, ts))
SELECT station_code, round(avg(abs(q - value)), 6) AS mae, count(*) FILTER (q IS NULL) AS skipped, count(q) AS used FROM e GROUP BY 1"""
)
def forecast_mae(spark, sf):
    """Views as predictions of purchases."""
    m = measurements(spark, sf)
    out = parking.forecast_mae(m.where("type_name = 'view'").select("station_code", "ts", F.col("value").alias("mean")), m.where("type_name = 'purchase'").select("station_code", "ts", "value"), 86400)
    return out.select("station_code", r6("mae", "mae"), "skipped", "used")


@query(
    """, b AS (SELECT type_name AS station_code, min(ts) AS lo, max(ts) AS hi FROM m GROUP BY 1),
g AS (SELECT station_code, unnest(generate_series(TIMESTAMP '2024-01-01', hi, INTERVAL 300 SECOND)) AS t FROM b),
l AS (SELECT g.station_code AS station_code, t, max(ts) AS seen FROM g JOIN m ON type_name = g.station_code AND ts >= t - INTERVAL 1 DAY AND ts <= t GROUP BY 1, 2),
tr AS (SELECT l.station_code AS station_code, t, avg(value) AS v FROM l JOIN m ON type_name = l.station_code AND ts = seen GROUP BY 1, 2),
r AS (SELECT station_code, t AS start, v AS told FROM tr WHERE t = date_trunc('day', t) AND t BETWEEN TIMESTAMP '2024-01-01' AND TIMESTAMP '2024-01-29'),
s AS (SELECT station_code, start, unnest(range(0, 576)) AS step, told FROM r),
e AS (SELECT s.*, pow(told * (1 + step / 1000.0::DOUBLE) - v, 2.0::DOUBLE) AS e2 FROM s LEFT JOIN tr ON tr.station_code = s.station_code AND t = start + to_seconds(300 * step)),
w AS (SELECT station_code, start FROM e GROUP BY 1, 2 HAVING bool_and(e2 IS NOT NULL))
SELECT station_code, step, round(sqrt(avg(e2)), 6) AS rmse FROM e JOIN w USING (station_code, start) GROUP BY 1, 2"""
)
def forecast_rmse(spark, sf):
    """Each midnight's last value, raised by a thousandth a step, as the forecast of the next 576 steps."""
    m = measurements(spark, sf).groupBy(F.col("type_name").alias("station_code"), "ts").agg(F.avg("value").alias("value"))
    g = grids.grid(m, 300, ["station_code"], start=F.lit("2024-01-01").cast("timestamp"))
    truth = grids.asof_pad(g, m, ["station_code"], name="value", max_age_s=86400).where("value IS NOT NULL")
    runs = truth.where("ts = date_trunc('day', ts)").select("station_code", F.col("ts").alias("start"), F.transform(F.sequence(F.lit(0), F.lit(575)), lambda i: F.col("value") * (1 + i / 1000)).alias("mean"))
    return parking.forecast_rmse(runs, truth, F.lit("2024-01-31").cast("timestamp"), "00:00:00").select("station_code", F.col("step").cast("long").alias("step"), r6("rmse", "rmse"))


@query(
    """, f AS (SELECT type_name AS station_code, epoch(ts) AS s, epoch(ts) + 60 AS e, value FROM m), b AS (SELECT station_code, min(s) AS f FROM f GROUP BY 1)
SELECT station_code, value FROM f JOIN b USING (station_code) WHERE e < f + 43200 QUALIFY row_number() OVER (PARTITION BY station_code ORDER BY e DESC) = 1"""
)
def forecast_at(spark, sf):
    """The step that ends within twelve hours."""
    fc = measurements(spark, sf).select(F.col("type_name").alias("station_code"), F.col("ts").alias("start"), (F.col("ts") + F.make_dt_interval(mins=F.lit(1))).alias("end"), "value")
    return parking.forecast_at(fc, 720).select("station_code", "value")


@query("SELECT station_code, CAST(CAST(ts AS DATE) AS VARCHAR) AS run, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS ts, round(value, 6) AS lo, round(value, 6) AS mean, CAST(NULL AS DOUBLE) AS hi, round(value + 1, 6) AS rmse FROM m")
def forecast_document(spark, sf):
    """Each user's events of a day as a forecast, written as documents and read back."""
    fc = measurements(spark, sf).select("station_code", F.to_date("ts").cast("string").alias("run"), "ts", F.col("value").alias("lo"), F.col("value").alias("mean"), F.lit(float("nan")).alias("hi"), (F.col("value") + 1).alias("rmse"))
    docs = parking.forecast_document(fc, ["station_code", "run"])
    step = "struct<ts: string, lo: double, mean: double, hi: double, rmse: double>"
    read = docs.select(F.from_json("document", f"station_code string, run string, timeseries array<{step}>").alias("d"))
    read = read.select("d.station_code", "d.run", F.explode("d.timeseries").alias("s")).select("station_code", "run", "s.*")
    return read.select("station_code", "run", "ts", *(r6(c, c) for c in ("lo", "mean", "hi", "rmse")))


@query("SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS date, arg_max(type_name, (ts, type_name)) AS code FROM m GROUP BY 1")
def dedupe_daily(spark, sf):
    """The type of each day's last event."""
    rows = measurements(spark, sf).select(F.to_date("ts").alias("date"), F.col("type_name").alias("code"), F.col("ts").alias("updated"))
    return parking.dedupe_daily(rows).select(F.col("date").cast("string").alias("date"), "code")


def _days(spark):
    days = spark.sql("SELECT explode(sequence(TIMESTAMP '2023-12-31', TIMESTAMP '2024-02-01', INTERVAL 1 DAY)) AS ts")
    return days.select("ts", (F.weekday("ts") >= 5).cast("int").alias("is_school"), (F.weekday("ts") == 6).cast("int").alias("is_holiday")), days.select("ts", (F.dayofmonth("ts") % 5).alias("symbol"))


def _signals(spark, sf):
    m = measurements(spark, sf).select(F.col("type_name").alias("station_code"), "ts", "value")
    return forecast.parking_signals(m, *_days(spark), interpolate=True)


NUMBERS = [*(f"lag_{n}" for n in forecast.LAGS), "running_mean", "is_school", "is_holiday"]


SIGNALS = """, n AS (SELECT type_name AS station_code, time_bucket(INTERVAL 300 SECOND, ts, TIMESTAMP '2024-01-01') AS t, avg(value) AS v FROM m GROUP BY 1, 2),
g AS (SELECT station_code, unnest(generate_series(min(t), max(t), INTERVAL 300 SECOND)) AS t FROM n GROUP BY 1),
p AS (SELECT g.station_code, g.t, n.v, last_value(CASE WHEN v IS NOT NULL THEN {'t': g.t, 'v': v} END IGNORE NULLS) OVER (PARTITION BY g.station_code ORDER BY g.t) AS a,
 first_value(CASE WHEN v IS NOT NULL THEN {'t': g.t, 'v': v} END IGNORE NULLS) OVER (PARTITION BY g.station_code ORDER BY g.t ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS b FROM g LEFT JOIN n ON n.station_code = g.station_code AND n.t = g.t),
sg AS (SELECT station_code, t, coalesce(v, a.v + (b.v - a.v) * (epoch(t) - epoch(a.t)) / (epoch(b.t) - epoch(a.t))) AS v FROM p)
"""


@query(
    SIGNALS
    + """SELECT station_code, epoch(t)::BIGINT AS ts, round(1.047197551196598::DOUBLE * v, 6) AS value, (hour(t) * 12 + minute(t) // 5)::BIGINT AS slot, (isodow(t) - 1)::BIGINT AS weekday,
 month(t) AS month, (isodow(t) >= 6)::INT::DOUBLE AS is_school, (isodow(t) = 7)::INT::DOUBLE AS is_holiday, (day(t) % 5)::DOUBLE AS symbol FROM sg"""
)
def parking_signals(spark, sf):
    """M1: signals of each type every five minutes."""
    return _signals(spark, sf).select("station_code", epoch("ts"), r6(F.col("value") * 1.047197551196598, "value"), *(F.col(c).cast("long").alias(c) for c in ("slot", "weekday", "month")), "is_school", "is_holiday", "symbol")


def _training(spark, sf):
    return forecast.training_set(_signals(spark, sf), F.lit("2024-01-25").cast("timestamp"))


@query(
    SIGNALS
    + """, l AS (SELECT station_code, t, v, lag(v, 1) OVER w AS l1, lag(v, 2) OVER w AS l2, lag(v, 12) OVER w AS l12, lag(v, 288) OVER w AS l288, lag(v, 2016) OVER w AS l2016, avg(v) OVER (w ROWS 2016 PRECEDING) AS mean FROM sg WINDOW w AS (PARTITION BY station_code ORDER BY t))
SELECT station_code, epoch(t)::BIGINT AS ts, round(v * 1.047197551196598::DOUBLE, 6) AS value, round(l1 * 1.047197551196598::DOUBLE, 6) AS lag_1, round(l2 * 1.047197551196598::DOUBLE, 6) AS lag_2, round(l12 * 1.047197551196598::DOUBLE, 6) AS lag_12, round(l288 * 1.047197551196598::DOUBLE, 6) AS lag_288, round(l2016 * 1.047197551196598::DOUBLE, 6) AS lag_2016,
 round(mean * 1.047197551196598::DOUBLE, 6) AS running_mean FROM l WHERE t <= TIMESTAMP '2024-01-25' AND l2016 IS NOT NULL"""
)
def training_set(spark, sf):
    """M2: the rows that models are fitted on."""
    scaled = lambda c: F.round(F.col(c) * 1.047197551196598, 6).alias(c)
    return _training(spark, sf).select("station_code", epoch("ts"), *(scaled(c) for c in ("value", "lag_1", "lag_2", "lag_12", "lag_288", "lag_2016", "running_mean")))


@query(
    SIGNALS
    + """, l AS (SELECT *, lag(v, 288) OVER (PARTITION BY station_code ORDER BY t) AS p FROM sg), r AS (SELECT *, percent_rank() OVER (PARTITION BY station_code ORDER BY t) AS pr FROM l WHERE p IS NOT NULL)
SELECT hour(t)::BIGINT AS hour, round(sqrt(avg((p - v) * (p - v))), 6) AS rmse, count(*) AS rows FROM r WHERE pr >= 0.9 GROUP BY 1"""
)
def step_errors(spark, sf):
    """M9: each day as the forecast of the next one, by hour of the last tenth of each series."""
    rows = grids.lag_features(_signals(spark, sf), [288]).where("lag_288 IS NOT NULL").withColumnRenamed("lag_288", "prediction")
    return forecast.step_errors(rows, 0.1).select(F.col("hour").cast("long").alias("hour"), r6("rmse", "rmse"), "rows")


@query(
    """, h AS (SELECT station_code, date_trunc('hour', ts) AS t, avg(value) AS y, count(*)::DOUBLE AS a, max(event_id % 97)::DOUBLE AS b FROM m GROUP BY 1, 2),
s AS (SELECT station_code, count(*) AS n, avg(y) AS my, avg(a) AS ma, avg(b) AS mb, var_pop(a) AS aa, var_pop(b) AS bb, covar_pop(a, b) AS ab, covar_pop(a, y) AS ay, covar_pop(b, y) AS by_, var_pop(y) AS yy FROM h GROUP BY 1),
w AS (SELECT *, (ay * bb - by_ * ab) / (aa * bb - ab * ab) AS wa, (by_ * aa - ay * ab) / (aa * bb - ab * ab) AS wb FROM s WHERE n >= 8 AND aa * bb - ab * ab > 1e-3)
SELECT station_code, round(my - wa * ma - wb * mb, 4) AS intercept, round(wa, 4) AS of_count, round(wb, 4) AS of_rest, round(sqrt(greatest(yy - wa * ay - wb * by_, 0) * n / (n - 1)), 4) AS deviation FROM w"""
)
def fit_lots(spark, sf):
    """M8: a linear model for each user, of hourly means on the number of events and the largest remainder of their ids."""
    m = measurements(spark, sf).repartition("station_code")  # a user's hours are in one task, whose sums leave it once
    h = m.groupBy("station_code", F.date_trunc("hour", "ts").alias("ts")).agg(F.avg("value").alias("value"), F.count(F.lit(1)).cast("double").alias("a"), F.max(F.col("event_id") % 97).cast("double").alias("b"))
    fit = forecast.fit_lots(h, ["a", "b"], ridge=0.0, calendar=False)
    usable = h.groupBy("station_code").agg(F.count(F.lit(1)).alias("n"), (F.var_pop("a") * F.var_pop("b") - F.pow(F.covar_pop("a", "b"), F.lit(2))).alias("d")).where("n >= 8 AND d > 1e-3")
    at = lambda i, name: F.round(F.get("weights", F.lit(i)), 4).alias(name)
    return fit.join(usable, "station_code").select("station_code", at(0, "intercept"), at(1, "of_count"), at(2, "of_rest"), F.round("deviation", 4).alias("deviation"))


@query(
    HOURLY
    + """, p AS (SELECT station_code, list(v ORDER BY t) AS past, max(t) AS last FROM h GROUP BY 1),
x AS (WITH RECURSIVE r AS (SELECT station_code, past, last, 0 AS i FROM p UNION ALL
 SELECT station_code, list_append(past, (i % 24) * 2.5 + 0.45 * past[-1] + 0.25 * past[-3] + 0.2 * past[-24]), last, i + 1 FROM r WHERE i < 72) SELECT * FROM r WHERE i > 0)
SELECT station_code, epoch(last)::BIGINT + 3600 * i AS ts, round(past[-1], 6) AS value FROM x"""
)
def forecast_linear(spark, sf):
    """M6: three days of hours that feed on themselves, by given weights of three lags."""
    hours = _hourly(spark, sf)
    ahead = hours.groupBy("station_code").agg(F.max("ts").alias("m")).select("station_code", "m", F.explode(F.sequence(F.lit(0), F.lit(71))).alias("i"))
    base = ahead.select("station_code", F.timestamp_micros(F.unix_micros("m") + (F.col("i").cast("long") + 1) * 3_600_000_000).alias("ts"), (F.col("i") % 24 * 2.5).alias("base"))
    return forecast.forecast_linear(hours, base, {1: 0.45, 3: 0.25, 24: 0.2}).select("station_code", epoch("ts"), r6("value", "value"))


@query(
    """, r AS (SELECT type_name AS station_code, round(value)::BIGINT AS value, hour(ts)::DOUBLE AS a, (event_id % 97)::DOUBLE AS b FROM m),
x AS (SELECT station_code, value, f, CASE f WHEN 0 THEN a ELSE b END AS x FROM r, (VALUES (0), (1)) v(f)), lim AS (SELECT station_code, f, min(x) AS lo, max(x) AS hi FROM x GROUP BY 1, 2),
c AS (SELECT station_code, f, greatest(0, least(7, floor((x - lo) / (hi - lo) * 8)))::BIGINT AS bin, count(*)::DOUBLE AS n, sum(value)::DOUBLE AS s FROM x JOIN lim USING (station_code, f) GROUP BY 1, 2, 3),
w AS (SELECT station_code, f, bin, sum(n) OVER u AS nl, sum(s) OVER u AS sl, sum(n) OVER o AS na, sum(s) OVER o AS sa FROM c WINDOW u AS (PARTITION BY station_code, f ORDER BY bin), o AS (PARTITION BY station_code, f)),
q AS (SELECT station_code, f AS feature, bin, sl * sl / nl + (sa - sl) * (sa - sl) / (na - nl) - sa * sa / na AS gain FROM w WHERE nl >= 20 AND na - nl >= 20)
SELECT station_code, feature::BIGINT AS feature, bin, round(gain, 2) AS gain FROM q WHERE gain > 1e-9 QUALIFY row_number() OVER (PARTITION BY station_code ORDER BY gain DESC, feature, bin) = 1"""
)
def split_lots(spark, sf):
    """M8: the first split of each type's model tree, of values by hour and remainder."""
    m = measurements(spark, sf).select(F.col("type_name").alias("station_code"), F.round("value").cast("double").alias("value"), F.hour("ts").cast("double").alias("a"), (F.col("event_id") % 97).cast("double").alias("b"))
    trees = lots.fit_trees(m, ["a", "b"], depth=1, bins=8, least=20)
    return trees.splits[0].select("station_code", F.col("feature").cast("long").alias("feature"), F.col("bin").cast("long").alias("bin"), F.round("gain", 2).alias("gain"))


@query()
def fit_trees(spark, sf):
    """M8: model trees of each user's hourly means, and their predictions."""
    h = measurements(spark, sf).groupBy(F.col("type_name").alias("station_code"), F.date_trunc("hour", "ts").alias("ts")).agg(F.avg("value").alias("value"), F.count(F.lit(1)).cast("double").alias("n"))
    rows = h.withColumns({"hour": F.hour("ts").cast("double"), "weekday": F.weekday("ts").cast("double")})
    out = lots.fit_trees(rows, ["n", "hour", "weekday"], depth=2, bins=24, least=30).predict(rows)
    return out.select("station_code", epoch("ts"), "leaf", r6("prediction", "prediction"))


@query()
def fit_network(spark, sf):
    """Five members of a network on the signals' lags and calendar, and what they predict."""
    rows = _training(spark, sf).withColumns({c: F.col(c).cast("double") for c in ("slot", "weekday")})
    model = network.fit_network(rows, [*NUMBERS, "slot", "weekday"], steps=40, rate=0.03)
    out = model.transform(rows.select("station_code", "ts", *model.columns))
    preds = out.select("station_code", "ts", F.explode("predictions").alias("value"))
    return parking.ensemble(preds).select("station_code", epoch("ts"), "lo", "mean", "hi")


@query()
def fit_absolute(spark, sf):
    """M4, M9: a linear model by absolute errors, and its error by hour on the last tenth."""
    rows = _training(spark, sf)
    return forecast.evaluate_steps(forecast.fit_absolute(rows, NUMBERS, (), rounds=6), rows)


@query()
def fit_linear(spark, sf):
    """M2, M3, M4, M9: a linear model, its error by hour on the last tenth."""
    rows = _training(spark, sf)
    train, _ = forecast.augment(rows, 0.01)
    return forecast.evaluate_steps(forecast.fit_linear(train, NUMBERS), rows)


@query()
def fit_ensemble(spark, sf):
    """Five boosted models of 20 trees, direct forecasts with blank lags."""
    rows = _training(spark, sf).withColumns({c: F.col(c).cast("double") for c in ("slot", "weekday")})
    train, _ = forecast.augment(rows, blank=True)
    models = forecast.fit_ensemble(train, [*NUMBERS, "slot", "weekday"], categories=())
    return parking.ensemble(forecast.ensemble_direct(models, rows)).select("station_code", epoch("ts"), "lo", "mean", "hi")


@query()
def forecast_recursive(spark, sf):
    """M4, M6: a linear model fitted on the signals, and the 576 five-minute steps after them, which feed on themselves."""
    signals = _signals(spark, sf).where("value IS NOT NULL")
    train, _ = forecast.augment(forecast.training_set(signals, F.lit("2024-01-25").cast("timestamp")), 0.01)
    model = forecast.fit_linear(train, NUMBERS)
    return forecast.forecast_recursive(signals, model, NUMBERS).select("station_code", epoch("ts"), r6("value", "value"))


@query()
def forecast_lots(spark, sf):
    """M8: free places of the next day."""
    m = measurements(spark, sf).select(F.col("type_name").alias("station_code"), "ts", "value")
    return forecast.forecast_lots(m, [lambda df: parking.overlay_days(df, df.sparkSession.sql("SELECT DATE '2024-01-06' AS date, 1 AS id"), True, "overlay_event")]).select("station_code", epoch("ts"), "free", "lo", "hi")
