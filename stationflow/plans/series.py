"""Queries on series of events: grids, roll-ups, as-of joins, runs of values."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import grids, parking, quality, rollups, scans, store
from .base import epoch, measurements, query, r6, table

HOURS = """, b AS (SELECT station_code, date_trunc('day', min(ts)) AS lo, max(ts) AS hi FROM m GROUP BY 1),
g AS (SELECT station_code, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS t FROM b),
c AS (SELECT station_code, date_trunc('hour', ts) AS t, count(*) AS n FROM m GROUP BY 1, 2)
"""


@query(HOURS + "SELECT station_code, epoch(t)::BIGINT + 1800 AS ts, coalesce(n, 0) AS value FROM g LEFT JOIN c USING (station_code, t)")
def window_count(spark, sf):
    """A1: dense hourly counts of each user."""
    return grids.window_count(measurements(spark, sf), 3600).select("station_code", epoch("ts"), "value")


@query(
    """, h AS (SELECT station_code, type_name, ceil(epoch_us(ts) / 3600e6)::BIGINT * 3600 AS e, avg(value) AS v, count(value) AS n FROM m GROUP BY 1, 2, 3),
b AS (SELECT station_code, type_name, floor(epoch_us(min(ts)) / 3600e6) * 3600 AS lo, floor(epoch_us(max(ts)) / 3600e6) * 3600 AS hi FROM m GROUP BY 1, 2)
SELECT station_code, type_name, e AS ts, round(v, 6) AS value FROM h JOIN b USING (station_code, type_name) WHERE n >= 2 AND e > lo AND e <= hi"""
)
def hourly_average(spark, sf):
    """A5: averages of hours with two or more values."""
    out = rollups.hourly_average(measurements(spark, sf), F.lit("2030-01-01").cast("timestamp"), min_points=2)
    return out.select("station_code", "type_name", epoch("ts"), r6("value", "value"))


@query("SELECT station_code, type_name, epoch(date_trunc('day', ts))::BIGINT + 86400 AS ts, round(sum(value), 6) AS value FROM m GROUP BY ALL")
def daily_sum(spark, sf):
    """A6."""
    return rollups.daily_sum(measurements(spark, sf)).select("station_code", "type_name", epoch("ts"), r6("value", "value"))


@query(
    """, d AS (SELECT station_code, type_name, epoch(date_trunc('day', ts))::BIGINT + 86400 AS ts, sum(value) AS value FROM m GROUP BY ALL)
SELECT station_code, type_name, ts, round(value, 6) AS value FROM d
UNION ALL SELECT station_code, 'total', ts, round(sum(value), 6) FROM d WHERE type_name IN ('click', 'view', 'purchase') GROUP BY station_code, ts"""
)
def daily_total(spark, sf):
    """A7, U6."""
    return rollups.daily_total(measurements(spark, sf), ["click", "view", "purchase"], "total").select("station_code", "type_name", epoch("ts"), r6("value", "value"))


@query(
    """SELECT n_name AS station_code, l_returnflag AS type_name, epoch(date_trunc('day', l_shipdate))::BIGINT + 86400 AS ts, round(sum(l_quantity), 6) AS value
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY ALL"""
)
def parent_sum(spark, sf):
    """Daily quantities of suppliers, added for their nations."""
    lines = table(spark, sf, "lineitem").select(F.col("l_suppkey").cast("string").alias("station_code"), F.col("l_returnflag").alias("type_name"), F.col("l_shipdate").cast("timestamp").alias("ts"), F.col("l_quantity").alias("value"))
    stations = table(spark, sf, "supplier").join(table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("s_suppkey").cast("string").alias("station_code"), F.col("n_name").alias("parent_code"))
    return rollups.parent_sum(rollups.daily_sum(lines), stations).select("station_code", "type_name", epoch("ts"), r6("value", "value"))


@query(
    """, d AS (SELECT station_code, date_trunc('day', ts) AS day, sum(value) FILTER (type_name = 'click') AS a, sum(value) FILTER (type_name = 'view') AS b,
 sum(value) FILTER (type_name = 'error') AS c, sum(value) FILTER (type_name = 'purchase') AS t, sum(value) FILTER (type_name = 'signup') AS e FROM m GROUP BY 1, 2)
SELECT station_code, epoch(day)::BIGINT AS ts, round(a, 6) AS light, round(t, 6) AS total FROM d WHERE (a + b + c <> t) OR (a + 2.5 * b + 2.5 * c <> e)"""
)
def check_daily_totals(spark, sf):
    """Days of which the classes don't add up."""
    days = measurements(spark, sf).groupBy("station_code", F.date_trunc("day", "ts").alias("ts"), "type_name").agg(F.sum("value").alias("value"))
    out = rollups.check_daily_totals(days, "click", "view", "error", "purchase", "signup")
    return out.select("station_code", epoch("ts"), r6("click", "light"), r6("purchase", "total"))


@query("SELECT station_code, type_name, epoch_us(ts) AS ts, value FROM m QUALIFY row_number() OVER (PARTITION BY station_code, type_name ORDER BY ts DESC, value ASC NULLS LAST) = 1")
def latest(spark, sf):
    """W1."""
    return store.latest(measurements(spark, sf), ["station_code", "type_name"]).select("station_code", "type_name", F.unix_micros("ts").alias("ts"), "value")


@query("SELECT station_code, epoch_us(min(ts)) AS ts FROM m GROUP BY 1")
def earliest(spark, sf):
    """L2."""
    return store.earliest(measurements(spark, sf), ["station_code"]).select("station_code", F.unix_micros("ts").alias("ts"))


@query("SELECT station_code, epoch_us(ts) AS ts, value FROM m QUALIFY row_number() OVER (PARTITION BY station_code ORDER BY ts) <= 20")
def limit_per_series(spark, sf):
    """L1: the first rows of each user."""
    return store.limit_per_series(measurements(spark, sf), 20, ["station_code"]).select("station_code", F.unix_micros("ts").alias("ts"), "value")


@query("SELECT station_code, count(*) AS points FROM m GROUP BY 1 HAVING count(*) > 60 AND max(ts) >= TIMESTAMP '2024-01-30 00:00:00' - INTERVAL 1 DAY")
def usable_stations(spark, sf):
    """L5."""
    return store.usable_stations(measurements(spark, sf), F.lit("2024-01-30").cast("timestamp"), 60, 1).select("station_code", "points")


DAYS = """, n AS (SELECT station_code, date_trunc('day', ts) AS t, round(sum(value), 6) AS v FROM m WHERE type_name <> 'click' GROUP BY 1, 2),
o AS (SELECT station_code, date_trunc('day', ts) AS t, round(sum(value), 6) AS v FROM m WHERE type_name <> 'error' GROUP BY 1, 2)
"""


def _two_days(spark, sf):
    m = measurements(spark, sf)
    one = lambda kind: m.where(F.col("type_name") != kind).groupBy("station_code", F.date_trunc("day", "ts").alias("ts")).agg(F.round(F.sum("value"), 6).alias("value"))
    return one("click"), one("error")


@query(
    DAYS
    + """SELECT station_code, epoch(t)::BIGINT AS ts, CASE WHEN n.v IS NULL THEN o.v ELSE n.v END AS value,
 CASE WHEN o.v IS NULL THEN 'insert' WHEN n.v IS NULL THEN 'delete' ELSE 'update' END AS op FROM n FULL JOIN o USING (station_code, t) WHERE n.v IS NULL OR o.v IS NULL OR abs(n.v - o.v) > 0.5"""
)
def change_set(spark, sf):
    """What turns the daily sums without errors into those without clicks."""
    new, old = _two_days(spark, sf)
    lo, hi = F.lit("2020-01-01").cast("timestamp"), F.lit("2030-01-01").cast("timestamp")
    return store.change_set(new, old, lo, hi, ["station_code"], eps=0.5).select("station_code", epoch("ts"), "value", "op")


@query(DAYS + "SELECT station_code, epoch(t)::BIGINT AS ts, v AS value FROM n")
def apply_changes(spark, sf):
    """The old sums after their change set are the new ones."""
    new, old = _two_days(spark, sf)
    lo, hi = F.lit("2020-01-01").cast("timestamp"), F.lit("2030-01-01").cast("timestamp")
    changes = store.change_set(new, old, lo, hi, ["station_code"])
    return store.apply_changes(old, changes, ["station_code"]).select("station_code", epoch("ts"), "value")


@query(
    """, c AS (SELECT station_code, type_name, max(ts) AS ts, arg_max(value, ts) AS value FROM m WHERE ts < TIMESTAMP '2024-01-20' GROUP BY 1, 2),
n AS (SELECT station_code, type_name, max(ts) AS ts, arg_max(value, ts) AS value FROM m WHERE ts >= TIMESTAMP '2024-01-15' GROUP BY 1, 2)
SELECT station_code, type_name, epoch_us(coalesce(n.ts, c.ts)) AS ts, coalesce(n.value, c.value) AS value,
 CASE WHEN c.ts IS NULL THEN 'insert' WHEN n.ts IS NOT NULL AND (n.ts <> c.ts OR n.value <> c.value) THEN 'update' ELSE 'keep' END AS op FROM n FULL JOIN c USING (station_code, type_name)"""
)
def refresh_latest(spark, sf):
    """The cache of the 20th, refreshed by rows from the 15th on."""
    m = measurements(spark, sf)
    cache = store.latest(m.where("ts < '2024-01-20'"), ["station_code", "type_name"])
    out = store.refresh_latest(cache, m, ["station_code", "type_name"], since=F.lit("2024-01-15").cast("timestamp"))
    return out.select("station_code", "type_name", F.unix_micros("ts").alias("ts"), "value", "op")


@query("SELECT station_code, type_name, epoch_us(max(ts)) AS ts, arg_max(value, ts) AS value FROM m WHERE NOT (type_name LIKE 'e%' AND ts >= TIMESTAMP '2024-01-10') GROUP BY 1, 2")
def purge_series(spark, sf):
    """Latest values after a purge of types by pattern and date."""
    _, cache = store.purge_series(measurements(spark, sf), F.col("type_name").like("e%"), F.lit("2024-01-10").cast("timestamp"), ["station_code", "type_name"])
    return cache.select("station_code", "type_name", F.unix_micros("ts").alias("ts"), "value")


@query("SELECT station_code, type_name, epoch_us(least(max(ts), TIMESTAMP '2024-01-25')) AS ts FROM m GROUP BY 1, 2")
def reset_latest(spark, sf):
    """U5."""
    cache = store.latest(measurements(spark, sf), ["station_code", "type_name"])
    return store.reset_latest(cache, F.lit(True), F.lit("2024-01-25").cast("timestamp")).select("station_code", "type_name", F.unix_micros("ts").alias("ts"))


@query("SELECT station_code, event_id FROM m JOIN events USING (event_id) WHERE type_name IN ('view', 'purchase') AND json_extract_string(props, '$.k') = '7'")
def where_measurements(spark, sf):
    """A condition on a path of JSON and one on types."""
    e = table(spark, sf, "events").select(F.col("user_id").cast("string").alias("station_code"), F.col("event_type").alias("type_name"), "event_id", F.col("props").alias("metadata"))
    return store.where_measurements(e, type_name=["view", "purchase"], metadata__k="7").select("station_code", "event_id")


RUNS_OF_ALL = """, s AS (SELECT ts, event_id, floor(value / 400)::INT AS v FROM m), r AS (SELECT *, CASE WHEN v IS NOT DISTINCT FROM lag(v) OVER w AND row_number() OVER w > 1 THEN 0 ELSE 1 END AS new FROM s WINDOW w AS (ORDER BY ts)),
q AS (SELECT *, sum(new) OVER (ORDER BY ts) AS run FROM r), z AS (SELECT *, row_number() OVER (PARTITION BY run ORDER BY ts) AS pos, count(*) OVER (PARTITION BY run) AS len FROM q),
h AS (SELECT *, min(CASE WHEN hour(ts) >= 6 AND pos >= 3 THEN pos END) OVER (PARTITION BY run) AS hit FROM z)
"""
P = """, p AS (SELECT station_code, ts, event_id FROM m WHERE type_name = 'purchase'), v AS (SELECT station_code, ts, value FROM m WHERE type_name = 'view')
"""


def _probe(spark, sf):
    m = measurements(spark, sf)
    return m.where("type_name = 'purchase'").select("station_code", "ts", "event_id"), m.where("type_name = 'view'").select("station_code", "ts", "value")


@query(P + "SELECT event_id, CASE WHEN p.ts - v.ts <= INTERVAL 12 HOUR THEN value END AS value FROM p ASOF LEFT JOIN v ON p.station_code = v.station_code AND p.ts >= v.ts")
def asof_pad(spark, sf):
    """The last view at most 12 hours before each purchase."""
    probe, series = _probe(spark, sf)
    return grids.asof_pad(probe, series, ["station_code"], name="value", max_age_s=43200).select("event_id", "value")


@query(
    P
    + """, b AS (SELECT event_id, p.ts, v.ts AS bt, value AS bv FROM p ASOF LEFT JOIN v ON p.station_code = v.station_code AND p.ts >= v.ts),
a AS (SELECT event_id, v.ts AS nt, value AS av FROM p ASOF LEFT JOIN v ON p.station_code = v.station_code AND p.ts <= v.ts)
SELECT event_id, CASE WHEN least(coalesce(epoch_us(ts) - epoch_us(bt), 9e18), coalesce(epoch_us(nt) - epoch_us(ts), 9e18)) < 7200e6 THEN CASE WHEN bt IS NULL OR epoch_us(nt) - epoch_us(ts) <= epoch_us(ts) - epoch_us(bt) THEN av ELSE bv END END AS value FROM b JOIN a USING (event_id)"""
)
def asof_nearest(spark, sf):
    """The view nearest to each purchase, less than two hours away."""
    probe, series = _probe(spark, sf)
    return grids.asof_nearest(probe, series, ["station_code"], name="value", within_s=7200).select("event_id", "value")


@query(
    P
    + """, b AS (SELECT event_id, p.ts, v.ts AS bt, value AS bv FROM p ASOF LEFT JOIN v ON p.station_code = v.station_code AND p.ts >= v.ts),
a AS (SELECT event_id, v.ts AS nt, value AS av FROM p ASOF LEFT JOIN v ON p.station_code = v.station_code AND p.ts <= v.ts)
SELECT event_id, CASE WHEN epoch_us(nt) - epoch_us(bt) <= 86400e6 THEN round(CASE WHEN nt = bt THEN bv ELSE bv + (epoch_us(ts) - epoch_us(bt)) / (epoch_us(nt) - epoch_us(bt))::DOUBLE * (av - bv) END, 6) END AS value FROM b JOIN a USING (event_id)"""
)
def interpolate_at(spark, sf):
    """Views interpolated at the times of purchases, over gaps of up to a day."""
    probe, series = _probe(spark, sf)
    return grids.interpolate_at(probe, series, ["station_code"], name="value", max_gap_s=86400).select("event_id", r6("value", "value"))


@query(P + "SELECT event_id, value FROM p ASOF LEFT JOIN v ON p.ts >= v.ts")
def asof_one_series(spark, sf):
    """The last view of any user before each purchase, as one series in buckets of a day."""
    probe, series = _probe(spark, sf)
    return grids.asof_pad(probe, series.drop("station_code"), [], name="value", bucket_s=86400).select("event_id", "value")


@query(
    RUNS_OF_ALL
    + """SELECT event_id, len, pos, CASE WHEN hit IS NOT NULL AND pos > hit - 3 THEN NULL ELSE v::DOUBLE END AS value FROM h"""
)
def runs_one_series(spark, sf):
    """Runs of equal levels of all events in order of time, as one series in buckets of a day; those of three and more become NULL after 06:00."""
    levels = measurements(spark, sf).select("ts", "event_id", F.floor(F.col("value") / 400).cast("double").alias("value"), F.lit("all").alias("station_code"))
    each = scans.runs(levels, ["station_code"], "value", 86400).select("event_id", F.col("_len").cast("long").alias("len"), F.col("_at").cast("long").alias("pos"))
    return quality.null_stuck(levels, least=3, bucket_s=86400).select("event_id", "value").join(each, "event_id")


GRID = """, k AS (SELECT type_name, date_trunc('hour', ts) AS t, avg(value * 1.047197551196598::DOUBLE) AS v FROM m GROUP BY 1, 2),
b AS (SELECT type_name, date_trunc('day', min(t)) AS lo, max(t) AS hi FROM k GROUP BY 1),
g AS (SELECT type_name, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS t FROM b), s AS (SELECT type_name, t, v FROM g LEFT JOIN k USING (type_name, t))
"""


def _hours(spark, sf):
    m = measurements(spark, sf)
    k = m.groupBy("type_name", F.date_trunc("hour", "ts").alias("ts")).agg(F.avg(F.col("value") * 1.047197551196598).alias("value"))
    return grids.grid(k, 3600, ["type_name"]).join(k, ["type_name", "ts"], "left")


@query(
    GRID
    + """, w AS (SELECT *, last_value(CASE WHEN v IS NOT NULL THEN t END IGNORE NULLS) OVER p AS bt, last_value(v IGNORE NULLS) OVER p AS bv,
 first_value(CASE WHEN v IS NOT NULL THEN t END IGNORE NULLS) OVER f AS nt, first_value(v IGNORE NULLS) OVER f AS av FROM s
 WINDOW p AS (PARTITION BY type_name ORDER BY t ROWS UNBOUNDED PRECEDING), f AS (PARTITION BY type_name ORDER BY t ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
SELECT type_name, epoch(t)::BIGINT AS ts, round(CASE WHEN v IS NOT NULL THEN v WHEN nt IS NULL THEN bv WHEN bt IS NOT NULL THEN bv + epoch(t - bt) / epoch(nt - bt) * (av - bv) END, 6) AS value FROM w"""
)
def interpolate_linear(spark, sf):
    """Hourly means without gaps."""
    return grids.interpolate_linear(_hours(spark, sf), ["type_name"]).select("type_name", epoch("ts"), r6("value", "value"))


@query(
    GRID
    + """, a AS (SELECT t, avg(v) AS v FROM s GROUP BY 1), w AS (SELECT *, lag(t) OVER o AS lt, last_value(CASE WHEN v IS NOT NULL THEN t END IGNORE NULLS) OVER p AS bt, last_value(v IGNORE NULLS) OVER p AS bv,
 first_value(CASE WHEN v IS NOT NULL THEN t END IGNORE NULLS) OVER f AS nt, first_value(v IGNORE NULLS) OVER f AS av FROM a
 WINDOW o AS (ORDER BY t), p AS (ORDER BY t ROWS UNBOUNDED PRECEDING), f AS (ORDER BY t ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
x AS (SELECT t, CASE WHEN v IS NOT NULL THEN v WHEN nt IS NULL THEN bv WHEN bt IS NOT NULL THEN bv + epoch(t - bt) / epoch(nt - bt) * (av - bv) END AS v FROM w)
SELECT epoch(t)::BIGINT AS ts, round(v, 6) AS value, round(lag(v, 24) OVER q, 6) AS lag_24, round(avg(v) OVER (q ROWS 48 PRECEDING), 6) AS running_mean FROM x WINDOW q AS (ORDER BY t)"""
)
def gaps_one_series(spark, sf):
    """Hourly means of all types as one series, its gaps, lags and running mean in buckets of two days."""
    hours = _hours(spark, sf).groupBy("ts").agg(F.avg("value").alias("value"))
    out = grids.interpolate_linear(hours, [], bucket_s=2 * 86400)
    out = grids.running_mean(grids.lag_features(out, [24], [], bucket_s=2 * 86400), 48, [], bucket_s=2 * 86400)
    return out.select(epoch("ts"), r6("value", "value"), r6("lag_24", "lag_24"), r6("running_mean", "running_mean"))


@query(
    GRID
    + """SELECT type_name, epoch(t)::BIGINT AS ts, round(lag(v, 1) OVER w, 6) AS lag_1, round(lag(v, 24) OVER w, 6) AS lag_24, round(avg(v) OVER (w ROWS 168 PRECEDING), 6) AS running_mean FROM s WINDOW w AS (PARTITION BY type_name ORDER BY t)"""
)
def lag_features(spark, sf):
    """Lags and a running mean over a week of hours."""
    out = grids.running_mean(grids.lag_features(_hours(spark, sf), [1, 24], ["type_name"]), 168, ["type_name"])
    return out.select("type_name", epoch("ts"), r6("lag_1", "lag_1"), r6("lag_24", "lag_24"), r6("running_mean", "running_mean"))


@query("SELECT station_code, epoch_us(ts) // 300000000 * 300 AS ts, round(avg(value), 6) AS value FROM m GROUP BY 1, 2")
def resample_mean(spark, sf):
    """Means of five minutes."""
    return grids.resample_mean(measurements(spark, sf)).select("station_code", epoch("ts"), r6("value", "value"))


@query("SELECT station_code, epoch_us(ts) // 1800000000 * 1800 AS ts, min(value) AS value FROM m GROUP BY 1, 2")
def min_downsample(spark, sf):
    """Least values of half hours."""
    return parking.min_downsample(measurements(spark, sf), 30).select("station_code", epoch("ts"), "value")


@query("SELECT station_code, epoch(date_trunc('hour', ts))::BIGINT AS ts, round(sum(value), 6) AS value FROM m GROUP BY 1, 2")
def hourly_precip(spark, sf):
    """A26."""
    return parking.hourly_precip(measurements(spark, sf)).select("station_code", epoch("ts"), r6("value", "value"))


@query(
    """, p AS (SELECT type_name, ts, event_id, value * 1.047197551196598::DOUBLE AS value, lead(ts) OVER w AS nt, lead(value * 1.047197551196598::DOUBLE) OVER w AS nv FROM m WINDOW w AS (PARTITION BY type_name ORDER BY ts, event_id)),
i AS (SELECT *, unnest(range(0, greatest(ceil(coalesce(epoch_us(nt) - epoch_us(ts), 0) / 600e6)::BIGINT, 1))) AS k FROM p)
SELECT type_name, event_id, epoch_us(ts) + k * 600000000 AS ts, round(CASE WHEN k = 0 THEN value ELSE value + k * 600e6 / (epoch_us(nt) - epoch_us(ts)) * (nv - value) END, 6) AS value FROM i"""
)
def densify(spark, sf):
    """Values every ten minutes between events of a type."""
    out = grids.densify(measurements(spark, sf).select("type_name", "ts", "event_id", (F.col("value") * 1.047197551196598).alias("value")), 600, ["type_name"], {"value": "exact"})
    return out.select("type_name", "event_id", F.unix_micros("ts").alias("ts"), r6("value", "value"))


@query(
    """, s AS (SELECT station_code, date_trunc('hour', ts) AS t, sum(CASE WHEN value < 100 THEN 0 ELSE value END) AS v FROM m GROUP BY 1, 2),
w AS (SELECT *, lag(v) OVER o AS pv, sum(v) OVER (o ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS s1, count(v) OVER (o ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS c1,
 sum(v) OVER (o ROWS BETWEEN 2 PRECEDING AND 1 FOLLOWING) AS s2, count(v) OVER (o ROWS BETWEEN 2 PRECEDING AND 1 FOLLOWING) AS c2,
 sum(v) OVER (o ROWS BETWEEN 1 PRECEDING AND 2 FOLLOWING) AS s3, count(v) OVER (o ROWS BETWEEN 1 PRECEDING AND 2 FOLLOWING) AS c3,
 sum(v) OVER (o ROWS BETWEEN CURRENT ROW AND 3 FOLLOWING) AS s4, count(v) OVER (o ROWS BETWEEN CURRENT ROW AND 3 FOLLOWING) AS c4 FROM s WINDOW o AS (PARTITION BY station_code ORDER BY t))
SELECT station_code, epoch(t)::BIGINT AS ts, NOT (coalesce((v - pv) / nullif(pv, 0) * 100 <= -99 AND pv >= 50, false) OR (c1 = 4 AND s1 = 0) OR (c2 = 4 AND s2 = 0) OR (c3 = 4 AND s3 = 0) OR (c4 = 4 AND s4 = 0)) AS is_valid FROM w"""
)
def layer3(spark, sf):
    """Falls and zeros in hourly sums of large values."""
    large = F.when(F.col("value") < 100, 0).otherwise(F.col("value"))
    s = measurements(spark, sf).groupBy("station_code", F.date_trunc("hour", "ts").alias("time")).agg(F.sum(large).alias("value"))
    return quality.layer3(s, ["station_code"]).select("station_code", epoch("time"), "is_valid")


RUNS = """, s AS (SELECT station_code, ts, event_id, floor(value / 150)::INT AS v FROM m),
r AS (SELECT *, CASE WHEN v = lag(v) OVER w THEN 0 ELSE 1 END AS new FROM s WINDOW w AS (PARTITION BY station_code ORDER BY ts)),
q AS (SELECT *, sum(new) OVER (PARTITION BY station_code ORDER BY ts) AS run FROM r),
z AS (SELECT *, row_number() OVER (PARTITION BY station_code, run ORDER BY ts) AS pos, count(*) OVER (PARTITION BY station_code, run) AS len,
 lag(v, 168) OVER (PARTITION BY station_code ORDER BY ts) AS week, lag(v, 24) OVER (PARTITION BY station_code ORDER BY ts) AS day FROM q)
"""


def _levels(spark, sf):
    return measurements(spark, sf).select("station_code", "ts", "event_id", F.floor(F.col("value") / 150).cast("double").alias("value"))


@query(
    RUNS
    + """, h AS (SELECT *, min(CASE WHEN hour(ts) >= 6 AND pos >= 6 THEN pos END) OVER (PARTITION BY station_code, run) AS hit FROM z)
SELECT event_id, CASE WHEN hit IS NOT NULL AND pos > hit - 6 THEN NULL ELSE v::DOUBLE END AS value FROM h"""
)
def null_stuck(spark, sf):
    """Stuck levels of users."""
    return quality.null_stuck(_levels(spark, sf)).select("event_id", "value")


@query(RUNS + "SELECT event_id, CASE WHEN len >= 12 THEN CASE WHEN week > 0 THEN week WHEN day > 0 THEN day END ELSE v END::DOUBLE AS value FROM z")
def fill_stuck(spark, sf):
    """W16."""
    return quality.fill_stuck(_levels(spark, sf)).select("event_id", "value")


@query("SELECT event_id, (hour(ts) * 60 + minute(ts)) // 15 AS slot, (isodow(ts) - 1)::INT AS weekday, month(ts) AS month FROM m")
def calendar_features(spark, sf):
    """Quarters of hours."""
    return parking.calendar_features(measurements(spark, sf), 96).select("event_id", F.col("slot").cast("long").alias("slot"), "weekday", F.col("month").cast("long").alias("month"))


@query("SELECT event_id, hour(ts) < 12 AS am, day(ts) AS day, isodow(ts) >= 6 AS weekend, quarter(ts) AS quarter FROM m")
def periodic_features(spark, sf):
    """P33."""
    return parking.periodic_features(measurements(spark, sf)).select("event_id", "am", F.col("day").cast("long").alias("day"), "weekend", F.col("quarter").cast("long").alias("quarter"))
