"""Queries on trips, stations along a road, validation and emissions."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import functions as fn
from ..operators import emissions, places, quality, trips
from ..sources import held
from .base import epoch, measurements, query, r6, table

DAY_S = 86400
TRIPS = """, o AS (SELECT station_code AS device, ts FROM m WHERE type_name = 'view'), d AS (SELECT station_code AS device, ts FROM m WHERE type_name = 'purchase'),
f AS (SELECT o.device, o.ts, min(d.ts) AS finish FROM o JOIN d ON o.device = d.device AND d.ts > o.ts AND d.ts < o.ts + INTERVAL 1 DAY GROUP BY 1, 2),
trips AS (SELECT device, ts, (epoch_us(finish) - epoch_us(ts)) / 1e6 AS value FROM f WHERE NOT EXISTS (SELECT 1 FROM o WHERE o.device = f.device AND o.ts > f.ts AND o.ts <= f.finish))
"""


def _edges(spark):
    return spark.createDataFrame([("view-purchase", "view", "purchase", 400000.0)], "link_code string, origin_code string, destination_code string, length_m double")


def _trips(spark, sf):
    seen = measurements(spark, sf).select(F.col("type_name").alias("station_code"), F.col("station_code").alias("device"), "ts")
    return trips.match_trips(seen, _edges(spark), DAY_S)


@query(TRIPS + "SELECT device, epoch_us(ts) AS ts, round(value, 6) AS value FROM trips")
def match_trips(spark, sf):
    """Trips from view to purchase within a day."""
    return _trips(spark, sf).select("device", F.unix_micros("ts").alias("ts"), r6("value", "value"))


@query(
    TRIPS
    + """, b AS (SELECT date_trunc('day', min(ts)) AS lo, max(ts) AS hi FROM trips), g AS (SELECT unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS t FROM b),
c AS (SELECT date_trunc('hour', ts) AS t, count(*) AS n FROM trips GROUP BY 1) SELECT epoch(t)::BIGINT + 1800 AS ts, coalesce(n, 0) AS value FROM g LEFT JOIN c USING (t)"""
)
def trip_count(spark, sf):
    """A2."""
    return trips.trip_count(_trips(spark, sf), 3600).select(epoch("ts"), "value")


MODES = """, w AS (SELECT date_trunc('day', ts) AS t, value FROM trips), l AS (SELECT t, floor(min(value))::BIGINT AS lo, ceil(max(value))::BIGINT AS hi FROM w GROUP BY 1),
s AS (SELECT t, unnest(generate_series(lo, hi, 60)) AS bin FROM l), c AS (SELECT s.t, bin, count(value) AS n FROM s LEFT JOIN w ON s.t = w.t AND value >= bin AND value < bin + 3600 GROUP BY 1, 2),
modes AS (SELECT t, bin + 1800 AS mode FROM c QUALIFY row_number() OVER (PARTITION BY t ORDER BY n DESC, bin) = 1)
"""


@query(TRIPS + MODES + "SELECT epoch(t)::BIGINT + 43200 AS ts, mode::DOUBLE AS value FROM modes")
def travel_time_mode(spark, sf):
    """The fullest hour of travel times of each day."""
    return trips.travel_time_mode(_trips(spark, sf), DAY_S, 60, 3600).select(epoch("ts"), "value")


@query(TRIPS + MODES + "SELECT epoch(t)::BIGINT + 43200 AS ts, round(400000.0::DOUBLE / mode * 3.6, 6) AS value FROM modes")
def link_speed(spark, sf):
    """P13."""
    return trips.link_speed(trips.travel_time_mode(_trips(spark, sf), DAY_S, 60, 3600), _edges(spark)).select(epoch("ts"), r6("value", "value"))


@query(TRIPS + "SELECT device, epoch_us(ts) AS ts FROM trips WHERE 400000.0::DOUBLE / value * 3.6 >= 50")
def fast_trips(spark, sf):
    """P14."""
    return trips.fast_trips(_trips(spark, sf), _edges(spark), 50).select("device", F.unix_micros("ts").alias("ts"))


@query(TRIPS.replace("SELECT device, ts, (epoch_us(finish)", "SELECT device, ts, finish, (epoch_us(finish)") + ", w AS (SELECT * FROM trips WHERE 400000.0::DOUBLE / value * 3.6 >= 50)" + MODES.replace("FROM trips)", "FROM w)").replace(", w AS (SELECT date_trunc", ", v AS (SELECT date_trunc").replace("FROM w GROUP", "FROM v GROUP").replace("LEFT JOIN w ON s.t = w.t", "LEFT JOIN v ON s.t = v.t") + "SELECT epoch(t)::BIGINT + 43200 AS ts, mode::DOUBLE AS value FROM modes")
def fast_mode(spark, sf):
    """A4: the fullest hour of travel times of each day, of fast trips alone."""
    fast = trips.fast_trips(_trips(spark, sf), _edges(spark), 50)
    return trips.travel_time_mode(fast, DAY_S, 60, 3600).select(epoch("ts"), "value")


@query(
    """, c AS (SELECT CAST(l_suppkey AS VARCHAR) AS station_code, date_trunc('day', l_shipdate) AS d, sum(l_quantity) AS v FROM lineitem GROUP BY 1, 2),
h AS (SELECT CAST(s_suppkey AS VARCHAR) AS station_code, avg((1 + n_regionkey / 10.0::DOUBLE) * n_nationkey) AS hv FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE n_nationkey > 3 GROUP BY 1)
SELECT station_code, epoch(d)::BIGINT AS ts, floor(v * coalesce(hv, 0) / 100)::BIGINT AS heavy, round(v - floor(v * coalesce(hv, 0) / 100), 6) AS light FROM c LEFT JOIN h USING (station_code)"""
)
def split_heavy_light(spark, sf):
    """Quantities of suppliers, split by a share that follows their nation."""
    counts = table(spark, sf, "lineitem").groupBy(F.col("l_suppkey").cast("string").alias("station_code"), F.date_trunc("day", F.col("l_shipdate").cast("timestamp")).alias("ts")).agg(F.sum("l_quantity").alias("value"))
    edges = table(spark, sf, "supplier").join(table(spark, sf, "nation").where("n_nationkey > 3"), F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("s_suppkey").cast("string").alias("destination_code"), (1 + F.col("n_regionkey") / 10).alias("factor"), F.col("n_nationkey").cast("double").alias("hv_perc"))
    return trips.split_heavy_light(counts, edges).select("station_code", epoch("ts"), "heavy", r6("light", "light"))


HISTORY = """, c AS (SELECT s_nationkey AS station, l_linenumber % 4 + 1 AS lane, CAST(l_shipdate AS DATE) AS date, sum(l_quantity) AS total_traffic
 FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2, 3),
h AS (SELECT CAST(station AS VARCHAR) AS station, CASE WHEN lane <= 2 THEN 'NORD' ELSE 'SUD' END AS direction, lane, date, total_traffic,
 CASE WHEN isodow(date) >= 6 THEN 'Festivo' ELSE 'Feriale' END AS day_type FROM c)
"""


def _history(spark, sf):
    """Daily quantities of nations as history of stations with four lanes."""
    lines = table(spark, sf, "lineitem").join(table(spark, sf, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    lane = F.col("l_linenumber") % 4 + 1
    h = lines.groupBy(F.col("s_nationkey").cast("string").alias("station"), lane.cast("long").alias("lane"), F.to_date("l_shipdate").alias("date")).agg(F.sum("l_quantity").alias("total_traffic"))
    h = h.withColumn("direction", fn.lane_direction(F.col("lane")))
    return quality.day_type(h, spark.createDataFrame([], "date date"))


def _places(spark, sf):
    return table(spark, sf, "nation").select(F.col("n_nationkey").cast("string").alias("station"), (F.col("n_nationkey") * 7 % 25 * 3.5).alias("km"))


ENDS = "e AS (SELECT CAST(n_nationkey AS VARCHAR) AS station, (n_nationkey * 7 % 25) * 3.5::DOUBLE AS km FROM nation)"


SUPPLIED = """, lines AS (SELECT CAST(l_suppkey AS VARCHAR) AS station, l_linenumber % 5 + 1 AS lane, CAST(CAST(l_shipdate AS DATE) + INTERVAL 8110 DAY AS DATE) AS day, sum(l_quantity) AS v FROM lineitem GROUP BY 1, 2, 3),
hist AS (SELECT station, lane, day, v, month(day) AS month, CASE WHEN isodow(day) >= 6 THEN 'Festivo' ELSE 'Feriale' END AS day_type, CASE WHEN lane <= 2 THEN 'NORD' WHEN lane <= 4 THEN 'SUD' END AS direction FROM lines),
places AS (SELECT CAST(s_suppkey AS VARCHAR) AS station, s_acctbal AS km FROM supplier),
cnt AS (SELECT station, month, day_type, count(*) AS n FROM hist GROUP BY ALL)
"""
BORROWED = """, w AS (SELECT wanted.*, coalesce(n, 0) AS n FROM wanted LEFT JOIN cnt USING (station, month, day_type)),
known AS (SELECT cnt.station, km, month, day_type FROM cnt JOIN places USING (station) WHERE km IS NOT NULL),
near AS (SELECT s.station, s.month, s.day_type, k.station AS near FROM (SELECT DISTINCT station, km, month, day_type FROM w WHERE n < @LEAST AND km IS NOT NULL) s JOIN known k USING (month, day_type)
 QUALIFY row_number() OVER (PARTITION BY s.station, s.month, s.day_type ORDER BY abs(k.km - s.km), k.station) <= 6),
lh AS (SELECT w.station, w.direction, w.month, w.day_type, false AS borrowed, day, lane, sum(v) AS v, avg(v) AS mean_v FROM w JOIN hist USING (station, direction, month, day_type) WHERE n >= @LEAST GROUP BY ALL
 UNION ALL SELECT w.station, w.direction, w.month, w.day_type, true, day, lane, avg(v), avg(v) FROM w JOIN near USING (station, month, day_type) JOIN hist h ON h.station = near AND h.month = w.month AND h.day_type = w.day_type AND h.direction = w.direction WHERE n < @LEAST GROUP BY ALL),
tot AS (SELECT station, direction, month, day_type, borrowed, day, sum(v) AS t FROM lh GROUP BY ALL),
hs AS (SELECT station, direction, month, day_type, borrowed, avg(t) AS mean, stddev_samp(t) AS std, count(*) AS days FROM tot GROUP BY ALL),
le AS (SELECT station, direction, month, day_type, min(lane) AS f, max(lane) AS s FROM lh GROUP BY ALL HAVING count(DISTINCT lane) = 2),
lw AS (SELECT station, direction, month, day_type, day, avg(mean_v) FILTER (lane = f) AS a, avg(mean_v) FILTER (lane = s) AS b FROM lh JOIN le USING (station, direction, month, day_type) GROUP BY ALL),
lr AS (SELECT station, direction, month, day_type, avg(a / b) AS mean, stddev_samp(a / b) AS std FROM lw GROUP BY ALL HAVING count(*) FILTER (b = 0) = 0)
"""


SHIFT = 8110  # days from order lines to the events' month


def _supplied(spark, sf):
    """Daily quantities of suppliers as history of stations with five lanes, stamped a day late, and the suppliers' places."""
    history = table(spark, sf, "lineitem").groupBy(F.col("l_suppkey").cast("string").alias("station"), (F.col("l_linenumber") % 5 + 1).cast("long").alias("lane"), F.date_add(F.to_date("l_shipdate"), SHIFT + 1).alias("date")).agg(F.sum("l_quantity").alias("total_traffic"))
    return history, table(spark, sf, "supplier").select(F.col("s_suppkey").cast("string").alias("station"), F.col("s_acctbal").alias("km"))


EVERY = """, wanted AS (SELECT DISTINCT station, km, d.direction, month, day_type FROM places JOIN (SELECT DISTINCT month, day_type FROM hist) ON true JOIN (VALUES ('NORD'), ('SUD')) d(direction) ON true WHERE CAST(station AS INT) % 3 > 0)"""


ALL = EVERY.replace(" WHERE CAST(station AS INT) % 3 > 0", "")


def _lane_history(spark, sf, some="station % 3 > 0"):
    """What stations are compared with; those without `some` only lend."""
    history, stations = _supplied(spark, sf)
    history = quality.day_type(history.withColumn("date", F.date_sub("date", 1)), spark.createDataFrame([], "date date"))
    days = history.select(F.month("date").alias("month"), "day_type").distinct()  # 24 rows at most
    wanted = stations.where(some).join(F.broadcast(days), F.lit(True)).join(F.broadcast(spark.createDataFrame([("NORD",), ("SUD",)], "direction string")), F.lit(True))
    return quality.lane_history(history, wanted, 3, 40, stations)


@query(SUPPLIED + EVERY + BORROWED.replace("@LEAST", "40") + "SELECT station, direction, month, day_type, borrowed, round(mean * 1.047197551196598::DOUBLE, 4) AS mean, round(std * 1.047197551196598::DOUBLE, 4) AS std, days FROM hs")
def history_stats(spark, sf):
    """Statistics of each month and day type; stations with fewer than 40 rows of one borrow those of their neighbours."""
    out = quality.history_stats(_lane_history(spark, sf))
    return out.select("station", "direction", F.col("month").cast("long").alias("month"), "day_type", "borrowed", F.round(F.col("mean") * 1.047197551196598, 4).alias("mean"), F.round(F.col("std") * 1.047197551196598, 4).alias("std"), "days")


@query(
    HISTORY
    + ", "
    + ENDS
    + """, d AS (SELECT station, direction, date, sum(total_traffic) AS t FROM h GROUP BY ALL),
k AS (SELECT d.*, km FROM d JOIN e USING (station)),
n AS (SELECT a.station, a.direction, a.date, b.t FROM k a JOIN k b ON a.direction = b.direction AND a.date = b.date AND a.station <> b.station
 QUALIFY row_number() OVER (PARTITION BY a.station, a.direction, a.date ORDER BY abs(a.km - b.km), b.station) <= 3)
SELECT station, direction, epoch(date)::BIGINT AS date, round(avg(t), 4) AS mean, round(stddev_pop(t), 4) AS std FROM n GROUP BY ALL"""
)
def neighbour_stats(spark, sf):
    """Among the stations that have traffic in the direction on the day."""
    daily = _history(spark, sf).groupBy("station", "direction", "date").agg(F.sum("total_traffic").alias("total_traffic"))
    out = quality.neighbour_stats(daily, _places(spark, sf), 2)
    return out.select("station", "direction", F.unix_seconds(F.col("date").cast("timestamp")).alias("date"), F.round("mean", 4).alias("mean"), F.round("std", 4).alias("std"))


@query(
    ", "
    + """e AS (SELECT s_nationkey AS by_nation, CAST(s_suppkey AS VARCHAR) AS station, s_acctbal AS km FROM supplier)
SELECT a.station, b.station AS near_code, round(abs(a.km - b.km), 6) AS distance, row_number() OVER (PARTITION BY a.station ORDER BY abs(a.km - b.km), b.station) AS rank
FROM e a JOIN e b ON a.by_nation = b.by_nation AND a.station <> b.station QUALIFY rank <= 3"""
)
def nearest_by_km(spark, sf):
    """Suppliers of a nation with the nearest balances."""
    s = table(spark, sf, "supplier").select(F.col("s_nationkey").alias("nation"), F.col("s_suppkey").cast("string").alias("station"), F.col("s_acctbal").alias("km"))
    return quality.nearest_by_km(s, 3, by=["nation"], order="station").select("station", "near_code", r6("distance", "distance"), F.col("rank").cast("long").alias("rank"))


@query(SUPPLIED + ALL + BORROWED.replace("@LEAST", "40") + "SELECT station, direction, month, day_type, round(mean, 4) AS mean, round(std, 4) AS std FROM lr")
def lane_ratio_stats(spark, sf):
    """Of all stations, each month and day type."""
    out = quality.lane_ratio_stats(_lane_history(spark, sf, "true"))
    return out.select("station", "direction", F.col("month").cast("long").alias("month"), "day_type", F.round("mean", 4).alias("mean"), F.round("std", 4).alias("std"))


@query(
    HISTORY
    + """, d AS (SELECT station, direction, date, sum(total_traffic) AS t FROM h GROUP BY ALL)
SELECT direction, epoch(date)::BIGINT AS date, round(avg(t), 4) AS mean, round(stddev_pop(t), 4) AS std FROM d GROUP BY ALL"""
)
def direction_stats(spark, sf):
    """A22."""
    daily = _history(spark, sf).groupBy("station", "direction", "date").agg(F.sum("total_traffic").alias("total_traffic"))
    return quality.direction_stats(daily).select("direction", F.unix_seconds(F.col("date").cast("timestamp")).alias("date"), F.round("mean", 4).alias("mean"), F.round("std", 4).alias("std"))


VALIDATED = (
    SUPPLIED
    + """, t AS (SELECT CAST(user_id % 97 + 1 AS VARCHAR) AS station, user_id % 4 + 1 AS lane, date_trunc('hour', ts) AS time, count(*) AS value FROM events GROUP BY ALL),
tr AS (SELECT *, CASE WHEN lane <= 2 THEN 'NORD' ELSE 'SUD' END AS direction, CAST(time AS DATE) AS day FROM t WHERE CAST(time AS DATE) IN (SELECT day FROM hist)),
daily AS (SELECT station, direction, day, sum(value)::DOUBLE AS total, month(day) AS month, CASE WHEN isodow(day) >= 6 THEN 'Festivo' ELSE 'Feriale' END AS day_type FROM tr GROUP BY ALL),
wanted AS (SELECT DISTINCT station, km, direction, month, day_type FROM daily LEFT JOIN places USING (station))"""
    + BORROWED.replace("@LEAST", "30")
    + """, sides AS (SELECT station, direction, day, total, km FROM daily JOIN places USING (station) WHERE km IS NOT NULL),
n11 AS (SELECT a.station, a.direction, a.day, b.total FROM sides a JOIN sides b ON a.direction = b.direction AND a.day = b.day AND a.station <> b.station QUALIFY row_number() OVER (PARTITION BY a.station, a.direction, a.day ORDER BY abs(a.km - b.km), b.station) <= 3),
s11 AS (SELECT station, direction, day, avg(total) AS mean, stddev_pop(total) AS std FROM n11 GROUP BY ALL),
ln AS (SELECT station, direction, day, lane, sum(value) AS v FROM tr GROUP BY ALL),
ra AS (SELECT station, direction, day, CASE WHEN count(*) = 2 AND arg_max(v, lane) <> 0 THEN arg_min(v, lane)::DOUBLE / arg_max(v, lane) END AS r FROM ln GROUP BY ALL),
fl AS (SELECT d.station, d.direction, d.day,
 CASE WHEN w.km IS NULL AND w.n < 30 THEN NULL WHEN hs.mean IS NULL OR hs.std IS NULL THEN false WHEN hs.std = 0 THEN NULL ELSE (total - hs.mean) / hs.std >= -2.5 END AS layer_1,
 CASE WHEN w.km IS NULL AND w.n < 30 THEN NULL WHEN s11.std IS NULL OR s11.std = 0 THEN NULL ELSE (total - s11.mean) / s11.std >= -2.0 END AS layer_1_1,
 CASE WHEN w.km IS NULL AND w.n < 30 THEN NULL WHEN r IS NULL OR lr.station IS NULL THEN NULL WHEN lr.mean IS NULL OR lr.std IS NULL THEN false WHEN lr.std = 0 THEN NULL ELSE (r - lr.mean) / lr.std BETWEEN -5 AND 5 END AS layer_2
 FROM daily d JOIN w USING (station, direction, month, day_type) LEFT JOIN hs USING (station, direction, month, day_type) LEFT JOIN lr ON lr.station = d.station AND lr.direction = d.direction AND lr.month = d.month AND lr.day_type = d.day_type
 LEFT JOIN s11 ON s11.station = d.station AND s11.direction = d.direction AND s11.day = d.day LEFT JOIN ra ON ra.station = d.station AND ra.direction = d.direction AND ra.day = d.day),
hr AS (SELECT station, CASE WHEN lane <= 2 THEN 'NORD' ELSE 'SUD' END AS direction, time, sum(value) AS v FROM t GROUP BY ALL),
pv AS (SELECT *, lag(v) OVER q AS b, sum(v) OVER (q ROWS 3 PRECEDING) AS z0, count(v) OVER (q ROWS 3 PRECEDING) AS c0 FROM hr WINDOW q AS (PARTITION BY station, direction ORDER BY time)),
zz AS (SELECT *, c0 = 4 AND z0 = 0 AS z FROM pv),
l3 AS (SELECT station, direction, time, NOT (coalesce((v - b) * 100.0::DOUBLE / nullif(b, 0) <= -99 AND b >= 50, false) OR z OR coalesce(lead(z, 1) OVER q, false) OR coalesce(lead(z, 2) OVER q, false) OR coalesce(lead(z, 3) OVER q, false)) AS layer_3 FROM zz WINDOW q AS (PARTITION BY station, direction ORDER BY time))
SELECT epoch(time)::BIGINT AS time, station, lane, value, layer_1, layer_1_1, layer_2, layer_3,
 CASE WHEN layer_1 = false AND coalesce(layer_1_1, false) = false THEN 0 WHEN layer_3 THEN 1 ELSE 0 END AS is_valid
FROM tr JOIN fl USING (station, direction, day) JOIN l3 USING (station, direction, time)"""
)


def _judged(spark, sf):
    """Hourly events as traffic of lanes."""
    station = (F.col("user_id") % 97 + 1).cast("string")
    return table(spark, sf, "events").groupBy(station.alias("station"), (F.col("user_id") % 4 + 1).cast("long").alias("lane"), F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("time")).agg(F.count(F.lit(1)).alias("value"))


FLAGS = ("station", "lane", "value", "layer_1", "layer_1_1", "layer_2", "layer_3", "is_valid")


@query(VALIDATED)
def validate_traffic(spark, sf):
    """Hourly events as traffic of lanes, judged by a history made of daily order lines, on the days that both have."""
    history, stations = _supplied(spark, sf)
    out = quality.validate_traffic(_judged(spark, sf), history, stations, spark.createDataFrame([], "date date"), least=30)
    return out.select(epoch("time", "time"), *FLAGS)


@query(VALIDATED)
def validate_by_moments(spark, sf):
    """The same rows, from moments of most of the history to which later days are merged, some of them sent a second time."""
    history, stations = _supplied(spark, sf)
    # written once: sums of lines and of lane days don't share tasks, and neither lines nor events are read for each use
    history, none = held(history.withColumn("date", F.date_sub("date", 1)), "history"), spark.createDataFrame([], "date date")
    late, again = F.col("date") >= "2023-12-01", F.col("date").between("2023-01-10", "2023-01-25")
    wrong = history.where(~late).withColumn("total_traffic", F.when(again, F.col("total_traffic") * 3 + 1).otherwise(F.col("total_traffic")))
    known = quality.History.of(wrong, none).updated(history.where(late | again), none)
    out = quality.validate_traffic(held(_judged(spark, sf), "traffic"), known, stations, none, least=30)
    return out.select(epoch("time", "time"), *FLAGS)


@query(
    """, c AS (SELECT c_custkey AS id, c_acctbal AS x, (c_custkey * 37 % 1000)::DOUBLE AS y FROM customer), s AS (SELECT s_suppkey AS code, s_acctbal AS x, (s_suppkey * 91 % 1000)::DOUBLE AS y FROM supplier)
SELECT id, code, round(d, 6) AS distance FROM (SELECT id, code, sqrt((c.x - s.x) * (c.x - s.x) + (c.y - s.y) * (c.y - s.y)) AS d FROM c, s) QUALIFY row_number() OVER (PARTITION BY id ORDER BY d, code) = 1"""
)
def nearest_place(spark, sf):
    """The supplier nearest to each customer, by balance and number."""
    of = lambda t, key, bal, k: table(spark, sf, t).select(F.col(key), F.col(bal).cast("double").alias("x"), (F.col(key) * k % 1000).cast("double").alias("y"))
    out = places.nearest_place(of("customer", "c_custkey", "c_acctbal", 37), of("supplier", "s_suppkey", "s_acctbal", 91), "c_custkey", "s_suppkey", 64.0)
    return out.select(F.col("c_custkey").alias("id"), F.col("s_suppkey").alias("code"), r6("distance", "distance"))


FLEET = """, t AS (SELECT CAST(l_suppkey AS VARCHAR) AS "Station", date_trunc('day', l_shipdate) AS d, l_returnflag AS "Category", sum(l_quantity) AS n, avg(40 + l_linenumber * 12.5::DOUBLE) AS v FROM lineitem GROUP BY ALL),
fleet AS (SELECT * FROM (VALUES ('A', 'p', 1, 0.25::DOUBLE), ('A', 'd', 2, 0.75::DOUBLE), ('N', 'p', 1, 1.0::DOUBLE), ('R', 'd', 3, 0.5::DOUBLE)) f(c, fuel, euro, share)),
e AS (SELECT t.*, fuel, euro, n * share AS n2, least(greatest(v, 50), 90) AS s FROM t JOIN fleet ON c = "Category"),
x AS (SELECT *, (0.01 * s * s + 0.2 * s + 3 + 5 / s) / (0.001 * s * s + 0.02 * s + euro) * (1 - 0.1::DOUBLE) * (1 - 0.05::DOUBLE) * n2 AS em FROM e)
"""


@query(FLEET + """SELECT "Station" AS station, epoch(d)::BIGINT AS ts, "Category" AS category, round_even(sum(n2), 0)::BIGINT AS transits, round(sum(em), 4) AS e FROM x GROUP BY ALL""")
def aggregate_emissions(spark, sf):
    """Quantities as transits of a fleet with three classes."""
    lines = table(spark, sf, "lineitem").groupBy(F.col("l_suppkey").cast("string").alias("Station"), F.date_trunc("day", F.col("l_shipdate").cast("timestamp")).alias("date"), F.col("l_returnflag").alias("Category")).agg(F.sum("l_quantity").alias("Transits"), F.avg(40 + F.col("l_linenumber") * 12.5).alias("Speed"))
    fleet = spark.createDataFrame([("A", "p", 1, 0.25), ("A", "d", 2, 0.75), ("N", "p", 1, 1.0), ("R", "d", 3, 0.5)], "Category string, Fuel string, ID_Euro int, PercvsADT double")
    names = "Location string, Category string, Fuel string, ID_Euro int, RoadSlope double, MinSpeed double, MaxSpeed double, Alpha double, Beta double, Gamma double, Delta double, Epsilon double, Zita double, Hta double, EuroReductionFactor double, FuelReductionFactor double"
    curves = spark.createDataFrame([("M", r[0], r[1], r[2], None, 50.0, 90.0, 0.01, 0.2, 3.0, 5.0, 0.001, 0.02, float(r[2]), 0.1, 0.05) for r in (("A", "p", 1), ("A", "d", 2), ("N", "p", 1), ("R", "d", 3))], names)
    rows = emissions.with_fleet(lines.withColumns({"Location": F.lit("M"), "RoadSlope": F.lit(None).cast("double")}), fleet)
    out = emissions.aggregate_emissions(emissions.emissions(emissions.with_coefficients(rows, curves)), ["Station", "date", "Category"])
    return out.select(F.col("Station").alias("station"), epoch("date"), F.col("Category").alias("category"), F.col("Transits").alias("transits"), F.round("E", 4).alias("e"))


@query(
    """, p AS (SELECT station_code, date_trunc('hour', ts) AS t, sum(value) FILTER (type_name = 'view') AS a, sum(value) FILTER (type_name = 'click') AS b, sum(value) FILTER (type_name = 'purchase') AS c
 FROM m WHERE type_name IN ('view', 'click', 'purchase') GROUP BY 1, 2) SELECT station_code, epoch(t)::BIGINT AS ts, round(coalesce(a, 0), 6) AS light_vehicles, round(coalesce(b, 0), 6) AS heavy_vehicles, round(coalesce(c, 0), 6) AS buses FROM p"""
)
def emission_pivot(spark, sf):
    """Hourly sums of three types as vehicle classes."""
    cls = F.when(F.col("type_name") == "view", "LIGHT_VEHICLES").when(F.col("type_name") == "click", "HEAVY_VEHICLES").when(F.col("type_name") == "purchase", "BUSES")
    rows = measurements(spark, sf).select("station_code", F.date_trunc("hour", "ts").alias("ts"), cls.alias("vehicle_class"), F.lit("NOx").alias("pollutant"), "value").where("vehicle_class IS NOT NULL")
    return emissions.emission_pivot(rows).select("station_code", epoch("ts"), r6("light_vehicles", "light_vehicles"), r6("heavy_vehicles", "heavy_vehicles"), r6("buses", "buses"))


@query(
    """, s AS (SELECT station_code, date_trunc('day', ts) AS t, CASE type_name WHEN 'view' THEN 'NOx' WHEN 'click' THEN 'CO2' ELSE 'PM' END AS p, sum(value) AS v FROM m GROUP BY ALL)
SELECT station_code, epoch(t)::BIGINT AS ts, p || '-emissions' AS type_name, round(v, 6) AS value, NULL::VARCHAR AS string_value FROM s
UNION ALL SELECT station_code, epoch(t)::BIGINT, p || '-emissions-impact', NULL, CASE p WHEN 'NOx' THEN CASE WHEN v > 120 THEN 'high' WHEN v > 60 THEN 'medium' ELSE 'low' END WHEN 'CO2' THEN CASE WHEN v > 70000 THEN 'high' WHEN v > 35000 THEN 'medium' ELSE 'low' END ELSE 'undefined' END FROM s"""
)
def sum_emissions(spark, sf):
    """Daily sums by pollutant and their impact."""
    kind = F.when(F.col("type_name") == "view", "light-NOx").when(F.col("type_name") == "click", "light-CO2").otherwise("light-PM")
    m = measurements(spark, sf).select("station_code", F.date_trunc("day", "ts").alias("ts"), kind.alias("type_name"), "value")
    return emissions.sum_emissions(m).select("station_code", epoch("ts"), "type_name", r6("value", "value"), "string_value")


@query("SELECT event_id FROM m WHERE type_name <> 'error' AND (station_code, date_trunc('day', ts)) IN (SELECT station_code, date_trunc('day', ts) FROM m WHERE type_name = 'error')")
def only_validated(spark, sf):
    """Events of days on which the user had an error."""
    m = measurements(spark, sf).withColumn("ts", F.date_trunc("day", "ts"))
    flags = m.where("type_name = 'error'").select("station_code", "ts", F.lit(1).alias("value"))
    return emissions.only_validated(m.where("type_name <> 'error'"), flags).select("event_id")


@query(
    """SELECT station_code, epoch(date_trunc('hour', ts))::BIGINT AS ts, CASE WHEN type_name IN ('view', 'signup') THEN 'LIGHT_VEHICLES' ELSE 'HEAVY_VEHICLES' END AS vehicle_class,
 arg_min(value, (ts, value)) FILTER (type_name IN ('view', 'click')) AS nr_of_vehicles, arg_min(value, (ts, value)) FILTER (type_name IN ('signup', 'error')) AS average_speed FROM m WHERE type_name <> 'purchase' GROUP BY ALL"""
)
def traffic_entries(spark, sf):
    """The first count and speed of each user, hour and class."""
    names = {"view": "Nr. Light Vehicles", "click": "Nr. Heavy Vehicles", "signup": "Average Speed Light Vehicles", "error": "Average Speed Heavy Vehicles"}
    name = F.create_map(*(F.lit(x) for kv in names.items() for x in kv))[F.col("type_name")]
    m = measurements(spark, sf).withColumns({"type_name": name, "created_on": F.col("ts"), "ts": F.date_trunc("hour", "ts")}).where("type_name IS NOT NULL")
    return emissions.traffic_entries(m).select("station_code", epoch("ts"), "vehicle_class", "nr_of_vehicles", "average_speed")


@query("SELECT split_part(c, ':', 2) AS station, epoch(t)::BIGINT AS ts, cls AS vehicle_class, round(sum(value), 6) AS value FROM (SELECT 'R1:' || station_code || ':' || event_id % 3 AS c, date_trunc('day', ts) AS t, type_name AS cls, value FROM m) GROUP BY ALL")
def emissions_by_station(spark, sf):
    """Lanes added for each station."""
    code = F.concat(F.lit("R1:"), F.col("station_code"), F.lit(":"), F.col("event_id") % 3)
    m = measurements(spark, sf).select(code.alias("station_code"), F.date_trunc("day", "ts").alias("ts"), F.col("type_name").alias("vehicle_class"), F.lit("NOx").alias("pollutant"), "value")
    return emissions.emissions_by_station(m).select("station", epoch("ts"), "vehicle_class", r6("value", "value"))
