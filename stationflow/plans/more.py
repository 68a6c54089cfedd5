"""Queries on stations, files, observation checks, and the streaming form of trips."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from .. import functions as fn
from .. import sources
from ..operators import catalog, dispersion, emissions, quality, roadwx, trips
from ..streaming import stateful, stream_match
from .base import epoch, measurements, query, r6, table
from .traffic import TRIPS


def _folder(spark) -> str:
    """A new folder that driver and executors share."""
    return f"{sources.shared_dir(spark)}/{uuid.uuid4().hex}"


@query("SELECT CAST(s_suppkey AS VARCHAR) AS station_code, round(s_acctbal / 1000, 6) AS km FROM supplier WHERE s_acctbal / 1000 > 0 AND s_nationkey % 3 <> 0 AND s_nationkey % 5 <> 0")
def eligible_traffic_stations(spark, sf):
    """P10: suppliers with their balance as metres in embedded JSON."""
    kind = F.when(F.col("s_nationkey") % 3 == 0, "radar").otherwise(F.when(F.col("s_nationkey") % 2 == 0, "camera").otherwise("induction_loop"))
    metadata = F.to_json(F.struct(kind.alias("sensor_type"), F.to_json(F.struct(F.col("s_acctbal").alias("metro"))).alias("a22_metadata")))
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").cast("string").alias("station_code"), F.when(F.col("s_nationkey") % 5 == 0, "FAMAS-traffic").alias("origin"), metadata.alias("metadata"))
    return quality.eligible_traffic_stations(s).select("station_code", r6("km", "km"))


@query("SELECT c_custkey, coalesce(CASE WHEN c_nationkey > 20 THEN 'city' END, CASE WHEN c_nationkey > 12 THEN 'town' END, CASE WHEN c_nationkey > 6 THEN 'village' END, c_mktsegment) AS municipality FROM customer")
def municipalities(spark, sf):
    """P35."""
    at = lambda n, name: F.when(F.col("c_nationkey") > n, name).alias(name)
    rows = table(spark, sf, "customer").select("c_custkey", at(20, "city"), at(12, "town"), at(6, "village"), F.col("c_mktsegment").alias("hamlet"))
    return catalog.municipalities(rows).select("c_custkey", "municipality")


@query(
    """, d AS (SELECT unnest(generate_series(DATE '1995-01-01', DATE '1995-12-31', INTERVAL 1 DAY)) AS d),
e AS (SELECT CASE WHEN o_orderstatus = 'P' THEN 'holiday' ELSE 'school' END AS kind, o_orderdate AS b, o_orderdate + INTERVAL 2 DAY AS t FROM orders WHERE o_orderpriority = '1-URGENT' AND o_totalprice > 490000),
f AS (SELECT DISTINCT kind, unnest(generate_series(b, t, INTERVAL 1 DAY)) AS d FROM e)
SELECT epoch(d)::BIGINT AS date, (d IN (SELECT d FROM f WHERE kind = 'school') OR isodow(d) >= 6)::INT AS is_school, (d IN (SELECT d FROM f WHERE kind = 'holiday') OR isodow(d) = 7)::INT AS is_holiday FROM d"""
)
def holiday_calendar(spark, sf):
    """Large urgent orders as holidays of three days."""
    o = table(spark, sf, "orders").where("o_orderpriority = '1-URGENT' AND o_totalprice > 490000")
    events = o.select(F.when(F.col("o_orderstatus") == "P", "holiday").otherwise("school").alias("kind"), F.col("o_orderdate").alias("begin"), (F.col("o_orderdate") + F.expr("INTERVAL 2 DAY")).alias("end"))
    out = catalog.holiday_calendar(events, F.lit("1995-01-01"), F.lit("1995-12-31"))
    return out.select(F.unix_seconds(F.col("date").cast("timestamp")).alias("date"), "is_school", "is_holiday")


@query(
    """, p AS (SELECT CAST(s_nationkey AS VARCHAR) AS link_code, s_suppkey::DOUBLE AS x, s_acctbal AS y, lag(s_suppkey::DOUBLE) OVER w AS px, lag(s_acctbal) OVER w AS py FROM supplier WINDOW w AS (PARTITION BY s_nationkey ORDER BY s_suppkey))
SELECT CAST(n_nationkey AS VARCHAR) AS link_code, round(CASE WHEN count(x) = 0 THEN -1 ELSE sum(coalesce(sqrt((x - px) * (x - px) + (y - py) * (y - py)), 0)) END, 4) AS length_m FROM nation LEFT JOIN p ON link_code = CAST(n_nationkey AS VARCHAR) GROUP BY 1"""
)
def update_link_geometry(spark, sf):
    """Lines through the suppliers of each nation."""
    edges = table(spark, sf, "nation").select(F.col("n_nationkey").cast("string").alias("link_code"), F.lit(None).cast("array<struct<x: double, y: double>>").alias("geometry"), F.lit(-1.0).alias("length_m"))
    point = F.struct(F.col("s_suppkey").cast("double").alias("x"), F.col("s_acctbal").alias("y"))
    shapes = table(spark, sf, "supplier").groupBy(F.col("s_nationkey").cast("string").alias("link_code")).agg(F.array_sort(F.collect_list(point)).alias("geometry"))
    return trips.update_link_geometry(edges, shapes).select("link_code", F.round("length_m", 4).alias("length_m"))


@query("SELECT station_code, epoch(date_trunc('day', ts))::BIGINT AS ts, arg_max(value, (ts, value)) FILTER (type_name = 'view') AS view, arg_max(value, (ts, value)) FILTER (type_name = 'click') AS click FROM m GROUP BY 1, 2")
def weather_entries(spark, sf):
    """The last view and click of each day."""
    m = measurements(spark, sf).withColumns({"created_on": F.col("ts"), "ts": F.date_trunc("day", "ts")})
    return emissions.weather_entries(m, ["view", "click"]).select("station_code", epoch("ts"), "view", "click")


OBS = """, f AS (SELECT type_name, date_trunc('hour', ts) AS t, avg(value) AS v, count(*) AS n FROM m GROUP BY 1, 2), o AS (SELECT type_name, t, (n % 2)::INT AS pi, (n % 3)::INT AS sc FROM f WHERE t < TIMESTAMP '2024-01-15')
"""


def _obs(spark, sf):
    f = measurements(spark, sf).groupBy(F.col("type_name").alias("station_code"), F.date_trunc("hour", "ts").alias("ts")).agg(F.avg("value").alias("v"), F.count(F.lit(1)).alias("n"))
    return f, f.where("ts < '2024-01-15'").select("station_code", "ts", (F.col("n") % 2).cast("int").alias("pi"), (F.col("n") % 3).cast("int").alias("sc"))


@query(OBS + "SELECT type_name AS station_code, epoch(f.t)::BIGINT AS ts, round(CASE WHEN pi IS NULL THEN v ELSE v * pi END, 4) AS qp, coalesce(sc, 1) AS sc FROM f LEFT JOIN o USING (type_name, t)")
def gate_precip(spark, sf):
    """J22."""
    fc, obs = _obs(spark, sf)
    return roadwx.gate_precip(obs, fc.withColumnRenamed("v", "qp")).select("station_code", epoch("ts"), F.round("qp", 4).alias("qp"), "sc")


@query(
    OBS
    + """, s AS (SELECT type_name, CAST(t AS DATE) AS d, min(t) FILTER (hour(t) >= 5) AS up, max(t) FILTER (hour(t) <= 18) AS down FROM f WHERE day(t) % 2 = 0 GROUP BY 1, 2)
SELECT f.type_name AS station_code, epoch(t)::BIGINT AS ts, round(CASE WHEN t IN (coalesce(up, date_trunc('day', t) + INTERVAL 6 HOUR), coalesce(down, date_trunc('day', t) + INTERVAL 20 HOUR)) THEN v END, 4) AS sst FROM f LEFT JOIN s ON s.type_name = f.type_name AND d = CAST(t AS DATE)"""
)
def sst_at_sun(spark, sf):
    """On even days between a first and a last hour, by the default hours on others."""
    fc, _ = _obs(spark, sf)
    sun = fc.where("day(ts) % 2 = 0").groupBy("station_code", F.to_date("ts").alias("date")).agg(F.min(F.when(F.hour("ts") >= 5, F.col("ts"))).alias("sunrise"), F.max(F.when(F.hour("ts") <= 18, F.col("ts"))).alias("sunset"))
    return roadwx.sst_at_sun(fc.withColumnRenamed("v", "sst"), sun).select("station_code", epoch("ts"), F.round("sst", 4).alias("sst"))


@query(
    OBS
    + """, ob AS (SELECT *, v * 1.1::DOUBLE - 3 AS "at", v + 5 AS td, v / 2 AS ws, type_name <> 'error' AS ok FROM f WHERE t < TIMESTAMP '2024-01-15'),
e AS (SELECT type_name, max(t) AS end_t, bool_and(ok) AS ok FROM ob GROUP BY 1),
z AS (SELECT e.*, o."at" AS oa, o.td AS ot, o.ws AS ow, f.v AS fv FROM e JOIN ob o ON o.type_name = e.type_name AND o.t = end_t LEFT JOIN f ON f.type_name = e.type_name AND f.t = end_t),
j AS (SELECT f.type_name, f.t, f.v, o."at", o.td, o.ws, z.* EXCLUDE (type_name), (epoch_us(f.t) - epoch_us(end_t)) / 1e6 AS age FROM f LEFT JOIN ob o ON o.type_name = f.type_name AND o.t = f.t LEFT JOIN z ON z.type_name = f.type_name),
b AS (SELECT type_name, t,
 CASE WHEN ok AND age <= 0 THEN coalesce("at", v) WHEN ok THEN v - exp(-age / 14400) * (fv - oa) ELSE v END AS "at",
 CASE WHEN age <= 0 THEN coalesce(td, v) ELSE v - exp(-age / 14400) * (fv - ot) END AS td,
 CASE WHEN age <= 0 THEN coalesce(ws, v) WHEN age >= 14400 THEN v
  WHEN ow < fv THEN v * (CASE WHEN ow = 0 THEN 1.0 ELSE ow END / CASE WHEN fv < 0.01 THEN 1.0 ELSE fv END + (1 - CASE WHEN ow = 0 THEN 1.0 ELSE ow END / CASE WHEN fv < 0.01 THEN 1.0 ELSE fv END) * age / 14400)
  ELSE v - exp(-age / 14400) * (fv - ow) END AS ws FROM j)
SELECT type_name AS station_code, epoch(t)::BIGINT AS ts, round("at", 6) AS "at", round(least(td, "at"), 6) AS td, round(ws, 6) AS ws FROM b"""
)
def blend_obs_forecast(spark, sf):
    """Hourly means as forecast, observed until the 15th (air temperatures of one type are invalid)."""
    fc, _ = _obs(spark, sf)
    fc = fc.select("station_code", "ts", *(F.col("v").alias(c) for c in ("at", "td", "ws")))
    seen = {"at": F.col("at") * 1.1 - 3, "td": F.col("td") + 5, "ws": F.col("ws") / 2}
    obs = fc.where("ts < '2024-01-15'").select("station_code", "ts", *(x.alias(c) for c, x in seen.items()), (F.col("station_code") != "error").alias("at_valid"), F.lit(True).alias("td_valid"), F.lit(True).alias("ws_valid"))
    return roadwx.blend_obs_forecast(obs, fc).select("station_code", epoch("ts"), r6("at", "at"), r6("td", "td"), r6("ws", "ws"))


@query(
    """, r AS (SELECT type_name AS station_code, ts, event_id, value - 100 AS st, value / 2 - 50 AS sst FROM m WHERE ts >= TIMESTAMP '2024-01-25'),
g AS (SELECT *, CASE WHEN epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY station_code ORDER BY ts)) > 3600e6 THEN ts END AS gap FROM r),
k AS (SELECT *, max(gap) OVER (PARTITION BY station_code) AS last FROM g)
SELECT event_id, st BETWEEN -40 AND 80 AS st_valid, round(last_value(CASE WHEN sst BETWEEN -40 AND 80 THEN sst END IGNORE NULLS) OVER (PARTITION BY station_code ORDER BY ts), 6) AS sst FROM k WHERE last IS NULL OR ts >= last"""
)
def qc_observation(spark, sf):
    """Events after the last gap of an hour."""
    rows = measurements(spark, sf).select(F.col("type_name").alias("station_code"), "ts", "event_id", F.lit(1.0).alias("at"), F.lit(0.0).alias("td"), F.lit(1.0).alias("ws"), (F.col("value") - 100).alias("st"), (F.col("value") / 2 - 50).alias("sst"))
    out = quality.qc_observation(rows, F.lit("2024-01-27").cast("timestamp"), max_gap_min=60)
    return out.select("event_id", "st_valid", r6("sst", "sst"))


@query(
    """, r AS (SELECT type_name AS station_code, ts, CASE WHEN event_id % 4 = 0 THEN NULL ELSE value END AS v, (event_id % 11)::DOUBLE AS cc, value AS ra FROM m),
w AS (SELECT *, lag(ra) OVER o AS pra, lag(ts) OVER o AS pts FROM r WINDOW o AS (PARTITION BY station_code ORDER BY ts))
SELECT station_code, count(*) FILTER (v IS NULL) AS missing, count(*) FILTER (cc > 8) AS clouds, count(*) FILTER (ra < pra) AS falling, count(*) FILTER (ts - pts <> INTERVAL 1 HOUR) AS spacing, count(*) AS rows, true AS overlaps, false AS usable FROM w GROUP BY 1"""
)
def qc_forecast(spark, sf):
    """Events as a forecast with all kinds of faults."""
    rows = measurements(spark, sf).select(F.col("type_name").alias("station_code"), "ts", F.when(F.col("event_id") % 4 != 0, F.col("value")).alias("at"), F.lit(0.0).alias("td"), F.col("value").alias("ra"), F.lit(0.0).alias("sn"), F.lit(1.0).alias("ws"), F.lit(1000.0).alias("ap"), (F.col("event_id") % 11).cast("double").alias("cc"))
    return quality.qc_forecast(rows, rows.select("station_code", "ts"))


@query(
    """, r AS (SELECT station_code, ts, CASE WHEN event_id % 2 = 0 THEN value END AS st, CASE WHEN event_id % 3 = 0 THEN value END AS sst, row_number() OVER (PARTITION BY station_code ORDER BY ts) AS n FROM m),
b AS (SELECT a.station_code, a.ts, count(b.ts) AS near FROM r a LEFT JOIN r b ON a.station_code = b.station_code AND b.st IS NOT NULL AND b.ts <> a.ts AND abs(epoch_us(a.ts) - epoch_us(b.ts)) <= 14400e6 WHERE a.st IS NOT NULL AND a.sst IS NOT NULL GROUP BY 1, 2)
SELECT r.station_code, count(b.ts) > 0 AS has_both, count(*) FILTER (near = 0) = 0 AS has_company, count(st) >= 2 AS has_two, count(*) FILTER (n <= 2 AND st IS NOT NULL) > 0 AS has_early, has_both AND has_company AND has_two AND has_early AS accepted FROM r LEFT JOIN b ON b.station_code = r.station_code AND b.ts = r.ts GROUP BY 1"""
)
def accept_observation(spark, sf):
    """W19."""
    rows = measurements(spark, sf).select("station_code", "ts", F.when(F.col("event_id") % 2 == 0, F.col("value")).alias("st"), F.when(F.col("event_id") % 3 == 0, F.col("value")).alias("sst"))
    return quality.accept_observation(rows)


@query(
    """SELECT c_custkey, round(coalesce(s_acctbal / 100, c_acctbal / 100), 6) AS km, round(CASE WHEN c_mktsegment = 'BUILDING' THEN CASE WHEN c_nationkey % 4 IN (1, 2) THEN -p_size ELSE p_size END END::DOUBLE, 6) AS slope
FROM customer LEFT JOIN supplier ON c_custkey = s_suppkey LEFT JOIN part ON round_even(coalesce(s_acctbal / 100, c_acctbal / 100), 0) = p_partkey"""
)
def road_geometry(spark, sf):
    """Customers on the road: km of suppliers, slopes of parts."""
    rows = table(spark, sf, "customer").select("c_custkey", F.col("c_custkey").alias("Station"), (F.col("c_acctbal") / 100).alias("KM"), (F.col("c_nationkey") % 4).alias("Lane"), F.col("c_mktsegment").alias("Category"))
    km = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("Station"), (F.col("s_acctbal") / 100).alias("km"))
    slopes = table(spark, sf, "part").select(F.col("p_partkey").alias("KM"), F.col("p_size").cast("double").alias("RoadSlope"))
    return emissions.with_slope(emissions.with_km(rows, km), slopes, ["BUILDING"]).select("c_custkey", r6("KM", "km"), r6("RoadSlope", "slope"))


@query(
    """, e AS (SELECT station_code, date_trunc('hour', ts) AS t, sum(value) AS v FROM m WHERE type_name = 'view' GROUP BY 1, 2), w AS (SELECT station_code, date_trunc('hour', ts) AS t, max(value) AS s FROM m WHERE type_name = 'click' GROUP BY 1, 2)
SELECT e.station_code AS traffic_station, epoch(e.t)::BIGINT AS ts, round(v, 6) AS value, s AS wind_speed FROM e JOIN w ON w.station_code = CAST(CAST(e.station_code AS INT) + 1 AS VARCHAR) AND w.t = e.t"""
)
def dispersion_inputs(spark, sf):
    """Views of a user and clicks of the next one."""
    m = measurements(spark, sf).withColumn("ts", F.date_trunc("hour", "ts"))
    emis = m.where("type_name = 'view'").groupBy("station_code", "ts").agg(F.sum("value").alias("value"))
    meteo = m.where("type_name = 'click'").groupBy("station_code", "ts").agg(F.max("value").alias("wind_speed"))
    domains = m.select("station_code").distinct().select(F.col("station_code").alias("domain_id"), F.col("station_code").alias("traffic_station"), (F.col("station_code").cast("int") + 1).cast("string").alias("weather_station"))
    both, _ = dispersion.dispersion_inputs(emis, meteo, domains)
    return both.select("traffic_station", epoch("ts"), r6("value", "value"), "wind_speed")


@query("SELECT type_name AS station_code, min(CASE WHEN value < 1 THEN 0 ELSE 1 END) AS confidence FROM m GROUP BY 1")
def overall_confidence(spark, sf):
    """A29."""
    rows = measurements(spark, sf).select(F.col("type_name").alias("station_code"), F.when(F.col("value") < 1, 0).otherwise(1).alias("confidence"))
    return roadwx.overall_confidence(rows)


@query("SELECT event_id, station_code AS station, CAST(event_id % 6 AS VARCHAR) AS lane, ascii(substr(type_name, 1, 1)) - 97 AS code FROM m")
def split_codes(spark, sf):
    """Composed codes taken apart, letters as numbers."""
    m = measurements(spark, sf).withColumn("code", F.concat_ws(":", F.lit("R1"), "station_code", F.col("event_id") % 6))
    return m.select("event_id", fn.code_part(F.col("code"), 1).alias("station"), fn.code_part(F.col("code"), 2).alias("lane"), fn.weather_code(F.substring("type_name", 1, 1)).alias("code"))


@query("SELECT year(l_shipdate)::INT AS year, month(l_shipdate)::INT AS month, count(*) AS rows FROM lineitem GROUP BY 1, 2")
def files_by_month(spark, sf):
    """Lines written by month of shipping and read again."""
    path = _folder(spark)
    sources.write_by_month(table(spark, sf, "lineitem").select("l_orderkey", F.col("l_shipdate").cast("timestamp").alias("ts")), path)
    return spark.read.schema("l_orderkey long, year int, month int").parquet(path).groupBy("year", "month").agg(F.count(F.lit(1)).alias("rows"))


@query("SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def csv_round_trip(spark, sf):
    """S3, S11."""
    path = _folder(spark)
    sources.write_csv(table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_acctbal"), path)
    return sources.read_dim_csv(spark, path, "s_suppkey long, s_name string, s_acctbal double")


@query("SELECT n_name AS name, 2020 AS year FROM nation")
def latest_year(spark, sf):
    """The newest of the files of three years that isn't after 2021."""
    path = _folder(spark)
    for year in (2018, 2020, 2022):
        table(spark, sf, "nation").select("n_name").coalesce(1).write.option("header", True).csv(f"{path}/fc_info_{year}")
    df = sources.with_year(sources.read_dim_csv(spark, f"{path}/fc_info_*", "n_name string"), r"fc_info_(\d{4})/")
    return sources.latest_year_file(df, 2021).select(F.col("n_name").alias("name"), "year")


@query(TRIPS + "SELECT device, epoch_us(ts) AS ts, round(value, 6) AS value FROM trips WHERE ts + INTERVAL 1 DAY <= (SELECT max(ts) FROM m WHERE type_name IN ('view', 'purchase')) - INTERVAL 11 MINUTE")
def stream_trips(spark, sf):
    """Trips of a stream of all events that its watermark has passed for good."""
    run = _folder(spark)
    source = spark.readStream.schema(spark.read.parquet(f"{sf}/events.parquet").schema).parquet(f"{sf}/event*.parquet")
    seen = source.where("event_type IN ('view', 'purchase')").select(F.col("event_type").alias("station_code"), F.col("user_id").cast("string").alias("device"), F.col("ts").cast("timestamp").alias("ts"))
    edges = spark.createDataFrame([("l", "view", "purchase")], "link_code string, origin_code string, destination_code string")
    q = stream_match(seen, edges, 86400).writeStream.format("parquet").option("path", f"{run}/out").option("checkpointLocation", f"{run}/state").trigger(availableNow=True).start()
    q.awaitTermination()
    out = spark.read.schema("link_code string, device string, ts timestamp, value double").parquet(f"{run}/out")
    last = seen_until(spark, sf)
    return out.crossJoin(F.broadcast(last)).where("ts + INTERVAL 1 DAY <= last - INTERVAL 11 MINUTE").select("device", F.unix_micros("ts").alias("ts"), r6("value", "value"))


STREAMED = TRIPS + "SELECT device, epoch_us(ts) AS ts, round(value, 6) AS value FROM trips WHERE ts + INTERVAL 1 DAY <= (SELECT max(ts) FROM m WHERE type_name IN ('view', 'purchase')) - INTERVAL 11 MINUTE"


def _streamed_trips(spark, sf, make):
    run = _folder(spark)
    source = spark.readStream.schema(spark.read.parquet(f"{sf}/events.parquet").schema).parquet(f"{sf}/event*.parquet")
    seen = source.where("event_type IN ('view', 'purchase')").select(F.col("event_type").alias("station_code"), F.col("user_id").cast("string").alias("device"), F.col("ts").cast("timestamp").alias("ts"))
    edges = spark.createDataFrame([("l", "view", "purchase")], "link_code string, origin_code string, destination_code string")
    with stateful.rocksdb(spark):
        q = make(seen, edges, 86400).writeStream.format("parquet").option("path", f"{run}/out").option("checkpointLocation", f"{run}/state").trigger(availableNow=True).start()
        q.awaitTermination()
    out = spark.read.schema("link_code string, device string, ts timestamp, value double").parquet(f"{run}/out")
    last = seen_until(spark, sf)
    return out.crossJoin(F.broadcast(last)).where("ts + INTERVAL 1 DAY <= last - INTERVAL 11 MINUTE").select("device", F.unix_micros("ts").alias("ts"), r6("value", "value"))


@query(STREAMED)
def stream_trips_state(spark, sf):
    """The same trips, by a list and a timer of each device."""
    return _streamed_trips(spark, sf, stateful.trips_with_state)


@query(STREAMED)
def stream_trips_join(spark, sf):
    """The same trips, by an interval join of two streams."""
    return _streamed_trips(spark, sf, stateful.trips_by_join)


def seen_until(spark, sf):
    """The last time of a view or purchase, one row."""
    return measurements(spark, sf).where("type_name IN ('view', 'purchase')").agg(F.max("ts").alias("last"))
