"""Queries on air quality, dispersion and road weather."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import functions as fn
from ..operators import air, dispersion, roadwx
from .base import epoch, measurements, query, r6, table


@query("SELECT event_id, CASE WHEN value >= 340 THEN 'extremely poor' WHEN value >= 230 THEN 'very poor' WHEN value >= 120 THEN 'poor' WHEN value >= 90 THEN 'moderate' WHEN value >= 40 THEN 'fair' ELSE 'good' END AS string_value FROM m WHERE value >= 0 AND type_name IN ('view', 'click')")
def rate_no2(spark, sf):
    """P2, P3."""
    m = air.no2_inputs(measurements(spark, sf).withColumn("origin", F.lit("x")), ["view", "click"], ["x"])
    return air.rate_no2(m).select("event_id", "string_value")


@query(
    """, w AS (SELECT station_code, date_trunc('day', ts) AS t, arg_max(value, (ts, value)) FILTER (type_name = 'view') AS no2, arg_max(value, (ts, value)) FILTER (type_name = 'click') AS o3, arg_max(value, (ts, value)) FILTER (type_name = 'error') AS temp
 FROM m GROUP BY 1, 2), k AS (SELECT *, 1 + 0.002::DOUBLE * no2 * no2 + 0.3::DOUBLE * no2 + CASE WHEN temp / 5 >= 35 THEN 0.5::DOUBLE * pow(o3, 0.1::DOUBLE) ELSE -0.5::DOUBLE * o3 END + 0.00001::DOUBLE * pow(temp / 5, 4) AS v FROM w WHERE no2 IS NOT NULL AND o3 IS NOT NULL AND temp IS NOT NULL)
SELECT station_code, epoch(t)::BIGINT AS ts, 'NO2-Alphasense_processed' AS type_name, round(greatest(v, 0), 4) AS value FROM k"""
)
def calibrate(spark, sf):
    """Days of users with a view (NO2), a click (O3) and an error (temperature)."""
    names = F.create_map(F.lit("view"), F.lit(air.NO2), F.lit("click"), F.lit(air.O3), F.lit("error"), F.lit(air.T))
    m = measurements(spark, sf).withColumns({"type_name": names[F.col("type_name")], "created_on": F.col("ts"), "ts": F.date_trunc("day", "ts")}).where("type_name IS NOT NULL")
    wide = air.widen(m, [air.NO2, air.O3, air.T]).withColumns({air.T: F.col(f"`{air.T}`") / 5, "sensor_id": F.lit("s")})
    params = spark.createDataFrame([("s", air.NO2, "hightemp", 1, 1.0, 0.002, 0.3, 0.5, 0.00001, 0.0), ("s", air.NO2, "lowtemp", 2, 1.0, 0.002, 0.3, -0.5, 0.00001, 0.0)], "sensor_id string, type_name string, temperature string, calc_version int, a double, b double, c double, d double, e double, f double")
    return air.calibrate(wide, params).select("station_code", epoch("ts"), "type_name", F.round("value", 4).alias("value"))


@query(
    """, h AS (SELECT unnest([1, 2, 3]) AS i, unnest(['a', NULL, 'c']) AS id, unnest([TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-08', TIMESTAMP '2024-01-18']) AS s, unnest([TIMESTAMP '2024-01-08', TIMESTAMP '2024-01-15', TIMESTAMP '2024-01-28']) AS e),
r AS (SELECT event_id, ts, id, s FROM m JOIN h ON ts <= e QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY i) = 1)
SELECT event_id, id AS sensor_id FROM r WHERE id IS NOT NULL AND s <= ts"""
)
def attach_sensor(spark, sf):
    """Three entries with a gap and one without id."""
    m = measurements(spark, sf)
    entries = F.expr("array(named_struct('id', 'a', 'start', '2024-01-01', 'end', '2024-01-08'), named_struct('id', '', 'start', '2024-01-08', 'end', '2024-01-15'), named_struct('id', 'c', 'start', '2024-01-18', 'end', '2024-01-28'))")
    history = m.select("station_code").distinct().withColumn("history", entries)
    return air.attach_sensor(m, history).select("event_id", "sensor_id")


@query("SELECT station_code, epoch_us(coalesce(min(d), min(f))) AS start, epoch_us(max(r)) AS \"end\" FROM (SELECT station_code, type_name, max(ts) FILTER (value > 200) AS d, max(ts) FILTER (NOT value > 200) AS r, min(ts) FILTER (NOT value > 200) AS f FROM m GROUP BY 1, 2) GROUP BY 1")
def elaboration_state(spark, sf):
    """Large values as processed ones."""
    out = air.elaboration_state(measurements(spark, sf), F.col("value") > 200)
    return out.select("station_code", F.unix_micros("start").alias("start"), F.unix_micros("end").alias("end"))


METEO = """, h AS (SELECT type_name AS station_code, date_trunc('hour', ts) AS hour, epoch(min(ts))::BIGINT AS ts, round_even(avg(value * 2.71828::DOUBLE - 300), 1) AS rad, round_even(avg(value / 47.3137::DOUBLE), 1) AS ws, round_even(avg(value / 20), 2) AS temp, avg(sin(radians(event_id % 360))) AS s, avg(cos(radians(event_id % 360))) AS c FROM m GROUP BY 1, 2)
"""


def _meteo(spark, sf):
    m = measurements(spark, sf).select(F.col("type_name").alias("station_code"), "ts", (F.col("value") * 2.71828 - 300).alias("radiation"), (F.col("value") / 47.3137).alias("wind_speed"), (F.col("event_id") % 360).cast("double").alias("wind_direction"), (F.col("value") / 20).alias("temperature"), F.lit(50.0).alias("humidity"))
    return dispersion.hourly_meteo(m)


@query(METEO + "SELECT station_code, epoch(hour)::BIGINT AS hour, round(rad, 4) AS radiation, round(ws, 4) AS wind_speed, round_even(CASE WHEN atan2(s, c) < 0 THEN degrees(atan2(s, c)) + 360 ELSE degrees(atan2(s, c)) END, 2) AS wind_direction FROM h")
def hourly_meteo(spark, sf):
    """Hourly means, with the vector mean of directions."""
    out = _meteo(spark, sf)
    return out.select("station_code", epoch("hour", "hour"), F.round("radiation", 4).alias("radiation"), F.round("wind_speed", 4).alias("wind_speed"), "wind_direction")


@query(
    METEO
    + """, k AS (SELECT *, CASE WHEN rad > 0 THEN CASE
 WHEN ws <= 2 THEN CASE WHEN rad >= 540 THEN 'A' WHEN rad >= 270 THEN 'B' WHEN rad >= 140 THEN 'C' ELSE 'D' END
 WHEN ws < 3 THEN CASE WHEN rad >= 700 THEN 'A' WHEN rad >= 270 THEN 'B' WHEN rad >= 140 THEN 'C' ELSE 'D' END
 WHEN ws < 4 THEN CASE WHEN rad >= 400 THEN 'B' WHEN rad >= 140 THEN 'C' ELSE 'D' END
 WHEN ws < 5 THEN CASE WHEN rad >= 540 THEN 'B' WHEN rad >= 270 THEN 'C' ELSE 'D' END
 WHEN ws < 6 THEN CASE WHEN rad >= 270 THEN 'C' ELSE 'D' END ELSE CASE WHEN rad >= 540 THEN 'C' ELSE 'D' END END
 ELSE CASE WHEN ws <= 3 THEN 'F' WHEN ws <= 5 THEN 'E' ELSE 'D' END END AS cls FROM h)
SELECT station_code, epoch(hour)::BIGINT AS hour, cls AS stability, CASE cls WHEN 'A' THEN 1300 WHEN 'B' THEN 900 WHEN 'C' THEN 850 WHEN 'D' THEN 800 WHEN 'E' THEN 400 ELSE 100 END AS mixing_height,
 CASE cls WHEN 'A' THEN -2 WHEN 'B' THEN -10 WHEN 'C' THEN -100 WHEN 'D' THEN 1000 WHEN 'E' THEN 100 ELSE 200 END AS mol FROM k"""
)
def stability_params(spark, sf):
    """Classes of hours in winter."""
    return dispersion.stability_params(_meteo(spark, sf)).select("station_code", epoch("hour", "hour"), "stability", "mixing_height", "mol")


@query(
    METEO
    + """, k AS (SELECT *, CASE WHEN rad > 0 THEN CASE
 WHEN ws <= 2 THEN CASE WHEN rad >= 540 THEN 'A' WHEN rad >= 270 THEN 'B' WHEN rad >= 140 THEN 'C' ELSE 'D' END
 WHEN ws < 3 THEN CASE WHEN rad >= 700 THEN 'A' WHEN rad >= 270 THEN 'B' WHEN rad >= 140 THEN 'C' ELSE 'D' END
 WHEN ws < 4 THEN CASE WHEN rad >= 400 THEN 'B' WHEN rad >= 140 THEN 'C' ELSE 'D' END
 WHEN ws < 5 THEN CASE WHEN rad >= 540 THEN 'B' WHEN rad >= 270 THEN 'C' ELSE 'D' END
 WHEN ws < 6 THEN CASE WHEN rad >= 270 THEN 'C' ELSE 'D' END ELSE CASE WHEN rad >= 540 THEN 'C' ELSE 'D' END END
 ELSE CASE WHEN ws <= 3 THEN 'F' WHEN ws <= 5 THEN 'E' ELSE 'D' END END AS cls FROM h),
a AS (SELECT *, MAP {'A': 1300, 'B': 900, 'C': 850, 'D': 800, 'E': 400, 'F': 100}[cls] AS mh, MAP {'A': -2, 'B': -10, 'C': -100, 'D': 1000, 'E': 100, 'F': 200}[cls] AS mol,
 round_even(0.9::DOUBLE * round_even(CASE WHEN rad > 0 THEN rad / 2 ELSE -40.0 END, 1) / (1 + 1 / 0.8::DOUBLE), 1) AS heat, 1004.0::DOUBLE * 1.29::DOUBLE * (temp + 273.15::DOUBLE) AS air FROM k),
u AS (SELECT *, round_even(pow(abs(0.4::DOUBLE * 9.81::DOUBLE * heat * mol / air), 1.0::DOUBLE / 3), 3) AS ustar, pow(abs(9.81::DOUBLE * heat * mh / air), 1.0::DOUBLE / 3) AS free FROM a)
SELECT station_code, epoch(hour)::BIGINT AS hour, heat, ustar, round_even(CASE WHEN heat >= 0 THEN free ELSE -free END, 3) AS wstar, round_even(greatest(50.0::DOUBLE, 2400 * pow(ustar, 1.5::DOUBLE)), 0) AS mechanical_height FROM u"""
)
def surface_layer(spark, sf):
    """P25."""
    out = dispersion.surface_layer(dispersion.stability_params(_meteo(spark, sf)))
    return out.select("station_code", epoch("hour", "hour"), "heat", "ustar", "wstar", "mechanical_height")


@query(
    """, e AS (SELECT s_nationkey AS d, date_trunc('day', l_shipdate) AS t, sum(l_quantity) AS e FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2)
SELECT o_orderkey, round(o_totalprice * e / 3600 / 1000, 4) AS value, CASE WHEN v >= 100 THEN 100 WHEN v >= 50 THEN 50 WHEN v >= 20 THEN 20 WHEN v >= 10 THEN 10 WHEN v >= 5 THEN 5 WHEN v >= 2 THEN 2 WHEN v >= 1 THEN 1 ELSE 0 END AS band
FROM (SELECT *, o_totalprice * e / 3600 / 1000 AS v FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN e ON d = c_nationkey AND t = date_trunc('day', o_orderdate))"""
)
def scale_concentration(spark, sf):
    """Prices of orders scaled by the quantities that their nation shipped on that day."""
    lines = table(spark, sf, "lineitem").join(table(spark, sf, "supplier"), F.col("l_suppkey") == F.col("s_suppkey")).select(F.col("s_nationkey").alias("domain_id"), F.date_trunc("day", F.col("l_shipdate").cast("timestamp")).alias("ts"), F.col("l_quantity").alias("value"))
    conc = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", F.col("c_nationkey").alias("domain_id"), F.date_trunc("day", F.col("o_orderdate").cast("timestamp")).alias("ts"), F.col("o_totalprice").alias("value"))
    return dispersion.banded(dispersion.scale_concentration(conc, lines)).select("o_orderkey", F.round("value", 4).alias("value"), F.coalesce("band", F.lit(0)).alias("band"))


@query(
    """, h AS (SELECT date_trunc('hour', ts) AS t, CASE WHEN avg(value) > 100 THEN 1 ELSE 0 END AS u, CASE WHEN count(*) < 8 THEN -999 ELSE 1 END AS q FROM m GROUP BY 1),
c AS (SELECT station_code, date_trunc('hour', ts) AS t, value FROM m)
SELECT station_code AS receptor, epoch(date_trunc('day', t))::BIGINT AS date, round(coalesce(avg(value) FILTER (u > 0 AND q <> -999), -99), 6) AS value, count(*) FILTER (u > 0 AND q <> -999) AS hours FROM c JOIN h USING (t) GROUP BY 1, 2"""
)
def daily_concentration(spark, sf):
    """Means of days over hours that count."""
    m = measurements(spark, sf).withColumn("ts", F.date_trunc("hour", "ts"))
    met = m.groupBy("ts").agg((F.avg("value") > 100).cast("int").alias("ustar"), F.when(F.count(F.lit(1)) < 8, -999).otherwise(1).alias("heat"))
    out = dispersion.daily_concentration(m.select(F.col("station_code").alias("receptor"), "ts", "value"), met)
    return out.select("receptor", F.unix_seconds(F.col("date").cast("timestamp")).alias("date"), r6("value", "value"), "hours")


@query(
    """, g AS (SELECT event_id, event_id % 100 AS i, (event_id // 100) % 50 AS j FROM m)
SELECT s_suppkey AS poi_id, event_id FROM supplier JOIN g ON floor(s_acctbal / 100) = i AND s_nationkey = j"""
)
def poi_values(spark, sf):
    """Cells of a grid at the places of suppliers."""
    grid = measurements(spark, sf).select("event_id", ((F.col("event_id") % 100) * 100.0).alias("x"), (F.floor(F.col("event_id") / 100) % 50 * 1.0).alias("y"))
    poi = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("poi_id"), F.col("s_acctbal").alias("x"), F.col("s_nationkey").cast("double").alias("y"))
    return dispersion.poi_values(grid, poi, 0.0, 0.0, 100.0, 1.0).select("poi_id", "event_id")


@query(
    """, o AS (SELECT event_id, event_id % 8 AS st, floor(value) - 100 AS t, floor(value / 2) - 60 AS d FROM m)
SELECT event_id, (CASE WHEN st IN (4, 5) THEN CASE WHEN t > 0 THEN 2 WHEN t < 0 THEN 8 ELSE 2 END WHEN st = 6 THEN CASE WHEN t > 0 THEN 6 ELSE 3 END WHEN t = 0 AND d = 0 THEN 1 WHEN t < d THEN 5 ELSE 1 END)::INT AS sc,
 (CASE WHEN st IN (4, 5, 6) THEN CASE WHEN t = 0 THEN 0 ELSE 1 END WHEN t = 0 AND d = 0 THEN 0 ELSE 1 END)::INT AS confidence, nullif(t, 0) AS temp_suolo FROM o"""
)
def clean_observation(spark, sf):
    """Road conditions of made-up states and temperatures."""
    rows = measurements(spark, sf).select("event_id", "station_code", "ts", F.lit(0.0).alias("prec_qta"), (F.col("event_id") % 8).alias("stato_meteo"), F.lit(1.0).alias("temp_aria"), (F.floor(F.col("value") / 2) - 60).cast("double").alias("temp_rugiada"), (F.floor("value") - 100).cast("double").alias("temp_suolo"), F.lit(1.0).alias("vento_vel"))
    return roadwx.clean_observation(rows).select("event_id", "sc", "confidence", "temp_suolo")


@query(
    """, f AS (SELECT type_name, ts, event_id, sum(CASE WHEN value < 50 THEN 0 ELSE floor(value) END) OVER (PARTITION BY type_name ORDER BY ts, event_id) AS ra, value - 60 AS air FROM m),
d AS (SELECT *, greatest(coalesce(ra - lag(ra) OVER (PARTITION BY type_name ORDER BY ts), 0), 0) AS x FROM f)
SELECT event_id, round(x, 6) AS ra, (CASE WHEN x > 0 THEN 1 WHEN air > 0 THEN 1 ELSE 2 END)::INT AS pi FROM d"""
)
def deaccumulate(spark, sf):
    """Rain from running totals."""
    from pyspark.sql import Window

    w = Window.partitionBy("type_name").orderBy("ts", "event_id")
    rows = measurements(spark, sf).select("type_name", "ts", "event_id", F.sum(F.when(F.col("value") < 50, 0.0).otherwise(F.floor("value").cast("double"))).over(w).alias("ra"), F.lit(0.0).alias("sn"), (F.col("value") - 60).alias("at"))
    return roadwx.deaccumulate(rows, ["type_name"]).select("event_id", r6("ra", "ra"), "pi")


@query(
    """, r AS (SELECT type_name, epoch_us(ts) // 1000000 AS t, (event_id % 5)::INT AS rc FROM m),
g AS (SELECT type_name, t, rc FROM r), p AS (SELECT DISTINCT type_name, t // 1200 * 1200 AS t FROM r),
v AS (SELECT p.type_name, p.t, r.rc, count(*) AS n FROM p JOIN r ON r.type_name = p.type_name AND r.t >= p.t - 600 AND r.t < p.t + 600 AND r.rc <> 0 GROUP BY 1, 2, 3)
SELECT type_name, t AS ts, rc FROM v QUALIFY row_number() OVER (PARTITION BY type_name, t ORDER BY n DESC, rc) = 1"""
)
def subsample_roadcast(spark, sf):
    """The most frequent code around each 20 minutes."""
    m = measurements(spark, sf).select("type_name", F.timestamp_seconds(F.unix_seconds("ts")).alias("ts"), (F.col("event_id") % 5).cast("int").alias("rc"))
    points = m.select("type_name", F.timestamp_seconds(F.floor(F.unix_seconds("ts") / 1200) * 1200).alias("ts")).distinct().withColumn("rc", F.lit(0))
    out = roadwx.subsample_roadcast(m.unionByName(points), key=["type_name"]).where(F.pmod(F.unix_seconds("ts"), F.lit(1200)) == 0)
    return out.groupBy("type_name", epoch("ts")).agg(F.max("rc").alias("rc")).where("rc <> 0")


@query(
    """, s AS (SELECT type_name AS station_code, date_trunc('hour', ts) AS t, (count(*) % 8 + 1)::INT AS rc FROM m GROUP BY 1, 2), f AS (SELECT station_code, min(t) AS f FROM s GROUP BY 1)
SELECT station_code, epoch(t)::BIGINT AS ts, 'forecast-' || (epoch(t - f)::BIGINT // 60) AS type_name, ['Dry road', 'Wet road', 'Ice / snow on the road', 'Mix water / snow on the road', 'Dew', 'Melting snow', 'Frost', 'Icing rain'][rc] AS condition
FROM s JOIN f USING (station_code) WHERE t > f + INTERVAL 3 HOUR AND t <= f + INTERVAL 45 HOUR"""
)
def roadcast_entries(spark, sf):
    """Hourly counts as a road forecast, typed by their lead time."""
    m = measurements(spark, sf)
    rc = m.groupBy(F.col("type_name").alias("station_code"), F.date_trunc("hour", "ts").alias("ts")).agg((F.count(F.lit(1)) % 8 + 1).cast("int").alias("rc"))
    last = rc.groupBy("station_code").agg((F.min("ts") + F.make_dt_interval(hours=F.lit(3))).alias("ts"))
    return roadwx.roadcast_entries(rc, last).select("station_code", epoch("ts"), "type_name", "condition")


@query("SELECT event_id, round(CASE WHEN value * 4 < 700 OR value * 4 > 1100 THEN 1013.25 ELSE value * 4 END * 100, 4) AS ap, round(value * 0.2777777, 6) AS ws, CASE WHEN value - 100 < 0 THEN 0 ELSE round(value - 100, 6) END AS ir FROM m")
def normalise_forecast(spark, sf):
    """P22, P31."""
    rows = measurements(spark, sf).select("event_id", F.col("value").alias("ws"), (F.col("value") * 4).alias("ap"), F.lit(0.0).alias("ra"), F.lit(0.0).alias("sn"), (F.col("value") - 100).alias("ir"))
    out = roadwx.clamp_radiation(roadwx.normalise_forecast(rows), ["ir"])
    return out.select("event_id", F.round("ap", 4).alias("ap"), r6("ws", "ws"), r6("ir", "ir"))


@query("SELECT event_id, round_even(value, 1) AS value FROM m")
def round_columns(spark, sf):
    """P38."""
    return roadwx.round_columns(measurements(spark, sf).select("event_id", "value"), {"value": 1})


@query("SELECT station_code, CASE WHEN upper(name) LIKE '%BUSES%' THEN 'BUSES' END AS cls, CASE WHEN lane IN (1, 2, 5) THEN 'NORD' WHEN lane IN (3, 4, 6) THEN 'SUD' END AS direction FROM (SELECT station_code, type_name || ' buses' AS name, event_id % 8 AS lane FROM m)")
def classify(spark, sf):
    """P7, P9."""
    rows = measurements(spark, sf).select("station_code", F.concat("type_name", F.lit(" buses")).alias("name"), (F.col("event_id") % 8).alias("lane"))
    return rows.select("station_code", fn.vehicle_class(F.col("name")).alias("cls"), fn.lane_direction(F.col("lane")).alias("direction"))
