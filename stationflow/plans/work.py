"""Queries on work ranges, stations, data sets, documents in JSON, handlers and streams."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from .. import sources
from .. import streaming as streams
from ..operators import catalog, grids, incremental, parking, quality, rollups, store
from ..sources import pages, versioned
from ..streaming import stateful, stream_window
from .base import epoch, measurements, query, r6, table


@query("SELECT station_code, type_name, epoch_us(min(ts)) AS ts FROM m GROUP BY 1, 2")
def first_base(spark, sf):
    """A35."""
    return rollups.first_base(measurements(spark, sf)).select("station_code", "type_name", F.unix_micros("ts").alias("ts"))


@query("SELECT DISTINCT 600 * (1 + event_id % 7) AS period FROM m")
def distinct_periods(spark, sf):
    """A34."""
    return rollups.distinct_periods(measurements(spark, sf).withColumn("period", 600 * (1 + F.col("event_id") % 7)))


@query(
    """, f AS (SELECT station_code, date_trunc('day', min(ts)) AS f FROM m GROUP BY 1), d AS (SELECT station_code, date_trunc('day', max(ts)) - INTERVAL 1 DAY AS d FROM m WHERE type_name = 'signup' AND ts < TIMESTAMP '2024-01-12' GROUP BY 1)
SELECT station_code, epoch(greatest(f, d, TIMESTAMP '2024-01-03'))::BIGINT AS start FROM f LEFT JOIN d USING (station_code)"""
)
def recompute_from(spark, sf):
    """I1."""
    m = measurements(spark, sf)
    return rollups.recompute_from(m, m.where("type_name = 'signup' AND ts < '2024-01-12'"), F.lit("2024-01-03").cast("timestamp")).select("station_code", epoch("start", "start"))


@query(
    """, e AS (SELECT station_code, min(ts) FILTER (type_name <> 'error') AS f, max(ts) FILTER (type_name <> 'error') AS l, max(ts) FILTER (type_name = 'error' AND ts < TIMESTAMP '2024-01-28') AS d FROM m GROUP BY 1)
SELECT station_code, epoch_us(coalesce(d, f)) AS from_ts, epoch(date_trunc('day', l))::BIGINT AS to_ts FROM e WHERE l IS NOT NULL AND (d IS NULL OR l - d > INTERVAL 86400 SECOND) AND coalesce(d, f) < date_trunc('day', l)"""
)
def pending_windows(spark, sf):
    """Errors before the 28th as aggregates of a day."""
    m = measurements(spark, sf).where("type_name <> 'error' OR ts < '2024-01-28'").withColumn("period", F.when(F.col("type_name") == "error", 86400).otherwise(600))
    return rollups.pending_windows(m, 600, 86400, ["station_code"]).select("station_code", F.unix_micros("from_ts").alias("from_ts"), epoch("to_ts", "to_ts"))


@query(
    """, s AS (SELECT CAST(s_suppkey AS VARCHAR) AS c, 'N' || s_nationkey AS p FROM supplier), k AS (SELECT p AS station_code, type_name, min(ts) AS f, max(ts) AS t FROM m JOIN s ON c = station_code GROUP BY 1, 2)
SELECT station_code, type_name, epoch_us(f) AS from_ts, epoch_us(t) AS to_ts FROM k WHERE t > f"""
)
def pending_parent_windows(spark, sf):
    """Users as children of nations."""
    stations = table(spark, sf, "supplier").select(F.col("s_suppkey").cast("string").alias("station_code"), F.concat(F.lit("N"), F.col("s_nationkey")).alias("parent_code"))
    return rollups.pending_parent_windows(measurements(spark, sf), stations).select("station_code", "type_name", F.unix_micros("from_ts").alias("from_ts"), F.unix_micros("to_ts").alias("to_ts"))


@query(
    """, d AS (SELECT station_code, max(ts) AS d FROM m WHERE type_name = 'view' AND ts < TIMESTAMP '2024-01-20' GROUP BY 1), k AS (SELECT station_code, max(ts) AS k FROM m WHERE type_name = 'click' AND ts < TIMESTAMP '2024-01-25' GROUP BY 1),
s AS (SELECT station_code, bool_or(type_name = 'signup' AND value > 100) AS camera FROM m GROUP BY 1),
a AS (SELECT station_code, CASE WHEN camera THEN greatest(coalesce(greatest(d, k), TIMESTAMP '2024-01-02'), TIMESTAMP '2024-07-10') ELSE coalesce(greatest(d, k), TIMESTAMP '2024-01-02') END AS start FROM s LEFT JOIN d USING (station_code) LEFT JOIN k USING (station_code))
SELECT station_code, epoch_us(greatest(start, (SELECT max(start) FROM a) - INTERVAL 170 DAY)) AS start FROM a"""
)
def start_dates(spark, sf):
    """Views as output, clicks as checkpoints, users with a large signup as cameras."""
    m = measurements(spark, sf)
    camera = F.bool_or((F.col("type_name") == "signup") & (F.col("value") > 100))
    stations = m.groupBy("station_code").agg(F.when(camera, '{"sensor_type": "camera"}').otherwise("{}").alias("metadata"))
    checkpoints = m.where("type_name = 'click' AND ts < '2024-01-25'").select("station_code", F.col("ts").alias("checkpoint_ts"))
    starts = incremental.start_dates(stations, m.where("type_name = 'view' AND ts < '2024-01-20'"), checkpoints, F.lit("2024-01-02").cast("timestamp"))
    return incremental.cap_lookback(starts, 170).select("station_code", F.unix_micros("start").alias("start"))


@query(
    """, r AS (SELECT station_code, min(ts) AS lo, max(ts) AS hi FROM m GROUP BY 1), i AS (SELECT *, unnest(range(0, ceil((epoch_us(hi) - epoch_us(lo)) / 172800e6)::BIGINT)) AS k FROM r)
SELECT station_code, epoch_us(lo) + k * 172800000000 AS from_ts, least(epoch_us(lo) + (k + 1) * 172800000000, epoch_us(hi)) AS to_ts FROM i"""
)
def batches(spark, sf):
    """Ranges of users in steps of two days."""
    ranges = measurements(spark, sf).groupBy("station_code").agg(F.min("ts").alias("lo"), F.max("ts").alias("hi"))
    return incremental.batches(ranges, 172800).select("station_code", F.unix_micros("from_ts").alias("from_ts"), F.unix_micros("to_ts").alias("to_ts"))


@query(
    """, c AS (SELECT type_name AS job, station_code, max(ts) AS c, CASE WHEN max(value) > 60 THEN TIMESTAMP '2024-01-01' + to_days(max(value)::INT // 3) END AS x FROM m WHERE ts < TIMESTAMP '2024-01-20' GROUP BY 1, 2),
l AS (SELECT * FROM c WHERE x IS NULL OR x > TIMESTAMP '2024-02-01'), e AS (SELECT type_name AS job, station_code, max(ts) AS e FROM m WHERE ts >= TIMESTAMP '2024-01-19' GROUP BY 1, 2),
j AS (SELECT *, e IS NOT NULL AND (c IS NULL OR date_trunc('day', e) > date_trunc('day', c)) AS moved FROM l FULL JOIN e USING (job, station_code))
SELECT job, station_code, epoch_us(CASE WHEN moved THEN e ELSE c END) AS checkpoint_ts, epoch(CASE WHEN moved THEN TIMESTAMP '2024-02-01' + INTERVAL 1 DAY ELSE x END)::BIGINT AS expires_at FROM j"""
)
def advance_checkpoint(spark, sf):
    """Checkpoints of which some expire."""
    m = measurements(spark, sf).withColumnRenamed("type_name", "job")
    x = F.date_add(F.lit("2024-01-01").cast("date"), F.floor(F.bround(F.max("value"), 0) / 3).cast("int")).cast("timestamp")
    old = m.where("ts < '2024-01-20'").groupBy("job", "station_code").agg(F.max("ts").alias("checkpoint_ts"), F.when(F.max("value") > 60, x).alias("expires_at"))
    ends = m.where("ts >= '2024-01-19'").select("job", "station_code", F.col("ts").alias("end"))
    return incremental.advance_checkpoint(old, ends, F.lit("2024-02-01").cast("timestamp"), 86400).select("job", "station_code", F.unix_micros("checkpoint_ts").alias("checkpoint_ts"), epoch("expires_at", "expires_at"))


@query("SELECT event_id FROM m LEFT JOIN (SELECT station_code, max(ts) AS l FROM m WHERE type_name = 'click' AND ts < TIMESTAMP '2024-01-15' GROUP BY 1) USING (station_code) WHERE l IS NULL OR (ts > l AND ts <= l + INTERVAL 5 DAY)")
def new_rows(spark, sf):
    """At most five days after the last click before the 15th."""
    m = measurements(spark, sf)
    return incremental.new_rows(m, m.where("type_name = 'click' AND ts < '2024-01-15'"), 5).select("event_id")


@query("SELECT DISTINCT station_code FROM m WHERE station_code NOT IN (SELECT CAST(s_suppkey AS VARCHAR) FROM supplier)")
def new_stations(spark, sf):
    """Users who aren't suppliers."""
    known = table(spark, sf, "supplier").select(F.col("s_suppkey").cast("string").alias("station_code"))
    return catalog.new_stations(measurements(spark, sf).select("station_code").distinct(), known)


@query("SELECT epoch(d)::BIGINT AS date, missing_in FROM (SELECT DISTINCT date_trunc('day', o_orderdate) AS d, 'traffic' AS missing_in FROM orders WHERE date_trunc('day', o_orderdate) NOT IN (SELECT date_trunc('day', l_shipdate) FROM lineitem) UNION ALL SELECT DISTINCT date_trunc('day', l_shipdate), 'history' FROM lineitem WHERE date_trunc('day', l_shipdate) NOT IN (SELECT date_trunc('day', o_orderdate) FROM orders))")
def common_dates(spark, sf):
    """Days that only orders or only shipments have."""
    _, report = quality.common_dates(table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("date")), table(spark, sf, "lineitem").select(F.to_date("l_shipdate").alias("date")))
    return report.select(F.unix_seconds(F.col("date").cast("timestamp")).alias("date"), "missing_in")


@query("SELECT array_to_string(list_sort(list(DISTINCT source)), ',') AS providers, array_to_string(list_sort(list(DISTINCT lang)), ',') AS licences, count(*) AS records FROM documents")
def profile_dataset(spark, sf):
    """Sources and languages of the documents."""
    out = rollups.profile_dataset(table(spark, sf, "documents"), "source", "lang")
    return out.select(F.array_join("providers", ",").alias("providers"), F.array_join("licences", ",").alias("licences"), "records")


@query(
    """, p AS (SELECT source AS dataset, array_to_string(list_sort(list(DISTINCT lang)), ',') AS l, count(*) AS n FROM documents GROUP BY 1)
SELECT dataset, CASE WHEN dataset > 'src5' THEN 'P ' || l ELSE 'old' END AS providers, CASE WHEN dataset > 'src5' THEN l ELSE 'none' END AS licences, CASE WHEN dataset > 'src5' THEN n ELSE 0 END AS records,
 CASE WHEN dataset > 'src5' THEN 1704153600 ELSE 1704067200 END::BIGINT AS last_update FROM p"""
)
def merge_profile(spark, sf):
    """Providers, licences and records of sources, replaced where the source changed."""
    langs = F.array_join(F.array_sort(F.collect_set("lang")), ",")
    profile = table(spark, sf, "documents").groupBy(F.col("source").alias("dataset")).agg(F.concat(F.lit("P "), langs).alias("providers"), langs.alias("licences"), F.count(F.lit(1)).alias("records"))
    meta = profile.select("dataset", F.lit("old").alias("providers"), F.lit("none").alias("licences"), F.lit(0).cast("long").alias("records"), F.when(F.col("dataset") > "src5", F.lit("2024-01-02")).otherwise("2024-01-01").cast("timestamp").alias("last_update"))
    return catalog.merge_profile(meta, profile, F.lit("2024-01-01").cast("timestamp")).withColumn("last_update", F.unix_seconds("last_update"))


@query("SELECT CAST(s_suppkey AS VARCHAR) AS station_code, coalesce(max(ts) > TIMESTAMP '2024-01-30 18:00:00', false) AS active FROM supplier LEFT JOIN m ON station_code = CAST(s_suppkey AS VARCHAR) AND type_name = 'view' GROUP BY 1")
def active_stations(spark, sf):
    """U8: suppliers whose number is that of a user with a view in the last 12 hours before the 31st, 06:00."""
    stations = table(spark, sf, "supplier").select(F.col("s_suppkey").cast("string").alias("station_code"), F.lit("S").alias("station_type"), F.lit(True).alias("active"))
    rules = spark.createDataFrame([("S", "view", 43200)], "station_type string, type_name string, max_age_s int")
    return catalog.active_stations(stations, measurements(spark, sf), rules, F.lit("2024-01-31 06:00:00").cast("timestamp")).select("station_code", "active")


@query("SELECT coalesce(c_custkey, s_suppkey) AS station_code, coalesce(s_name, c_name) AS name, coalesce(s_acctbal, c_acctbal) AS x FROM customer FULL JOIN supplier ON c_custkey = s_suppkey")
def upsert_stations(spark, sf):
    """Customers, updated by suppliers of the same number."""
    old = table(spark, sf, "customer").select(F.col("c_custkey").alias("station_code"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("x"))
    new = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("station_code"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("x"))
    return catalog.upsert_stations(old, new)


@query(
    """, r AS (SELECT station_code AS task, ts AS s, type_name AS status FROM m), l AS (SELECT task, max(s) AS s, arg_max(status, s) AS status FROM r GROUP BY 1)
SELECT l.task, epoch_us(l.s) AS last_start, l.status, round((epoch_us(l.s) - epoch_us(max(r.s) FILTER (r.status <> l.status))) / 1e6, 3) AS since_other_s FROM l JOIN r USING (task) GROUP BY l.task, l.s, l.status"""
)
def run_summary(spark, sf):
    """Users as tasks, events as runs that took no time."""
    runs = measurements(spark, sf).select(F.col("station_code").alias("task"), F.col("ts").alias("start"), F.col("ts").alias("end"), F.col("type_name").alias("status"))
    return catalog.run_summary(runs).select("task", F.unix_micros("last_start").alias("last_start"), "status", F.round("since_other_s", 3).alias("since_other_s"))


@query("SELECT CAST(s_suppkey AS VARCHAR) AS station_code FROM supplier WHERE s_acctbal > 0 AND s_nationkey IN (1, 2, 3)")
def list_stations(spark, sf):
    """Suppliers of three nations with a positive balance."""
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").cast("string").alias("station_code"), F.col("s_nationkey").cast("string").alias("station_type"), (F.col("s_acctbal") > 0).alias("active"), F.lit("x").alias("origin"))
    return catalog.list_stations(s, ["1", "2", "3"], "x").select("station_code")


LANES = """, lanes AS (SELECT 'R1:' || s_nationkey AS road, 'R1:' || s_nationkey || ':' || (s_suppkey % 6 + 1) || '.' || s_suppkey AS code, CASE WHEN s_suppkey % 2 = 0 THEN 'nord' ELSE 'sud' END AS dir, s_name AS n, s_acctbal AS x, 'o' || s_suppkey AS o, 'S' || s_suppkey AS ph FROM supplier),
d AS (SELECT road, dir, arg_min(struct_pack(n := n, x := x, o := o, ph := ph), code) AS f, min(code) AS code FROM lanes GROUP BY 1, 2),
dirs AS (SELECT road || ':' || dir AS station_code, f.n || ' (direzione ' || dir || ')' AS name, f.x AS x, f.o AS origin, '{"a22_metadata":{"autostrada":"A","iddirezione":"","idspira":"' || f.ph || '","metro":"' || CAST(length(f.n) AS VARCHAR) || '"}}' AS metadata, road AS parent_code FROM d)
"""


def _directions(spark, sf):
    s = table(spark, sf, "supplier")
    side = F.when(F.col("s_suppkey") % 2 == 0, "nord").otherwise("sud")
    inner = F.to_json(F.struct(F.lit("A").alias("autostrada"), F.concat(F.lit("S"), F.col("s_suppkey")).alias("idspira"), F.length("s_name").cast("string").alias("metro"), F.lit("x").alias("other")))
    lanes = s.select(
        F.concat(F.lit("R1:"), F.col("s_nationkey"), F.lit(":"), F.col("s_suppkey") % 6 + 1, F.lit("."), F.col("s_suppkey")).alias("station_code"), F.concat(F.col("s_name"), F.lit(" (corsia di marcia "), side, F.lit(", direzione "), side, F.lit(")")).alias("name"),
        F.col("s_acctbal").alias("x"), F.col("s_acctbal").alias("y"), F.concat(F.lit("o"), F.col("s_suppkey")).alias("origin"), F.to_json(F.struct(inner.alias("a22_metadata"))).alias("metadata"),
    )
    return rollups.combine_directions(lanes)


@query(LANES + "SELECT station_code, name, round(x, 6) AS x, origin, metadata, parent_code FROM dirs")
def combine_directions(spark, sf):
    """Suppliers as lanes of nations, combined into directions."""
    return _directions(spark, sf).select("station_code", "name", r6("x", "x"), "origin", "metadata", "parent_code")


@query(
    LANES
    + """, l AS (SELECT parent_code AS station_code, avg(x) AS x, min(name) AS lo, max(name) AS hi, arg_min(origin, station_code) AS origin FROM dirs GROUP BY 1)
SELECT station_code, rtrim(left(lo, list_max(list_filter(range(0, least(length(lo), length(hi)) + 1), lambda i: left(lo, i) = left(hi, i)))::BIGINT)) AS name, round(x, 6) AS x, origin FROM l"""
)
def combine_locations(spark, sf):
    """A10: the directions of nations, combined into locations."""
    return rollups.combine_locations(_directions(spark, sf)).select("station_code", "name", r6("x", "x"), "origin")


@query("SELECT 'S' AS station_type, station_code, type_name, epoch_us(ts) // 1000 AS ts, value, event_id AS period FROM m")
def tree_json(spark, sf):
    """Every event as a tree of JSON, flattened again."""
    m = measurements(spark, sf)
    leaf = F.array(F.struct(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSZ").alias("mvalidtime"), F.col("value").alias("mvalue"), F.col("event_id").cast("int").alias("mperiod")))
    types = F.create_map("type_name", F.struct(leaf.alias("tmeasurements")))
    tree = F.create_map(F.lit("S"), F.struct(F.create_map("station_code", F.struct(types.alias("sdatatypes"))).alias("stations")))
    return sources.flatten_tree_json(m.select(F.to_json(tree).alias("json"))).select("station_type", "station_code", "type_name", F.unix_millis("ts").alias("ts"), "value", F.col("period").cast("long").alias("period"))


@query("SELECT station_code, type_name, 'stationflow' AS provenance, epoch_us(ts) // 1000 AS ts, value, CAST(3600 AS BIGINT) AS period FROM m")
def to_datamap(spark, sf):
    """Each user's events as one document, read back."""
    out = sources.to_datamap(measurements(spark, sf), "stationflow")
    kind = "provenance string, branch map<string, array<struct<timestamp: bigint, value: double, period: bigint>>>"
    read = out.select("station_code", F.from_json("datamap", kind).alias("d")).select("station_code", "d.provenance", F.explode("d.branch").alias("type_name", "records"))
    return read.select("station_code", "type_name", "provenance", F.explode("records").alias("r")).select("station_code", "type_name", "provenance", F.col("r.timestamp").alias("ts"), "r.value", "r.period")


@query("SELECT station_code, round(sum(value), 4) AS total, count(*) AS rows FROM m GROUP BY 1")
def follow_station(spark, sf):
    """a handler that adds up each user's values by slices of days, and their sums."""
    import pandas as pd

    def total(rows: pd.DataFrame) -> pd.DataFrame:
        return rows.groupby(["station_code", "_slice"], dropna=False).agg(total=("value", "sum"), rows=("ts", "size")).reset_index()[["station_code", "total", "rows"]]

    m = measurements(spark, sf).select("station_code", "ts", "value")
    parts = incremental.follow_station(m, m.select("station_code").distinct(), total, "station_code string, total double, rows long", many=True)
    return parts.groupBy("station_code").agg(F.round(F.sum("total"), 4).alias("total"), F.sum("rows").alias("rows"))


@query("SELECT station_code, type_name, floor(epoch(ts) / 432000)::BIGINT AS slice, count(*) AS rows FROM m GROUP BY ALL")
def follow_type(spark, sf):
    """a handler for five days of a user's type."""
    import pandas as pd

    def count(rows: pd.DataFrame) -> pd.DataFrame:
        return rows.groupby(["station_code", "type_name", "_slice"], dropna=False).agg(rows=("ts", "size")).reset_index().rename(columns={"_slice": "slice"})

    return incremental.follow_type(measurements(spark, sf).select("station_code", "type_name", "ts", "value"), count, "station_code string, type_name string, slice long, rows long", many=True)


@query("SELECT type_name, epoch(date_trunc('day', ts))::BIGINT + 86400 AS ts, round(sum(value), 4) AS value FROM m WHERE ts < (SELECT date_trunc('day', max(ts)) FROM m) GROUP BY 1, 2")
def stream_window(spark, sf, make=stream_window):
    """Daily sums of a stream of all events; days that the watermark has passed."""
    run = f"{sources.shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    files = f"{sf}/event*.parquet"
    source = spark.readStream.schema(spark.read.parquet(f"{sf}/events.parquet").schema).parquet(files)
    m = source.select(F.col("event_type").alias("type_name"), F.col("ts").cast("timestamp").alias("ts"), "value")
    sums = make(m, F.sum("value"), "1 day", ["type_name"], "1 minute")
    q = sums.writeStream.format("parquet").option("path", f"{run}/out").option("checkpointLocation", f"{run}/state").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema("type_name string, start timestamp, ts timestamp, value double").parquet(f"{run}/out").select("type_name", epoch("ts"), F.round("value", 4).alias("value"))


def _streamed(spark, sf):
    """All events as a stream of measurements, and a new folder of the run."""
    events = spark.readStream.schema(spark.read.parquet(f"{sf}/events.parquet").schema).parquet(f"{sf}/event*.parquet")
    m = events.select(F.col("user_id").cast("string").alias("station_code"), F.col("event_type").alias("type_name"), F.col("ts").cast("timestamp").alias("ts"), "value")
    return m, f"{sources.shared_dir(spark)}/stream-{uuid.uuid4().hex}"


def _drained(writer, run: str) -> None:
    writer.option("checkpointLocation", f"{run}/state").trigger(availableNow=True).start().awaitTermination()


@query(
    """, c AS (SELECT type_name, epoch(time_bucket(INTERVAL 3600 SECOND, ts))::BIGINT AS t, count(*) AS n FROM m GROUP BY 1, 2), mark AS (SELECT epoch_ms(max(ts)) // 1000 - 60 AS s FROM m),
done AS (SELECT c.* FROM c, mark WHERE t + 3600 <= s), g AS (SELECT type_name, unnest(generate_series(min(t), max(t), 3600)) AS t FROM done GROUP BY 1)
SELECT type_name, g.t + 1800 AS ts, coalesce(n, 0) AS value FROM g LEFT JOIN done USING (type_name, t)"""
)
def stream_counts(spark, sf):
    """Dense hourly counts of a stream of all events; hours that the watermark has passed."""
    m, run = _streamed(spark, sf)
    _drained(streams.stream_counts(m, 3600, "type_name", "1 minute").writeStream.format("parquet").option("path", f"{run}/out"), run)
    return spark.read.schema("type_name string, ts timestamp, value long").parquet(f"{run}/out").select("type_name", epoch("ts"), "value")


@query(
    """, c AS (SELECT type_name, epoch(time_bucket(INTERVAL 3600 SECOND, ts))::BIGINT AS t, count(*) AS n FROM m GROUP BY 1, 2), mark AS (SELECT epoch_ms(max(ts)) // 1000 - 60 AS s FROM m),
done AS (SELECT c.* FROM c, mark WHERE t + 3600 <= s), g AS (SELECT type_name, unnest(generate_series(min(t), max(t), 3600)) AS t FROM done GROUP BY 1)
SELECT type_name, g.t + 1800 AS ts, coalesce(n, 0) AS value FROM g LEFT JOIN done USING (type_name, t)"""
)
def stream_counts_state(spark, sf):
    """The same counts, by maps and timers."""
    m, run = _streamed(spark, sf)
    with stateful.rocksdb(spark):
        _drained(stateful.counts_with_state(m, 3600, "type_name", "1 minute").writeStream.format("parquet").option("path", f"{run}/out"), run)
    return spark.read.schema("type_name string, ts timestamp, value long").parquet(f"{run}/out").select("type_name", epoch("ts"), "value")


@query(
    """, h AS (SELECT type_name, (ceil(epoch_us(ts) / 3600e6) * 3600)::BIGINT AS ts, avg(value) AS value FROM m GROUP BY 1, 2 HAVING count(value) >= 2)
SELECT type_name, ts, round(value, 4) AS value FROM h WHERE ts * 1000000 + 1 <= (SELECT epoch_ms(max(ts)) * 1000 - 60000000 FROM m)"""
)
def stream_hourly_average(spark, sf):
    """Hourly means of a stream of all events; hours that the watermark has passed."""
    m, run = _streamed(spark, sf)
    _drained(streams.stream_hourly_average(m, 2, ["type_name"], "1 minute").writeStream.format("parquet").option("path", f"{run}/out"), run)
    return spark.read.schema("type_name string, ts timestamp, value double").parquet(f"{run}/out").select("type_name", epoch("ts"), F.round("value", 4).alias("value"))


def _target(spark, path: str, schema: str):
    """read() and write() of a Parquet target in folders by type, of which a batch rewrites those that it has."""

    def read(keys):
        return spark.read.schema(schema).parquet(path)

    def write(keys, rows):
        kept = read(keys).join(keys.select("type_name").distinct(), "type_name", "left_semi").join(keys, ["station_code", "type_name"], "left_anti")
        both = kept.unionByName(rows.select(*kept.columns))
        both.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("type_name").parquet(path)

    return read, write


TARGET = "station_code string, ts timestamp, value double, type_name string"


@query("SELECT station_code, type_name, max(epoch_us(ts)) AS ts, arg_max(value, ts) AS value FROM m GROUP BY 1, 2")
def stream_latest(spark, sf):
    """The cache of latest rows after a stream of all events, from one that has the first days."""
    m, run = _streamed(spark, sf)
    early = measurements(spark, sf).where("ts < '2024-01-05'")
    store.latest(early, ["station_code", "type_name"]).select("station_code", "ts", "value", "type_name").write.partitionBy("type_name").parquet(f"{run}/cache")
    read, write = _target(spark, f"{run}/cache", TARGET)
    _drained(streams.stream_latest(m, read, write, ["station_code", "type_name"]), run)
    return read(None).select("station_code", "type_name", F.unix_micros("ts").alias("ts"), "value")


@query("SELECT station_code, type_name, epoch_us(max(ts)) AS ts, max(struct_pack(ts := ts, value := value)).value AS value FROM m GROUP BY 1, 2")
def stream_latest_once(spark, sf):
    """The latest rows by a versioned target, in which a batch that is sent a second time changes nothing."""
    m, run = _streamed(spark, sf)
    keys = ["station_code", "type_name"]
    target = versioned.VersionedTarget(spark, f"{run}/target", "station_code string, type_name string, ts timestamp, value double", keys)
    early = measurements(spark, sf).where("ts < '2024-01-05'")
    target.apply(early, streams.latest_rows(keys), "history", 0)
    _drained(streams.stream_into(m, target, "events", streams.latest_rows(keys)), run)
    target.apply(early.withColumn("ts", F.col("ts") + F.make_dt_interval(days=F.lit(99))), streams.latest_rows(keys), "history", 0)
    return target.read().select("station_code", "type_name", F.unix_micros("ts").alias("ts"), "value")


@query("SELECT station_code, type_name, epoch_us(date_trunc('day', ts)) AS ts, round(sum(value), 4) AS value FROM m GROUP BY 1, 2, 3")
def stream_merge(spark, sf):
    """Daily sums as a recomputed range, merged into a target that has other values and days of its own."""
    keys = ["station_code", "type_name"]
    m = measurements(spark, sf)
    days = m.groupBy(*keys, F.date_trunc("day", "ts").alias("ts")).agg(F.sum("value").alias("value")).select("station_code", "ts", "value", "type_name")
    run = f"{sources.shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    days.write.parquet(f"{run}/in")
    wrong = days.select("station_code", F.when(F.dayofmonth("ts") % 2 == 0, F.col("ts")).otherwise(F.col("ts") + F.make_dt_interval(hours=F.lit(1))).alias("ts"), (F.col("value") + 1).alias("value"), "type_name")
    wrong.write.partitionBy("type_name").parquet(f"{run}/target")
    read, write = _target(spark, f"{run}/target", TARGET)
    # rows after the range that a batch covers stay, so the target has none of those here
    _drained(streams.stream_merge(spark.readStream.schema(TARGET).parquet(f"{run}/in"), read, write, keys), run)
    last = days.agg(F.max("ts")).first()[0]
    return read(None).where(F.col("ts") <= F.lit(last)).select("station_code", "type_name", F.unix_micros("ts").alias("ts"), F.round("value", 4).alias("value"))


@query("SELECT station_code, type_name, epoch_us(ts) AS ts, value FROM m WHERE ts >= TIMESTAMP '2024-01-08' AND ts < TIMESTAMP '2024-01-19'")
def station_pages(spark, sf):
    """All events as pages of nested JSON by user and five days, of which a range of times is read."""
    path = f"{sources.shared_dir(spark)}/{uuid.uuid4().hex}"
    pages.write_pages(measurements(spark, sf).withColumn("station_type", F.lit("user")), path)
    return pages.read_pages(spark, path).where("ts >= timestamp '2024-01-08' AND ts < timestamp '2024-01-19'").select("station_code", "type_name", F.unix_micros("ts").alias("ts"), "value")


@query("SELECT station_code, type_name, count(*) AS rows, epoch_us(max(ts)) AS ts FROM m GROUP BY 1, 2")
def stream_of_pages(spark, sf):
    """Pages of two halves of the events, read as a stream that goes on after each station's last time."""
    m, run = measurements(spark, sf).withColumn("station_type", F.lit("user")), f"{sources.shared_dir(spark)}/{uuid.uuid4().hex}"
    for part in ("ts < '2024-01-16'", "ts >= '2024-01-16'"):
        pages.write_pages(m.where(part), f"{run}/pages")
        _drained(pages.stream_pages(spark, f"{run}/pages").writeStream.format("parquet").option("path", f"{run}/out"), run)
    out = spark.read.schema(pages.SCHEMA).parquet(f"{run}/out")
    return out.groupBy("station_code", "type_name").agg(F.count(F.lit(1)).alias("rows"), F.unix_micros(F.max("ts")).alias("ts"))


@query("SELECT station_code, type_name, epoch_us(ts) AS ts, value FROM m WHERE type_name IN ('view', 'click') AND ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-20'")
def read_measurements(spark, sf):
    """All events as a history in files of at most 1000 rows (S9), of which two types and ten days are read."""
    path = f"{sources.shared_dir(spark)}/{uuid.uuid4().hex}"
    sources.write_batched(measurements(spark, sf).drop("event_id"), path, 1000)
    at = lambda d: F.lit(d).cast("timestamp")
    return sources.read_measurements(spark, path, ["view", "click"], at("2024-01-10"), at("2024-01-20")).select("station_code", "type_name", F.unix_micros("ts").alias("ts"), "value")


@query("SELECT station_code, type_name, epoch_us(ts) AS ts, value, event_id, true AS fits FROM m")
def write_batched(spark, sf):
    """All events in files of at most 1000 rows, read back, and whether each row's file fits."""
    path = f"{sources.shared_dir(spark)}/{uuid.uuid4().hex}"
    sources.write_batched(measurements(spark, sf), path, 1000)
    rows = spark.read.parquet(path).withColumn("file", F.input_file_name())
    sizes = rows.groupBy("file").agg((F.count(F.lit(1)) <= 1000).alias("fits"))
    return rows.join(sizes, "file").select("station_code", "type_name", F.unix_micros("ts").alias("ts"), "value", "event_id", "fits")


@query("SELECT type_name AS station_code, type_name || ' lot' AS name, epoch(date_trunc('second', ts))::BIGINT AS ts, floor(value)::INT AS occ FROM m")
def read_station_csv(spark, sf):
    """A file without header for each type of events, read with the code and name that its own name has."""
    path = f"{sources.shared_dir(spark)}/{uuid.uuid4().hex}"
    m = measurements(spark, sf).select("type_name", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("ts"), F.floor("value").cast("int").alias("occ"))
    for i, code in enumerate(r.type_name for r in m.select("type_name").distinct().orderBy("type_name").collect()):
        one = f"{path}/{i:02d}__{code}__{code} lot"
        m.where(F.col("type_name") == code).select("ts", "occ").coalesce(1).write.csv(one)
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    for folder in fs.listStatus(root):
        for f in fs.listStatus(folder.getPath()):
            if f.getPath().getName().endswith(".csv"):
                fs.rename(f.getPath(), jvm.org.apache.hadoop.fs.Path(f"{path}/{folder.getPath().getName()}.csv"))
    return sources.read_station_csv(spark, f"{path}/*.csv").select("station_code", "name", epoch("ts"), "occ")


@query("SELECT epoch(ts)::BIGINT AS ts, value AS at, value - 3 AS td, CAST(NULL AS DOUBLE) AS ra FROM (SELECT date_trunc('second', ts) AS ts, value FROM m)")
def read_prediction_xml(spark, sf):
    """All events as predictions in XML, read back."""
    path = f"{sources.shared_dir(spark)}/{uuid.uuid4().hex}"
    rows = measurements(spark, sf).select(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("forecast-time"), F.col("value").alias("at"), (F.col("value") - 3).alias("td"))
    rows.write.format("xml").option("rowTag", "prediction").option("rootTag", "forecast").save(path)
    return sources.read_prediction_xml(spark, path).select(epoch("forecast-time", "ts"), "at", "td", "ra")


@query("SELECT type_name, round(value, 6) AS value, epoch_us(ts) AS ts FROM m WHERE type_name = 'view'")
def forecast_of(spark, sf):
    """All steps of one car park."""
    fc = measurements(spark, sf).select(F.col("type_name").alias("station_code"), F.col("ts").alias("start"), "value")
    return parking.forecast_of(fc, "view").select(F.col("station_code").alias("type_name"), F.round("value", 6).alias("value"), F.unix_micros("start").alias("ts"))


@query("SELECT station_code, type_name, epoch_us(ts) AS ts, value FROM m WHERE NOT (type_name IN ('view', 'click'))")
def purge_everything(spark, sf):
    """U4: all rows of two types go, whenever they are of."""
    left, _ = store.purge_series(measurements(spark, sf), F.col("type_name").isin("view", "click"))
    return left.select("station_code", "type_name", F.unix_micros("ts").alias("ts"), "value")


@query("SELECT station_code, type_name, epoch_us(max(ts)) AS ts FROM m WHERE NOT (type_name IN ('view', 'click')) GROUP BY 1, 2")
def purged_latest(spark, sf):
    """U4: the latest rows of what is left."""
    _, cache = store.purge_series(measurements(spark, sf), F.col("type_name").isin("view", "click"))
    return cache.select("station_code", "type_name", F.unix_micros("ts").alias("ts"))


@query(
    """, n AS (SELECT type_name AS station_code, ts, avg(value) AS value FROM m GROUP BY 1, 2), g AS (SELECT station_code, unnest(generate_series(time_bucket(INTERVAL 300 SECOND, min(ts), TIMESTAMP '2024-01-01'), max(ts), INTERVAL 300 SECOND)) AS t FROM n GROUP BY 1),
b AS (SELECT g.station_code, t, ts AS bt, value AS bv FROM g ASOF LEFT JOIN n ON n.station_code = g.station_code AND g.t >= n.ts), a AS (SELECT g.station_code, t, ts AS nt, value AS nv FROM g ASOF LEFT JOIN n ON n.station_code = g.station_code AND g.t <= n.ts)
SELECT station_code, epoch(t)::BIGINT AS ts, round(CASE WHEN bt IS NULL THEN nv WHEN nt IS NULL THEN bv WHEN t - bt < nt - t THEN bv ELSE nv END, 6) AS value FROM b JOIN a USING (station_code, t)"""
)
def resample_nearest(spark, sf):
    """The nearest value of each type every five minutes, from all events at their own times."""
    m = measurements(spark, sf).groupBy(F.col("type_name").alias("station_code"), "ts").agg(F.avg("value").alias("value"))
    return grids.resample_nearest(m).select("station_code", epoch("ts"), r6("value", "value"))


@query(
    """, h AS (SELECT station_code, date_trunc('day', ts) AS d, date_trunc('hour', ts) AS t, round(avg(value), 6) AS v FROM m GROUP BY ALL), n AS (SELECT *, row_number() OVER (PARTITION BY station_code ORDER BY t) AS i FROM h),
lags AS (SELECT unnest(range(1, 25)) AS n UNION ALL SELECT d * 24 + k FROM range(2, 8) r(d), (VALUES (-1), (0), (1)) v(k))
SELECT a.station_code, epoch(a.t)::BIGINT AS ts, count(b.v) AS known, round(sum(b.v * lags.n), 3) AS weighed, max(CASE WHEN lags.n = 24 THEN b.v END) AS day_before, max(CASE WHEN lags.n = 169 THEN b.v END) AS week_before
FROM n a CROSS JOIN lags LEFT JOIN n b ON a.station_code = b.station_code AND b.i = a.i - lags.n GROUP BY ALL"""
)
def lag_set(spark, sf):
    """The weekly lags of the users' hourly means."""
    hours = measurements(spark, sf).groupBy("station_code", F.date_trunc("hour", "ts").alias("ts")).agg(F.round(F.avg("value"), 6).alias("value"))
    lags = grids.lag_set()
    out = grids.weekly_lags(hours)
    weighed = F.aggregate(F.zip_with("lags", F.array(*map(F.lit, lags)), lambda v, n: F.coalesce(v * n, F.lit(0.0))), F.lit(0.0), lambda s, x: s + x)
    known = F.size(F.filter("lags", lambda v: v.isNotNull())).cast("long")
    return out.select("station_code", epoch("ts"), known.alias("known"), F.when(known > 0, F.round(weighed, 3)).alias("weighed"), F.col("lags")[lags.index(24)].alias("day_before"), F.col("lags")[lags.index(169)].alias("week_before"))


