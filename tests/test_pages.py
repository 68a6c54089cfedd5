"""Pages of measurements: what is planned and read, streams by last times, writes that are whole or absent."""

import datetime as dt
import glob
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThanOrEqual, In, IsNotNull, LessThan
from stationflow import sources
from stationflow.sources import pages

T0 = dt.datetime(2024, 1, 1)


def rows(days, stations=("a", "b/c d", "é")):
    return [("S", s, t, T0 + dt.timedelta(days=d, hours=h, microseconds=7), float(10 * d + h), 600) for s in stations for d in days for h in (0, 13) for t in ("x", "y")]


def frame(spark, some):
    return spark.createDataFrame(some, pages.SCHEMA)


def got(df):
    return sorted(map(tuple, df.collect()))


def test_round_trip_in_order(spark, tmp_path):
    path, some = str(tmp_path / "p"), rows(range(12)) + [("S", None, "x", T0, 1.0, 1), ("S", "a", "x", None, 1.0, 1), ("S", "a", "z", T0, None, None)]
    pages.write_pages(frame(spark, some).repartition(3), path, rows=7)
    assert got(pages.read_pages(spark, path)) == sorted(r for r in some if r[1] and r[3])
    files = glob.glob(f"{path}/*/*/*.json")
    for f in files:
        tree = json.load(open(f))
        stations = tree["S"]["stations"]
        assert len(stations) == 1 and sum(len(d["tmeasurements"]) for d in next(iter(stations.values()))["sdatatypes"].values()) <= 7
        for d in next(iter(stations.values()))["sdatatypes"].values():
            assert [m["mvalidtime"] for m in d["tmeasurements"]] == sorted(m["mvalidtime"] for m in d["tmeasurements"])
    flat = sources.flatten_tree_json(spark.read.text(files, wholetext=True).withColumnRenamed("value", "json"))
    assert flat.count() == len([r for r in some if r[1] and r[3]])


def test_filters_choose_pages(spark, tmp_path):
    path = str(tmp_path / "p")
    pages.write_pages(frame(spark, rows(range(20))), path)
    assert len(pages.PagesReader({"path": path, "splitbytes": "1"}).partitions()) == 3 * 5  # the epoch's five days cut twenty days in five
    assert len(pages.PagesReader({"path": path}).partitions()) == 1  # all of them are small
    reader = pages.PushingReader({"path": path, "splitbytes": "1"})
    kept = IsNotNull(("ts",))
    assert list(reader.pushFilters([In(("station_code",), ("a", "é", "q")), kept, GreaterThanOrEqual(("ts",), T0 + dt.timedelta(days=6)), LessThan(("ts",), T0 + dt.timedelta(days=8))])) == [kept]
    parts = reader.partitions()
    assert 2 <= len(parts) <= 4 and {p.pages[0].station for p in parts} == {"a", "é"}
    assert list(pages.PushingReader({"path": path}).pushFilters([EqualTo(("type_name",), "x")])) == [EqualTo(("type_name",), "x")]
    where = (F.col("station_code") == "b/c d") & (F.col("ts") > F.lit("2024-01-03 00:00:00").cast("timestamp")) & (F.col("ts") <= F.lit("2024-01-05 00:00:00.000007").cast("timestamp"))
    want = [r for r in rows(range(20)) if r[1] == "b/c d" and T0 + dt.timedelta(days=2) < r[3] <= T0 + dt.timedelta(days=4, microseconds=7)]
    assert got(pages.read_pages(spark, path).where(where)) == sorted(want)
    spark.conf.set(pages.PUSHED, "true")
    try:
        pushed = pages.read_pages(spark, path).where(where)
        assert got(pushed) == sorted(want) and pushed.rdd.getNumPartitions() <= 2
        assert pages.read_pages(spark, path).where("station_code = 'none'").collect() == []
    finally:
        spark.conf.unset(pages.PUSHED)


def test_streams_go_on_after_the_last_times(spark, tmp_path):
    path, seen = str(tmp_path / "p"), []

    def drain():
        n = len(seen)
        q = pages.stream_pages(spark, path).writeStream.foreachBatch(lambda b, i: seen.extend(map(tuple, b.collect()))).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
        q.awaitTermination()
        return sorted(seen[n:])

    pages.write_pages(frame(spark, rows(range(4))), path)
    assert drain() == sorted(rows(range(4))) and drain() == []
    pages.write_pages(frame(spark, rows(range(4, 9), ("a", "new")) + rows([2], ("é",))), path)
    assert drain() == sorted(rows(range(4, 9), ("a", "new")))


def test_nothing_is_visible_of_an_aborted_write(spark, tmp_path):
    path = str(tmp_path / "p")
    pages.write_pages(frame(spark, rows([0])), path)
    bad = frame(spark, rows(range(9))).withColumn("value", F.when(F.dayofmonth("ts") == 7, F.raise_error(F.lit("no")).cast("double")).otherwise(F.col("value")))
    with pytest.raises(Exception):
        pages.write_pages(bad, path)
    assert got(pages.read_pages(spark, path)) == sorted(rows([0])) and len(glob.glob(f"{path}/*/")) == 1
