"""The WARC data source: round trips, planned ranges, pushed predicates, what is decoded, foreign and broken files."""

import glob
import gzip
import hashlib
import os

import pytest
from stationflow.llm import warc

BIG = "<p>" + "x é" * 600 + "</p>"
PAGES = [(1, "http://a/1", BIG), (2, None, BIG), (3, "http://a/\r\nX: y", "short"), (4, "u", "short"), (5, "u", None), (6, "u", ""), (None, "u", BIG), (9, "u", BIG), (9, "u", BIG), (10, "u", BIG + "z" * 3_000_000), (11, "u", "HTTP/1.1 200 OK\r\n\r\n" + "WARC/1.1\r\n" * 200), (None, "v", "q" * 2000), (None, "w", "q" * 2000)]
SCHEMA = "page_id long, url string, html string, record_type int, payload int"


def expected(pages):
    best = {}
    for p, _, h in pages:
        if p is not None:
            best[h or ""] = max(best.get(h or "", p), p)
    out = []
    for p, _, h in pages:
        data, keeper = (h or "").encode(), best.get(h or "")
        again = len(data) >= 1000 and keeper is not None and p != keeper
        out.append((p, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", keeper if again else None))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(p, u, h, 1, 2) for p, u, h in PAGES], SCHEMA).repartition(3)


def test_pages(spark, pages):
    got = warc.archive_pages(pages)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == expected(PAGES)
    assert warc.archive_pages(pages.limit(0)).collect() == []


@pytest.mark.parametrize("compression", ["gzip", "none"])
def test_round_trip_and_ranges(spark, pages, tmp_path, compression):
    path = str(tmp_path / "a")
    records = warc.crawl_records(pages).repartition(2)
    warc.write_warc(records, path, compression)
    want = sorted(((r.record_type, r.record_id, r.refers_to, None if r.record_type == "revisit" else bytes(r.payload)) for r in records.collect()), key=repr)
    read = lambda df: sorted(((r.record_type, r.record_id, r.refers_to, r.payload and bytes(r.payload) if r.record_type == "revisit" else bytes(r.payload)) for r in df.collect()), key=repr)
    assert read(warc.read_warc(spark, path)) == want
    targets = {r.target_uri for r in warc.read_warc(spark, path, ["target_uri"]).collect()}
    assert "http://a/%0D%0AX: y" in targets and None in targets
    spark.dataSource.register(warc.WarcSource)
    assert read(spark.read.format("warc").option("splitBytes", "1").load(path)) == want
    if compression == "gzip":  # any reader of gzip can read the files, and files without a manifest are read too
        whole = b"".join(gzip.open(f).read() for f in glob.glob(f"{path}/*/*.warc.gz"))
        assert whole.count(b"WARC/1.1\r\nWARC-Type: ") == len(PAGES)
        (tmp_path / "b").mkdir()
        (tmp_path / "b" / "x.warc.gz").write_bytes(gzip.compress(whole))
        assert read(warc.read_warc(spark, str(tmp_path / "b"))) == want
        assert read(warc.read_warc(spark, str(tmp_path / "b")).where("record_type = 'revisit'")) == [w for w in want if w[0] == "revisit"]


def test_more_ranges_for_larger_files(spark, tmp_path, monkeypatch):
    rows = spark.range(400).selectExpr("'response' AS record_type", "concat('urn:x:', id) AS record_id", "cast(concat_ws(',', transform(sequence(1, 3000), i -> hash(id, i))) AS binary) AS payload").coalesce(1)
    path = str(tmp_path / "a")
    writer = warc.WarcWriter({"path": path}, None, False)
    writer.split = 100_000
    writer.commit([writer.write(iter(rows.toArrow().to_batches()))])
    reader = warc.WarcReader({"path": path, "splitbytes": "1000000"}, warc.StructType())
    ranges = reader.partitions()
    assert len(ranges) > 4 and all(a.end == b.start for a, b in zip(ranges, ranges[1:]))
    spark.dataSource.register(warc.WarcSource)
    got = spark.read.format("warc").option("splitBytes", "1000000").load(path)
    assert got.rdd.getNumPartitions() == len(ranges) and got.select("record_id").distinct().count() == 400


@pytest.mark.parametrize("compression", ["gzip", "none"])
def test_predicates_keep_payloads_from_being_decoded(spark, pages, tmp_path, compression):
    path = str(tmp_path / "a")
    warc.write_warc(warc.crawl_records(pages).coalesce(1), path, compression)
    reader = warc.PushingReader({"path": path}, warc.StructType())
    from pyspark.sql.datasource import EqualTo, GreaterThan, In, StringStartsWith

    later = GreaterThan(("content_length",), 5)
    assert list(reader.pushFilters([EqualTo(("record_type",), "response"), later, In(("record_id",), ("urn:x-page:3", "urn:x-page:2")), StringStartsWith(("record_id",), "urn:x-page")])) == [later]
    store = warc._files(path)[0]
    for payloads, times in ((True, 1), (False, 0)):
        seen = []
        found = [r for part in reader.partitions() for r in warc.records(store, part, reader.tests, payloads, seen)]
        assert [r["record_id"] for r in found] == ["urn:x-page:3"] and len(seen) == times
    with warc.pushed_filters(spark):
        plan = warc.read_warc(spark, path).where("record_type = 'revisit'")
        assert plan.count() == 3 and "Filter (" not in plan._jdf.queryExecution().executedPlan().toString().split("BatchScan")[0]


def test_unwanted_payloads_are_never_read(tmp_path):
    data = [warc.record_bytes({"record_type": t, "record_id": f"urn:{i}", "payload": os.urandom(4_000_000)}, "d") for i, t in enumerate(["metadata", "response", "metadata"])]
    (tmp_path / "x.warc").write_bytes(b"".join(data))
    store, file = warc._files(str(tmp_path / "x.warc"))
    read = []

    class Counted(warc.Bytes):
        def get(self, at, n):
            before = self.at, len(self.held)
            out = super().get(at, n)
            if before != (self.at, len(self.held)):
                read.append(len(self.held))
            return out

    plain, warc.Bytes = warc.Bytes, Counted
    try:
        found = list(warc.records(store, warc.Range(file, 0, sum(map(len, data))), [("record_type", "EqualTo", "response")], False))
    finally:
        warc.Bytes = plain
    assert [r["record_id"] for r in found] == ["urn:1"] and sum(read) <= 3 * warc.READ_BYTES


def test_broken_files_say_where(tmp_path):
    record = warc.record_bytes({"record_type": "response", "record_id": "urn:1", "payload": b"y" * 5000}, "d")
    for data in (record[:-600], warc.member(record)[:-20], gzip.compress(record[:-600]), b"no archive\r\n\r\n", record + b"\x00" * 50):
        file = tmp_path / "x.warc"
        file.write_bytes(data)
        store, at = warc._files(str(file))
        with pytest.raises((ValueError, EOFError)):
            list(warc.records(store, warc.Range(at, 0, len(data)), [], True))


def test_nothing_is_visible_of_an_aborted_write(spark, tmp_path):
    from pyspark.sql import functions as F

    path = str(tmp_path / "a")
    one = spark.createDataFrame([("response", "urn:1", b"a")], "record_type string, record_id string, payload binary")
    warc.write_warc(one, path)
    bad = spark.range(40).repartition(4).select(F.lit("response").alias("record_type"), F.expr("if(id = 39, raise_error('no'), concat('urn:', id))").alias("record_id"), F.lit(b"b").alias("payload"))
    with pytest.raises(Exception):
        warc.write_warc(bad, path)
    assert [r.record_id for r in warc.read_warc(spark, path, ["record_id"]).collect()] == ["urn:1"] and len(glob.glob(f"{path}/*/")) == 1
    warc.write_warc(one.withColumn("record_id", one.payload.cast("string")), path, mode="overwrite")
    assert [r.record_id for r in warc.read_warc(spark, path, ["record_id"]).collect()] == ["a"]
