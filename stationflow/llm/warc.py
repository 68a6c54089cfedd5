"""WARC archives as a Python data source of Spark: planned file ranges, header predicates, payloads decoded on demand.

The source is named warc. Its writer gives each record a gzip member of its own whose header tells the member's length
(the 'sl' field of the format's annex), so that a reader steps over a payload without inflating it. A write becomes
visible by one manifest that lists its files and the places at which they may be split.
"""

from __future__ import annotations

import base64
import contextlib
import gzip
import hashlib
import json
import posixpath
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In, InputPartition, IsNotNull, StringStartsWith, WriterCommitMessage
from pyspark.sql.types import StructType

from ..sources import shared_dir
from .common import join_spread, small_batches, written

SCHEMA = "record_type string, record_id string, target_uri string, date string, refers_to string, payload_digest string, content_type string, content_length long, headers map<string,string>, payload binary, file string, offset long"
# column: the header that it shows
NAMED = {"record_type": "warc-type", "record_id": "warc-record-id", "target_uri": "warc-target-uri", "date": "warc-date", "refers_to": "warc-refers-to", "payload_digest": "warc-payload-digest", "content_type": "content-type"}
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"  # fixed value: the format's name of it
SPLIT_BYTES = 32 << 20
FILE_BYTES = 512 << 20
READ_BYTES = 1 << 20
BATCH_BYTES = 4 << 20


def _files(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path and the path in it, for any store that Arrow knows."""
    if "://" not in path:
        path = "file://" + path.removeprefix("file:")
    return pafs.FileSystem.from_uri(path)


@dataclass
class Range(InputPartition):
    """Records of a file that begin in [start, end)."""

    file: str
    start: int
    end: int


@dataclass
class Written(WriterCommitMessage):
    """Files of a task: name, bytes, places of records at which they may be split."""

    files: list


class WarcSource(DataSource):
    """format("warc"): options path; for writing also compression (gzip or none) and date; for reading splitBytes and pushFilters."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        kind = PushingReader if self.options.get("pushfilters", "false").lower() == "true" else WarcReader
        return kind(self.options, schema)

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        return WarcWriter(self.options, schema, overwrite)


class WarcReader(DataSourceReader):
    """Plans ranges of files and reads the records of each; columns are those of the schema that was asked for."""

    def __init__(self, options: dict, schema: StructType):
        self.path, self.split = options["path"], int(options.get("splitbytes", SPLIT_BYTES))
        self.schema, self.tests = schema, []

    def partitions(self) -> list[Range]:
        """Ranges of about splitBytes of the files that manifests list; of a folder without manifests, its .warc and .warc.gz files."""
        store, root = _files(self.path)
        found = store.get_file_info(pafs.FileSelector(root, recursive=True)) if store.get_file_info(root).type == pafs.FileType.Directory else [store.get_file_info(root)]
        manifests = [x.path for x in found if x.base_name.startswith("_written-")]
        if not manifests:
            files = [x for x in found if x.type == pafs.FileType.File and x.path.endswith((".warc", ".warc.gz"))]
            return [Range(x.path, 0, x.size) for x in sorted(files, key=lambda x: x.path)] or [Range("", 0, 0)]
        out = []
        for m in sorted(manifests):
            with store.open_input_stream(m) as f:
                files = json.loads(f.read())
            for name, size, places in files:
                begin = 0
                for p in [*places, size]:
                    if p - begin >= self.split or p == size and p > begin:
                        out.append(Range(posixpath.join(root, name), begin, p))
                        begin = p
        return out or [Range("", 0, 0)]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        kind = _arrow(self.schema)
        rows, size = [], 0
        if partition.file:
            for record in records(_files(self.path)[0], partition, self.tests, "payload" in self.schema.names):
                rows.append(record)
                size += 300 + len(record["payload"] or b"")
                if size >= BATCH_BYTES:
                    yield pa.RecordBatch.from_pylist(rows, kind)
                    rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, kind)


class PushingReader(WarcReader):
    """The same, with predicates on header columns tested before payloads are decoded (the session must allow pushed filters)."""

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if column in NAMED and isinstance(f, (EqualTo, In, IsNotNull, StringStartsWith)):
                self.tests.append((column, type(f).__name__, getattr(f, "value", None)))
            else:
                yield f


def _arrow(schema: StructType) -> pa.Schema:
    kinds = {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary(), "map<string,string>": pa.map_(pa.string(), pa.string())}
    return pa.schema([(f.name, kinds[f.dataType.simpleString()]) for f in schema.fields])


def passes(head: dict, tests: list[tuple]) -> bool:
    """Whether a record's header columns meet all tests; what is compared with null doesn't."""
    for column, test, value in tests:
        own = head[column]
        if own is None or test == "EqualTo" and own != value or test == "In" and own not in value or test == "StringStartsWith" and not own.startswith(value):
            return False
    return True


def parse_head(text: bytes) -> dict:
    """The columns of a record's header; names of headers are lower-cased, folded lines joined, angle brackets left out."""
    first, *lines = text.replace(b"\r\n ", b" ").replace(b"\r\n\t", b" ").split(b"\r\n")
    if not first.startswith(b"WARC/"):
        raise ValueError(f"no WARC record: {first[:40]!r}")
    headers: dict[str, str] = {}
    for line in lines:
        name, colon, value = line.decode("utf-8", "replace").partition(":")
        if colon:
            headers[name.strip().lower()] = value.strip()
    head = {c: headers.get(h) for c, h in NAMED.items()}
    for c in ("record_id", "refers_to", "target_uri"):
        if head[c] and head[c].startswith("<") and head[c].endswith(">"):
            head[c] = head[c][1:-1]
    return head | {"content_length": int(headers.get("content-length", 0)), "headers": headers}


def payload_of(block: bytes, content_type: str | None) -> bytes:
    """A block without the HTTP header that it begins with."""
    return block.partition(b"\r\n\r\n")[2] if (content_type or "").lower().startswith("application/http") else block


class Bytes:
    """A file read in large pieces, of which unwanted ones are never read."""

    def __init__(self, store: pafs.FileSystem, path: str):
        self.file, self.at, self.held = store.open_input_file(path), 0, b""
        self.size = self.file.size()

    def get(self, at: int, n: int) -> bytes:
        """n bytes from a place (fewer at the file's end)."""
        if not self.at <= at <= at + n <= self.at + len(self.held):
            self.at = at
            self.held = self.file.read_at(min(max(n, READ_BYTES), max(0, self.size - at)), at)
        return self.held[at - self.at : at - self.at + n]


HEAD_BYTES = 4096


def records(store: pafs.FileSystem, part: Range, tests: list[tuple], payloads: bool, seen: list | None = None) -> Iterator[dict]:
    """The records that begin in a range and pass the tests, headers first.

    A payload is only decoded if it is wanted and the headers pass; a revisit, and any block that isn't decoded, has a
    null payload. seen, if given, gets the place of each payload that was decoded. A file that ends within a record
    is an error that names the file and the place. Files of other writers (gzip members without lengths) are inflated
    as a stream, in which unwanted blocks are passed over in pieces.
    """
    source, at = Bytes(store, part.file), part.start
    begin = source.get(at, 16)
    if begin[:2] == b"\x1f\x8b" and (begin[3:4] != b"\x04" or begin[12:14] != b"sl"):
        yield from _streamed(store, part, tests, payloads, seen)
        return
    while at < part.end:
        begin = source.get(at, 24)
        member = begin[:2] == b"\x1f\x8b"
        if member and (begin[3:4] != b"\x04" or begin[12:14] != b"sl" or len(begin) < 24):
            raise ValueError(f"{part.file}: a member without its length at {at}")
        length = struct.unpack("<I", begin[16:20])[0] if member else 0
        known, text = HEAD_BYTES, b""
        while True:  # headers of any length
            raw = source.get(at, min(known, length) if member else known)
            text = zlib.decompressobj(-15).decompress(raw[24:], known) if member else raw
            end = text.find(b"\r\n\r\n")
            if end >= 0 or len(raw) < known and (not member or len(raw) == length or at + len(raw) >= source.size):
                break
            known *= 4
        if end < 0:
            raise ValueError(f"{part.file}: the record at {at} has no end of its headers")
        head = parse_head(text[:end])
        n = head["content_length"]
        length = length if member else end + 4 + n + 4
        if at + length > source.size:
            raise ValueError(f"{part.file}: the record at {at} isn't complete")
        if passes(head, tests):
            payload = None
            if payloads and head["record_type"] != "revisit":
                block = zlib.decompress(source.get(at, length)[24:-8], -15)[end + 4 : end + 4 + n] if member else source.get(at + end + 4, n)
                payload = payload_of(block, head["content_type"])
                if seen is not None:
                    seen.append(at)
            yield head | {"payload": payload, "file": part.file, "offset": at}
        at += length


def _streamed(store: pafs.FileSystem, part: Range, tests: list[tuple], payloads: bool, seen: list | None) -> Iterator[dict]:
    with store.open_input_file(part.file) as raw, gzip.GzipFile(fileobj=raw) as f:
        at = 0
        while True:
            text = b""
            while not text.endswith(b"\r\n\r\n"):
                line = f.readline()
                if not line:
                    if text.strip():
                        raise ValueError(f"{part.file}: the record at {at} isn't complete")
                    return
                text = text + line if text or line.strip() else b""
            head = parse_head(text[:-4])
            at, left, payload = at + len(text), head["content_length"], None
            if passes(head, tests):
                if payloads and head["record_type"] != "revisit":
                    block = f.read(left)
                    if len(block) < left:
                        raise ValueError(f"{part.file}: the record before {at} isn't complete")
                    payload, left = payload_of(block, head["content_type"]), 0
                    if seen is not None:
                        seen.append(at - len(text))
                yield head | {"payload": payload, "file": part.file, "offset": at - len(text)}
            while left > 0:
                got = len(f.read(min(left, READ_BYTES)))
                if not got:
                    raise ValueError(f"{part.file}: the record before {at} isn't complete")
                left -= got
            at += head["content_length"] + 4


def record_bytes(row: dict, date: str) -> bytes:
    """A record in the format: a response has an HTTP header before its payload, a revisit only that header."""
    payload, revisit = row.get("payload") or b"", row["record_type"] == "revisit"
    line = lambda v: v.replace("\r", "%0D").replace("\n", "%0A")  # noqa: E731  a header can't hold line ends
    http = f"HTTP/1.1 200 OK\r\nContent-Type: {line(row.get('content_type') or 'text/html; charset=utf-8')}\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    digest = row.get("payload_digest") or "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode()
    head = [("WARC-Type", row["record_type"]), ("WARC-Record-ID", f"<{line(row['record_id'] or uuid.uuid4().urn)}>"), ("WARC-Date", row.get("date") or date)]
    head += [("WARC-Target-URI", line(row["target_uri"]))] if row.get("target_uri") is not None else []
    head += [("WARC-Refers-To", f"<{line(row['refers_to'])}>")] if row.get("refers_to") else []
    head += [("WARC-Profile", PROFILE)] if revisit else []
    block = http if revisit else http + payload
    head += [("WARC-Payload-Digest", digest), ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    """data as a gzip member whose header has its length."""
    deflate = zlib.compressobj(4, zlib.DEFLATED, -15)
    body = deflate.compress(data) + deflate.flush()
    size = 24 + len(body) + 8
    return b"\x1f\x8b\x08\x04\x00\x00\x00\x00\x00\xff" + struct.pack("<H2sHII", 12, b"sl", 8, size, len(data)) + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


class WarcWriter(DataSourceArrowWriter):
    """Columns record_type, record_id and payload, and target_uri, refers_to, date, payload_digest, content_type if there.

    Tasks write into a folder of the write's own; the driver's manifest makes their files visible together. An aborted
    write's folder is deleted, and files of failed attempts are in no manifest.
    """

    def __init__(self, options: dict, schema: StructType, overwrite: bool):
        self.path, self.overwrite, self.plain = options["path"], overwrite, options.get("compression", "gzip") == "none"
        self.date, self.job, self.split = options.get("date", "1970-01-01T00:00:00Z"), uuid.uuid4().hex, SPLIT_BYTES // 4

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, root = _files(self.path)
        store.create_dir(posixpath.join(root, self.job), recursive=True)
        files, out, size, places = [], None, 0, []

        def close() -> None:
            if out is not None:
                out.close()
                files.append((name, size, places))

        for batch in iterator:
            for row in batch.to_pylist():
                if out is None or size >= FILE_BYTES:
                    close()
                    name, size, places = f"{self.job}/{uuid.uuid4().hex}.warc{'' if self.plain else '.gz'}", 0, []
                    out = store.open_output_stream(posixpath.join(root, name), compression=None)
                data = record_bytes(row, self.date)
                data = data if self.plain else member(data)
                if size and size - (places[-1] if places else 0) >= self.split:
                    places.append(size)
                out.write(data)
                size += len(data)
        close()
        return Written(files)

    def commit(self, messages: list[Written | None]) -> None:
        store, root = _files(self.path)
        old = [x.path for x in store.get_file_info(pafs.FileSelector(root, allow_not_found=True)) if x.base_name.startswith("_written-")] if self.overwrite else []
        store.create_dir(root, recursive=True)
        draft = posixpath.join(root, f".{self.job}")
        with store.open_output_stream(draft) as f:
            f.write(json.dumps([x for m in messages if m for x in m.files]).encode())
        store.move(draft, posixpath.join(root, f"_written-{self.job}"))
        for m in old:
            store.delete_file(m)
            with contextlib.suppress(FileNotFoundError):
                store.delete_dir(posixpath.join(root, posixpath.basename(m).removeprefix("_written-")))

    def abort(self, messages: list[Written | None]) -> None:
        store, root = _files(self.path)
        with contextlib.suppress(FileNotFoundError):
            store.delete_dir(posixpath.join(root, self.job))


ALLOWED = "spark.sql.python.filterPushdown.enabled"


def write_warc(rows: DataFrame, path: str, compression: str = "gzip", mode: str = "append") -> None:
    """Writes rows (WarcWriter tells the columns) as an archive below path, which all executors can reach."""
    rows.sparkSession.dataSource.register(WarcSource)
    rows.write.format("warc").mode(mode).option("compression", compression).save(path)


def read_warc(spark: SparkSession, path: str, columns: Iterable[str] | None = None) -> DataFrame:
    """The records below path, with the given columns; payloads are only decoded if asked for.

    Predicates on header columns (=, in, is not null, like 'x%') are pushed into the reader where the session's
    spark.sql.python.filterPushdown.enabled is true; otherwise Spark applies them to what was read.
    """
    spark.dataSource.register(WarcSource)
    kinds = dict(c.split(" ", 1) for c in SCHEMA.split(", "))
    schema = ", ".join(f"{c} {kinds[c]}" for c in (columns or kinds))
    return spark.read.format("warc").schema(schema).option("pushFilters", spark.conf.get(ALLOWED, "false")).load(path)


@contextlib.contextmanager
def pushed_filters(spark: SparkSession) -> Iterator[None]:
    """Allows pushed filters for the queries that run within; the session's setting comes back afterwards."""
    before = spark.conf.get(ALLOWED, None)
    spark.conf.set(ALLOWED, "true")
    try:
        yield
    finally:
        spark.conf.unset(ALLOWED) if before is None else spark.conf.set(ALLOWED, before)


PAGE = "urn:x-page:"


def crawl_records(pages: DataFrame, least_bytes: int = 1000) -> DataFrame:
    """The records of pages (page_id, url, html): of equal payloads of least_bytes bytes, that of the largest page_id is the response."""
    p = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("target_uri"), F.coalesce(F.col("html").cast("binary"), F.lit(b"")).alias("payload"))
    # a key of its own for each payload that is too short to be looked for
    p = p.withColumn("digest", F.when(F.length("payload") >= least_bytes, F.sha2("payload", 256)).otherwise(F.monotonically_increasing_id().cast("string")))
    again = p.where(F.length("payload") >= least_bytes).groupBy("digest").agg(F.count(F.lit(1)).alias("copies"), F.max("page_id").alias("keeper")).where("copies > 1")
    again = written(again, "repeated-payloads")
    p = join_spread(p, again, "digest", "copies", ["page_id"], "left")
    revisit = F.col("keeper").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("keeper"))
    name = lambda c: F.concat(F.lit(PAGE), F.coalesce(F.col(c).cast("string"), F.lit("none")))
    return p.select(F.when(revisit, "revisit").otherwise("response").alias("record_type"), name("page_id").alias("record_id"), "target_uri", F.when(revisit, name("keeper")).alias("refers_to"), "payload")


def archive_pages(pages: DataFrame, least_bytes: int = 1000) -> DataFrame:
    """page_id, payload_bytes, payload_digest (hex SHA-1), record_type and refers_to of a record for each page, read back from an archive.

    pages needs page_id, url and html; a null html is an empty payload, a null url gives no target. Of records with
    equal payloads of least_bytes bytes or more, those of the largest page_id are responses (several if the row is
    repeated, all if no page_id is known) and the others revisit it. Responses are digested from the payloads as they
    are read; revisits have no payload and take the length of the response that they refer to. No pages, no rows.
    """
    spark = pages.sparkSession
    small_batches(spark)
    path = f"{shared_dir(spark)}/stationflow-warc-{uuid.uuid4().hex}"
    write_warc(crawl_records(pages, least_bytes), path)
    page = lambda c: F.expr(f"try_cast(substring({c}, {len(PAGE) + 1}) AS bigint)")
    with pushed_filters(spark):
        found = read_warc(spark, path, ["record_type", "record_id", "payload_digest", "payload"]).where("record_type = 'response'")
        responses = written(found.select(page("record_id").alias("page_id"), F.col("payload_digest").alias("header"), F.length("payload").cast("long").alias("payload_bytes"), F.sha1("payload").alias("payload_digest")), "responses")
        found = read_warc(spark, path, ["record_type", "record_id", "refers_to", "payload_digest"]).where("record_type = 'revisit'")
        revisits = written(found.select(page("record_id").alias("page_id"), page("refers_to").alias("refers_to"), F.col("payload_digest").alias("header")), "revisits")
    store, root = _files(path)
    store.delete_dir(root)
    times = revisits.groupBy("refers_to", "header").agg(F.count(F.lit(1)).alias("times"))
    one = times.join(responses.withColumnRenamed("page_id", "refers_to").distinct(), ["refers_to", "header"])
    one = written(one.select(F.concat_ws(" ", "refers_to", "header").alias("key"), "payload_bytes", "payload_digest", "times"), "referred")
    again = join_spread(revisits.withColumn("key", F.concat_ws(" ", "refers_to", "header")), one, "key", "times", ["page_id"], "left")
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    first = responses.select("page_id", "payload_bytes", "payload_digest", F.lit("response").alias("record_type"), F.lit(None).cast("long").alias("refers_to"))
    return first.unionByName(again.select("page_id", "payload_bytes", "payload_digest", F.lit("revisit").alias("record_type"), "refers_to")).select(*names)


ORACLE = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest,
                  max(page_id) OVER (PARTITION BY coalesce(html, '')) AS keeper FROM pages),
t AS (SELECT *, payload_bytes >= 1000 AND page_id <> keeper AS again FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN again THEN keeper END AS refers_to FROM t
"""
