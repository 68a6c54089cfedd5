"""Pages of measurements as a Python data source: nested JSON by station and range of time, read by pushed ranges or as a stream.

format("station_pages"): a page is a file {station}/{from}-{to}-{id}.json (times of its first and last row in
microseconds, the station's name quoted as in addresses) with a tree of JSON as flatten_tree_json() takes it. Readers
plan from the names alone. A write becomes visible by one manifest that lists its pages.
"""

from __future__ import annotations

import contextlib
import datetime as dt
import json
import posixpath
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual, WriterCommitMessage
from pyspark.sql.types import StructType

SCHEMA = "station_type string, station_code string, type_name string, ts timestamp, value double, period int"
ARROW = pa.schema([("station_type", pa.string()), ("station_code", pa.string()), ("type_name", pa.string()), ("ts", pa.timestamp("us", "UTC")), ("value", pa.float64()), ("period", pa.int32())])
RANGE_S = 5 * 86400
SPLIT_BYTES = 8 << 20
PUSHED = "spark.sql.python.filterPushdown.enabled"


def _files(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path if "://" in path else "file://" + path.removeprefix("file:"))


def _us(t: dt.datetime) -> int:
    t = t if t.tzinfo else t.replace(tzinfo=dt.UTC)
    return (t - dt.datetime(1970, 1, 1, tzinfo=dt.UTC)) // dt.timedelta(microseconds=1)


@dataclass
class Page:
    file: str
    station: str
    first: int
    last: int
    size: int


@dataclass
class Pages(InputPartition):
    """The pages of stations whose first rows are in one range of time, or of several that are small; rows outside of [least, most] are left out."""

    pages: list[Page]
    least: int | None = None
    most: int | None = None


@dataclass
class Written(WriterCommitMessage):
    names: list[str]


def pages_of(path: str) -> list[Page]:
    """All visible pages, by station and time: those that manifests list, or all if there is no manifest."""
    store, root = _files(path)
    found = [x for x in store.get_file_info(pafs.FileSelector(root, recursive=True, allow_not_found=True)) if x.type == pafs.FileType.File]
    size = {x.path: x.size for x in found}
    names = [x.path for x in found if x.path.endswith(".json") and not x.base_name.startswith(("_", "."))]
    manifests = [x.path for x in found if x.base_name.startswith("_written-")]
    if manifests:
        listed: set[str] = set()
        for m in manifests:
            with store.open_input_stream(m) as f:
                listed |= {posixpath.join(root, n) for n in json.loads(f.read())}
        names = [n for n in names if n in listed]
    out = []
    for n in names:
        station, file = posixpath.split(n)
        first, last, *_ = posixpath.splitext(file)[0].split("-")
        out.append(Page(n, unquote(posixpath.basename(station)), int(first), int(last), size[n]))
    return sorted(out, key=lambda p: (p.station, p.first, p.file))


def planned(pages: Iterable[Page], range_s: int, split: int, least: int | None = None, most: int | None = None) -> list[Pages]:
    """Partitions of whole stations' ranges of range_s seconds, small ones together up to about `split` bytes."""
    out: list[Pages] = []
    now, size = None, 0
    for p in pages:
        at = p.station, p.first // (range_s * 1_000_000)
        if not out or at != now and size >= split:
            out.append(Pages([], least, most))
            size = 0
        out[-1].pages.append(p)
        now, size = at, size + p.size
    return out or [Pages([])]


def rows_of(path: str, part: Pages) -> Iterator[pa.RecordBatch]:
    store = _files(path)[0]
    for page in part.pages:
        with store.open_input_stream(page.file) as f:
            tree = json.loads(f.read())
        rows = []
        for kind, of_kind in tree.items():
            for code, station in of_kind["stations"].items():
                for name, data in station["sdatatypes"].items():
                    for m in data["tmeasurements"]:
                        t = dt.datetime.fromisoformat(m["mvalidtime"])
                        if (part.least is None or _us(t) >= part.least) and (part.most is None or _us(t) <= part.most):
                            rows.append((kind, code, name, t, m["mvalue"], m["mperiod"]))
        rows.sort(key=lambda r: (r[3], r[2]))
        if rows:
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), ARROW.types)], schema=ARROW)


class PagesSource(DataSource):
    """Options: path; rangeSeconds and splitBytes of partitions, pushFilters (where the session allows it) for reading, and rows of a page for writing."""

    @classmethod
    def name(cls) -> str:
        return "station_pages"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        return (PushingReader if self.options.get("pushfilters", "false").lower() == "true" else PagesReader)(self.options)

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return PagesStream(self.options)

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        return PagesWriter(self.options)


class PagesReader(DataSourceReader):
    """Partitions by station and range of days."""

    def __init__(self, options: dict):
        self.path, self.range_s = options["path"], int(options.get("rangeseconds", RANGE_S))
        self.split = int(options.get("splitbytes", SPLIT_BYTES))
        self.stations: set[str] | None = None
        self.least: int | None = None
        self.most: int | None = None

    def partitions(self) -> list[Pages]:
        some = [p for p in pages_of(self.path) if (self.stations is None or p.station in self.stations) and (self.least is None or p.last >= self.least) and (self.most is None or p.first <= self.most)]
        return planned(some, self.range_s, self.split, self.least, self.most)

    def read(self, partition: Pages) -> Iterator[pa.RecordBatch]:
        return rows_of(self.path, partition)


class PushingReader(PagesReader):
    """The same, for the stations and the range of times that filters ask for."""

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if column == "station_code" and isinstance(f, (EqualTo, In)):
                own = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.stations = own if self.stations is None else self.stations & own
            elif column == "ts" and isinstance(f, (GreaterThan, GreaterThanOrEqual, EqualTo, LessThan, LessThanOrEqual)):
                at = _us(f.value)
                if isinstance(f, (GreaterThan, GreaterThanOrEqual, EqualTo)):
                    self.least = max(at + isinstance(f, GreaterThan), self.least if self.least is not None else at)
                if isinstance(f, (LessThan, LessThanOrEqual, EqualTo)):
                    at -= isinstance(f, LessThan)
                    self.most = min(at, self.most if self.most is not None else at)
            else:
                yield f


class PagesStream(DataSourceStreamReader):
    """An offset is the last time that was read of each station; pages that begin after it are new.

    As with an incremental download, rows of a station that appear later with earlier times aren't read any more.
    """

    def __init__(self, options: dict):
        self.path, self.range_s = options["path"], int(options.get("rangeseconds", RANGE_S))
        self.split = int(options.get("splitbytes", SPLIT_BYTES))

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        out: dict[str, int] = {}
        for p in pages_of(self.path):
            out[p.station] = max(p.last, out.get(p.station, p.last))
        return out

    def partitions(self, start: dict, end: dict) -> list[Pages]:
        new = [p for p in pages_of(self.path) if p.station in end and p.last <= end[p.station] and (p.station not in start or p.first > start[p.station])]
        return planned(new, self.range_s, self.split)

    def read(self, partition: Pages) -> Iterator[pa.RecordBatch]:
        return rows_of(self.path, partition)


class PagesWriter(DataSourceArrowWriter):
    """Rows that come in order of station and time go into pages of one station, of `rows` rows at most and of one range of time."""

    def __init__(self, options: dict):
        self.path, self.rows, self.range_s, self.job = options["path"], int(options.get("rows", 1000)), int(options.get("rangeseconds", RANGE_S)), uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, root = _files(self.path)
        names: list[str] = []
        held: list[dict] = []
        made = [""]

        def close() -> None:
            tree: dict = {}
            for r in held:
                data = tree.setdefault(r["station_type"] or "", {"stations": {}})["stations"].setdefault(r["station_code"], {"sdatatypes": {}})["sdatatypes"]
                stamp = r["ts"].astimezone(dt.UTC).replace(tzinfo=None).isoformat(" ", "microseconds") + "+0000"
                data.setdefault(r["type_name"], {"tmeasurements": []})["tmeasurements"].append({"mvalidtime": stamp, "mvalue": r["value"], "mperiod": r["period"]})
            folder = posixpath.join(self.job, quote(held[0]["station_code"], safe=""))
            if folder != made[0]:  # a station's pages mostly follow each other
                store.create_dir(posixpath.join(root, folder), recursive=True)
                made[0] = folder
            names.append(posixpath.join(folder, f"{_us(held[0]['ts'])}-{_us(held[-1]['ts'])}-{uuid.uuid4().hex}.json"))
            with store.open_output_stream(posixpath.join(root, names[-1])) as f:
                f.write(json.dumps(tree).encode())
            held.clear()

        now = None
        for batch in iterator:
            for row in batch.to_pylist():
                bucket = row["station_code"], _us(row["ts"]) // (self.range_s * 1_000_000)
                if held and (len(held) >= self.rows or bucket != now):
                    close()
                now = bucket
                held.append(row)
        if held:
            close()
        return Written(names)

    def commit(self, messages: list[Written | None]) -> None:
        store, root = _files(self.path)
        store.create_dir(root, recursive=True)
        draft = posixpath.join(root, f".{self.job}")
        with store.open_output_stream(draft) as f:
            f.write(json.dumps([n for m in messages if m for n in m.names]).encode())
        store.move(draft, posixpath.join(root, f"_written-{self.job}"))

    def abort(self, messages: list[Written | None]) -> None:
        store, root = _files(self.path)
        with contextlib.suppress(FileNotFoundError):
            store.delete_dir(posixpath.join(root, self.job))


def write_pages(m: DataFrame, path: str, rows: int = 1000, range_s: int = RANGE_S) -> None:
    """Measurements (columns of SCHEMA; rows without station, type or time are left out) as pages, in order of time in each.

    Stations are dealt by station and range of time, so that one with much history isn't one task.
    """
    m.sparkSession.dataSource.register(PagesSource)
    kinds = dict(c.split(" ") for c in SCHEMA.split(", "))
    some = m.select(*(F.col(c).cast(k).alias(c) for c, k in kinds.items())).where("station_code IS NOT NULL AND type_name IS NOT NULL AND ts IS NOT NULL")
    part = F.floor(F.unix_micros("ts") / (range_s * 1_000_000))
    dealt = some.withColumn("_range", part).repartition("station_code", "_range").sortWithinPartitions("station_code", "_range", "ts", "type_name").drop("_range")
    dealt.write.format("station_pages").mode("append").option("rows", rows).option("rangeSeconds", range_s).save(path)


def read_pages(spark: SparkSession, path: str, range_s: int = RANGE_S, split: int = SPLIT_BYTES) -> DataFrame:
    """All pages below path; filters on station_code and ts choose pages by their names where the session allows pushed filters."""
    spark.dataSource.register(PagesSource)
    return spark.read.format("station_pages").option("rangeSeconds", range_s).option("splitBytes", split).option("pushFilters", spark.conf.get(PUSHED, "false")).load(path)


def stream_pages(spark: SparkSession, path: str, range_s: int = RANGE_S) -> DataFrame:
    """Pages as a stream, station by station after the last time that was read."""
    spark.dataSource.register(PagesSource)
    return spark.readStream.format("station_pages").option("rangeSeconds", range_s).load(path)
