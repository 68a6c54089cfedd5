"""What several operators of this subpackage share: written tables, text columns, packed hash filters."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from ..sources import shared_dir

def written(df: DataFrame, name: str, codec: str = "zstd", by: str | None = None) -> DataFrame:
    """df as a table in the shared folder (in a folder for each value of by): cuts the lineage, survives lost executors, is computed once."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/stationflow-{name}-{uuid.uuid4().hex}"
    writer = df.write.option("compression", codec)
    (writer.partitionBy(by) if by else writer).parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table._stationflow_path = path
    return table


def forget(table: DataFrame, part: str = "") -> None:
    """Deletes a table of written(), or one folder of it, that nothing reads again."""
    jvm = table.sparkSession._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{table._stationflow_path}/{part}".rstrip("/"))
    path.getFileSystem(table.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


BATCH_BYTES = 2 << 20


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of a few megabytes, however long a document is; a limit that the session has already stays."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, str(BATCH_BYTES))


def portions(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about `most` bytes of a text or binary column (a longer value is a slice of its own)."""
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        part = (np.cumsum(size) - size) // most
        cuts = np.r_[0, np.flatnonzero(part[1:] != part[:-1]) + 1, batch.num_rows] if batch.num_rows else [0, 0]
        for a, b in zip(cuts[:-1], cuts[1:]):
            yield batch.slice(int(a), int(b - a))
    pa.default_memory_pool().release_unused()


_HELD: list = [(), None]


def held_by_worker(of: tuple, make: Callable):
    """make(*of), kept for the further tasks of this Python worker until one asks for what is made of other objects.

    A worker serves one operator after another, and would otherwise hold the maps of all of them.
    """
    if len(_HELD[0]) != len(of) or not all(a is b or isinstance(a, str) and a == b for a, b in zip(_HELD[0], of)):
        _HELD[:] = (), None  # goes before the next is made
        _HELD[:] = of, make(*of)
    return _HELD[1]


HOTTEST = 4096  # keys that join_spread() looks after


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def hash_sample(df: DataFrame, by: Column, most: int, columns: Sequence[str]) -> DataFrame:
    """At most `most` different rows of df[columns], those of the lowest hashes by; equal hashes are settled by the columns.

    The highest hash that is taken is found from the different hashes first, 8 bytes each, so that only rows at or
    below it leave their tasks. Repeated rows are one row of the sample, and take no other row's place.
    """
    spread = F.pmod(by, F.lit(1 << 62))
    top = df.select(spread.alias("h")).distinct().orderBy("h").limit(most).agg(F.max("h")).first()[0]
    if top is None:
        return df.select(*columns).limit(0)
    return df.where(spread <= top).select(spread.alias("_h"), *columns).distinct().orderBy("_h", *columns).limit(most).drop("_h")


def join_spread(many: DataFrame, one: DataFrame, key: str, weight: str, by: Sequence[str], how: str = "inner", most: int = 50_000) -> DataFrame:
    """many joined with one, which has each key once; keys that are frequent in many are dealt over several tasks.

    weight names the column of one that tells how many rows of many have the key (it isn't returned). The rows of a
    key with more than `most` are dealt by the hash of the columns by, and the key's row of one is repeated for each
    deal. Only the HOTTEST most frequent keys are looked up; any other has fewer than one in HOTTEST of all rows.
    """
    found = one.where(F.col(weight) > most).select(F.col(key).alias("_hot"), F.least(F.ceil(F.col(weight) / most), F.lit(1024)).cast("int").alias("_deals"))
    rows = found.orderBy(F.desc("_deals")).limit(HOTTEST).collect()
    if not rows:
        return many.join(one.drop(weight), key, how)
    hot = F.broadcast(many.sparkSession.createDataFrame(rows, found.schema))
    left = many.join(hot, F.col(key) == F.col("_hot"), "left")
    left = left.withColumn("_deal", F.coalesce(F.pmod(F.xxhash64(*by), F.col("_deals")), F.lit(0)).cast("int")).drop("_hot", "_deals")
    right = one.join(hot, F.col(key) == F.col("_hot"), "left").drop(weight)
    right = right.withColumn("_deal", F.explode(F.sequence(F.lit(0), F.coalesce("_deals", F.lit(1)) - 1))).drop("_hot", "_deals")
    return left.join(right, [key, "_deal"], how).drop("_deal")


MOST_IDS = 2_000_000  # ids that are broadcast, 16 bytes each


def of_ids(rows: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    """The rows whose doc_id is (left_semi) or isn't (left_anti) in the written table ids; rows stay in place if ids are few."""
    ids = ids.select(F.col("doc_id").alias("_id"))
    return rows.join(F.broadcast(ids) if ids.count() <= MOST_IDS else ids, F.col("doc_id") == F.col("_id"), how)


def without(docs: DataFrame, gone: DataFrame, every: DataFrame) -> DataFrame:
    """The rows of docs whose doc_id isn't in gone, each doc_id once; rows without doc_id stay.

    every: the doc_id of each row. Of the rows of a doc_id, the one with the lowest text stays (then by a hash of all
    columns). Rows are only shuffled where their doc_id is there several times.
    """
    kept = of_ids(docs, written(gone, "gone"), "left_anti")
    again = written(every.where(F.col("doc_id").isNotNull()).groupBy("doc_id").count().where("count > 1"), "repeated-ids")
    if again.isEmpty():
        return kept
    row = F.struct(*(F.col(c) for c in docs.columns))
    hash_ = F.xxhash64(*(F.to_json(F.struct(F.col(c))) if isinstance(docs.schema[c].dataType, MapType) else F.col(c) for c in docs.columns))
    one = of_ids(kept, again, "left_semi").groupBy("doc_id").agg(F.min_by(row, F.struct(F.col("text").cast("string"), hash_)).alias("row")).select("row.*")
    return of_ids(kept, again, "left_anti").unionByName(one)


def ascii_lower(c):
    """A-Z lower-cased, all else as it is."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def text_bytes(batch: pa.RecordBatch, column: str = "text") -> list[bytes | None]:
    """UTF-8 bytes of a string column, without decoding them."""
    a = batch.column(column)
    kind = pa.large_binary() if pa.types.is_large_string(a.type) else pa.binary()
    return a.view(kind).to_pylist() if not pa.types.is_binary(a.type) else a.to_pylist()


def mix64(h: np.ndarray) -> np.ndarray:
    """A finaliser that spreads the bits of 64-bit integers."""
    h = h.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


class TwiceFilter:
    """Which hashes may have been seen twice: two Bloom filters (seen once, seen twice) of 2 ** bits bits.

    Each hash has two places. Places that were set by two sightings are in the twice-seen filter; a hash is
    suspected when both of its places are. No hash that was seen twice is missed, whatever the load: a filter
    that is too small only suspects more. filter_bits() gives the size for a number of hashes, up to a bound of what
    is broadcast (2 ** MOST_BITS / 8 bytes).
    """

    def __init__(self, packed: bytes, bits: int):
        self.bits, self.map = bits, np.frombuffer(packed, dtype=np.uint8)

    @staticmethod
    def places(h: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """One place in each half of the filter."""
        m, half = mix64(h), np.uint64((1 << (bits - 1)) - 1)
        return (m & half).astype(np.int64), ((m >> np.uint64(32)) & half).astype(np.int64) + (1 << (bits - 1))

    def suspects(self, h: np.ndarray) -> np.ndarray:
        a, b = self.places(h, self.bits)
        return (self.map[a >> 3] >> (a & 7).astype(np.uint8) & 1 & (self.map[b >> 3] >> (b & 7).astype(np.uint8))).astype(bool)


MOST_BITS = 29


def filter_bits(hashes: int) -> int:
    """Bits of a filter's size for about so many hashes: 16 places for each, MOST_BITS at most."""
    return min(MOST_BITS, max(SLICE_BITS, (16 * max(1, hashes) - 1).bit_length()))


SLICE_BITS = 18  # places of a slice of the filter; a slice is merged as a whole


def seen_twice(rows: DataFrame, bits: int, hashed: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]] = iter) -> bytes:
    """The twice-seen filter over a column h of packed 64-bit hashes, each row holding what one document or block saw.

    hashed makes batches with that column of those of rows, in the same Python worker that sends their places: two
    Python steps in a task would take two workers, which stay.
    Tasks send the places that they saw, once or more, by slice; a slice's task merges them as they come, in
    2 ** SLICE_BITS bytes of memory. The merged slices are written, and the driver reads the bits of the twice-seen
    filter at once, 2 ** bits / 8 bytes.
    """
    spark, most = rows.sparkSession, 2_000_000

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def flush() -> Iterator[pa.RecordBatch]:
            if not held:
                return
            h, n = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            at = np.concatenate(TwiceFilter.places(h, bits))
            many = np.concatenate([n > 1, n > 1])
            order = np.argsort(at, kind="stable")
            at, many = at[order], many[order]
            first = np.r_[True, at[1:] != at[:-1]]
            # two different hashes of this task on one place count as two sightings
            group = np.cumsum(first) - 1
            twice = np.bincount(group, weights=many + 0.0) + np.bincount(group) > 1
            at = at[first]
            part = at >> SLICE_BITS
            cuts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
            ends = np.r_[cuts[1:], len(at)]
            low = (at & ((1 << SLICE_BITS) - 1)).astype(np.uint32)
            yield pa.record_batch(
                [
                    pa.array(part[cuts].astype(np.int32)),
                    pa.array([low[a:b].tobytes() for a, b in zip(cuts, ends)], pa.binary()),
                    pa.array([np.packbits(twice[a:b]).tobytes() for a, b in zip(cuts, ends)], pa.binary()),
                ],
                ["slice", "at", "twice"],
            )

        size = 0
        for batch in hashed(batches):
            for x in batch.column("h").to_pylist():
                if x:
                    held.append(np.frombuffer(x, dtype=np.uint64))
                    size += len(held[-1])
                    if size >= most:
                        yield from flush()
                        size = 0
        yield from flush()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, at, twice in zip(*(c.to_pylist() for c in batch.columns)):
                s = seen.setdefault(part, np.zeros(1 << SLICE_BITS, np.uint8))
                at = np.frombuffer(at, np.uint32)
                more = np.unpackbits(np.frombuffer(twice, np.uint8), count=len(at))
                s[at] = np.minimum(s[at] + 1 + more, 2)
        for part, s in seen.items():
            if (s == 2).any():
                yield pa.record_batch([pa.array([part], pa.int32()), pa.array([np.packbits(s == 2, bitorder="little").tobytes()], pa.binary())], ["slice", "bits"])

    sent = rows.mapInArrow(send, "slice int, at binary, twice binary")
    slices = max(1, (1 << bits) >> SLICE_BITS)
    parts = sent.repartition(min(slices, int(spark.conf.get("spark.sql.shuffle.partitions"))), "slice").mapInArrow(merge, "slice int, bits binary")
    merged = written(parts, "filter")
    out = bytearray((1 << bits) // 8)
    for row in merged.collect():
        out[row.slice << (SLICE_BITS - 3) : (row.slice + 1) << (SLICE_BITS - 3)] = row.bits
    forget(merged)
    return bytes(out)
