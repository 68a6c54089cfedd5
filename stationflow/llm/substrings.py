"""Suffix-array dedup: long strings that start more than once are removed.

Windows of `width` bytes can only be equal if the smallest hash of the q-grams in them is equal too. Each text is cut
into slices, runs of windows with one smallest hash; slices whose hash was seen once can't repeat and stay where
they are. The others meet by that hash, and within it their suffixes are sorted by bucket-pointer refinement: first
into buckets by q-gram, then each bucket by the bucket pointers of later offsets, whose updates the next round
reuses, until buckets agree over the whole width. Windows whose bucket has company are repeated. A hash with too many
slices for one task is refined by Spark: its suffixes are shuffled by the bucket of their first half and that of the
offset where the second half begins.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import TwiceFilter, filter_bits, forget, join_spread, mix64, portions, seen_twice, small_batches, written

WIDTH = 200
BUCKETS = ("h0", "h1", "h2", "h3")  # the two buckets of a suffix
GRAM = 96  # bytes of the q-grams whose smallest hash routes a window
MOST_WINDOWS = 512  # windows of a slice
MOST_SLICES = 1000  # different slices of a smallest hash that one task sorts; those of more are refined over several tasks
STRETCH = 512 << 10  # bytes of slices that are sorted at once


def _words(data: bytes) -> np.ndarray:
    """The 8 bytes from each position on, as integers."""
    n = len(data) - 7
    out = np.empty(n, np.uint64)
    for k in range(min(8, n)):
        own = out[k::8]
        own[:] = np.frombuffer(data, "<u8", count=len(own), offset=k)
    return out


def slices(data: bytes, width: int = WIDTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First window, number of windows and smallest hash of each slice of a text, and whether the text has that hash again."""
    n = len(data) - width + 1
    if n <= 0:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0, np.uint64), np.zeros(0, bool)
    h, size = _words(data), 8
    with np.errstate(over="ignore"):
        for times in (2, 2, 3):  # 8, 16, 32, 96 bytes
            m = len(h) - size * (times - 1)
            new = h[:m] * np.uint64(0x9E3779B97F4A7C15)
            for t in range(1, times):
                new ^= new >> np.uint64(29)
                new = (new + h[t * size : t * size + m]) * np.uint64(0xBF58476D1CE4E5B9)
            h, size = new ^ (new >> np.uint64(32)), size * times
        h = mix64(h)
    span = width - gram + 1
    pad = -len(h) % span
    grid = np.concatenate([h, np.full(pad, np.uint64(2**64 - 1))]).reshape(-1, span)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    low = np.minimum(back[:n], ahead[span - 1 : span - 1 + n])
    begin = np.r_[0, np.flatnonzero(low[1:] != low[:-1]) + 1]
    few = np.sort(h[h <= low[begin].max()])
    twice = few[1:][few[1:] == few[:-1]]
    count = np.diff(np.r_[begin, n])
    if count.max() > MOST_WINDOWS:
        parts = -(-count // MOST_WINDOWS)
        rank = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        first, whole = np.repeat(begin, parts), np.repeat(count, parts)
        begin, count = first + rank * MOST_WINDOWS, np.minimum(MOST_WINDOWS, whole - rank * MOST_WINDOWS)
    return begin, count, low[begin], np.isin(low[begin], twice)


def repeated_windows(parts: list[bytes], width: int = WIDTH) -> list[np.ndarray]:
    """For each part, which of its windows of width bytes start more than once in all parts: bucket-pointer refinement."""
    size = np.fromiter(map(len, parts), dtype=np.int32, count=len(parts))
    first = np.cumsum(size, dtype=np.int32) - size
    end = np.repeat(first + size, size)  # where the part of each position ends
    n = len(end)
    gram = 8
    bucket = -1 - np.arange(n, dtype=np.int32)  # pointers of suffixes that are alone; those of a bucket get its first place
    active = np.flatnonzero(np.arange(n, dtype=np.int32) + gram <= end).astype(np.int32)
    if len(active):
        active = _refined(bucket, active, _words(b"".join(parts))[active])
    depth = gram
    while depth < width and len(active):
        step = min(depth, width - depth)
        fits = active + (depth + step) <= end[active]
        short, active = active[~fits], active[fits]
        if not len(active):
            break
        # a bucket's pointer and that of the later offset, as one key
        pair = bucket[active].astype(np.int64) << 32
        pair |= bucket[active + step].astype(np.int64) & 0xFFFFFFFF
        bucket[short] = -1 - short
        active = _refined(bucket, active, pair)
        depth += step
    flag = np.zeros(n, bool)
    flag[active] = True
    return [flag[a : a + max(0, s - width + 1)] for a, s in zip(first.tolist(), size.tolist())]


def _refined(bucket: np.ndarray, active: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Gives each run of equal keys its bucket pointer; returns the places that still have company."""
    order = np.argsort(key, kind="stable")
    at, key = active[order], key[order]
    start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    del key, order
    count = np.diff(np.r_[start, len(at)])
    many = np.repeat(count > 1, count)
    bucket[at] = np.where(many, np.repeat(at[start], count), -1 - at)
    return at[many]


def halves(data: bytes, width: int) -> np.ndarray:
    """The buckets of each window: digests of its first half, and of the offset where its second half begins; both 128 bits."""
    half = -(-width // 2)
    digests = b"".join(xxhash.xxh3_128_digest(data[i : i + half]) for i in range(len(data) - half + 1))
    each = np.frombuffer(digests, "<i8").reshape(-1, 2)
    n = len(data) - width + 1
    return np.concatenate([each[:n], each[width - half : width - half + n]], axis=1)


def remove_repeats(docs: DataFrame, width: int = WIDTH, with_kept: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of each document, and kept (binary) if asked for.

    Texts are bytes of UTF-8; null and empty ones have none. Each byte of a window of `width` bytes that also starts
    anywhere else in the table, in the same text too, is removed; windows are judged on the input. Repeated rows are
    different places. An empty table gives no rows. width may be GRAM or more.

    A first pass finds the smallest hashes that may have been seen twice, by a filter whose size follows from the
    bytes of text, up to a bound of what is broadcast; a fuller filter only lets more slices through. Equal slices meet
    by digest, in counts that are summed before they are shuffled: each of them stands for equal suffixes, so one goes
    on. Different slices of a hash are sorted in one task if they are MOST_SLICES or fewer; the suffixes of more are
    dealt by their buckets, as halves() has them. What many texts share is dealt over several tasks where it is joined.
    """
    if width < GRAM:
        raise ValueError(f"width must be {GRAM} or more")
    spark = docs.sparkSession
    small_batches(spark)
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    long = base.where(F.length("text") >= width).withColumn("text_id", F.unhex(F.md5("text")))
    windows = long.agg(F.sum(F.length("text") - width + 1).alias("n")).first().n or 0
    bits = filter_bits(2 * windows // (width - GRAM + 2))  # smallest hashes change about so often

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches):
            each = (slices(t or b"", width) for t in batch.column("text").to_pylist())
            yield pa.record_batch([pa.array([np.concatenate([low, low[again]]).tobytes() for _, _, low, again in each], pa.binary())], ["h"])

    twice = spark.sparkContext.broadcast(seen_twice(long.select("text"), bits, hashed))

    def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = TwiceFilter(twice.value, bits)
        for batch in portions(batches):
            node, start, count, key, text_id, data = [], [], [], [], [], []
            for t, text in zip(batch.column("text_id").to_pylist(), batch.column("text").to_pylist()):
                begin, n, low, _ = slices(text, width)
                yes = np.flatnonzero(seen.suspects(low))
                node.append(low[yes].view(np.int64))
                start.append(begin[yes])
                count.append(n[yes])
                own = [text[a : a + k + width - 1] for a, k in zip(begin[yes].tolist(), n[yes].tolist())]
                data += own
                key += map(xxhash.xxh3_128_digest, own)
                text_id += [t] * len(own)
            if data:
                yield pa.record_batch(
                    [pa.array(np.concatenate(node)), pa.array(np.concatenate(start).astype(np.int32)), pa.array(np.concatenate(count).astype(np.int32)), pa.array(key, pa.binary()), pa.array(text_id, pa.binary()), pa.array(data, pa.binary())],
                    ["node", "start", "n", "key", "text_id", "data"],
                )

    table = written(long.select("text_id", "text").mapInArrow(sliced, "node long, start int, n int, key binary, text_id binary, data binary"), "slices")
    different = written(table.groupBy("key").agg(F.count(F.lit(1)).alias("times"), F.first("node").alias("node"), F.first("data").alias("data")), "different-slices")
    per_node = different.groupBy("node").count()
    large = written(per_node.where(F.col("count") > MOST_SLICES).select("node"), "large-nodes")

    def sort_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of a node come one after another; nodes are sorted together in stretches of about STRETCH bytes."""

        def done(held: list[tuple]) -> Iterator[pa.RecordBatch]:
            flags = repeated_windows([d for _, _, _, d in held], width)
            out = [(k, np.packbits(f).tobytes()) for (_, k, times, _), f in zip(held, flags) if times == 1 and f.any()]
            if out:
                yield pa.record_batch([pa.array(c, pa.binary()) for c in zip(*out)], ["key", "mask"])

        held: list[tuple] = []
        group: list[tuple] = []
        size = 0
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("node", "key", "times", "data"))):
                if group and group[0][0] != row[0]:
                    if any(g[2] == 1 for g in group):
                        held += group
                        size += sum(len(g[3]) for g in group)
                    group = []
                    if size >= STRETCH:
                        yield from done(held)
                        held, size = [], 0
                group.append(row)
        held += group
        if held:
            yield from done(held)

    few = different.join(large, "node", "left_anti").repartition("node").sortWithinPartitions("node").select("node", "key", "times", "data")
    masks = few.mapInArrow(sort_slices, "key binary, mask binary")

    if not large.isEmpty():
        crowd = different.join(large, "node", "left_semi")

        def bucketed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for key, times, data in zip(*(batch.column(c).to_pylist() for c in ("key", "times", "data"))):
                    d = halves(data, width)
                    n = len(d)
                    yield pa.record_batch([*(pa.array(np.ascontiguousarray(d[:, k])) for k in range(4)), pa.array([key] * n, pa.binary()), pa.array(np.arange(n, dtype=np.int32)), pa.array(np.full(n, times, np.int64))], [*BUCKETS, "key", "at", "times"])

        each = written(crowd.select("key", "times", "data").mapInArrow(bucketed, ", ".join(f"{b} long" for b in BUCKETS) + ", key binary, at int, times long").withColumn("bucket", F.struct(*BUCKETS)).drop(*BUCKETS), "suffixes")
        again = written(each.groupBy("bucket").agg(F.count(F.lit(1)).alias("c")).where("c > 1"), "repeated-suffixes")

        def masked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                out = []
                for key, at in zip(batch.column("key").to_pylist(), batch.column("ats").to_pylist()):
                    f = np.zeros(max(at) + 1, np.uint8)
                    f[at] = 1
                    out.append((key, np.packbits(f).tobytes()))
                if out:
                    yield pa.record_batch([pa.array(c, pa.binary()) for c in zip(*out)], ["key", "mask"])

        found = join_spread(each.where("times = 1"), again, "bucket", "c", ["key", "at"]).groupBy("key").agg(F.collect_list("at").alias("ats"))
        masks = masks.unionByName(found.mapInArrow(masked, "key binary, mask binary"))

    whole = different.where("times > 1").select("key", F.lit(None).cast("binary").alias("mask"))
    marks = whole.unionByName(masks).join(different.select("key", "times"), "key")
    marks = written(marks, "marks")
    # copies of a text have the same slices, and one of them is joined; a slice may be at several places of a text
    held = table.groupBy("key", "text_id", "start", "n").agg(F.count(F.lit(1)).alias("copies"))
    places = join_spread(held, marks, "key", "times", ["text_id", "start"])
    # no more than the text has slices
    places = written(places.groupBy("text_id").agg(F.collect_list(F.struct("start", "n", "mask")).alias("marks"), F.max("copies").alias("copies")), "places")
    for done in (table, different, large):
        forget(done)
    joined = join_spread(long, places, "text_id", "copies", ["doc_id"], "left", 5000).select("doc_id", "text", "marks")
    short = base.where(F.coalesce(F.length("text"), F.lit(0)) < width).select("doc_id", "text", F.lit(None).cast(joined.schema["marks"].dataType).alias("marks"))
    joined = joined.unionByName(short)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches):
            rows = []
            for doc, text, own in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "marks"))):
                text = text or b""
                kept, removed, spans = text, 0, 0
                if own:
                    delta = np.zeros(len(text) + 1, np.int64)
                    for m in own:
                        at = np.arange(m["start"], m["start"] + m["n"])
                        if m["mask"] is not None:
                            bits = np.unpackbits(np.frombuffer(m["mask"], np.uint8))[: m["n"]]
                            at = m["start"] + np.flatnonzero(bits)
                        np.add.at(delta, at, 1)
                        np.add.at(delta, at + width, -1)
                    gone = np.cumsum(delta[:-1]) > 0
                    removed = int(gone.sum())
                    spans = int((gone[1:] & ~gone[:-1]).sum() + gone[0])
                    kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
                rows.append((doc, len(text), removed, spans, hashlib.sha256(kept).hexdigest(), kept if with_kept else None))
            cols = list(zip(*rows)) or [()] * 6
            types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, types)], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    out = joined.mapInArrow(cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    return out if with_kept else out.drop("kept")
