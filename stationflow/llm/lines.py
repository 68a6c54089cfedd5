"""Line dedup: two Bloom filters find lines that may repeat; only those are shuffled, confirmed and resolved."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import MOST_IDS, TwiceFilter, filter_bits, forget, held_by_worker, join_spread, portions, seen_twice, small_batches, written


def keys(text: bytes | None, least: int) -> list[bytes | None]:
    """The key of each line: stripped of ASCII white space, A-Z lower-cased; None for keys of under least code points."""
    out: list[bytes | None] = []
    for line in (text or b"").split(b"\n"):
        key = line.strip().lower()
        n = len(key)
        out.append(key if n >= least and (n >= 4 * least or len(key.decode("utf-8", "replace")) >= least) else None)
    return out


MOST_SHARED = 200_000  # repeated keys that are broadcast; a worker holds some 30 MB of them


def line_dedup(docs: DataFrame, least: int = 20, least_docs: int = 3, most_shared: int = MOST_SHARED) -> DataFrame:
    """The documents without repeated lines, and n_lines, n_dropped and kept_sha256 of each.

    A line's key is the line without ASCII white space at its ends and with A-Z lower-cased. Keys of at least
    `least` code points that are in at least least_docs documents (distinct doc_id; null counts as one, and as the
    smallest) lose all their lines but those of the largest doc_id that holds them. A null or empty text is one
    empty line. Repeated rows are treated alike. docs needs doc_id and text; its other columns are returned as
    they are, but for those named n_lines, n_dropped and kept_sha256.

    The first pass sends places of key hashes, the second only the digests of suspected lines. The filters' size
    follows from the number of lines, up to a bound of what is broadcast; fuller filters suspect more lines, and all
    suspects are confirmed exactly. Up to most_shared repeated keys are broadcast, and texts stay where
    they are; more are joined with the documents that lose lines, hot keys dealt over several tasks, and texts that
    lose none stay where they are unless more than MOST_IDS documents lose lines.
    """
    spark = docs.sparkSession
    small_batches(spark)
    others = [c for c in docs.columns if c not in ("doc_id", "text", "n_lines", "n_dropped", "kept_sha256")]
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *others)
    lean = docs.select("doc_id", F.col("text").cast("binary").alias("text"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches):
            out = []
            for text in batch.column("text").to_pylist():
                own = {xxhash.xxh3_64_intdigest(k) for k in keys(text, least) if k is not None}
                out.append(np.fromiter(own, dtype=np.uint64, count=len(own)).tobytes())
            yield pa.record_batch([pa.array(out, pa.binary())], ["h"])

    lines = docs.agg(F.sum(F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1).alias("n"))
    bits = filter_bits(lines.first().n or 0)
    twice = spark.sparkContext.broadcast(seen_twice(lean.select("text"), bits, hashed))

    def suspected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once = TwiceFilter(twice.value, bits)
        for batch in portions(batches):
            found: list[tuple] = []
            each = [list({k for k in keys(t, least) if k is not None}) for t in batch.column("text").to_pylist()]
            flat = [(d, k) for d, ks in zip(batch.column("doc_id").to_pylist(), each) for k in ks]
            if flat:
                h = np.fromiter((xxhash.xxh3_64_intdigest(k) for _, k in flat), dtype=np.uint64, count=len(flat))
                found = [flat[i] for i in np.flatnonzero(once.suspects(h)).tolist()]
            yield pa.record_batch([pa.array([d for d, _ in found], pa.int64()), pa.array([xxhash.xxh3_128_digest(k) for _, k in found], pa.binary())], ["doc_id", "key"])

    # 128-bit digests stand for the keys: no two of them are equal by chance
    suspects = written(lean.mapInArrow(suspected, "doc_id long, key binary"), "suspects")
    held = suspects.groupBy("key", "doc_id").agg(F.lit(1).alias("one"))
    repeated = held.groupBy("key").agg(F.count(F.lit(1)).alias("docs"), F.max("doc_id").alias("keeper"))
    repeated = written(repeated.where(F.col("docs") >= least_docs), "repeated-lines")
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}
    names = ["doc_id", "text", *others]
    small = repeated.count() <= most_shared
    if small:
        rows = repeated.select("key", "keeper").toPandas().sort_values("key")
        held_by = spark.sparkContext.broadcast((b"".join(rows["key"]), [None if x != x else int(x) for x in rows["keeper"].tolist()]))
        joined = docs.withColumn("drops", F.lit(None).cast("array<binary>"))
    else:
        drops = join_spread(suspects, repeated, "key", "docs", ["doc_id"]).where(~F.col("doc_id").eqNullSafe(F.col("keeper"))).select("doc_id", "key")
        drops = drops.groupBy(F.col("doc_id").alias("of")).agg(F.collect_set("key").alias("drops"))  # no more than the document has lines
        drops = written(drops, "drops")
        losers = drops.select("of")
        losers = F.broadcast(losers) if losers.count() <= MOST_IDS else losers
        losing = docs.join(losers, docs.doc_id.eqNullSafe(losers.of), "left_semi")
        joined = losing.join(drops, losing.doc_id.eqNullSafe(drops.of), "left").drop("of")
        joined = joined.unionByName(docs.join(losers, docs.doc_id.eqNullSafe(losers.of), "left_anti").withColumn("drops", F.lit(None).cast("array<binary>")))

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keeper = held_by_worker((held_by.value,), _keepers) if small else {}
        for batch in portions(batches):
            rows = []
            for doc, text, gone in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "drops"))):
                lines = (text or "").encode().split(b"\n")
                left, drop = lines, set(gone or ())
                if small or drop:
                    digests = [None if k is None else xxhash.xxh3_128_digest(k) for k in keys(b"\n".join(lines), least)]
                    left = [a for a, d in zip(lines, digests) if d is None or (d not in drop and keeper.get(d, doc) == doc)]
                out = b"\n".join(left)
                rows.append((None if text is None else out.decode(), len(lines), len(lines) - len(left), hashlib.sha256(out).hexdigest()))
            cols = list(zip(*rows)) or [()] * 4
            yield pa.record_batch(
                [batch.column("doc_id"), pa.array(cols[0], pa.string()), *(batch.column(c) for c in others), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.string())],
                [*names, "n_lines", "n_dropped", "kept_sha256"],
            )

    schema = ", ".join(f"`{c}` {kinds[c]}" for c in names)
    return joined.select(*names, "drops").mapInArrow(kept, schema + ", n_lines long, n_dropped long, kept_sha256 string")


def _keepers(shared: tuple[bytes, list]) -> dict[bytes, int | None]:
    """The document that keeps each repeated key."""
    digests, ids = shared
    return {digests[16 * i : 16 * i + 16]: d for i, d in enumerate(ids)}


ORACLE = r"""
WITH lines AS (
  SELECT doc_id, i, l, translate(trim(l, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS l, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents)),
repeated AS (SELECT k, max(doc_id) AS keeper FROM lines WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (keeper <> doc_id) AS n_dropped,
       sha256(coalesce(string_agg(l, chr(10) ORDER BY i) FILTER (keeper IS NULL OR keeper = doc_id), '')) AS kept_sha256
FROM lines LEFT JOIN repeated USING (k) GROUP BY doc_id
"""
