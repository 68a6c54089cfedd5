"""SimHash near-dedup: fingerprints of word shingles, linked by a self-join of their binary trie."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import forget, join_spread, portions, small_batches, without, written

BITS = 64
MOST_IN_NODE = 256  # fingerprints below a trie node that one task joins; larger nodes are refined


def fingerprint(text: bytes | None, width: int) -> int:
    """Bits set in over half of the hashes of a text's shingles; 0 without words."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    if len(words) <= width:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(width))))
    hashes = np.fromiter((xxhash.xxh64_intdigest(s, 42) for s in shingles), dtype="<u8")
    ones = np.zeros(BITS, np.int64)
    for s in range(0, len(hashes), 1 << 14):
        part = hashes[s : s + (1 << 14)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, width: int = 3) -> DataFrame:
    """doc_id and fp, the fingerprint as a signed 64-bit integer."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches):
            fp = np.array([fingerprint(t, width) for t in batch.column("text").to_pylist()], dtype=np.uint64)
            yield pa.record_batch([batch.column("doc_id"), pa.array(fp.view(np.int64))], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")).mapInArrow(run, "doc_id long, fp long")


def _parts(bits: list[int], n: int) -> list[list[int]]:
    """bits in n runs of nearly the same length."""
    return [bits[len(bits) * i // n : len(bits) * (i + 1) // n] for i in range(n)]


def _mask(bits: list[int]) -> int:
    m = sum(1 << b for b in bits)
    return m - (1 << 64) if m >> 63 else m


def trie_pairs(fp: np.ndarray, begin: np.ndarray, end: np.ndarray, budget: int, other: tuple[np.ndarray, np.ndarray] | None = None, leaf: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of positions in fp (unsigned, sorted within each range) that differ in at most budget bits: of the same range,
    or, if other has the begins and ends of further ranges, one of a range and one of the other range.

    Pairs of trie nodes are traversed together, level by level. A pair of nodes stands for two ranges of the sorted
    fingerprints; its children get one more differing bit where they part, and are dropped beyond the budget. Nodes
    that stand for leaf pairs or fewer are compared as they are, as are those of equal fingerprints at the end.
    """
    a0, a1, b0, b1 = begin, end, *(other or (begin, end))
    spent = np.zeros(len(begin), np.int64)
    left: list[np.ndarray] = []
    right: list[np.ndarray] = []
    for level in range(BITS - 1, -2, -1):  # below bit 0 nothing is split, but what its split has made is taken
        take = ((a1 - a0) * (b1 - b0) <= leaf) | (level < 0)
        if take.any():
            width = (b1 - b0)[take]
            size = (a1 - a0)[take] * width
            node = np.repeat(np.arange(len(size)), size)
            step = np.arange(len(node)) - (np.cumsum(size) - size)[node]
            i, j = a0[take][node] + step // width[node], b0[take][node] + step % width[node]
            near = (np.bitwise_count(fp[i] ^ fp[j]) <= budget) & ((a0 != b0)[take][node] | (i < j))
            left.append(i[near])
            right.append(j[near])
            a0, a1, b0, b1, spent = (x[~take] for x in (a0, a1, b0, b1, spent))
        if not len(a0) or level < 0:
            break
        ones = np.r_[0, np.cumsum((fp >> np.uint64(level)).astype(np.int64) & 1)]
        am, bm = a1 - (ones[a1] - ones[a0]), b1 - (ones[b1] - ones[b0])
        same = a0 == b0
        both = [
            (a0, am, b0, bm, spent, slice(None)),
            (am, a1, bm, b1, spent, slice(None)),
            (a0, am, bm, b1, spent + 1, slice(None)),
            (am, a1, b0, bm, spent + 1, ~same),
        ]
        nodes = [tuple(x[pick] for x in parts) for *parts, pick in both]
        a0, a1, b0, b1, spent = (np.concatenate([n[k] for n in nodes]) for k in range(5))
        live = (a0 < a1) & (b0 < b1) & (spent <= budget) & ~((a0 == b0) & (a1 - a0 == 1))
        a0, a1, b0, b1, spent = (x[live] for x in (a0, a1, b0, b1, spent))
    return np.concatenate(left or [np.zeros(0, np.int64)]), np.concatenate(right or [np.zeros(0, np.int64)])


def lowest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each of n nodes, the lowest one that the links i - j lead to."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, label[i], low)
        np.minimum.at(new, label[j], low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def near_links(classes: DataFrame, budget: int = 2) -> DataFrame:
    """Links (a, b), a > b, between the ids of fingerprints that differ in at most budget bits, enough to connect all of them.

    classes: id and fp, each fp once. Fingerprints within the budget agree in one of budget + 1 runs of bits, so
    each trie node below such a run (taken as the trie's first bits) is joined with itself, in one task. Nodes with
    more than MOST_IN_NODE fingerprints are refined: their other bits are cut into runs again, until so few bits
    are left that a node can't hold more. So no task gets a group that grows with the data, and within a node only
    links that connect are sent.
    """
    spark = classes.sparkSession
    runs = budget + 1
    rest = {0: list(range(BITS - 1, -1, -1))}  # bits that a path of the trie leaves open
    level = classes.select("id", "fp", F.lit(0).alias("path"))
    ready: list[DataFrame] = []
    while True:
        masks, nxt = [], {}
        for path, open_ in rest.items():
            fixed = [b for b in range(BITS) if b not in open_]
            for k, part in enumerate(_parts(open_, runs)):
                new = path * runs + k + 1
                nxt[new] = [b for b in open_ if b not in part]
                masks.append((path, new, _mask(fixed + part)))
        split = spark.createDataFrame(masks, "path int, new int, mask long")
        level = level.join(F.broadcast(split), "path").select("id", "fp", F.col("new").alias("path"), F.col("fp").bitwiseAND(F.col("mask")).alias("node"))
        rest = nxt
        if all(1 << len(open_) <= 4 * MOST_IN_NODE for open_ in rest.values()):
            ready.append(level)
            break
        large = written(level.groupBy("path", "node").count().where(F.col("count") > MOST_IN_NODE).select("path", "node"), "large-nodes")
        if large.isEmpty():
            ready.append(level)
            break
        ready.append(level.join(large, ["path", "node"], "left_anti"))
        level = written(level.join(large, ["path", "node"], "left_semi").select("id", "fp", "path"), "refined-nodes")
    nodes = ready[0]
    for more in ready[1:]:
        nodes = nodes.unionByName(more)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def joined(rows: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            path, node, fp, ids = rows
            if not len(path):
                return
            cuts = np.flatnonzero(np.r_[True, (path[1:] != path[:-1]) | (node[1:] != node[:-1]), True])
            begin, end = cuts[:-1], cuts[1:]
            many = end - begin > 1
            fp = fp.view(np.uint64)
            order = np.lexsort((fp, node, path))
            i, j = trie_pairs(fp[order], begin[many], end[many], budget)
            if len(i):
                by_id = np.argsort(ids[order], kind="stable")  # the lowest node is the one with the lowest id
                at = np.empty(len(ids), np.int64)
                at[by_id] = np.arange(len(ids))
                sorted_ids = ids[order][by_id]
                # an id is once in each trie node, so its places are kept apart by node
                root = lowest(len(ids), at[i], at[j])
                own = np.flatnonzero(root != np.arange(len(ids)))
                a, b = sorted_ids[own], sorted_ids[root[own]]
                yield pa.record_batch([pa.array(a[a != b]), pa.array(b[a != b])], ["a", "b"])

        rows = [np.zeros(0, np.int64)] * 4
        for batch in batches:
            new = [batch.column(c).to_numpy().astype(np.int64) for c in ("path", "node", "fp", "id")]
            rows = [np.concatenate([x, y]) for x, y in zip(rows, new)]
            if len(rows[0]) >= 100_000:
                change = np.flatnonzero((rows[0][1:] != rows[0][:-1]) | (rows[1][1:] != rows[1][:-1]))
                if len(change):
                    cut = int(change[-1]) + 1
                    yield from joined([x[:cut] for x in rows])
                    rows = [x[cut:] for x in rows]
        yield from joined(rows)

    return nodes.select("path", "node", "fp", "id").repartition("path", "node").sortWithinPartitions("path", "node").mapInArrow(run, "a long, b long").distinct()


def _total(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.col("a").cast("decimal(38,0)")), F.sum(F.col("b").cast("decimal(38,0)")), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """id and root, the lowest id that links (a, b) lead to, for each id that has links.

    Alternates between linking each id's higher neighbours, then its lower ones, to the lowest of them, until
    nothing changes. Each round is written, so that lineage stays short and lost executors cost one round.
    """
    links = written(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct(), "links")
    before = None
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = written(both.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("n")).select("a", F.least("a", "m").alias("m"), "n"), "lowest")
        upper = join_spread(both.where("b > a"), low, "a", "n", ["b"]).select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()
        upper = written(upper, "links")
        forget(links)
        forget(low)
        low = written(upper.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("n")), "lowest")
        lower = join_spread(upper, low, "a", "n", ["b"]).select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("x")).select("x.a", "x.b")
        links = written(lower.where("a != b").distinct(), "links")
        forget(upper)
        forget(low)
        now = _total(links)
        if now == before:
            return links.select(F.col("a").alias("id"), F.col("b").alias("root")).unionByName(links.select(F.col("b").alias("id"), F.col("b").alias("root")).distinct())
        before = now


def near_duplicates(docs: DataFrame, width: int = 3, budget: int = 2) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id, the lowest doc_id of the documents that links lead to.

    docs needs doc_id and text. Fingerprints link at budget or fewer differing bits; texts without words (null and
    empty ones too) have fingerprint 0 and link like others. Repeated rows give repeated rows. Rows whose doc_id is
    null take the component of documents with the same fingerprint and link nothing else: null if there is none.
    An empty table gives no rows. Equal fingerprints are one class before anything is joined, so groups of copies
    cost one row each, and their documents are dealt over several tasks where they get their component.
    """
    each = written(fingerprints(docs, width), "fingerprints")
    classes = written(each.groupBy("fp").agg(F.min("doc_id").alias("id"), F.count(F.lit(1)).alias("n")).where(F.col("id").isNotNull()), "classes")
    roots = components(near_links(classes.select("id", "fp"), budget))
    named = written(classes.join(roots, "id", "left").select("fp", "n", F.coalesce("root", "id").alias("component_id")), "components")
    forget(classes)
    return join_spread(each, named, "fp", "n", ["doc_id"], "left").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, width: int = 3, budget: int = 2) -> DataFrame:
    """The rows of docs whose document has the lowest doc_id of its component, each doc_id once; columns stay as they are.

    Rows whose doc_id is null can't be told apart by it and stay. Of several rows of a doc_id the one with the lowest
    text stays.
    """
    near = written(near_duplicates(docs, width, budget).select("doc_id", "component_id"), "near")
    return without(docs, near.where(F.col("doc_id") != F.col("component_id")).select("doc_id").distinct(), near)
