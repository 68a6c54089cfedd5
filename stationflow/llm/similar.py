"""Near-dedup by the similarity of word shingles: SimHash fingerprints, whose trie self-join is dealt by MinHash bands.

Pairs of a Jaccard similarity of 0.8 differ in some ten of 64 bits, too many to deal the trie's nodes by equal runs of
bits. So the tries are dealt by bands of MinHash values, and every pair comes out of the tries' cross-join, with a
Hamming budget and a sketch, before it is confirmed exactly: first of the members of bands with the most connected one
of each, then of what this leaves apart with the whole band.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import forget, join_spread, mix64, of_ids, portions, small_batches, without, written
from .simhash import BITS, components, trie_pairs

BANDS, ROWS = 40, 4  # a pair of similarity s has no band in common with probability (1 - s ** ROWS) ** BANDS: 7e-10 at 0.8
BUDGET = 24  # differing bits of a candidate: a pair of similarity 0.8 has 9.7, give or take 2.9
CENTRE_BUDGET = 32  # the same for a band's centre, which costs a pair a member: texts of five shingles differ in 12 bits, give or take 3.1
SKETCH = 128  # first bytes of a sketch, one of each of so many MinHash values
BINS_LOG = 9  # further bytes: one for each of 2 ** BINS_LOG ranges of hashes, of the lowest hash in it; 0 if there is none
SIGMAS = 5.5  # how far below its mean a candidate's share of equal bytes may be: a link is lost with probability 2e-8
DEAL = 20_000  # members of a band that one task looks through
CELLS = 1 << 18  # pairs of members whose tries are traversed at once
LEAF = 1 << 12  # pairs of two trie nodes that are compared without going further down
FIRST = 8  # nearest documents of other components that are confirmed before all others, for each document
_SEEDS = mix64(np.arange(1, 2 * BANDS * ROWS + 1))
_FLIP, _ODD = _SEEDS[::2], _SEEDS[1::2] | np.uint64(1)


def shingles(text: bytes | None, width: int) -> np.ndarray:
    """Distinct hashes of a text's runs of width words, sorted; a shorter text is one run, and one without words has none."""
    words = (text or b"").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    runs = [b" ".join(words)] if len(words) <= width else map(b" ".join, zip(*(words[i:] for i in range(width))))
    return np.unique(np.fromiter((xxhash.xxh64_intdigest(s, 42) for s in runs), dtype=np.uint64))


def fingerprint_of(s: np.ndarray) -> int:
    """Bits set in over half of the distinct hashes."""
    ones = np.zeros(BITS, np.int64)
    for i in range(0, len(s), 1 << 14):
        ones += np.unpackbits(s[i : i + (1 << 14)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(s), bitorder="little").view("<i8")[0])


def summary(s: np.ndarray) -> tuple[np.ndarray, bytes]:
    """A key for each band of ROWS minima of s (equal keys of two texts mean equal minima of the same band), and the sketch."""
    low = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(s), 512):
        low = np.minimum(low, ((s[i : i + 512, None] ^ _FLIP) * _ODD).min(axis=0))
    key = np.arange(BANDS, dtype=np.uint64)
    for column in low.reshape(BANDS, ROWS).T:
        key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + column)
    bins = (s >> np.uint64(64 - BINS_LOG)).astype(np.int64)
    first = np.flatnonzero(np.r_[True, bins[1:] != bins[:-1]])
    lowest_of = np.zeros(1 << BINS_LOG, np.uint8)
    lowest_of[bins[first]] = mix64(s[first]) % np.uint64(255) + np.uint64(1)
    return key.view(np.int64), mix64(low[:SKETCH]).astype(np.uint8).tobytes() + lowest_of.tobytes() + np.uint32(len(s)).tobytes()


def near_sketches(x: np.ndarray, y: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """For rows of sketches x and y: whether sets of a similarity of least may have them, and the share of equal bins.

    A MinHash value is equal with the probability of the sets' similarity. Of the elements of both sets, the lowest
    ones of the bins are a random subset, so that the equal ones among them are distributed hypergeometrically: the
    more of the elements have a bin of their own, the closer is their share to the similarity.
    """
    sizes = [z[:, -4:].copy().view("<u4")[:, 0].astype(float) for z in (x, y)]
    ok = np.minimum(*sizes) >= least * np.maximum(*sizes)
    spread = SIGMAS * np.sqrt(least * (1 - least))
    at = np.flatnonzero(ok)
    ok[at] = (x[at, :SKETCH] == y[at, :SKETCH]).sum(axis=1) >= least * SKETCH - spread * np.sqrt(SKETCH)
    share = np.zeros(len(x))
    at = np.flatnonzero(ok)  # most pairs are told apart before their bins are read
    p, q = x[at, SKETCH:-4], y[at, SKETCH:-4]
    filled = ((p | q) != 0).sum(axis=1)
    same = ((p == q) & (p != 0)).sum(axis=1)
    most = (sizes[0] + sizes[1])[at] / (1 + least)  # elements of both sets, if they are similar
    left = np.clip((most - filled) / np.maximum(most - 1, 1), 0, 1)
    ok[at] = same >= least * filled - spread * np.sqrt(filled * left) - 1
    share[at] = same / np.maximum(filled, 1)
    return ok, share


def _summaries(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, digest of its shingles, fp, sketch and band keys (none without words)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches):
            sets = [shingles(t, width) for t in batch.column("text").to_pylist()]
            digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
            told = [summary(s) if len(s) else ([], None) for s in sets]
            cols = [batch.column("doc_id"), pa.array(digests, pa.binary()), pa.array([fingerprint_of(s) if len(s) else 0 for s in sets], pa.int64())]
            yield pa.record_batch([*cols, pa.array([x for _, x in told], pa.binary()), pa.array([k for k, _ in told], pa.list_(pa.int64()))], ["doc_id", "digest", "fp", "sketch", "keys"])

    return docs.mapInArrow(run, "doc_id long, digest binary, fp long, sketch binary, keys array<long>")


def confirmed(texts: DataFrame, pairs: DataFrame, width: int, least: float) -> DataFrame:
    """Those of the written pairs (a, b) whose exact similarity is least or more; texts: doc_id and text."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches):
            yield pa.record_batch([batch.column("doc_id"), pa.array([shingles(t, width).tobytes() for t in batch.column("text").to_pylist()], pa.binary())], ["doc_id", "s"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yes = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                yes.append(both >= least * (len(x) + len(y) - both))
            yield pa.record_batch([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(yes, pa.bool_()))

    wanted = written(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "wanted")
    held = written(of_ids(texts, wanted, "left_semi").dropDuplicates(["doc_id"]).mapInArrow(sets, "doc_id long, s binary"), "shingles")
    hubs = written(pairs.groupBy("b").agg(F.count(F.lit(1)).alias("n")), "hubs")
    left = pairs.join(held.select(F.col("doc_id").alias("a"), F.col("s").alias("x")), "a")
    right = held.select(F.col("doc_id").alias("b"), F.col("s").alias("y")).join(hubs, "b")
    out = written(join_spread(left, right, "b", "n", ["a"], most=5000).select("a", "b", "x", "y").mapInArrow(compare, "a long, b long"), "similar")
    for done in (wanted, held, hubs):
        forget(done)
    return out


def similar_roots(texts: DataFrame, classes: DataFrame, width: int, least: float) -> DataFrame:
    """id and root, the lowest id that links of similarity least or more lead to, for each id that has links.

    classes: id, fp, sketch and keys. A band's centre is its member with the most company in its bands. The tries of
    each centre and of the members of its bands are joined, so that a group of copies costs a row each, and the pairs
    whose sketches agree enough are confirmed. Members that are in another
    component than their band's centre are then joined with all others of the band (the tries of both are traversed
    together with a Hamming budget; a band of many is dealt over tasks), and pairs of other components whose sketches
    agree enough are confirmed: the FIRST nearest of each id, then, looked for again, those that are still apart and
    weren't tried before. So only what the first ones leave apart is listed in pairs. Components of components are found among the new links only.
    """
    rows = classes.select("id", F.explode("keys").alias("key"))
    shared = written(rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "bands")
    members = written(join_spread(rows, shared.withColumn("size", F.col("n")), "key", "n", ["id"]), "members")
    forget(shared)
    degree = members.groupBy("id").agg(F.sum("size").alias("degree"))
    placed = members.join(degree, "id")
    centres = placed.groupBy("key").agg(F.max(F.struct("degree", (-F.col("id")).alias("id"))).alias("m"), F.count(F.lit(1)).alias("n")).select("key", (-F.col("m.id")).alias("centre"), "n")
    centres = written(centres, "centres")
    centred = written(join_spread(members, centres, "key", "n", ["id"]), "centred")
    for done in (members, centres):
        forget(done)
    seen = written(_with_centres(centred.where("id != centre").select(F.col("id").alias("a"), F.col("centre").alias("b")).distinct(), classes, least), "stars")
    roots = written(components(confirmed(texts, seen, width, least)), "roots")
    tried = seen
    for most in (FIRST, None):
        due = _nearest(_bands_apart(centred, roots), classes, least, most)
        due = written(due.join(tried, ["a", "b"], "left_anti"), "due")
        if due.isEmpty():
            continue
        more = confirmed(texts, due, width, least)
        tried = tried.unionByName(due)
        if not more.isEmpty():
            roots = _merged(roots, more)
    for done in (centred, seen):
        forget(done)
    return roots


def _bands_apart(centred: DataFrame, roots: DataFrame) -> DataFrame:
    """The members of bands of which one at least is in another component than its centre: out of those, n_out of each band."""
    named = centred.join(roots, "id", "left").select("key", "id", "size", "centre", F.coalesce("root", "id").alias("root"))
    named = named.join(roots.select(F.col("id").alias("centre"), F.col("root").alias("centre_root")), "centre", "left").withColumn("out", F.col("root") != F.coalesce("centre_root", "centre"))
    named = written(named.select("key", "id", "size", "root", "out"), "named")
    apart = written(named.where("out").groupBy("key").agg(F.count(F.lit(1)).alias("n_out")), "bands-apart")
    out = written(named.join(apart, "key"), "members-apart")
    for done in (named, apart):
        forget(done)
    return out


def _with_centres(stars: DataFrame, classes: DataFrame, least: float) -> DataFrame:
    """Those of the pairs (a, b) of members and centres that the tries' join finds and whose sketches agree enough."""
    stars = written(stars, "members-of-centres")
    told = classes.select("id", "fp", "sketch")
    hubs = written(stars.groupBy("b").agg(F.count(F.lit(1)).alias("n")).join(told.toDF("b", "fp_b", "sketch_b"), "b"), "centres-of-members")
    rows = join_spread(stars.join(told.withColumnRenamed("id", "a"), "a"), hubs, "b", "n", ["a"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = len(batch)
            if not m:
                continue
            a, b = (batch.column(c).to_numpy().astype(np.int64) for c in ("a", "b"))
            fp, fp_b = (batch.column(c).to_numpy().astype(np.int64).view(np.uint64) for c in ("fp", "fp_b"))
            sketch, sketch_b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(m, -1) for c in ("sketch", "sketch_b"))
            by = np.lexsort((fp, b))  # a centre's members are one range, sorted
            begin = np.flatnonzero(np.r_[True, b[by][1:] != b[by][:-1]])
            end, centre = np.r_[begin[1:], m], m + np.arange(len(begin))
            i, j = trie_pairs(np.r_[fp[by], fp_b[by[begin]]], begin, end, CENTRE_BUDGET, (centre, centre + 1), LEAF)
            at = by[i]
            at = at[near_sketches(sketch[at], sketch_b[by[begin]][j - m], least)[0]]
            yield pa.record_batch([pa.array(a[at]), pa.array(b[at])], ["a", "b"])

    out = written(rows.select("a", "b", "fp", "sketch", "fp_b", "sketch_b").mapInArrow(run, "a long, b long"), "with-centres")
    for done in (stars, hubs):
        forget(done)
    return out


def _merged(roots: DataFrame, more: DataFrame) -> DataFrame:
    """roots (id, root) after further links (a, b), some of whose ids may have had none."""
    named = roots.select(F.col("id").alias("a"), F.col("root").alias("x"))
    between = more.join(named, "a", "left").join(named.select(F.col("a").alias("b"), F.col("x").alias("y")), "b", "left")
    above = written(components(between.select(F.coalesce("x", "a").alias("a"), F.coalesce("y", "b").alias("b"))), "roots-of-roots")
    every = roots.unionByName(above.join(roots, "id", "left_anti").select("id", F.col("id").alias("root")))
    sizes = every.groupBy("root").agg(F.count(F.lit(1)).alias("n"))
    lead = written(above.select(F.col("id").alias("root"), F.col("root").alias("new")).join(sizes, "root"), "sized-roots")
    out = written(join_spread(every, lead, "root", "n", ["id"], "left").select("id", F.coalesce("new", "root").alias("root")), "roots")
    for done in (above, lead):
        forget(done)
    return out


def _nearest(named: DataFrame, classes: DataFrame, least: float, most: int | None = None) -> DataFrame:
    """Candidates (a, b) of other components within each band; with most, those where b is among so many nearest of a, or a of b, in one."""
    deals = F.ceil(F.col("size") / DEAL).cast("int")
    told = named.join(classes.select("id", "fp", "sketch"), "id")
    as_y = told.withColumn("deal", F.pmod(F.xxhash64("id"), deals).cast("int"))
    as_x = told.where("out").withColumn("deal", F.explode(F.sequence(F.lit(0), deals - 1)))
    cols = ["key", "deal", "id", "root", "fp", "sketch", "out"]
    both = as_y.select(*cols, F.lit(False).alias("x")).unionByName(as_x.select(*cols, F.lit(True).alias("x")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def joined(group: list[tuple]) -> Iterator[pa.RecordBatch]:
            ids, root, fp = (np.array([g[k] for g in group], np.int64) for k in (0, 1, 2))
            sketch = np.frombuffer(b"".join(g[3] for g in group), np.uint8).reshape(len(group), SKETCH + (1 << BINS_LOG) + 4)
            out, is_x = (np.array([g[k] for g in group], bool) for k in (4, 5))
            fp = fp.view(np.uint64)
            xs, ys = (np.flatnonzero(w)[np.argsort(fp[w], kind="stable")] for w in (is_x, ~is_x))
            wide = min(len(ys), 4096)
            for s in range(0, len(xs), max(1, CELLS // max(wide, 1))):
                part, found = xs[s : s + max(1, CELLS // max(wide, 1))], []
                for t in range(0, len(ys), wide):  # both stay sorted
                    at = np.r_[part, ys[t : t + wide]]
                    m = len(part)
                    i, j = trie_pairs(fp[at], np.array([0]), np.array([m]), BUDGET, (np.array([m]), np.array([len(at)])), LEAF)
                    i, j = at[i], at[j]
                    ok = (root[i] != root[j]) & (~out[j] | (ids[i] < ids[j]))
                    i, j = i[ok], j[ok]
                    for c in range(0, len(i), 4096):
                        u, v = i[c : c + 4096], j[c : c + 4096]
                        near, share = near_sketches(sketch[u], sketch[v], least)
                        found.append((u[near], v[near], share[near]))
                i, j, share = (np.concatenate(c) for c in zip(*found)) if found else (np.zeros(0, np.int64),) * 3
                if len(i):
                    by = np.lexsort((ids[j], -share, i))
                    i, j = i[by], j[by]
                    new = np.r_[True, i[1:] != i[:-1]]
                    rank = np.arange(len(i)) - np.maximum.accumulate(np.where(new, np.arange(len(i)), 0))
                    if most is not None:
                        i, j = i[rank < most], j[rank < most]
                    yield pa.record_batch([pa.array(np.maximum(ids[i], ids[j])), pa.array(np.minimum(ids[i], ids[j]))], ["a", "b"])

        held: list[tuple] = []
        now = None
        for batch in batches:
            for key, deal, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if (key, deal) != now:
                    if held:
                        yield from joined(held)
                    now, held = (key, deal), []
                held.append(row)
        if held:
            yield from joined(held)

    pairs = both.select(*cols, "x").repartition("key", "deal").sortWithinPartitions("key", "deal").mapInArrow(run, "a long, b long")
    return pairs.distinct()


def keep_one_similar(docs: DataFrame, width: int = 5, least: float = 0.8) -> DataFrame:
    """The rows of docs whose document has the lowest doc_id of its component, each doc_id once; columns stay as they are.

    Documents link whose sets of width-word shingles have a Jaccard similarity of least or more; those without words
    are equal. Rows whose doc_id is null can't be told apart by it and stay; of several rows of a doc_id the one with
    the lowest text stays. Documents of equal sets are one class before anything is joined.
    """
    small_batches(docs.sparkSession)
    texts = docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    each = written(_summaries(texts, width), "summaries")
    classes = each.groupBy("digest").agg(F.min("doc_id").alias("id"), F.count(F.lit(1)).alias("n"), F.first("fp").alias("fp"), F.first("sketch").alias("sketch"), F.first("keys").alias("keys"))
    classes = written(classes, "classes")
    roots = similar_roots(texts, classes, width, least)
    named = written(classes.select("digest", "id", "n").join(roots, "id", "left").select("digest", "n", F.coalesce("root", "id").alias("root")), "roots-of-classes")
    gone = join_spread(each.select("doc_id", "digest"), named, "digest", "n", ["doc_id"]).where("doc_id != root").select("doc_id").distinct()
    return without(docs, gone, each.select("doc_id"))
