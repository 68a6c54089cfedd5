"""Benchmark decontamination: an FM-index for each shard of documents, searched backward for the benchmark's phrases."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import forget, held_by_worker, portions, small_batches, text_bytes, written

# Bytes outside of words become spaces, A-Z become a-z; bytes of 128 and above belong to words.
WORD_BYTES = bytes(c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else c + 32 if 0x41 <= c <= 0x5A else 32 for c in range(256))
SAMPLED = 8  # every so many positions keep their place in the suffix array


def words(text: bytes | None) -> list[bytes]:
    return text.translate(WORD_BYTES).split() if text else []


def _digests(found: list[bytes]) -> np.ndarray:
    """128-bit digests, which stand for words, as rows of two integers."""
    return np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, found)), "<u8").reshape(-1, 2)


def pack_phrases(pieces: list[tuple[str, bytes]], window: int) -> tuple:
    """What is broadcast of a block of pieces (item, its words joined by spaces): digests of the distinct words in order, the pieces'
    words as numbers (1 ...) one after another, where each piece begins, its item, and the items; 4 bytes a word and 16 a distinct one.
    The distinct words themselves are there too if they are MOST_KNOWN at most."""
    pieces = sorted(pieces)
    items = sorted({i for i, _ in pieces})
    each = [w.split(b" ") for _, w in pieces]
    vocabulary = list(set(chain.from_iterable(each)))
    digests = _digests(vocabulary)
    by = np.lexsort((digests[:, 1], digests[:, 0]))
    number = dict(zip((vocabulary[i] for i in by.tolist()), range(1, len(by) + 1)))
    begin = np.cumsum([0, *map(len, each)]).astype(np.int32)
    seq = np.fromiter(map(number.__getitem__, chain.from_iterable(each)), dtype=np.int32, count=int(begin[-1]))
    at = {x: k for k, x in enumerate(items)}
    spelled = b" ".join(number) if len(by) <= MOST_KNOWN else None
    return digests[by], seq, begin, np.array([at[i] for i, _ in pieces], np.int32), items, window, spelled


class Phrases:
    """The windows of a block of the benchmark: where each ends in the pieces' words, how long it is, and its item."""

    def __init__(self, packed: tuple):
        self.digests, self.seq, begin, item, self.items, window, spelled = packed
        self.whole = spelled is not None
        self.known: dict[bytes, int] = dict(zip(spelled.split(b" "), range(1, len(self.digests) + 1))) if spelled else {}
        n = np.diff(begin).astype(np.int64)
        windows = np.maximum(1, n - window + 1)
        piece = np.repeat(np.arange(len(n)), windows)
        first = begin[piece] + np.arange(len(piece)) - np.repeat(np.cumsum(windows) - windows, windows)
        self.size = np.minimum(window, n[piece]).astype(np.int64)
        self.end = first + self.size
        self.item = item[piece] if len(piece) else np.zeros(0, np.int32)
        self.symbols = len(self.digests)
        self.shortest = int(self.size.min()) if len(self.size) else 0

    def ids(self, found: list[bytes]) -> np.ndarray:
        """The numbers of words, 0 for those that the block doesn't have: from its spelled words, or by digests."""
        if self.whole:
            return np.fromiter(map(self.known.get, found, repeat(0)), dtype=np.int64, count=len(found))
        if len(self.known) > MOST_KNOWN:
            self.known.clear()
        new = list(set(found).difference(self.known))
        if new:
            d = _digests(new)
            at = np.minimum(np.searchsorted(self.digests[:, 0], d[:, 0]), self.symbols - 1)
            same = (self.digests[at] == d).all(axis=1)
            for k in np.flatnonzero((self.digests[at, 0] == d[:, 0]) & ~same).tolist():  # first halves that several digests share
                i = int(at[k])
                while i < self.symbols and self.digests[i, 0] == d[k, 0] and not same[k]:
                    at[k], same[k] = i, self.digests[i, 1] == d[k, 1]
                    i += 1
            self.known.update(zip(new, np.where(same, at + 1, 0).tolist()))
        return np.fromiter(map(self.known.__getitem__, found), dtype=np.int64, count=len(found))


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Sorted suffixes by prefix doubling; separators (0) differ from one another, so that equal parts end at them."""
    n = len(text)
    breaks = text == 0
    key = np.where(breaks, np.cumsum(breaks), text + int(breaks.sum()))
    rank = np.unique(key, return_inverse=True)[1]
    step = 1
    while True:
        later = np.zeros(n, np.int64)
        later[: n - step] = rank[step:] + 1
        pair = rank * (n + 1) + later
        order = np.argsort(pair, kind="stable")
        same = np.r_[False, pair[order][1:] == pair[order][:-1]]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(~same) - 1
        if not same.any() or step >= n:
            return order
        step *= 2


class FMIndex:
    """Occurrences of phrases in a sequence of word numbers; 0 separates runs and is never searched."""

    def __init__(self, text: np.ndarray, symbols: int):
        n = len(text)
        order = suffix_array(text)
        last = text[order - 1]  # the word before each suffix, the text's last word before the first
        if n:
            last = np.where(order == 0, 0, last)
        self.levels = max(1, int(symbols).bit_length())
        self.first = np.zeros(symbols + 2, np.int64)
        self.first[1:] = np.cumsum(np.bincount(text, minlength=symbols + 1))
        self.last = last
        self.ones: list[np.ndarray] = []
        self.zeros: list[int] = []
        now = last
        for level in range(self.levels - 1, -1, -1):  # the tree's nodes of a level lie side by side
            bit = now >> level & 1
            self.ones.append(np.r_[0, np.cumsum(bit)].astype(np.int32))
            self.zeros.append(int(n - self.ones[-1][-1]))
            now = np.concatenate([now[bit == 0], now[bit == 1]])
        kept = (order % SAMPLED == 0) | (last == 0)
        self.kept, self.places = np.r_[0, np.cumsum(kept)].astype(np.int32), order[kept]
        self.is_kept = kept

    def rank(self, symbol: np.ndarray, upto: np.ndarray) -> np.ndarray:
        """How often each symbol is among the first upto words before suffixes."""
        at, begin = upto, np.zeros_like(upto)
        for k, level in enumerate(range(self.levels - 1, -1, -1)):
            bit = symbol >> level & 1
            one_at, one_begin = self.ones[k][at].astype(np.int64), self.ones[k][begin].astype(np.int64)
            at = np.where(bit, self.zeros[k] + one_at, at - one_at)
            begin = np.where(bit, self.zeros[k] + one_begin, begin - one_begin)
        return at - begin

    def search(self, seq: np.ndarray, end: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each phrase (size words of seq before end), the range of suffixes that begin with it."""
        lo, hi = np.zeros(len(end), np.int64), np.full(len(end), len(self.last), np.int64)
        for step in range(int(size.max()) if len(size) else 0):
            live = np.flatnonzero((size > step) & (lo < hi))
            if not len(live):
                break
            symbol = seq[end[live] - 1 - step].astype(np.int64)
            lo[live], hi[live] = self.first[symbol] + self.rank(symbol, lo[live]), self.first[symbol] + self.rank(symbol, hi[live])
        return lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Where suffixes begin: walks back to one whose place is kept."""
        rows, steps, out = rows.copy(), np.zeros(len(rows), np.int64), np.full(len(rows), -1, np.int64)
        open_ = np.arange(len(rows))
        while len(open_):
            at = rows[open_]
            done = self.is_kept[at]
            out[open_[done]] = self.places[self.kept[at[done]]] + steps[open_[done]]
            open_ = open_[~done]
            at = rows[open_]
            symbol = self.last[at]
            rows[open_] = self.first[symbol] + self.rank(symbol, at)
            steps[open_] += 1
        return out


class Shard:
    """Documents whose runs of a block's words are indexed together."""

    def __init__(self, phrases: Phrases):
        self.phrases, self.docs, self.parts, self.owner, self.place, self.size = phrases, 0, [], [], [], 0

    def add(self, each: list[list[bytes]]) -> None:
        """Keeps the runs of words that the block has and that are as long as its shortest window; no other word can be hit."""
        n = np.array([len(w) for w in each], np.int64)
        base = self.docs
        self.docs += len(each)
        if not n.sum() or not len(self.phrases.size):
            return
        ids = self.phrases.ids(list(chain.from_iterable(each)))
        doc = np.repeat(np.arange(len(each)), n)
        known = np.r_[False, ids > 0, False]
        change = np.r_[True, doc[1:] != doc[:-1], True]
        inside = known[1:-1]
        begins = np.flatnonzero(inside & (~known[:-2] | change[:-1]))
        ends = np.flatnonzero(inside & (~known[2:] | change[1:])) + 1
        long = ends - begins >= self.phrases.shortest
        begins, ends = begins[long], ends[long]
        if not len(begins):
            return
        size = ends - begins
        at = np.arange(size.sum()) + np.repeat(begins - (np.cumsum(size) - size), size)
        gaps = np.cumsum(size)
        first = np.cumsum(n) - n
        self.parts.append(np.insert(ids[at], gaps, 0))
        self.owner.append(np.insert(doc[at] + base, gaps, -1))
        self.place.append(np.insert(at - first[doc[at]], gaps, -1))
        self.size += len(self.parts[-1])

    def hits(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Documents, begins and ends of the merged spans of words; documents and items (numbers) of what was found."""
        none = np.zeros(0, np.int64)
        if not self.parts:
            return none, none, none, none, none
        text, owner, place = map(np.concatenate, (self.parts, self.owner, self.place))
        p, spans, pairs = self.phrases, [np.zeros((0, 3), np.int64)], [np.zeros((0, 2), np.int64)]
        index = FMIndex(text, p.symbols)
        for s in range(0, len(p.size), MOST_SEARCHED):
            part = slice(s, s + MOST_SEARCHED)
            lo, hi = index.search(p.seq, p.end[part], p.size[part])
            found = np.flatnonzero(lo < hi)
            ends = np.cumsum((hi - lo)[found])
            for a in range(0, int(ends[-1]) if len(ends) else 0, MOST_SEARCHED):  # a window may be anywhere in the shard
                rank = np.arange(a, min(a + MOST_SEARCHED, int(ends[-1])))
                of = np.searchsorted(ends, rank, side="right")
                which = found[of]
                at = index.locate(hi[which] - (ends[of] - rank))
                doc, begin = owner[at], place[at]
                spans.append(merge(np.stack([doc, begin, begin + p.size[part][which]], 1)))
                pairs.append(np.unique(np.stack([doc, p.item[part][which]], 1), axis=0))
        merged, pair = merge(np.concatenate(spans)), np.unique(np.concatenate(pairs), axis=0)
        return merged[:, 0], merged[:, 1], merged[:, 2], pair[:, 0], pair[:, 1]


def merge(spans: np.ndarray) -> np.ndarray:
    """Rows (document, begin, end) in order, with those of a document that touch or overlap as one."""
    if not len(spans):
        return spans
    spans = spans[np.lexsort((spans[:, 1], spans[:, 0]))]
    wide = int(spans[:, 2].max()) + 1
    reach = np.maximum.accumulate(spans[:, 0] * wide + spans[:, 2])
    new = np.flatnonzero(np.r_[True, (spans[1:, 0] * wide + spans[1:, 1] > reach[:-1])])
    return np.stack([spans[new, 0], spans[new, 1], reach[np.r_[new[1:] - 1, len(spans) - 1]] - spans[new, 0] * wide], 1)


OUT = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, spans array<struct<start: long, end: long>>, items array<string>"
BLOCK_BYTES = 16 << 20  # bytes of benchmark words that are packed and broadcast as one block
MOST_BLOCKS = 4  # blocks that one pass over the documents searches
PIECE_WORDS = 50_000  # words of a longer item that stay together
MOST_KNOWN = 200_000  # words of documents whose numbers a worker keeps for each block
MOST_SEARCHED = 1 << 18  # windows, and occurrences, that are looked at together
HELD_BYTES = 32 << 20  # bytes of rows that a task holds until their shard is judged
RESULTS = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated", "spans", "items")
TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.list_(pa.string())]


def _row(doc, n: int, spans: list[tuple[int, int]], names: list[str], share: int) -> tuple:
    hit = sum(b - a for a, b in spans)
    return doc, n, hit, len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), hit > 0 and share * hit >= n, [{"start": a, "end": b} for a, b in spans], names


def _batch(rows: list[tuple], kept: list, keep: tuple[str, ...]) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [()] * len(TYPES)
    return pa.record_batch([*(pa.array(c, t) for c, t in zip(cols, TYPES)), *kept], ["doc_id", *RESULTS, *keep])


def _pieces(benchmark: DataFrame, window: int) -> DataFrame:
    """item, words (joined by spaces) of the items' stretches: whole items of up to PIECE_WORDS words, longer ones in stretches that share window - 1 words."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches):
            out = []
            for item, text in zip(batch.column("item").to_pylist(), batch.column("text").to_pylist()):
                w = words(text)
                out += [(item, b" ".join(w[s : s + PIECE_WORDS + window - 1])) for s in range(0, max(1, len(w) - window + 1), PIECE_WORDS) if w]
            yield pa.record_batch([pa.array([i for i, _ in out], pa.string()), pa.array([w for _, w in out], pa.binary())], ["item", "words"])

    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), F.col("text").cast("binary").alias("text"))
    return items.mapInArrow(cut, "item string, words binary").distinct()


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 13, shard_words: int = 1_500_000, share: int = 20, block_bytes: int = BLOCK_BYTES, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row for each document: how many of its words lie in occurrences of benchmark windows, and the merged spans.

    docs needs doc_id and text, benchmark item_id and text. Null texts have no words; items without words have no
    windows; an item that is there twice counts once, and a null item_id is an empty name. Repeated rows of documents
    give repeated rows. An empty benchmark hits nothing, an empty table of documents gives no rows.

    The benchmark is packed in blocks of about block_bytes bytes of words (20 bytes a word in memory at most), each of
    which is broadcast; up to MOST_BLOCKS are searched in one pass, in which documents are read and cut into words once
    and aren't shuffled: each task indexes what it reads, in shards of about shard_words words of a block's vocabulary.
    A benchmark of more blocks takes more passes, whose spans are merged for each document. Columns of docs that are
    named in keep are returned besides, but for those that have the name of a result.
    """
    spark = docs.sparkSession
    small_batches(spark)
    keep = tuple(c for c in keep if c not in {"doc_id", *RESULTS})
    pieces = written(_pieces(benchmark, window), "pieces-of-items")
    size = pieces.agg(F.sum(F.length("words") + 1).alias("n")).first().n or 0
    blocks = 1 if size <= block_bytes else -(-size * 5 // (block_bytes * 4))  # a fifth to spare, as hashes deal unevenly
    block = F.pmod(F.xxhash64("item", "words"), F.lit(blocks))
    if blocks > MOST_BLOCKS:
        return _in_passes(docs, pieces.withColumn("pass", F.floor(block / MOST_BLOCKS)), -(-blocks // MOST_BLOCKS), window, shard_words, share, block_bytes, keep)
    shared = [spark.sparkContext.broadcast(pack_phrases([(r.item, bytes(r.words)) for r in pieces.where(block == b).collect()], window)) for b in range(blocks)]
    forget(pieces)
    return _search(docs, shared, shard_words, share, keep)


def _search(docs: DataFrame, shared: list, shard_words: int, share: int, keep: tuple[str, ...]) -> DataFrame:
    """One pass over docs with the blocks that shared has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = held_by_worker(tuple(b.value for b in shared), lambda *packed: list(map(Phrases, packed)))

        def judged(shards: list[Shard], held: list[tuple]) -> Iterator[pa.RecordBatch]:
            found = [s.hits() for s in shards]
            spans = merge(np.concatenate([np.stack(f[:3], 1) for f in found]))
            first = np.searchsorted(spans[:, 0], np.arange(sum(len(h[0]) for h in held) + 1)).tolist()
            spans = spans[:, 1:].tolist()
            items: dict[int, set[str]] = {}
            for p, f in zip(phrases, found):
                for d, i in zip(f[3].tolist(), f[4].tolist()):
                    items.setdefault(d, set()).add(p.items[i])
            at = 0
            for docs_, n, kept in held:
                rows = [_row(d, c, spans[first[k] : first[k + 1]], sorted(items.get(k, ())), share) for k, (d, c) in enumerate(zip(docs_, n), at)]
                at += len(rows)
                yield _batch(rows, kept, keep)

        shards, held, size = [Shard(p) for p in phrases], [], 0
        for batch in portions(batches):
            each = [words(t) for t in text_bytes(batch)]
            for s in shards:
                s.add(each)
            held.append((batch.column("doc_id").to_pylist(), list(map(len, each)), [batch.column(f"kept_{i}") for i in range(len(keep))]))
            size += batch.nbytes if keep else 0
            if max(s.size for s in shards) >= shard_words or shards[0].docs >= 50_000 or size >= HELD_BYTES:
                yield from judged(shards, held)
                shards, held, size = [Shard(p) for p in phrases], [], 0
        yield from judged(shards, held)

    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}
    lean = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"), *(F.col(c).alias(f"kept_{i}") for i, c in enumerate(keep)))
    return lean.mapInArrow(run, ", ".join([OUT, *(f"`{c}` {kinds[c]}" for c in keep)]))


def keep_clean(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of docs that aren't contaminated."""
    others = tuple(c for c in docs.columns if c != "doc_id")
    named = docs.withColumnsRenamed({c: f"own_{c}" for c in others}).withColumn("text", F.col("own_text"))
    found = contamination(named, benchmark, keep=tuple(f"own_{c}" for c in others), **options).where(~F.col("contaminated"))
    return found.select(*("doc_id" if c == "doc_id" else F.col(f"own_{c}").alias(c) for c in docs.columns))


def _in_passes(docs: DataFrame, pieces: DataFrame, passes: int, window: int, shard_words: int, share: int, block_bytes: int, keep: tuple[str, ...]) -> DataFrame:
    """contamination() for a benchmark of many blocks: rows are numbered once, and the passes' hits are merged by row."""
    spark = docs.sparkSession
    rows = written(docs.select("doc_id", "text", *(F.col(c).alias(f"kept_{i}") for i, c in enumerate(keep))).withColumn("row", F.monotonically_increasing_id()), "numbered")
    hits = None
    for p in range(passes):
        own = pieces.where(F.col("pass") == p)
        block = F.pmod(F.xxhash64("words", "item", F.lit("block")), F.lit(MOST_BLOCKS))
        shared = [spark.sparkContext.broadcast(pack_phrases([(r.item, bytes(r.words)) for r in own.where(block == b).collect()], window)) for b in range(MOST_BLOCKS)]
        found = written(_search(rows, shared, shard_words, share, ("row",)).where("n_hit > 0").select("row", "spans", "items"), "hits")
        for b in shared:
            b.destroy()
        hits = found if hits is None else hits.unionByName(found)
    # no more spans than a document has words
    each = hits.groupBy(F.col("row").alias("of")).agg(F.flatten(F.collect_list("spans")).alias("s"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("found"))
    counted = _search(rows, [spark.sparkContext.broadcast(pack_phrases([], window))], shard_words, share, ("row", *(f"kept_{i}" for i in range(len(keep)))))
    both = counted.drop("spans", "items").join(each, F.col("row") == F.col("of"), "left")

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, n, spans, names in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "n_words", "s", "found"))):
                spans = merge(np.array([(0, x["start"], x["end"]) for x in spans or ()], np.int64).reshape(-1, 3))
                out.append(_row(doc, n, [tuple(x) for x in spans[:, 1:].tolist()], names or [], share))
            yield _batch(out, [batch.column(f"kept_{i}") for i in range(len(keep))], keep)

    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}
    return both.select("doc_id", "n_words", "s", "found", *(f"kept_{i}" for i in range(len(keep)))).mapInArrow(merged, ", ".join([OUT, *(f"`{c}` {kinds[c]}" for c in keep)]))
