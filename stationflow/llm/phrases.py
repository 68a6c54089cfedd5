"""Phrase mining: an FM-index over word ids for each shard, n-grams by bidirectional interval extension, sums across shards.

A shard holds the pieces of the documents that a task reads as word ids (a word of another language is another id).
Its index is a pair of Burrows-Wheeler transforms, of the text and of the reversed text, with wavelet-matrix ranks. An
n-gram is a pair of intervals of the two; extending it by all words on its left (or right) walks the wavelet matrix
below its interval, which gives each extension's intervals and count at once.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import forget, join_spread, mix64, portions, small_batches, text_bytes, written

BREAK = b"\xff"  # is in no UTF-8 text
# A-Z become a-z, tabs become spaces, .,;:!? and line ends become breaks between pieces
PIECE_BYTES = bytes(0xFF if chr(c) in ".,;:!?\n\x0b\x0c\r" else 32 if c == 9 else c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))


def pieces(texts: list[bytes | None]) -> list[bytes]:
    """The words of texts one after another, BREAK between pieces and texts."""
    return BREAK.join(t for t in texts if t).translate(PIECE_BYTES).replace(BREAK, b" \xff ").split()


class Index:
    """One side of the FM-index: the symbol before each suffix, suffixes sorted by their first `depth` symbols.

    Intervals of up to depth symbols are contiguous; extending one of them gives the right count whatever the order
    of suffixes that agree in depth symbols.
    """

    def __init__(self, text: np.ndarray, depth: int):
        n, symbols = len(text), int(text.max(initial=0)) + 1
        width = max(1, (symbols - 1).bit_length())
        key, held = text.astype(np.uint64), 1
        while held < depth:  # as many symbols as 64 bits hold; the ranks of longer keys take their place
            if (held + 1) * width > 64:
                key = np.unique(key, return_inverse=True)[1].astype(np.uint64)
                width_of_rank = max(1, int(key.max(initial=0)).bit_length())
                room = (64 - width_of_rank) // width
            else:
                room = 64 // width - held
            for _ in range(min(room, depth - held)):
                later = np.zeros(n, np.uint64)
                later[: max(0, n - held)] = text[held:]
                key = key << np.uint64(width) | later
                held += 1
        order = np.argsort(key, kind="stable")
        now = text[order - 1].astype(np.int32)
        del key, order
        self.first = np.r_[0, np.cumsum(np.bincount(text, minlength=symbols))]
        self.levels = width
        self.ones, self.zeros = [], []
        for level in range(width - 1, -1, -1):
            bit = (now >> level & 1).astype(bool)
            ones = np.zeros(n + 1, np.int32)
            np.cumsum(bit, out=ones[1:])
            self.ones.append(ones)
            self.zeros.append(n - int(ones[-1]))
            now = np.concatenate([now[~bit], now[bit]])
            del bit
        self.leaf = np.zeros(symbols, np.int64)  # where each symbol's occurrences begin below the last level
        at = np.flatnonzero(np.r_[True, now[1:] != now[:-1]]) if n else np.zeros(0, np.int64)
        self.leaf[now[at]] = at

    def extensions(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """All symbols before the intervals, by interval and symbol: the interval's number, the symbol, and the range of the longer phrase."""
        of, symbol, lo, hi = np.arange(len(lo)), np.zeros(len(lo), np.int64), lo.astype(np.int32), hi.astype(np.int32)
        for ones, zeros in zip(self.ones, self.zeros):
            lo1, hi1 = ones[lo], ones[hi]
            child_lo, child_hi = np.empty(2 * len(lo), np.int32), np.empty(2 * len(lo), np.int32)
            child_lo[0::2], child_hi[0::2] = lo - lo1, hi - hi1
            child_lo[1::2], child_hi[1::2] = lo1 + zeros, hi1 + zeros
            live = np.flatnonzero(child_lo < child_hi)
            parent = live >> 1
            of, symbol, lo, hi = of[parent], symbol[parent] << 1 | (live & 1), child_lo[live], child_hi[live]
        begin = self.first[symbol] - self.leaf[symbol]
        return of, symbol, lo + begin, hi + begin


class Phrases:
    """The n-grams of a text (0 separates pieces) as pairs of intervals; all n-grams of one length at a time."""

    def __init__(self, text: np.ndarray, longest: int):
        text = np.r_[0, text, 0]
        self.sides = Index(text, max(1, longest - 1)), Index(text[::-1].copy(), max(1, longest - 1)) if longest > 2 else None
        counts = np.bincount(text)
        words = np.flatnonzero(counts)
        words = words[words > 0]
        lo = self.sides[0].first[words]
        self.words, self.lo, self.hi, self.other = words[:, None], lo, lo + counts[words], lo.copy()

    def extend(self, side: int) -> None:
        """Every n-gram by each word that is on its left (0) or right (1): other, the first place in the other index, moves past smaller words."""
        mine = (self.lo, self.other) if side == 0 else (self.other, self.lo)
        size = self.hi - self.lo
        of, symbol, lo, hi = self.sides[side].extensions(mine[0], mine[0] + size)
        n = hi - lo
        before = np.cumsum(n) - n
        first = np.flatnonzero(np.r_[True, of[1:] != of[:-1]]) if len(of) else np.zeros(0, np.int64)
        other = mine[1][of] + before - np.repeat(before[first], np.diff(np.r_[first, len(of)]))
        kept = symbol > 0
        of, symbol, lo, n, other = of[kept], symbol[kept], lo[kept], n[kept], other[kept]
        if side == 0:
            self.words, self.lo, self.other = np.column_stack([symbol, self.words[of]]), lo, other
        else:
            self.words, self.lo, self.other = np.column_stack([self.words[of], symbol]), other, lo
        self.hi = self.lo + n

    def counts(self, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The n-grams of 1, 2 ... longest words and how often each is there; sides take turns."""
        yield self.words, self.hi - self.lo
        for size in range(2, longest + 1):
            self.extend(size % 2)
            yield self.words, self.hi - self.lo


def keys_of(hashes: np.ndarray, grams: np.ndarray) -> np.ndarray:
    """64-bit keys of n-grams (rows of word ids), equal in all shards; hashes: of the words by id."""
    key = hashes[grams[:, 0]]
    for k in range(1, grams.shape[1]):
        key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + hashes[grams[:, k]])
    return key


def starts(text: np.ndarray, size: int) -> np.ndarray:
    """Where n-grams of so many words begin."""
    n = len(text) - size + 1
    ok = np.ones(max(0, n), bool)
    for k in range(size if n > 0 else 0):
        ok &= text[k : k + n] > 0
    return np.flatnonzero(ok)


def narrowed(text: np.ndarray, hashes: np.ndarray, size: int, bits: np.ndarray) -> np.ndarray:
    """The stretches in which every n-gram of so many words may be frequent; bits: by the order of the text's keys.

    Each n-gram that is kept is there as often as before. An n-gram of one more word is kept if both its ends are.
    """
    at = starts(text, size)
    key = keys_of(hashes, np.column_stack([text[at + k] for k in range(size)]))
    at = at[bits[np.unique(key, return_inverse=True)[1]]] if len(at) else at
    if not len(at):
        return text[:0]
    ends = np.r_[np.flatnonzero(np.diff(at) != 1), len(at) - 1]  # the last start of each stretch
    begins = np.r_[0, ends[:-1] + 1]
    width = ends - begins + size + 1  # and a separator
    out = np.cumsum(width)
    place = np.arange(out[-1]) - np.repeat(out - width, width)
    source = np.minimum(np.repeat(at[begins], width) + place, len(text) - 1)
    kept = text[source]
    kept[out - 1] = 0
    return kept


class Shard:
    """Word ids of the pieces that a task has read; ids are dealt out by language when the shard is closed."""

    def __init__(self):
        self.known: dict[str, dict[bytes, int]] = {}
        self.langs: list[np.ndarray] = []
        self.ids: list[np.ndarray] = []
        self.next, self.size = 1, 0

    def add(self, lang: str, found: list[bytes]) -> None:
        known = self.known.setdefault(lang, {BREAK: 0})
        new = set(found).difference(known)
        known.update(zip(new, range(self.next, self.next + len(new))))
        self.next += len(new)
        self.ids.append(np.fromiter(chain(map(known.__getitem__, found), (0,)), dtype=np.int32, count=len(found) + 1))
        self.size += len(found) + 1

    def row(self) -> tuple[bytes, list[str], list[int], bytes]:
        """The ids, the languages and how many words each has, and the words in order of their ids (from 1)."""
        langs = sorted(self.known)
        words, new, n = [], np.zeros(self.next, np.int32), 0
        for lang in langs:
            own = sorted(w for w in self.known[lang] if w != BREAK)
            new[np.fromiter((self.known[lang][w] for w in own), np.int64, len(own))] = np.arange(n + 1, n + 1 + len(own), dtype=np.int32)
            n += len(own)
            words += own
        text = new[np.concatenate(self.ids)] if self.ids else np.zeros(0, np.int32)
        text = text[(text > 0) | np.r_[True, text[:-1] > 0]] if len(text) else text
        return zlib.compress(text.tobytes(), 1), langs, [len(self.known[g]) - 1 for g in langs], zlib.compress(b"\n".join(words), 1)


class Read:
    """A shard as it was written."""

    def __init__(self, ids: bytes, langs: list[str], sizes: list[int], words: bytes):
        self.text, self.langs = np.frombuffer(zlib.decompress(ids), np.int32).astype(np.int64), langs
        words = zlib.decompress(words)
        self.words = words.split(b"\n") if sum(sizes) else []
        self.lang = np.r_[-1, np.repeat(np.arange(len(sizes)), sizes)]
        own = [xxhash.xxh3_64_intdigest(w, seed=0) for w in self.words]
        salt = np.array([xxhash.xxh3_64_intdigest(g.encode(), seed=1) for g in langs], np.uint64)
        self.hashes = mix64(np.r_[np.uint64(0), np.array(own, np.uint64) + salt[self.lang[1:]]]) if own else np.zeros(1, np.uint64)

    def narrow(self, rounds: list[tuple[int, np.ndarray]]) -> np.ndarray:
        text = self.text
        for size, bits in rounds:
            text = narrowed(text, self.hashes, size, bits)
        return text


SHARD = "shard long, ids binary, langs array<string>, sizes array<int>, words binary"
COUNTS = "lang string, size int, phrase string, f long"


def _shards(docs: DataFrame, shard_words: int) -> DataFrame:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, shard = TaskContext.get().partitionId() << 24, Shard()

        def close() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([dict(zip(("shard", "ids", "langs", "sizes", "words"), (number, *shard.row())))], KIND)

        for batch in portions(batches):
            by: dict[str, list] = {}
            for lang, text in zip(batch.column("lang").to_pylist(), text_bytes(batch)):
                by.setdefault(lang, []).append(text)
            for lang, texts in by.items():
                shard.add(lang, pieces(texts))
            if shard.size >= shard_words:
                yield close()
                number, shard = number + 1, Shard()
        if shard.size:
            yield close()

    KIND = pa.schema([("shard", pa.int64()), ("ids", pa.binary()), ("langs", pa.list_(pa.string())), ("sizes", pa.list_(pa.int32())), ("words", pa.binary())])
    lean = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("binary").alias("text"))
    return lean.mapInArrow(cut, SHARD)


def _read(batch: pa.RecordBatch) -> Iterator[tuple[int, Read, list[tuple[int, np.ndarray]]]]:
    """Shards one by one, with the bits of the rounds so far."""
    for i in range(batch.num_rows):
        r = batch.slice(i, 1).to_pylist()[0]
        rounds = []
        for size in sorted(int(c[4:]) for c in batch.schema.names if c.startswith("bits")):
            parts = r[f"bits{size}"] or []
            rounds.append((size, np.concatenate([np.unpackbits(np.frombuffer(p["bits"], np.uint8), count=p["n"]).astype(bool) for p in parts]) if parts else np.zeros(0, bool)))
        yield r["shard"], Read(r["ids"], r["langs"], r["sizes"], r["words"]), rounds


def _frequent(shards: DataFrame, size: int, least: int) -> DataFrame:
    """shard, bits{size}: which of a shard's n-grams (by part, then key) may have `least` occurrences in all shards.

    A shard sends its keys and counts in one message for each of as many ranges of keys as Spark has shuffle
    partitions. A range's task sums them and sends a bit for each key back.
    """
    parts = int(shards.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, read, rounds in _read(batch):
                text = read.narrow(rounds)
                *_, (grams, n) = Phrases(text, size).counts(size)
                key = keys_of(read.hashes, grams)
                by = np.argsort(key)
                key, n = key[by], n[by]
                first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
                key, n = key[first], np.minimum(np.add.reduceat(n, first), least).astype(np.uint32) if len(first) else n[:0].astype(np.uint32)
                cuts = np.searchsorted((key >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32), np.arange(parts + 1, dtype=np.uint64)).tolist()
                rows = [(p, a, b) for p, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])) if a < b]
                yield pa.record_batch(
                    [
                        pa.array([p for p, _, _ in rows], pa.int32()),
                        pa.array([shard] * len(rows), pa.int64()),
                        pa.array([np.diff(key[a:b], prepend=np.uint64(0)).tobytes() for _, a, b in rows], pa.binary()),
                        pa.array([zlib.compress(n[a:b].tobytes(), 1) for _, a, b in rows], pa.binary()),
                    ],
                    ["part", "shard", "keys", "n"],
                )

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple]] = {}
        for batch in batches:
            for part, shard, keys, n in zip(*(c.to_pylist() for c in batch.columns)):
                held.setdefault(part, []).append((shard, np.cumsum(np.frombuffer(keys, np.uint64)), np.frombuffer(zlib.decompress(n), np.uint32)))
        for part in list(held):
            rows = held.pop(part)
            key = np.concatenate([k for _, k, _ in rows])
            by = np.argsort(key)
            n = np.concatenate([n for *_, n in rows])[by].astype(np.int64)
            key = key[by]
            first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            enough = np.repeat(np.add.reduceat(n, first) >= least, np.diff(np.r_[first, len(key)]))
            bits = np.empty(len(key), bool)
            bits[by] = enough
            at = np.cumsum([0, *(len(k) for _, k, _ in rows)]).tolist()
            yield pa.record_batch(
                [
                    pa.array([s for s, _, _ in rows], pa.int64()),
                    pa.array([part] * len(rows), pa.int32()),
                    pa.array([len(k) for _, k, _ in rows], pa.int32()),
                    pa.array([np.packbits(bits[a:b]).tobytes() for a, b in zip(at[:-1], at[1:])], pa.binary()),
                ],
                ["shard", "part", "n", "bits"],
            )

    sent = shards.mapInArrow(send, "part int, shard long, keys binary, n binary")
    back = sent.repartitionById(parts, F.col("part")).mapInArrow(total, "shard long, part int, n int, bits binary")
    return back.groupBy("shard").agg(F.array_sort(F.collect_list(F.struct("part", "n", "bits"))).alias(f"bits{size}"))


def _strings(read: Read, grams: np.ndarray, n: np.ndarray, words: pa.Array) -> pa.RecordBatch:
    phrase = words.take(pa.array(grams[:, 0] - 1))
    for k in range(1, grams.shape[1]):
        phrase = pc.binary_join_element_wise(phrase, words.take(pa.array(grams[:, k] - 1)), b" ")
    lang = pa.array(read.langs or [""], pa.string()).take(pa.array(read.lang[grams[:, 0]]))
    return pa.record_batch([lang, pa.array(np.full(len(n), grams.shape[1]), pa.int32()), phrase.view(pa.string()), pa.array(n, pa.int64())], ["lang", "size", "phrase", "f"])


def phrase_counts(docs: DataFrame, longest: int = 4, least: int = 30, shard_words: int = 1_000_000) -> DataFrame:
    """lang, size, phrase, f: the phrases of 1 to longest words of each language that occur at least `least` times.

    Row (lang, 0, '', f) tells how many words the language has. docs needs text and lang: a null text is empty, a null lang 'und';
    repeated rows count again.

    An n-gram can only be frequent if its first and its last n - 1 words are. So lengths are counted one after
    another: before n-grams of n words are listed, shards are told which of their n-grams of n - 1 words may be
    frequent (by sums over 64-bit keys, which never miss one), and the stretches of all others are left out. What is
    left after the last such round is listed as text and summed exactly.
    """
    small_batches(docs.sparkSession)
    shards = whole = written(_shards(docs, shard_words), "phrase-shards")
    told = []
    for size in range(2, max(3, longest)):
        told.append(written(_frequent(shards, size, least), "phrase-bits"))
        shards = shards.join(told[-1], "shard", "left")

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, read, rounds in _read(batch):
                words = pa.array(read.words, pa.binary())
                counts = np.bincount(read.text, minlength=len(read.words) + 1)
                each = np.bincount(read.lang[1:], weights=counts[1:], minlength=len(read.langs)).astype(np.int64) if read.langs else np.zeros(0, np.int64)
                m = len(each)
                yield pa.record_batch([pa.array(read.langs, pa.string()), pa.array([0] * m, pa.int32()), pa.array([""] * m, pa.string()), pa.array(each, pa.int64())], ["lang", "size", "phrase", "f"])
                own = np.flatnonzero(counts[1:]) + 1
                yield _strings(read, own[:, None], counts[own], words)
                text = read.text
                for k, (size, bits) in enumerate(rounds):
                    text = narrowed(text, read.hashes, size, bits)
                    top = longest if k == len(rounds) - 1 else size
                    for grams, n in list(Phrases(text, top).counts(top))[size - 1 :]:
                        yield _strings(read, grams, n, words)

    found = shards.mapInArrow(listed, COUNTS).groupBy("lang", "size", "phrase").agg(F.sum("f").alias("f"))
    out = written(found.where((F.col("f") >= least) | (F.col("size") == 0)), "phrase-counts")
    for t in (whole, *told):
        forget(t)
    return out


def collocations(docs: DataFrame, longest: int = 4, least: int = 30, share: int = 80, most: int = 2000, shard_words: int = 1_000_000) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's `most` phrases of the highest scores.

    A phrase of 2 to longest words with a >= least occurrences, cut into two parts with l and r occurrences, has the
    score floor(2000000 * a / (l + r)); the cut with the lowest score counts (of equal ones the first). Phrases that
    a longer one contains with at least share percent of their occurrences are left out. n: the language's words.
    Rows by score and a (descending) and phrase (bytes). Documents of any form are taken as phrase_counts() says; no
    documents, or none with frequent phrases, give no rows.

    A phrase is within a longer frequent one exactly if it is at an end of one that has one more word, and none of
    longer ones occurs more often; so each phrase is only compared with the two that it has at its ends.
    """
    counts = phrase_counts(docs, longest, least, shard_words)
    word = F.split("phrase", " ")
    phrases = counts.where("size >= 2").select("lang", "size", "phrase", F.col("f").alias("a"))
    some = lambda first, n: F.array_join(F.slice(word, first, n), " ")
    cuts = phrases.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cuts = cuts.select("lang", "phrase", "a", "k", some(F.lit(1), F.col("k")).alias("left"), some(F.col("k") + 1, F.col("size") - F.col("k")).alias("right"))
    parts = counts.where(f"size between 1 and {longest - 1}")
    for side, f in (("left", "l"), ("right", "r")):  # no more cuts have a part than it has occurrences / least for each length
        own = parts.select(F.concat_ws(" ", "lang", "phrase").alias(f"{side}_of"), F.col("f").alias(f), F.ceil(F.col("f") * longest / least).alias("weight"))
        cuts = join_spread(cuts.withColumn(f"{side}_of", F.concat_ws(" ", "lang", side)), own, f"{side}_of", "weight", ["phrase", "k"])
    exact = lambda c: c.cast("decimal(38,0)")
    score = F.call_function("div", exact(F.lit(2_000_000)) * exact(F.col("a")), exact(F.col("l")) + exact(F.col("r")))
    best = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.cast("long").alias("score"), "k", "l", "r")).alias("cut"))
    inside = phrases.where("size >= 3").select("lang", F.col("a").alias("longer"), F.explode(F.array(some(F.lit(1), F.col("size") - 1), some(F.lit(2), F.col("size") - 1))).alias("phrase"))
    inside = inside.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    left = best.join(inside, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (exact(F.lit(100)) * exact(F.col("longer")) < exact(F.lit(share)) * exact(F.col("a"))))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    left = left.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score", F.pmod(F.xxhash64("phrase"), F.lit(64)).alias("deal"))
    for by in (("lang", "deal"), ("lang",)):  # the best of each deal, then of those
        left = left.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order)).cast("long")).where(F.col("rank") <= most)
    words = counts.where("size = 0").select("lang", F.col("f").alias("n"))
    return left.join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


ORACLE = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, doc_id, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, piece, unnest(w) AS w, generate_subscripts(w, 1) AS i FROM (SELECT lang, row_number() OVER () AS piece, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p)),
v AS (SELECT lang, w, lead(w, 1) OVER o AS w1, lead(w, 2) OVER o AS w2, lead(w, 3) OVER o AS w3 FROM w WINDOW o AS (PARTITION BY piece ORDER BY i)),
g AS (SELECT lang, 1 AS size, w AS phrase FROM v UNION ALL SELECT lang, 2, w || ' ' || w1 FROM v WHERE w1 IS NOT NULL
      UNION ALL SELECT lang, 3, w || ' ' || w1 || ' ' || w2 FROM v WHERE w2 IS NOT NULL UNION ALL SELECT lang, 4, w || ' ' || w1 || ' ' || w2 || ' ' || w3 FROM v WHERE w3 IS NOT NULL),
c AS MATERIALIZED (SELECT lang, size, phrase, count(*) AS f FROM g GROUP BY lang, size, phrase),
n AS (SELECT lang, sum(f) AS n FROM c WHERE size = 1 GROUP BY lang),
cand AS MATERIALIZED (SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w FROM c WHERE size >= 2 AND f >= 30),
cuts AS (SELECT lang, size, phrase, a, k, array_to_string(w[1 : k], ' ') AS x, array_to_string(w[k + 1 :], ' ') AS y FROM cand, range(1, 4) t(k) WHERE k < size),
scored AS (SELECT q.*, x.f AS l, y.f AS r, CAST((CAST(2000000 AS HUGEINT) * a) // (x.f + y.f) AS BIGINT) AS score
           FROM cuts q JOIN c x ON x.lang = q.lang AND x.phrase = q.x AND x.size = q.k JOIN c y ON y.lang = q.lang AND y.phrase = q.y AND y.size = q.size - q.k),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (SELECT lang, size AS longer, a AS longer_a, array_to_string(w[i : i + s - 1], ' ') AS phrase, s
           FROM cand, range(2, 4) t(s), range(1, 4) u(i) WHERE s < size AND i + s - 1 <= size),
dropped AS (SELECT DISTINCT i.lang, i.phrase FROM inside i JOIN cand b ON b.lang = i.lang AND b.phrase = i.phrase WHERE 100 * i.longer_a >= 80 * b.a),
left_ AS (SELECT b.* FROM best b ANTI JOIN dropped d ON b.lang = d.lang AND b.phrase = d.phrase),
ranked AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, score FROM left_)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, score FROM ranked JOIN n USING (lang) WHERE rank <= 2000
"""
