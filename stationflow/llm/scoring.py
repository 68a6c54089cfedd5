"""LM scoring: a weighted backoff automaton of smoothed n-grams, traversed from left to right.

Each n-gram of up to order - 1 tokens that training showed is a state. A state has an arc for each token that followed
it, and a failure arc to the state without its first token, at the weight that smoothing leaves; the last one's failure
arc ends at the smoothed unigrams. A text begins in the state of the text's end, which is a token too; the traversal
carries the state of the last tokens, follows arcs and failure arcs, and adds up log10 probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix64, portions, small_batches, written
from .language import bucket

LAST = b"\n"  # the end of a text, among the tokens
BLOCK_BYTES = 24 << 20
PART_KEYS = 2_000_000  # n-grams of a part that one task sums


def _squeezed(x: np.ndarray) -> bytes:
    """Integers as planes of bytes, of which the high ones are mostly zeros, compressed."""
    width = x.dtype.itemsize
    return pa.compress(np.ascontiguousarray(x.view(np.uint8).reshape(-1, width).T).data, codec="zstd", asbytes=True) if len(x) else b""


def _spread(data: bytes, n: int, kind: str) -> np.ndarray:
    width = np.dtype(kind).itemsize
    if not n:
        return np.zeros(0, kind)
    planes = np.frombuffer(pa.decompress(data, n * width, codec="zstd"), np.uint8).reshape(width, n)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def _steps(keys: np.ndarray) -> bytes:
    """Sorted keys by their differences."""
    return _squeezed(np.diff(keys, prepend=np.uint64(0)).astype("<u8"))


def part_of(keys: np.ndarray, parts: int) -> np.ndarray:
    """The part of each key; sorted keys have sorted parts."""
    return ((keys >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


class Text:
    """The documents of a block as token numbers, each with the end of a text before it, and the keys of their n-grams."""

    def __init__(self, words: bytes, ids: np.ndarray, lengths: np.ndarray, held: np.ndarray, order: int):
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words.split(b" ")), dtype=np.uint64, count=words.count(b" ") + 1)
        self.by = np.argsort(hashes, kind="stable")
        self.words = hashes[self.by]  # the keys of the tokens, sorted
        self.number = np.empty(len(hashes), np.int32)
        self.number[self.by] = np.arange(len(hashes), dtype=np.int32)
        self.ids, self.lengths = self.number[ids], lengths
        begin = np.cumsum(lengths) - lengths
        self.rank = (np.arange(len(ids)) - np.repeat(begin, lengths)).astype(np.int32)  # tokens before each token
        self.learned = np.repeat(~held, lengths)
        self.before = np.roll(self.ids, 1)
        self.before[begin] = self.number[0]  # number 0 is the end of a text
        self.order = order

    def grams(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each order k from two tokens on: k, the keys of its n-grams in the order of the text, and whether training has them."""
        key = self.words[self.before]
        for k in range(2, self.order + 1):
            # the key of k tokens follows from that of the k - 1 up to the last but one, and the last
            key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + self.words[self.ids] + np.uint64(k))
            valid = self.rank >= k - 2
            now = [key[valid]]
            key = np.roll(key, 1) if k < self.order else None
            yield k, now.pop(), self.learned[valid]  # nothing here holds the keys while they are counted

    def token_counts(self) -> np.ndarray:
        return np.bincount(self.ids[self.learned], minlength=len(self.words))


BLOCKS = "block long, n_docs long, words binary, n_tokens long, ids binary, lengths binary, held binary, docs binary, null_docs binary"
SENT = "part int, block long, kind int, n int, keys binary, times binary"
SUMS = "kind int, block long, part int, n int, rest binary, tokens long, distinct long"
DIGEST = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
TYPES = {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary(), "double": pa.float64()}


def _batch(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    names, kinds = zip(*(c.split() for c in schema.split(", ")))
    cols = list(zip(*rows)) or [()] * len(names)
    return pa.record_batch([pa.array(c, TYPES[k]) for c, k in zip(cols, kinds)], names)


def _rows(batch: pa.RecordBatch, schema: str) -> Iterator[tuple]:
    return zip(*(batch.column(c.split()[0]).to_pylist() for c in schema.split(", ")))


class Block:
    """A stretch of documents as numbers of its distinct tokens."""

    def __init__(self, number: int):
        self.number, self.ids, self.docs, self.held, self.seqs, self.size = number, {LAST: 0}, [], [], [], 0

    def add(self, doc: int | None, held: bool, text: bytes | None) -> None:
        words = (text or b"").lower().split()
        words.append(LAST)
        ids = self.ids
        for w in set(words).difference(ids):
            ids[w] = len(ids)
        self.seqs.append(np.fromiter(map(ids.__getitem__, words), dtype=np.int32, count=len(words)))
        self.docs.append(doc)
        self.held.append(held)
        self.size += len(text or b"")

    def row(self) -> tuple:
        lengths = np.array([len(s) for s in self.seqs], "<i8")
        ids = np.concatenate(self.seqs)
        # frequent tokens get low numbers, which compress better; the end of a text keeps 0
        count = np.bincount(ids, minlength=len(self.ids))
        count[0] = len(ids) + 1
        by = np.argsort(-count, kind="stable")
        new = np.empty(len(by), np.int32)
        new[by] = np.arange(len(by), dtype=np.int32)
        words = list(self.ids)
        docs = np.array([d or 0 for d in self.docs], "<i8")
        bits = lambda x: np.packbits(np.array(x, bool)).tobytes()
        return self.number, len(docs), b" ".join([words[i] for i in by.tolist()]), len(ids), _squeezed(new[ids].astype("<u4")), _squeezed(lengths), bits(self.held), _squeezed(docs), bits([d is None for d in self.docs])


def _text(words: bytes, n_tokens: int, ids: bytes, lengths: bytes, held: bytes, n_docs: int, order: int) -> Text:
    held_ = np.unpackbits(np.frombuffer(held, np.uint8), count=n_docs).astype(bool)
    return Text(words, _spread(ids, n_tokens, "<u4"), _spread(lengths, n_docs, "<i8"), held_, order)


def lm_scores(docs: DataFrame, folds: int = 5, held_out: int = 1, smoothing: float = 0.5, strength: float = 64.0, order: int = 3, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every document.

    A-Z are lower-cased, tokens are what ASCII white space separates, and one end of the text. Documents whose
    crc32(doc_id) modulo folds is held_out are scored, not learned from; a null doc_id is never held out. A null
    text is empty: its end is its only token. Repeated rows are learned from, and scored, as often as they are there.

    base_score has the smoothed unigrams alone. score is the automaton's: a state that training showed c times has an
    arc of (times) / (c + strength) for each token that followed it, and a failure arc of strength / (c + strength) to
    the next shorter state; what arcs and failure arcs lead to adds up to one over the vocabulary and one unknown token.
    All n-grams of training up to `order` tokens have their arcs, whatever their number.

    Each task turns what it reads into blocks of about block_bytes of text: documents as numbers of the block's distinct
    tokens. Only distinct n-grams travel, as sorted 64-bit keys with their counts, to the part that sums them over all
    blocks, and back goes what other blocks add, in the same order. Parts are ranges of keys, which are hashes: a
    frequent n-gram is one key of each block, so no part is larger than others, and their number follows from the
    tokens. Texts aren't shuffled.
    """
    spark = docs.sparkSession
    small_batches(spark)
    fold = F.coalesce(bucket(F.col("doc_id"), folds) == held_out, F.lit(False))
    lean = docs.select(F.col("doc_id").cast("long").alias("doc_id"), fold.alias("held_out"), F.col("text").cast("binary").alias("text"))

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = Block(TaskContext.get().partitionId() << 24)
        for batch in portions(batches):
            for r in _rows(batch, "doc_id long, held_out boolean, text binary"):
                block.add(*r)
            if block.size >= block_bytes:
                yield _batch(BLOCKS, [block.row()])
                block = Block(block.number + 1)
        if block.docs:
            yield _batch(BLOCKS, [block.row()])

    table = written(lean.mapInArrow(blocks, BLOCKS), "blocks")
    tokens = int(table.agg(F.sum("n_tokens").alias("n")).first().n or 0)
    parts = max(16, -(-tokens * (order - 1) // PART_KEYS))
    own = "block long, n_docs long, words binary, n_tokens long, ids binary, lengths binary, held binary"

    def dealt(block: int, kind: int, keys: np.ndarray, times: np.ndarray) -> Iterator[pa.RecordBatch]:
        cuts = np.searchsorted(part_of(keys, parts), np.arange(parts + 1)).tolist()
        for first in range(0, parts, 64):
            slices = [(p, cuts[p], cuts[p + 1]) for p in range(first, min(first + 64, parts)) if cuts[p] < cuts[p + 1]]
            if slices:
                yield _batch(SENT, [(p, block, kind, b - a, _steps(keys[a:b]), _squeezed(times[a:b].astype("<u4"))) for p, a, b in slices])

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, n_docs, *row in _rows(batch, own):
                text = _text(*row, n_docs, order)
                yield from dealt(block, 1, text.words, text.token_counts())
                for k, keys, learned in text.grams():  # one order at a time: its keys are what a task holds most of
                    grams, times = np.unique(keys[learned], return_counts=True)
                    more = np.unique(keys[~learned])
                    del keys, learned
                    more = more[~np.isin(more, grams, assume_unique=True)]
                    grams, times = np.concatenate([grams, more]), np.concatenate([times, np.zeros(len(more), np.int64)])
                    by = np.argsort(grams)
                    yield from dealt(block, k, grams[by], times[by])
                del text

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of one part and kind come one after another; their sums are known when the next ones begin."""

        def close(part: int, kind: int, held: list[tuple]) -> Iterator[pa.RecordBatch]:
            times = np.concatenate([t for *_, t in held]).astype(np.int64)
            found, at = np.unique(np.concatenate([k for _, k, _ in held]), return_inverse=True)
            total = np.bincount(at, weights=times, minlength=len(found)).astype(np.int64)
            if kind == 1:
                yield _batch(SUMS, [(0, None, part, None, None, int(total.sum()), int((total > 0).sum()))])
            rest, a = total[at] - times, 0
            for block, keys, _ in held:
                yield _batch(SUMS, [(kind, block, part, len(keys), _squeezed(rest[a : a + len(keys)].astype("<i8")), None, None)])
                a += len(keys)

        now, held = None, []
        for batch in batches:
            for part, block, kind, n, keys, times in _rows(batch, SENT):
                if (part, kind) != now:
                    if held:
                        yield from close(*now, held)
                    now, held = (part, kind), []
                held.append((block, np.cumsum(_spread(keys, n, "<u8")), _spread(times, n, "<u4")))
        if held:
            yield from close(*now, held)

    messages = table.select(*(c.split()[0] for c in own.split(", "))).mapInArrow(sent, SENT).repartition("part").sortWithinPartitions("part", "kind", "block")
    answers = written(messages.mapInArrow(summed, SUMS), "sums")
    sums = answers.where("kind = 0").agg(F.sum("tokens").alias("n"), F.sum("distinct").alias("v")).first()
    train_tokens, kinds = int(sums.n or 0), int(sums.v or 0)
    joined = f"{BLOCKS}, kind int, part int, n int, rest binary"

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A block's rows in order: its documents, then what other blocks add to its n-grams by kind and part."""
        open_: Counted | None = None
        for batch in batches:
            for block, n_docs, words, n_tokens, ids, lengths, held, doc_ids, null_docs, kind, part, n, rest in _rows(batch, joined):
                if kind == 0:
                    if open_ is not None:
                        yield _batch(DIGEST, open_.rows(smoothing, strength, train_tokens, kinds))
                        open_ = None  # before the next block is unpacked
                    held_ = np.unpackbits(np.frombuffer(held, np.uint8), count=n_docs).astype(bool).tolist()
                    none = np.unpackbits(np.frombuffer(null_docs, np.uint8), count=n_docs).astype(bool).tolist()
                    named = [None if x else d for d, x in zip(_spread(doc_ids, n_docs, "<i8").tolist(), none)]
                    open_ = Counted(_text(words, n_tokens, ids, lengths, held, n_docs, order), named, held_, parts)
                else:
                    open_.add(kind, part, _spread(rest, n, "<i8"))
        if open_ is not None:
            yield _batch(DIGEST, open_.rows(smoothing, strength, train_tokens, kinds))

    both = table.withColumn("kind", F.lit(0)).unionByName(answers.where("kind > 0").select("kind", "block", "part", "n", "rest"), allowMissingColumns=True)
    both = both.select(*(c.split()[0] for c in joined.split(", ")))
    return both.repartition("block").sortWithinPartitions("block", "kind", "part").mapInArrow(scored, DIGEST)


class Counted:
    """A block's documents with the counts of their n-grams in all of training: the part of the automaton that they traverse."""

    def __init__(self, text: Text, docs: list, held: list[bool], parts: int):
        self.text, self.docs, self.held = text, docs, held
        self.counts, self.cuts, self.at = {1: text.token_counts()}, {1: np.searchsorted(part_of(text.words, parts), np.arange(parts + 1))}, {}
        for k, keys, learned in text.grams():
            by = np.argsort(keys)
            keys = keys[by]
            new = np.r_[True, keys[1:] != keys[:-1]][: len(keys)]
            grams, self.at[k] = keys[new], np.empty(len(keys), np.int32)
            del keys
            self.at[k][by] = np.cumsum(new, dtype=np.int32) - 1
            del by, new
            self.counts[k] = np.bincount(self.at[k][learned], minlength=len(grams))
            self.cuts[k] = np.searchsorted(part_of(grams, parts), np.arange(parts + 1))

    def add(self, kind: int, part: int, rest: np.ndarray) -> None:
        self.counts[kind][self.cuts[kind][part] : self.cuts[kind][part + 1]] += rest

    def rows(self, smoothing: float, strength: float, train_tokens: int, kinds: int) -> list[tuple]:
        """Walks all texts from left to right at once: at each token the chain of states is one n-gram after another."""
        t, tokens = self.text, self.counts[1]
        seen = tokens[t.ids]
        prob = (seen + smoothing) / (train_tokens + smoothing * (kinds + 1))
        base = np.log10(prob)
        state = tokens[t.before].astype(np.float64)  # how often training showed the state before each token
        for k, at in self.at.items():
            on = t.rank >= k - 2
            arc = np.zeros(len(prob))
            arc[on] = self.counts[k][at]
            # an arc besides the failure arc to the shorter state; a state that training never showed has the latter alone
            prob = np.where(on, (arc + strength * prob) / (state + strength), prob)
            state = np.roll(arc, 1)
        begin = np.cumsum(t.lengths) - t.lengths
        score, known = np.add.reduceat(np.log10(prob), begin), np.add.reduceat((seen > 0).astype(np.int64), begin)
        return list(zip(self.docs, self.held, t.lengths.tolist(), known.tolist(), [train_tokens] * len(begin), np.add.reduceat(base, begin).tolist(), score.tolist()))
