"""Packing of token sequences by minimum bin slack.

Documents are tokenised, cut into whole windows of the capacity and one remainder, and the remainders of a block
of documents fill windows by subset-sum over the multiset of their lengths: a bitset holds the sums that can be
reached, the highest one is taken, and its counts are found by walking the bitsets back. What is still free in a
window is filled by cutting one more remainder, so that only the last sequences of a task can be short; their
lengths are powers of two, which are not padded.
"""

from __future__ import annotations

import json
import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import held_by_worker, portions, small_batches, written

MOST_CACHED = 300_000  # pieces whose ids a worker keeps; beyond that it begins anew
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"  # fixed value: the public byte-level pattern


class Encoder:
    """Ids as little-endian 32-bit integers, equal to those of the tokenizer file.

    A text is cut before each space that a non-space follows: the byte-level pattern always begins a new piece
    there. Pieces repeat, so each worker keeps the ids of those that it met; the ones that a batch lacks are
    encoded together. Texts in which white space follows a space, or that hold the name of a special token, are
    encoded by the tokenizer itself.
    """

    def __init__(self, definition: str):
        self.definition, self.whole = definition, None
        spec = json.loads(definition)
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        self.quick = self._quick(spec)
        self._forget()

    def _forget(self) -> None:
        """known: piece (after a space; with a space in front if it begins a text) to its number; ids of number i are flat[start[i] : start[i + 1]]."""
        self.known: dict[str, int] = {}
        self.flat, self.start, self.used = np.zeros(1 << 20, np.uint32), np.zeros(1 << 18, np.int64), 0

    def _quick(self, spec: dict):
        """An encoder of ordinary text from the same vocabulary; None where the tokenizer is of another kind."""
        pre = spec.get("pre_tokenizer") or {}
        if pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or spec.get("normalizer") or spec["model"]["type"] != "BPE":
            return None
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(shown))}
        try:
            import tiktoken

            ranks = {bytes(byte[c] for c in piece): i for piece, i in spec["model"]["vocab"].items() if piece not in self.special}
            self.size = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
            for piece, i in ranks.items():
                self.size[i] = len(piece)
            quick = tiktoken.Encoding("from-file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        except (ImportError, KeyError, ValueError):
            return None
        return lambda text: quick.encode_to_numpy(text, disallowed_special=())

    def _slow(self, text: str) -> np.ndarray:
        if self.whole is None:  # most texts don't need it, and it takes tens of megabytes
            from tokenizers import Tokenizer

            self.whole = Tokenizer.from_str(self.definition)
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    def _learn(self, keys: list[str], ids: np.ndarray, ends: np.ndarray) -> None:
        """Numbers the keys; ends: where each one's ids end."""
        n, at = len(self.known), self.used
        while len(self.flat) < at + len(ids):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while len(self.start) < n + len(keys) + 1:
            self.start = np.concatenate([self.start, np.zeros_like(self.start)])
        self.flat[at : at + len(ids)] = ids
        self.start[n + 1 : n + len(keys) + 1] = at + ends
        self.used += len(ids)
        self.known.update(zip(keys, range(n, n + len(keys))))

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text; a null text is empty."""
        texts = pc.fill_null(texts, "")
        if not len(texts):
            return []
        if self.quick is None:
            return [self._slow(t) for t in texts.to_pylist()]
        if len(self.known) >= MOST_CACHED:
            self._forget()
        cut = pc.split_pattern(texts, " ")
        off = cut.offsets.to_numpy().astype(np.int64)
        pieces = pc.dictionary_encode(cut.values.slice(off[0], off[-1] - off[0]))
        off -= off[0]
        each = pieces.dictionary.to_numpy(zero_copy_only=False).tolist()
        number = list(map(self.known.get, each))
        lacking = [(i, p) for i, (p, k) in enumerate(zip(each, number)) if k is None and p and not p[0].isspace()]
        if lacking:
            new = [p for _, p in lacking]
            ids = self.quick(" " + " ".join(new))
            width = pc.binary_length(pa.array(new)).to_numpy().astype(np.int64) + 1
            n = len(self.known)
            self._learn(new, ids, np.searchsorted(np.cumsum(self.size[ids]), np.cumsum(width)) + 1)
            for k, (i, _) in enumerate(lacking):
                number[i] = n + k
        number = np.array([-1 if k is None else k for k in number], dtype=np.int64)[pieces.indices.to_numpy()]
        odd = np.zeros(len(texts), bool)
        for k, i in enumerate(off[:-1].tolist()):  # what begins a text has no space before it
            first = each[pieces.indices[i].as_py()]
            key = " " + first
            if key not in self.known:
                ids = self.quick(first) if first else np.zeros(0, np.uint32)
                self._learn([key], ids, np.array([len(ids)]))
            number[i] = self.known[key]
            odd[k] = first.isspace()
        odd |= np.minimum.reduceat(number, off[:-1]) < 0
        for s in self.special:
            odd |= pc.match_substring(texts, s).to_numpy(zero_copy_only=False)
        number = np.maximum(number, 0)
        size = self.start[number + 1] - self.start[number]
        ends = np.cumsum(size)
        ids = self.flat[np.arange(ends[-1]) + np.repeat(self.start[number] - (ends - size), size)] if len(ends) else self.flat[:0]
        cuts = ends[off[1:] - 1].tolist()
        return [self._slow(texts[k].as_py()) if odd[k] else ids[a:b] for k, (a, b) in enumerate(zip([0, *cuts[:-1]], cuts))]


def fill(free: int, lengths: list[int], count: dict[int, int]) -> tuple[int, dict[int, int]]:
    """The sum nearest to free from below that some of the lengths (sorted; each there count times) reach, and how many of each."""
    reach, most, steps = 1, (1 << (free + 1)) - 1, []
    for i in range(bisect_right(lengths, free) - 1, -1, -1):
        n = lengths[i]
        steps.append((n, reach))
        left, k = min(count[n], free // n), 1
        while left > 0:
            take = min(k, left)
            reach |= reach << (take * n) & most
            left, k = left - take, 2 * k
        if reach >> free & 1:
            break
    best = at = reach.bit_length() - 1
    chosen: dict[int, int] = {}
    for n, before in reversed(steps):
        while not before >> at & 1:
            at -= n
            chosen[n] = chosen.get(n, 0) + 1
    return best, chosen


class Packer:
    """Fills windows from remainders; what doesn't fill a window is carried to the next block."""

    def __init__(self, capacity: int):
        self.capacity, self.items, self.lengths, self.total, self.sequence = capacity, {}, [], 0, 0
        self.count: dict[int, int] = {}

    def add(self, item: tuple) -> None:
        """item: (document, its tokens, start, ids)."""
        n = len(item[3]) // 4
        if n not in self.items or not self.items[n]:
            self.items.setdefault(n, [])
            insort(self.lengths, n)
            self.count[n] = 0
        self.items[n].append(item)
        self.count[n] += 1
        self.total += n

    def take(self, n: int) -> tuple:
        item = self.items[n].pop()
        self.count[n] -= 1
        self.total -= n
        if not self.count[n]:
            del self.lengths[bisect_left(self.lengths, n)]
        return item

    def cut(self, n: int) -> tuple:
        """The first n tokens of the longest item; its rest stays."""
        doc, tokens, start, ids = self.take(self.lengths[-1])
        if len(ids) > 4 * n:
            self.add((doc, tokens, start + n, ids[4 * n :]))
        return doc, tokens, start, ids[: 4 * n]

    def place(self, pieces: list[tuple]) -> Iterator[tuple]:
        at = 0
        for doc, tokens, start, ids in pieces:
            yield doc, start, len(ids) // 4, zlib.crc32(ids), tokens, self.sequence, at, ids
            at += len(ids) // 4
        self.sequence += 1

    def windows(self) -> Iterator[tuple]:
        """All windows that can be filled to the last token."""
        while self.total >= self.capacity:
            longest = self.lengths[-1]
            first = self.take(longest)
            best, chosen = fill(self.capacity - longest, self.lengths, self.count)
            times = min([c // chosen[n] for n, c in ((n, self.count[n]) for n in chosen)], default=0) if best == self.capacity - longest else 0
            pieces = [first, *(self.take(n) for n, k in chosen.items() for _ in range(k))]
            if slack := self.capacity - longest - best:
                pieces.append(self.cut(slack))
            yield from self.place(pieces)
            for _ in range(times - 1):  # the same multiset again, as often as its lengths are there
                if self.count.get(longest, 0) - chosen.get(longest, 0) < 1:
                    break
                yield from self.place([self.take(longest), *(self.take(n) for n, k in chosen.items() for _ in range(k))])

    def rest(self) -> Iterator[tuple]:
        """What is less than a window, in sequences whose lengths are powers of two."""
        while self.total:
            free, pieces = 1 << (self.total.bit_length() - 1), []
            while free:
                n = min(free, self.lengths[-1])
                pieces.append(self.cut(n))
                free -= n
            yield from self.place(pieces)


PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence long, offset long, part int, ids binary"


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 1, block_tokens: int = 1_000_000, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents in sequences of at most capacity tokens.

    docs needs doc_id and text; further columns are ignored. A null text is empty and has one token, end_id.
    Repeated rows and null ids are packed like any other row. An empty table gives no rows. Returns doc_id,
    start, length, ids_crc32, doc_tokens, sequence_id, offset and, with_ids, the piece's ids as little-endian
    unsigned 32-bit integers. Nothing is shuffled but one row for each task: every task packs what it reads, in
    blocks of about block_tokens tokens, and its sequences get numbers after those of the tasks before it.
    """
    spark = docs.sparkSession
    small_batches(spark)
    with open(tokenizer_path, encoding="utf-8") as f:
        definition = spark.sparkContext.broadcast(f.read())
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, packer, held, part = held_by_worker((definition.value,), Encoder), Packer(capacity), 0, TaskContext.get().partitionId()
        rows: list[tuple] = []

        def sent(least: int = 0) -> Iterator[pa.RecordBatch]:
            """What has been placed, in batches of a few megabytes."""
            most = 1000 if with_ids else 20_000
            while len(rows) > least:
                *cols, ids = zip(*rows[:most])
                del rows[:most]
                yield pa.record_batch([*(pa.array(c, pa.int64()) for c in cols), pa.array([part] * len(ids), pa.int32()), pa.array(ids if with_ids else [None] * len(ids), pa.binary())], PIECE_NAMES)

        def place(pieces: Iterator[tuple]) -> None:
            rows.extend(pieces if with_ids else ((*p[:-1], None) for p in pieces))

        for batch in portions(batches):
            for doc, ids in zip(batch.column("doc_id").to_pylist(), encoder.encode(batch.column("text"))):
                ids = ids.astype("<u4").tobytes() + end
                n = len(ids) // 4
                whole = n // capacity * capacity
                for s in range(0, whole, capacity):
                    place(packer.place([(doc, n, s, ids[4 * s : 4 * (s + capacity)])]))
                if n > whole:
                    packer.add((doc, n, whole, ids[4 * whole :]))
                held += n
                if held >= block_tokens:
                    place(packer.windows())
                    held = 0
            yield from sent(1000)
        place(packer.windows())
        place(packer.rest())
        yield from sent()

    pieces = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, PIECES)
    pieces = written(pieces if with_ids else pieces.drop("ids"), "pieces")
    ends = pieces.groupBy("part").agg((F.max("sequence") + 1).alias("n"))
    # one row for each task that read documents
    starts = ends.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("base"))
    out = pieces.join(F.broadcast(starts), "part").withColumn("sequence_id", F.col("sequence") + F.col("base"))
    return out.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", *(["ids"] if with_ids else []))


PIECE_NAMES = [c.split()[0] for c in PIECES.split(", ")]
