"""Alignment of two tokenizers' tokens, and how many documents of the corpus link each pair of ids.

Each task tokenises slices of what it reads and works on Arrow columns: token lists are flattened with their parents,
byte ends are segmented cumulative sums, and a hash join on (document, end) finds where tokens of both sides end.
Linked pairs are grouped by document and then by pair; Spark sums the partial counts of all tasks and sends them back
to the slices' documents.
"""

from __future__ import annotations

import hashlib
import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import forget, portions, small_batches, written
from .packing import Encoder

SPACE = "▁"  # what pieces have in place of a space
DIRECT = 64  # pairs of a group that are listed one by one; of larger groups each pair of different ids is, with its times


class ByteLevel(Encoder):
    """A byte-level tokenizer for texts that begin with a space; names of special tokens are ordinary text."""

    def __init__(self, definition: str):
        super().__init__(definition)
        self.special = []
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(shown))}
        spec = json.loads(definition)
        entries = spec["model"]["vocab"] | {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.tokens = [b""] * (max(entries.values()) + 1)
        for entry, i in entries.items():
            self.tokens[i] = bytes(byte[c] for c in entry) if all(c in byte for c in entry) else entry.encode()

    def _slow(self, text: str) -> np.ndarray:
        if self.whole is None:
            from tokenizers import Tokenizer

            self.whole = Tokenizer.from_str(self.definition)
            self.whole.encode_special_tokens = True
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, dtype=np.uint32)


class Pieces(Encoder):
    """A sentencepiece model for texts that begin with the space that the model adds itself.

    Where no piece has a space but at its beginning, words that single spaces part are encoded one by one and kept; a
    model that changes texts (so that a word's pieces aren't as long as it is) encodes whole texts.
    """

    def __init__(self, model: bytes):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_proto=model)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.tokens = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)]
        self.size = np.array([len(t) for t in self.tokens], np.int64)
        self.special, self.lossy = [], False
        self.quick = None if any(SPACE in p[1:] and p.strip(SPACE) for p in pieces) else self._words
        self._forget()

    def _words(self, text: str) -> np.ndarray:
        if not text:
            return np.zeros(0, np.uint32)
        each = self.model.encode(text[1:].split(" "), num_threads=1)
        ids = np.fromiter((i for word in each for i in word), np.uint32, sum(map(len, each)))
        self.lossy |= int(self.size[ids].sum()) != len(text.encode())
        return ids

    def _slow(self, text: str) -> np.ndarray:
        return np.array(self.model.encode(text[1:]), dtype=np.uint32)

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        self.lossy = False
        found = super().encode(texts)
        if self.lossy:
            self._forget()
            found = [self._slow(t) for t in texts.to_pylist()]
        return found


class Aligner:
    """Aligns the tokens of slices of texts."""

    def __init__(self, definition: str, model: bytes):
        self.sides = ByteLevel(definition), Pieces(model)
        self.bytes = [pa.array(s.tokens, pa.binary()) for s in self.sides]
        self.width = [np.array([len(t) for t in s.tokens], np.int64) for s in self.sides]
        self.pairs = len(self.sides[1].tokens)  # pair = a * pairs + b
        marks = ((0, ","), (0, "|"), (1, ","), (1, ";"))
        self.shown = pa.array([f"{i}{m}".encode() for side, m in marks for i in range(len(self.sides[side].tokens))], pa.binary())
        self.shown_from = np.cumsum([0, *(len(self.sides[side].tokens) for side, _ in marks)])

    def align(self, texts: pa.Array) -> tuple[np.ndarray, list[str], pa.Table]:
        """Rows (n_a, n_b, n_groups, n_links) and digests of the groups of each text; a table doc, pair, times of linked pairs."""
        n = len(texts)
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        texts = pc.if_else(pc.match_substring(texts, SPACE), "", texts)  # a piece would have a space in its place
        spaced = pc.binary_join_element_wise(pa.scalar("", pa.large_string()), texts, pa.scalar(" ", pa.large_string()))
        spaced = pc.if_else(pc.equal(texts, ""), "", spaced)
        lists = [self._lists(side, spaced) for side in (0, 1)]
        ok = self._whole(lists, spaced)
        if not ok.all():
            lists = [self._only(x, ok) for x in lists]
        flat, parent, ends = zip(*(self._ends(side, x) for side, x in enumerate(lists)))
        tables = [pa.table({"doc": p, "end": e, f"at{side}": pa.array(np.arange(len(p)))}) for side, (p, e) in enumerate(zip(parent, ends))]
        cuts = tables[0].join(tables[1], keys=["doc", "end"], join_type="inner", use_threads=False)
        a_end, b_end = np.sort(cuts["at0"].to_numpy()), np.sort(cuts["at1"].to_numpy())  # both go up from group to group
        a, b = (f.to_numpy().astype(np.int64) for f in flat)
        a_from, b_from = np.r_[0, a_end[:-1] + 1][: len(a_end)], np.r_[0, b_end[:-1] + 1][: len(b_end)]
        na, nb = a_end + 1 - a_from, b_end + 1 - b_from
        doc = parent[0].to_numpy()[a_end].astype(np.int64) if len(a_end) else np.zeros(0, np.int64)
        links = na * nb
        total = np.zeros(n, np.int64)
        np.add.at(total, doc, links)
        rows = np.column_stack([np.bincount(parent[0].to_numpy(), minlength=n), np.bincount(parent[1].to_numpy(), minlength=n), np.bincount(doc, minlength=n), total])
        return rows, self._digests(a, b, a_from, b_from, na, nb, rows), self._linked(a, b, a_from, b_from, na, nb, doc)

    def _lists(self, side: int, texts: pa.Array) -> pa.ListArray:
        each = self.sides[side].encode(texts)
        offsets = np.cumsum([0, *map(len, each)])
        return pa.LargeListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(each).astype(np.int32) if each else np.zeros(0, np.int32)))

    def _whole(self, lists: list[pa.Array], texts: pa.Array) -> np.ndarray:
        """Which texts are what the tokens of both sides have, byte by byte."""
        want = texts.cast(pa.large_binary())
        ok = np.ones(len(texts), bool)
        for side, x in enumerate(lists):
            token = self.bytes[side].cast(pa.large_binary()).take(pc.list_flatten(x))
            joined = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(x), [None, pa.py_buffer(_starts(token)[x.offsets.to_numpy()].tobytes()), token.buffers()[2] or pa.py_buffer(b"")])
            ok &= pc.equal(joined, want).to_numpy(zero_copy_only=False)
        return ok

    @staticmethod
    def _only(x: pa.Array, ok: np.ndarray) -> pa.Array:
        empty = pa.array([[]], x.type)
        return pa.concat_arrays([x, empty]).take(pa.array(np.where(ok, np.arange(len(x)), len(x))))

    def _ends(self, side: int, x: pa.Array) -> tuple[pa.Array, pa.Array, pa.Array]:
        """All ids, the text of each, and where it ends in its text: a cumulative sum that begins anew with each text."""
        ids, parent = pc.list_flatten(x), pc.list_parent_indices(x)
        width = pa.array(self.width[side]).take(ids)
        ends = pc.cumulative_sum(width).to_numpy()
        first = (x.offsets.to_numpy() - x.offsets.to_numpy()[0])[:-1]
        before = np.r_[0, ends][first]
        return ids, parent, pa.array(ends - before[parent.to_numpy()])

    def _digests(self, a, b, a_from, b_from, na, nb, rows) -> list[str]:
        """The groups of each text as a1,a2|b1;a3|b2 by digest; '' without tokens."""
        group_a, group_b = np.repeat(np.arange(len(na)), na), np.repeat(np.arange(len(nb)), nb)
        code = np.empty(len(a) + len(b), np.int64)
        last_a, last_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        last_a[a_from + na - 1] = 1
        last_b[b_from + nb - 1] = 1
        code[np.arange(len(a)) + b_from[group_a]] = a + self.shown_from[last_a]
        code[np.arange(len(b)) + (a_from + na)[group_b]] = b + self.shown_from[2 + last_b]
        text = self.shown.cast(pa.large_binary()).take(pa.array(code))
        at = _starts(text)[np.cumsum([0, *(rows[:, 0] + rows[:, 1])])].tolist()
        data = memoryview(text.buffers()[2] or b"")
        return [hashlib.sha256(data[s : e - 1]).hexdigest() if s < e else "" for s, e in zip(at[:-1], at[1:])]

    def _linked(self, a, b, a_from, b_from, na, nb, doc) -> pa.Table:
        few = np.flatnonzero(na * nb <= DIRECT)
        links = (na * nb)[few]
        group = np.repeat(few, links)
        k = np.arange(len(group)) - np.repeat(np.cumsum(links) - links, links)
        parts = [(doc[group], a[a_from[group] + k // nb[group]] * self.pairs + b[b_from[group] + k % nb[group]], np.ones(len(group), np.int64))]
        for g in np.flatnonzero(na * nb > DIRECT).tolist():
            ids_a, times_a = np.unique(a[a_from[g] : a_from[g] + na[g]], return_counts=True)
            ids_b, times_b = np.unique(b[b_from[g] : b_from[g] + nb[g]], return_counts=True)
            parts.append((np.full(len(ids_a) * len(ids_b), doc[g]), (ids_a[:, None] * self.pairs + ids_b).ravel(), (times_a[:, None] * times_b).ravel()))
        columns = [pa.array(np.concatenate(c)) for c in zip(*parts)]
        found = pa.table(columns, ["doc", "pair", "n"]).group_by(["doc", "pair"], use_threads=False).aggregate([("n", "sum")])
        return found.rename_columns({"n_sum": "times"}).select(["doc", "pair", "times"])


def _starts(a: pa.Array) -> np.ndarray:
    """The offsets of a large binary array's values."""
    return np.frombuffer(a.buffers()[1], np.int64)[a.offset : a.offset + len(a) + 1] if len(a) else np.zeros(1, np.int64)


class Block:
    """Texts whose pairs are counted and answered together."""

    def __init__(self, number: int):
        self.number, self.doc_ids, self.rows, self.digests, self.linked, self.size = number, [], [], [], [], 0

    def add(self, aligner: Aligner, batch: pa.RecordBatch) -> None:
        rows, digests, linked = aligner.align(batch.column("text"))
        at = pa.array(linked["doc"].to_numpy() + len(self.digests))
        self.linked.append(linked.set_column(0, "doc", at))
        self.doc_ids += batch.column("doc_id").to_pylist()
        self.rows.append(rows)
        self.digests += digests
        self.size += max(1, batch.nbytes)

    def row(self) -> pa.RecordBatch:
        linked, rows = pa.concat_tables(self.linked), np.concatenate(self.rows)
        found = linked.group_by("pair", use_threads=False).aggregate([("doc", "count")])
        pairs, docs = found["pair"].to_numpy(), found["doc_count"].to_numpy()
        by = np.argsort(pairs)
        pairs, docs = pairs[by], docs[by]
        doc, pair, times = (linked[c].to_numpy() for c in ("doc", "pair", "times"))
        by = np.argsort(doc, kind="stable")
        at = np.searchsorted(pairs, pair[by]).astype(np.uint32)
        kept = {"doc_ids": pa.array([self.doc_ids], pa.list_(pa.int64())), "digests": pa.array([self.digests], pa.list_(pa.string()))}
        kept |= {c: pa.array([zlib.compress(np.ascontiguousarray(x).tobytes(), 1)], pa.binary()) for c, x in (("numbers", rows), ("held", np.bincount(doc, minlength=len(rows))), ("at", at), ("times", times[by]))}
        return pa.record_batch({"block": pa.array([self.number], pa.int64()), **kept, "pairs": pa.array([pairs.tolist()], pa.list_(pa.int64())), "docs": pa.array([docs.tolist()], pa.list_(pa.int64()))})


KEPT = "block long, doc_ids array<long>, digests array<string>, numbers binary, held binary, at binary, times binary"
OUT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def align_tokens(docs: DataFrame, definition: str, model: str, block_bytes: int = 12 << 20) -> DataFrame:
    """One row for each document: its tokens by both tokenizers, where they meet, and how its links fare in the corpus.

    definition: the path of a byte-level tokenizer's file (A, for the text with a space in front); model: that of a
    sentencepiece model (B, which adds the space). Names of special tokens in texts are ordinary text. Offsets at which
    tokens of both end cut a text into groups; tokens of a group are linked, each of A with each of B. n_best counts
    the links whose pair of ids is linked in as many documents as any pair with that id of A; count_sum adds the
    numbers of documents up. Null and empty texts, and texts that tokens don't give back byte by byte, have no tokens:
    zeros, and an empty digest. docs needs doc_id (null stays null) and text; repeated rows count as documents each.

    Pairs are counted within blocks of about block_bytes bytes of texts; only a block's different pairs are shuffled.
    """
    small_batches(docs.sparkSession)
    with open(definition, encoding="utf-8") as f, open(model, "rb") as g:
        public = f.read(), g.read()
    shared = docs.sparkSession.sparkContext.broadcast(public)  # two files of a few megabytes
    width = _aligner(public).pairs

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, block = _aligner(shared.value), Block(TaskContext.get().partitionId() << 24)
        for batch in portions(batches):
            block.add(aligner, batch)
            if block.size >= block_bytes:
                yield block.row()
                block = Block(block.number + 1)
        if block.size:
            yield block.row()

    def answered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                numbers, held, at, times = (np.frombuffer(zlib.decompress(row.column(c)[0].as_py()), t) for c, t in (("numbers", np.int64), ("held", np.int64), ("at", np.uint32), ("times", np.int64)))
                told = row.column("told")[0].values
                count, best = np.zeros(len(told) if told is not None else 0, np.int64), np.zeros(len(told) if told is not None else 0, bool)
                if told is not None:
                    place = told.field("place").to_numpy()
                    count[place] = told.field("count").to_numpy()
                    best[place] = told.field("best").to_numpy(zero_copy_only=False)
                numbers = numbers.reshape(-1, 4)
                ends = np.cumsum(held)
                added = [np.r_[0, np.cumsum(x)] for x in (times * best[at], times * count[at])]
                sums = [x[ends] - x[ends - held] for x in added]
                cols = [row.column("doc_ids")[0].values, *(pa.array(numbers[:, k]) for k in range(4)), *map(pa.array, sums), row.column("digests")[0].values]
                yield pa.record_batch(cols, [c.split()[0] for c in OUT.split(", ")])

    lean = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    table = written(lean.mapInArrow(aligned, f"{KEPT}, pairs array<long>, docs array<long>"), "aligned")
    counts = table.select(F.explode(F.arrays_zip("pairs", "docs")).alias("p")).groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.docs").alias("count"))
    counts = written(counts, "pair-counts")
    most = counts.groupBy(F.expr(f"pair div {width}").alias("a")).agg(F.max("count").alias("most"))  # one row for each id of A at most
    counts = counts.join(F.broadcast(most), F.expr(f"pair div {width}") == F.col("a")).select("pair", "count", (F.col("count") == F.col("most")).alias("best"))
    asked = table.select("block", F.posexplode("pairs").alias("place", "pair"))
    told = asked.join(counts, "pair").groupBy("block").agg(F.collect_list(F.struct("place", "count", "best")).alias("told"))
    both = table.drop("pairs", "docs").join(told, "block", "left")
    return both.mapInArrow(answered, OUT)


_ALIGNER: list = [None, None]


def _aligner(public: tuple[str, bytes]) -> Aligner:
    """One for each Python worker."""
    if _ALIGNER[0] is not public:
        _ALIGNER[:] = public, Aligner(*public)
    return _ALIGNER[1]
