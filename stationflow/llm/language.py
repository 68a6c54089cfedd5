"""Language ID of words and texts by a linear-chain conditional random field."""

from __future__ import annotations

import re
import sys
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import hash_sample, held_by_worker, portions, small_batches

# word characters that are neither letters nor decimal digits: fractions, powers, Roman and circled numbers
NUMBERS = frozenset(c for c in map(chr, range(128, sys.maxunicode + 1)) if c.isalnum() and not c.isalpha() and not c.isdecimal())
GAPS = dict.fromkeys(map(ord, NUMBERS), " ")
WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    """The runs of letters of a text, in lower case."""
    text = (text or "").lower()
    if not text.isascii() and not NUMBERS.isdisjoint(text):
        text = text.translate(GAPS)
    return WORD.findall(text)


BUCKETS = 1 << 16  # hashed features
SEGMENT = 64  # words of a segment; segments are chained by their transfer matrices
MOST_WORDS = 150_000  # words whose scores a worker keeps; beyond that it begins anew
NEW_WORDS = 1 << 13  # words whose features are made at once


def _hashed(kind: int, *parts: np.ndarray) -> np.ndarray:
    """Buckets of features: a kind and its letters."""
    h = np.full(len(parts[0]), kind, np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for p in parts:
        h = (h ^ p) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
    return ((h * np.uint64(0x94D049BB133111EB)) >> np.uint64(48)).astype(np.int64) & (BUCKETS - 1)


def features(words: list[str], lexicon: dict[str, tuple[int, ...]]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Affixes of one to three letters, bigrams and trigrams, the word itself, and the lexica that have it, for many words at once.

    Groups of (hashed features, numbers of their words, in order); in the first two, those of the bigrams and trigrams,
    each word has several, and in the others one at most.
    """
    n = len(words)
    size = np.fromiter(map(len, words), dtype=np.int64, count=n)
    text = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    start, each = np.cumsum(size) - size, np.arange(n)
    framed = np.empty(len(text) + 2 * n, np.uint64)
    framed[np.arange(len(text)) + np.repeat(2 * each + 1, size)] = text
    framed[start + 2 * each], framed[start + size + 2 * each + 1] = ord("^"), ord("$")
    owner = np.repeat(each, size + 2)
    out = []
    for k in (2, 3):
        inside = owner[k - 1 :] == owner[: len(owner) - k + 1]
        out.append((_hashed(k, *(framed[j : len(framed) - k + 1 + j] for j in range(k)))[inside], owner[: len(owner) - k + 1][inside]))
    for k in (1, 2, 3):
        on = np.flatnonzero(size >= k)
        out.append((_hashed(3 + k, *(text[start[on] + j] for j in range(k))), on))
        out.append((_hashed(6 + k, *(text[start[on] + size[on] - k + j] for j in range(k))), on))
    out.append((_hashed(10, np.fromiter((zlib.crc32(w.encode("utf-8", "surrogatepass")) for w in words), dtype=np.uint64, count=n)), each))
    told = [(i, y) for i, w in enumerate(words) if w in lexicon for y in lexicon[w]]
    for y in sorted({y for _, y in told}):
        on = np.array([i for i, z in told if z == y])
        out.append((_hashed(11, np.full(len(on), y, np.uint64)), on))
    return out


@dataclass
class Model:
    """Labels, hashed feature weights (BUCKETS, labels), transitions (labels, labels) and lexicon."""

    labels: list[str]
    weights: np.ndarray
    moves: np.ndarray
    lexicon: dict[str, tuple[int, ...]] = field(default_factory=dict)


def word_scores(weights: np.ndarray, words: list[str], lexicon: dict[str, tuple[int, ...]]) -> np.ndarray:
    """Sum of the weights of each word's features."""
    out = np.zeros((len(words), weights.shape[1]))
    for g, (ids, of) in enumerate(features(words, lexicon) if words else ()):
        if g < 2:
            out += np.add.reduceat(weights[ids], np.flatnonzero(np.r_[True, of[1:] != of[:-1]]), axis=0)
        else:
            out[of] += weights[ids]
    return out


def fit(samples: list[tuple[str, str]], epochs: int = 30, mixed: int = 1500, seed: int = 7) -> Model:
    """A model from (text, label) samples by gradient ascent on the conditional likelihood.

    Words take the label of their text. So that transitions are learned too, `mixed` sequences are added in which
    stretches of texts of different labels follow one another.
    """
    labels = sorted({y for _, y in samples})
    k = len(labels)
    number = {y: i for i, y in enumerate(labels)}
    rng = np.random.default_rng(seed)
    sequences = [(w, [number[y]] * len(w)) for t, y in samples if (w := words_of(t))]
    counts: dict[str, Counter] = {}
    for w, ys in sequences:
        for x in set(w):
            counts.setdefault(x, Counter())[ys[0]] += 1
    lexicon = {x: tuple(y for y, n in c.items() if 10 * n >= 9 * c.total()) for x, c in counts.items() if c.total() >= 5}
    lexicon = {x: y for x, y in lexicon.items() if y}
    model = Model(labels, np.zeros((BUCKETS, k)), np.zeros((k, k)), lexicon)
    if k < 2 or not sequences:
        return model
    pure = list(sequences)
    for _ in range(mixed):
        words, ys = [], []
        for i in rng.integers(0, len(pure), 4):
            w, y = pure[i]
            n = int(rng.integers(4, 20))
            s = int(rng.integers(0, max(1, len(w) - n + 1)))
            words += w[s : s + n]
            ys += y[s : s + n]
        sequences.append((words, ys))
    vocabulary: dict[str, int] = {}
    ids = [np.array([vocabulary.setdefault(x, len(vocabulary)) for x in w]) for w, _ in sequences]
    groups = features(list(vocabulary), lexicon)
    owner = np.concatenate([of for _, of in groups])
    flat = np.concatenate([f for f, _ in groups])[np.argsort(owner, kind="stable")]
    size = np.bincount(owner, minlength=len(vocabulary))
    begin = np.cumsum(size) - size
    length = np.array([len(x) for x in ids])
    steps, n = int(length.max()), len(ids)
    grid, gold = np.zeros((steps, n), np.int64), np.full((steps, n), -1)
    for c, (x, (_, y)) in enumerate(zip(ids, sequences)):
        grid[: len(x), c], gold[: len(x), c] = x, y
    tokens = float((gold >= 0).sum())
    gold_moves = np.zeros((k, k))
    both = (gold[:-1] >= 0) & (gold[1:] >= 0)
    np.add.at(gold_moves, (gold[:-1][both], gold[1:][both]), 1.0)
    few = max(1, min(FIT_CELLS // (k * k), FIT_CELLS // (steps * k)))  # sequences of a block
    some = max(1, FIT_CELLS // (k * int(size.max())))  # words of a block
    params = [model.weights, model.moves]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for epoch in range(1, epochs + 1):
        of_word = np.empty((len(vocabulary), k))
        for a in range(0, len(vocabulary), some):
            b = min(a + some, len(vocabulary))
            of_word[a:b] = np.add.reduceat(model.weights[flat[begin[a] : begin[b - 1] + size[b - 1]]], begin[a:b] - begin[a], axis=0)
        by_word, moved = np.zeros((len(vocabulary), k)), np.zeros((k, k))
        for a in range(0, n, few):
            now = slice(a, a + few)
            t = int(length[now].max())
            moved += _expected(of_word[grid[:t, now]], model.moves, gold[:t, now], grid[:t, now], by_word)
        by_feature = np.stack([np.bincount(flat, weights=np.repeat(by_word[:, y], size), minlength=BUCKETS) for y in range(k)], 1)
        grads = [by_feature / tokens - 1e-6 * model.weights, (gold_moves - moved) / tokens - 1e-6 * model.moves]
        for p, g, m, v in zip(params, grads, first, second):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p += 0.2 * (m / (1 - 0.9**epoch)) / (np.sqrt(v / (1 - 0.99**epoch)) + 1e-8)
    return model


FIT_CELLS = 4 << 20  # numbers of an array while fitting, whatever the number of labels


def _expected(score: np.ndarray, moves: np.ndarray, gold: np.ndarray, grid: np.ndarray, by_word: np.ndarray) -> np.ndarray:
    """Expected transitions of a block of sequences (steps, sequences, labels); adds gold less expected labels to by_word."""
    steps, n, k = score.shape
    live = gold >= 0
    score = np.exp(score - score.max(axis=2, keepdims=True))
    move = np.exp(moves - moves.max())
    alpha, beta = np.empty((steps, n, k)), np.ones((steps, n, k))
    alpha[0] = score[0] / score[0].sum(1, keepdims=True)
    for t in range(1, steps):
        a = (alpha[t - 1] @ move) * score[t]
        alpha[t] = np.where(live[t, :, None], a / a.sum(1, keepdims=True), alpha[t - 1])
    moved = np.zeros((k, k))
    for t in range(steps - 2, -1, -1):
        ahead = score[t + 1] * beta[t + 1]
        b = ahead @ move.T
        on = live[t + 1]
        # the sum of all pairs of a step is alpha's product with b
        total = (alpha[t] * b).sum(1, keepdims=True)
        moved += ((alpha[t] / total)[on].T @ ahead[on]) * move
        beta[t] = np.where(on[:, None], b / b.sum(1, keepdims=True), 1.0)
    off = -alpha * beta
    off /= -off.sum(2, keepdims=True)
    off[live, gold[live]] += 1.0
    for y in range(k):
        by_word[:, y] += np.bincount(grid[live], weights=off[..., y][live], minlength=len(by_word))
    return moved


class Labeller:
    """Marginals of the labels of words, by forward and backward passes over segments of all texts of a batch."""

    def __init__(self, model: Model):
        self.model, self.number, self.scores, self.used = model, {}, np.zeros((1 << 12, len(model.labels)), np.float32), 0
        self.move = np.exp(model.moves - model.moves.max()).astype(np.float32)

    def ids(self, words: list[str]) -> np.ndarray:
        new = list(set(words).difference(self.number))
        if new:
            while len(self.scores) < self.used + len(new):
                self.scores = np.concatenate([self.scores, np.zeros_like(self.scores)])
            for a in range(0, len(new), NEW_WORDS):
                s = word_scores(self.model.weights, new[a : a + NEW_WORDS], self.model.lexicon)
                self.scores[self.used + a : self.used + a + len(s)] = np.exp(s - s.max(1, keepdims=True)) + 1e-12
            self.number.update(zip(new, range(self.used, self.used + len(new))))
            self.used += len(new)
        return np.fromiter(map(self.number.__getitem__, words), dtype=np.int64, count=len(words))

    def marginals(self, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Marginals (all words, labels) of the texts' words one after another, and each text's first word."""
        k = len(self.model.labels)
        size = np.array([len(t) for t in texts], np.int64)
        first = np.cumsum(size) - size
        if not size.sum():
            return np.zeros((0, k)), first
        if self.used >= MOST_WORDS:
            self.number, self.used = {}, 0
        number = self.ids(list(chain.from_iterable(texts)))  # may enlarge the scores
        score = self.scores[number]
        segs = -(-size // SEGMENT)  # segments of each text
        seg_text = np.repeat(np.arange(len(texts)), segs)
        seg_rank = np.arange(segs.sum()) - np.repeat(np.cumsum(segs) - segs, segs)
        seg_at = first[seg_text] + seg_rank * SEGMENT
        seg_len = np.minimum(SEGMENT, size[seg_text] - seg_rank * SEGMENT)
        n, move = len(seg_at), self.move
        at = np.minimum(seg_at[:, None] + np.arange(SEGMENT)[None], len(score) - 1)
        live = np.arange(SEGMENT)[None] < seg_len[:, None]
        cells = score[at]
        carry = np.broadcast_to(np.eye(k, dtype=np.float32), (n, k, k)).copy()
        for t in range(SEGMENT):  # what a segment does to whatever enters it
            on = np.flatnonzero(live[:, t])
            if not len(on):
                break
            step = (carry[on] @ move) * cells[on, t][:, None, :]
            carry[on] = step / step.sum((1, 2), keepdims=True)
        enter, leave = np.full((n, k), 1.0 / k, np.float32), np.ones((n, k), np.float32)
        for r in range(1, int(segs.max())):
            on = np.flatnonzero(seg_rank == r)
            x = np.einsum("ni,nij->nj", enter[on - 1], carry[on - 1])
            enter[on] = x / x.sum(1, keepdims=True)
        for r in range(int(segs.max()) - 2, -1, -1):
            on = np.flatnonzero((seg_rank == r) & (segs[seg_text] > r + 1))
            x = np.einsum("nij,nj->ni", carry[on + 1], leave[on + 1])
            leave[on] = x / x.sum(1, keepdims=True)
        alpha, now = np.empty((n, SEGMENT, k), np.float32), enter
        for t in range(SEGMENT):
            x = (now @ move) * cells[:, t]
            now = np.where(live[:, t, None], x / x.sum(1, keepdims=True), now)
            alpha[:, t] = now
        now = leave
        for t in range(SEGMENT - 1, -1, -1):
            post = alpha[:, t] * now
            alpha[:, t] = post / post.sum(1, keepdims=True)
            x = (cells[:, t] * now) @ move.T
            now = np.where(live[:, t, None], x / x.sum(1, keepdims=True), now)
        return alpha[live], first


def bucket(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n."""
    return F.crc32(doc_id.cast("string").cast("binary")) % n


OUT = "doc_id long, held_out boolean, lang_pred string, score double, n_words long, n_switches long"


def identify(docs: DataFrame, folds: int = 4, held_out: int = 2, most_samples: int = 3000, sample_chars: int = 600, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, held_out, lang_pred, score (the predicted language's share of the words), n_words and n_switches.

    docs needs doc_id, text and lang. Learns from documents with text and lang whose crc32(doc_id) modulo folds is
    not held_out: a sample of at most most_samples different ones by a hash of id, language and text, from each a
    stretch of at most sample_chars characters at a place that the hash gives (words that the cut breaks are left out
    where there are others). Rows that are there many times are one row of the sample. All texts are labelled whole. Rows whose text is null or has
    no letter get `und` and score 0; a null doc_id is never held out and never learned from. Repeated rows give
    repeated rows. If nothing can be learned, every row is `und`. Columns of docs that are named in keep are returned
    besides, but for those that have the name of a result.
    """
    spark = docs.sparkSession
    small_batches(spark)
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}
    keep = tuple(c for c in keep if c not in {o.split()[0] for o in OUT.split(", ")})
    kept = [F.col(c).alias(f"kept_{i}") for i, c in enumerate(keep)]
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"), *kept)
    fold = F.coalesce(bucket(F.col("doc_id"), folds) == held_out, F.lit(False))
    learn = docs.where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull() & ~fold)
    by = F.xxhash64("doc_id", "lang", "text")
    place = F.pmod(by, F.greatest(F.length("text") - sample_chars + 1, F.lit(1)).cast("long")).cast("int") + 1
    # stretches are cut before rows are compared, so that no whole text leaves its task
    stretch = F.col("text").substr(place, F.lit(sample_chars))
    stretch = F.when(place > 1, F.regexp_replace(stretch, r"^\S+\s", "")).otherwise(stretch)
    stretch = F.when(F.length("text") - place >= sample_chars, F.regexp_replace(stretch, r"\s\S+$", "")).otherwise(stretch)
    rows = hash_sample(learn.select("doc_id", "lang", "text", stretch.alias("stretch")), by, most_samples, ["lang", "stretch"]).collect()
    model = spark.sparkContext.broadcast(fit(sorted((r.stretch, r.lang) for r in rows)))

    names_out = [*(c.split()[0] for c in OUT.split(", ")), *keep]
    extra = lambda batch: [batch.column(f"kept_{i}") for i in range(len(keep))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not model.value.labels:
            for batch in batches:
                n = batch.num_rows
                yield pa.record_batch([batch.column("doc_id"), batch.column("held_out"), pa.array(["und"] * n, pa.string()), pa.array([0.0] * n), pa.array([0] * n, pa.int64()), pa.array([0] * n, pa.int64()), *extra(batch)], names_out)
            return
        labeller, names = held_by_worker((model.value,), Labeller), np.array(model.value.labels, dtype=object)
        for batch in portions(batches, most=max(1 << 14, (1 << 24) // len(names) ** 2)):
            texts = list(map(words_of, batch.column("text").to_pylist()))
            post, first = labeller.marginals(texts)
            n = np.array([len(t) for t in texts], np.int64)
            some = np.flatnonzero(n)
            share = np.zeros((len(texts), len(names)))
            switches = np.zeros(len(texts), np.int64)
            if len(some):
                share[some] = np.add.reduceat(post.astype(np.float64), first[some], axis=0) / n[some, None]
                best = post.argmax(1)
                change = np.r_[False, best[1:] != best[:-1]]
                change[first[some]] = False
                switches[some] = np.add.reduceat(change.astype(np.int64), first[some])
            top = share.argmax(1)
            pred = np.where(n > 0, names[top], "und")
            score = np.clip(share[np.arange(len(texts)), top], 0.0, 1.0)
            yield pa.record_batch([batch.column("doc_id"), batch.column("held_out"), pa.array(pred.tolist(), pa.string()), pa.array(score), pa.array(n), pa.array(switches), *extra(batch)], names_out)

    return docs.select("doc_id", fold.alias("held_out"), "text", *(f"kept_{i}" for i in range(len(keep)))).mapInArrow(run, ", ".join([OUT, *(f"`{c}` {kinds[c]}" for c in keep)]))


def keep_identified(docs: DataFrame, least: float = 0.3, **options) -> DataFrame:
    """The rows of docs whose language is known: not `und`, and at least the share `least` of the words has it."""
    others = tuple(c for c in docs.columns if c != "doc_id")
    found = identify(docs.withColumnsRenamed({c: f"own_{c}" for c in others}).withColumns({"text": F.col("own_text"), "lang": F.col("own_lang")}), keep=tuple(f"own_{c}" for c in others), **options)
    found = found.where((F.col("lang_pred") != "und") & (F.col("score") >= least))
    return found.select(*("doc_id" if c == "doc_id" else F.col(f"own_{c}").alias(c) for c in docs.columns))
