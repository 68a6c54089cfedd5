"""Near-dedup by shingles: what is lost, and how many pairs are compared."""

from collections import Counter

import numpy as np
import pytest
from stationflow.llm import similar, simhash


def exact_roots(sets, least=0.8):
    """The lowest place that links of a similarity of least or more lead to, for each of the sets."""
    ids = {x: i for i, x in enumerate(sorted(set().union(*sets)))}
    has = np.zeros((len(sets), len(ids)), np.float32)
    for row, s in zip(has, sets):
        row[[ids[x] for x in s]] = 1
    both, size = has @ has.T, has.sum(axis=1)
    i, j = np.nonzero(both >= least * (size[:, None] + size[None] - both) - 1e-3)
    return simhash.lowest(len(sets), i, j)


@pytest.mark.parametrize("n", [3, 20, 130, 900, 6000])
def test_sketches_lose_no_pair_at_the_limit(n):
    rng = np.random.default_rng(n)
    taken = apart = 0
    for _ in range(60):
        part = n // 9  # two sets of n elements whose similarity is 0.8 or just above, and others at 0.4
        pool = rng.integers(0, 1 << 63, 4 * n, dtype=np.uint64) * np.uint64(2)
        x, y, z = (np.unique(np.r_[pool[: n - k], pool[at : at + k]]) for k, at in ((part, n), (part, 2 * n), (3 * n // 7, 3 * n)))
        rows = [np.frombuffer(similar.summary(s)[1], np.uint8)[None] for s in (x, y, z)]
        both = len(np.intersect1d(x, y))
        if both >= 0.8 * (len(x) + len(y) - both):
            taken += 1
            assert similar.near_sketches(rows[0], rows[1], 0.8)[0].all()
        apart += not similar.near_sketches(rows[0], rows[2], 0.8)[0].any()
    assert taken == 60 and (n < 20 or apart == 60)


def test_equal_fingerprints_meet_in_the_tries_join():
    fp = np.array([7, 7, 7, 9, 9], np.uint64)
    for leaf in (1, 4, 64):
        i, j = simhash.trie_pairs(fp, np.array([0]), np.array([2]), 3, (np.array([2]), np.array([5])), leaf)
        assert sorted(zip(i.tolist(), j.tolist())) == [(a, b) for a in (0, 1) for b in (2, 3, 4)]
        i, j = simhash.trie_pairs(fp, np.array([0]), np.array([5]), 0, None, leaf)
        assert sorted(zip(i.tolist(), j.tolist())) == [(0, 1), (0, 2), (1, 2), (3, 4)]


def test_a_large_family_of_documents_that_are_alike(spark, monkeypatch):
    rng = np.random.default_rng(8)
    base = [f"w{x}" for x in rng.integers(0, 10**6, 250)]
    texts = []
    for c in range(1500):  # similarities of 0.5 to 0.9, most of them below 0.8
        copy = list(base)
        for at in rng.integers(0, len(base), rng.integers(2, 11)):
            copy[at] = f"n{c}-{at}"
        texts.append(" ".join(copy))
    asked = Counter()
    plain = similar.confirmed

    def counted(texts, pairs, width, least):
        asked["pairs"] += pairs.count()
        asked["calls"] += 1
        return plain(texts, pairs, width, least)

    monkeypatch.setattr(similar, "confirmed", counted)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = {r.doc_id for r in similar.keep_one_similar(docs).collect()}
    want = exact_roots([set(similar.shingles(t.encode(), 5).tolist()) for t in texts])
    assert kept == set(want.tolist()) and 10 < len(kept) < 1490
    assert asked["calls"] <= 3 and asked["pairs"] <= 40 * len(texts)  # of 750 * len(texts)


def test_first_pairs_come_from_the_tries(spark, monkeypatch):
    rng = np.random.default_rng(5)
    base = [f"w{x}" for x in rng.integers(0, 10**6, 250)]
    texts = [" ".join(f"n{c}-{k}" if k % 25 == 3 and k < cut else w for k, w in enumerate(base)) for c in range(60) for cut in ((25, 250) if c % 2 else (100,))]
    texts += ["a b c d e f g h", "a b c d e f g h i", "a b c d e f g h", "", "a b c d"]
    sets = [similar.shingles(t.encode(), 5) for t in texts]
    asked, plain = [], similar.confirmed

    def seen(docs, pairs, width, least):
        asked.append([tuple(r) for r in pairs.collect()])
        return plain(docs, pairs, width, least)

    monkeypatch.setattr(similar, "confirmed", seen)
    kept = {r.doc_id for r in similar.keep_one_similar(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    want = exact_roots([set(s.tolist()) or {-1} for s in sets])
    assert kept == set(want.tolist())
    sketch = [np.frombuffer(similar.summary(s)[1], np.uint8)[None] if len(s) else None for s in sets]
    fp = [similar.fingerprint_of(s) & (2**64 - 1) for s in sets]
    assert asked[0]
    for a, b in asked[0]:
        assert (fp[a] ^ fp[b]).bit_count() <= similar.CENTRE_BUDGET and similar.near_sketches(sketch[a], sketch[b], 0.8)[0].all()


def test_pairs_that_the_first_ones_settle_are_not_listed(spark, monkeypatch):
    rng = np.random.default_rng(11)
    base = [f"w{x}" for x in rng.integers(0, 10**6, 250)]
    texts = []
    for c in range(200):
        copy = list(base)
        for at in rng.integers(0, len(base), rng.integers(2, 11)):
            copy[at] = f"n{c}-{at}"
        texts.append(" ".join(copy))
    monkeypatch.setattr(similar, "FIRST", 2)
    rows, write = [], similar.written

    def counted(df, name, *args):
        table = write(df, name, *args)
        if name in ("rest", "due"):
            rows.append(table.count())
        return table

    monkeypatch.setattr(similar, "written", counted)
    kept = {r.doc_id for r in similar.keep_one_similar(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert kept == set(exact_roots([set(similar.shingles(t.encode(), 5).tolist()) for t in texts]).tolist())
    assert sum(rows) <= 12 * len(texts), rows
