"""Phrase mining against a plain version, with shards and rounds forced on small tables."""

from collections import Counter

import brute
import numpy as np
import pytest
from stationflow.llm import phrases


def test_index_counts_all_ngrams():
    rng = np.random.default_rng(1)
    for _ in range(60):
        text = rng.integers(0, rng.integers(2, 7), rng.integers(1, 80)).astype(np.int64)
        for longest in (2, 3, 4, 5):
            for size, (grams, n) in enumerate(phrases.Phrases(text, longest).counts(longest), 1):
                want = Counter(tuple(text[p : p + size].tolist()) for p in phrases.starts(text, size))
                assert dict(zip(map(tuple, grams.tolist()), n.tolist())) == want


@pytest.mark.parametrize("longest,least,shard_words", [(4, 3, 50), (4, 2, 10**6), (3, 4, 200), (2, 2, 100), (5, 3, 100)])
def test_collocations(spark, docs, data, longest, least, shard_words):
    more = [(900 + i, t, g) for i, (t, g) in enumerate([("a b a b. a b! A B\ta b", None), ("a b a b a b a b", "und"), ("\x00   x\x0bx x x x x x", "en"), ("to be or not to be, to be or not to be; to be or not to be", "en"), (" ".join(["w"] * 300), "de"), ("", "xx"), (None, None)])]
    own = spark.createDataFrame(more, "doc_id long, text string, lang string").unionByName(docs.select("doc_id", "text", "lang")).selectExpr("*", "1 AS phrase", "'x' AS n")
    got = sorted(map(tuple, phrases.collocations(own, longest, least, 80, 150, shard_words).collect()))
    want = brute.phrases([(t, g) for _, t, g, *_ in data] + [(t, g) for _, t, g in more], longest, least, 80, 150)
    assert got == sorted(want) and len(got) > 10


def test_no_documents(empty):
    assert phrases.collocations(empty).collect() == []
