"""A block's n-grams are counted one order at a time."""

import tracemalloc

import numpy as np
from stationflow.llm import scoring


def test_memory_of_a_block():
    rng = np.random.default_rng(4)
    n = 400_000
    words = b" ".join([scoring.LAST, *(b"w%d" % i for i in range(2000))])
    ids, lengths = rng.integers(1, 2001, n), np.full(400, n // 400)
    ids[np.cumsum(lengths) - 1] = 0
    tracemalloc.start()
    held = scoring.Counted(scoring.Text(words, ids, lengths, np.zeros(400, bool), 3), [None] * 400, [False] * 400, 16)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(int(c.sum()) for c in held.counts.values()) == n + n + (n - 400)
    assert peak < 80 * n  # 129 with all orders at once
