"""What Python workers hold: one worker for a task, and the maps of one operator."""

import re

import numpy as np
import pytest
from stationflow.llm import common, language, lines, substrings


@pytest.mark.parametrize("module,run", [(lines, lines.line_dedup), (substrings, substrings.remove_repeats)])
def test_a_task_has_one_python_step(docs, monkeypatch, module, run):
    """Two steps in a task take two workers, and an executor keeps those of all its cores."""
    plans, write = [], common.written

    def seen(df, *args, **options):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, *args, **options)

    monkeypatch.setattr(common, "written", seen)
    monkeypatch.setattr(module, "written", seen)
    run(docs).count()
    assert any("MapInArrow" in p for p in plans)
    for p in plans:
        assert max(len(re.findall("MapInArrow", part)) for part in re.split("Exchange", p)) <= 1, p


def test_a_worker_holds_what_was_made_last():
    made = []
    make = lambda *of: made.append(of) or list(of)
    x, y = ("a", [1]), ("b", [2])
    first = common.held_by_worker((x,), make)
    assert common.held_by_worker((x,), make) is first and len(made) == 1
    assert common.held_by_worker((x, y), make) == [x, y] and common.held_by_worker((x,), make) is not first
    assert common._HELD[0] == (x,) and len(made) == 3
    assert common.held_by_worker(("text",), make) is common.held_by_worker(("".join(["te", "xt"]),), make)


def test_scores_of_many_new_words(monkeypatch):
    rng = np.random.default_rng(3)
    words = ["".join(chr(97 + c) for c in rng.integers(0, 26, rng.integers(1, 9))) for _ in range(1000)]
    model = language.Model(["a", "b", "c"], rng.normal(size=(language.BUCKETS, 3)), np.zeros((3, 3)), {words[0]: (1,), words[5]: (0, 2)})
    texts = [words[:700], [], words[300:]]
    whole = language.Labeller(model).marginals(texts)[0]
    monkeypatch.setattr(language, "NEW_WORDS", 7)
    assert np.array_equal(language.Labeller(model).marginals(texts)[0], whole)
