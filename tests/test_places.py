"""Nearest places against all pairs."""

import math
import random

import pytest
from stationflow.operators import places


def to_stretch(x, y, ax, ay, bx, by):
    dx, dy = bx - ax, by - ay
    t = 0 if dx == dy == 0 else max(0, min(1, ((x - ax) * dx + (y - ay) * dy) / (dx * dx + dy * dy)))
    return math.hypot(x - (ax + t * dx), y - (ay + t * dy))


@pytest.fixture(scope="module")
def points():
    rng = random.Random(3)
    return [(i, rng.choice([rng.uniform(-50, 50), rng.uniform(0, 2), 400.0]), rng.choice([rng.uniform(-50, 50), rng.uniform(0, 2)])) for i in range(150)]


@pytest.mark.parametrize("cell", [0.5, 7.0, 1000.0])
def test_points(spark, points, cell):
    rng = random.Random(4)
    there = [(f"r{i:02}", float(rng.randint(-30, 30)), float(rng.randint(-30, 30))) for i in range(40)] + [("s", 3.0, 3.0), ("r", 3.0, 3.0), ("none", None, 1.0)]
    probes = points + [(900, 3.0, 3.0), (901, None, 2.0)]
    got = {r.id: (r.code, r.distance) for r in places.nearest_place(spark.createDataFrame(probes, "id int, x double, y double"), spark.createDataFrame(there, "code string, x double, y double"), "id", "code", cell).collect()}
    want = {i: min((math.hypot(x - a, y - b), c) for c, a, b in there if a is not None) for i, x, y in probes if x is not None}
    assert set(got) == set(want) and all(got[i] == (c, pytest.approx(d)) for i, (d, c) in want.items()) and got[900] == ("r", 0.0)


def test_lines(spark, points):
    rng = random.Random(5)
    lines = [(f"l{i:02}", [(rng.uniform(-60, 60), rng.uniform(-60, 60)) for _ in range(rng.randint(1, 5))]) for i in range(25)] + [("empty", [])]
    df = spark.createDataFrame(lines, "link_code string, geometry array<struct<x: double, y: double>>")
    got = {r.id: (r.link_code, r.distance) for r in places.nearest_place(spark.createDataFrame(points, "id int, x double, y double"), places.segments(df), "id", "link_code", 5.0).collect()}
    for i, x, y in points:
        d, c = min((min(to_stretch(x, y, *a, *b) for a, b in (zip(g, g[1:]) if len(g) > 1 else [(g[0], g[0])])), c) for c, g in lines if g)
        assert got[i][1] == pytest.approx(d) and got[i][0] == c


def test_none(spark):
    nothing = spark.createDataFrame([], "code string, x double, y double")
    assert places.nearest_place(spark.createDataFrame([(1, 0.0, 0.0)], "id int, x double, y double"), nothing, "id", "code", 1.0, levels=2).collect() == []
