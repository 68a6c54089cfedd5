"""Learners against functions that are known."""

import math
import random

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F
from stationflow.operators import forecast, network


def test_gradients_are_those_of_the_errors():
    rng = np.random.default_rng(0)
    layers = [(rng.normal(size=(2, 3, 4)), rng.normal(size=(2, 1, 4))), (rng.normal(size=(2, 4, 1)), rng.normal(size=(2, 1, 1)))]
    x, y, weight = rng.normal(size=(5, 3)), rng.normal(size=5), rng.poisson(1.0, (2, 5)).astype(float)
    grads, loss = network.gradients(layers, x, y, weight)
    flat = [p for layer in layers for p in layer]
    for p, g in zip(flat, grads):
        at = tuple(rng.integers(0, n) for n in p.shape)
        old = p[at]
        p[at] = old + 1e-6
        more = network.gradients(layers, x, y, weight)[1]
        p[at] = old
        assert g[at] == pytest.approx((more - loss) / 1e-6, rel=1e-3, abs=1e-3)


def test_network_learns_what_a_line_does_not(spark):
    rng = random.Random(2)
    f = lambda a, b: 20 * math.sin(2 * a) + 5 * abs(b)
    rows = [(a, b, f(a, b) + rng.gauss(0, 0.5)) for a, b in ((rng.uniform(-2, 2), rng.uniform(-2, 2)) for _ in range(3000))]
    df = spark.createDataFrame([*rows, (None, 1.0, 5.0)], "a double, b double, value double").repartition(2)
    model = network.fit_network(df, ["a", "b"], steps=120, rate=0.03)
    out = model.transform(df.withColumn("extra", F.lit("x")))
    assert out.where("a IS NULL").first().prediction is None and out.columns == ["a", "b", "value", "extra", "predictions", "prediction"]
    rmse = lambda d: d.agg(F.sqrt(F.avg(F.pow(F.col("prediction") - F.col("value"), F.lit(2))))).first()[0]
    stages = [*forecast.features(df, ["a", "b"], (), False), LinearRegression(labelCol="value")]
    line = Pipeline(stages=stages).fit(df.na.drop()).transform(df.na.drop())
    assert rmse(out) < 0.35 * rmse(line)
    first = out.where("a IS NOT NULL").first()
    assert len(set(first.predictions)) == 5 and first.prediction == pytest.approx(sum(first.predictions) / 5)


def test_absolute_errors_find_the_median(spark):
    rng = random.Random(5)
    rows = [(float(x), 3 * x + 10 + (rng.expovariate(0.05) - 20 * math.log(2))) for x in [rng.uniform(0, 10) for _ in range(4000)]]  # noise of median 0 and mean 6.1
    df = spark.createDataFrame(rows, "x double, value double")
    miss = lambda m: m.transform(df).agg(F.avg(F.col("prediction") - (3 * F.col("x") + 10))).first()[0]
    stages = [*forecast.features(df, ["x"], (), False), LinearRegression(labelCol="value")]
    assert miss(Pipeline(stages=stages).fit(df)) > 5 and abs(miss(forecast.fit_absolute(df, ["x"], (), False))) < 0.8
    upper = forecast.fit_absolute(df, ["x"], (), False, quantile=0.9, rounds=24).transform(df)
    assert 0.88 < upper.agg(F.avg((F.col("value") <= F.col("prediction")).cast("double"))).first()[0] < 0.92


def plain_tree(rows, node, depth, bounds, bins, least):
    """Splits {node: (feature, bin)} and leaves {node: rows} of one lot; rows: (value, features)."""

    def cut(i, x):
        lo, hi = bounds[i]
        return 0 if hi == lo else max(0, min(bins - 1, math.floor((x - lo) / (hi - lo) * bins)))

    best, total = None, sum(r[0] for r in rows)
    for i in range(len(bounds)) if depth else ():
        for b in range(bins):
            left = [r for r in rows if cut(i, r[1][i]) <= b]
            nl, nr = len(left), len(rows) - len(left)
            if any(cut(i, r[1][i]) == b for r in rows) and nl >= least and nr >= least:
                s = sum(r[0] for r in left)
                gain = s * s / nl + (total - s) * (total - s) / nr - total * total / len(rows)
                if gain > 1e-9 and (best is None or gain > best[0]):
                    best = (gain, i, b)
    if best is None:
        return {}, {node: rows}
    _, i, b = best
    out, leaves = {node: (i, b)}, {}
    for k, side in enumerate(([r for r in rows if cut(i, r[1][i]) <= b], [r for r in rows if cut(i, r[1][i]) > b])):
        s, v = plain_tree(side, 2 * node + k, depth - 1, bounds, bins, least)
        out |= s
        leaves |= v
    return out, leaves


def test_model_trees_equal_a_loop_over_lots(spark):
    from stationflow.operators import lots

    rng, rows = random.Random(6), []
    for k in range(10):
        for _ in range(rng.choice([8, 120, 200])):
            a, b = rng.uniform(0, 10), float(rng.randint(0, 6))
            rows.append((f'lot "{k}"', float(round((3 + k) * a * (1 if b < 3 else -1) + 50 * (a > 6) + rng.randint(-3, 3))), a, b))
    df = spark.createDataFrame([*rows, ("none", None, 1.0, 1.0)], "station_code string, value double, a double, b double").repartition(3)
    trees = lots.fit_trees(df, ["a", "b"], depth=2, bins=8, least=10, ridge=0.1)
    got = {}
    for level in trees.splits:
        for r in level.collect():
            got[r.station_code, r.node] = (r.feature, r.bin)
    models = {(r.station_code, r.leaf): r.weights for r in trees.models.collect()}
    want = {}
    for k in range(10):
        own = [(v, (a, b)) for s, v, a, b in rows if s == f'lot "{k}"']
        bounds = [(min(r[1][i] for r in own), max(r[1][i] for r in own)) for i in (0, 1)]
        splits, leaves = plain_tree(own, 1, 2, bounds, 8, 10)
        want |= {(f'lot "{k}"', n): s for n, s in splits.items()}
        for n, some in leaves.items():
            x = np.array([[1, *f] for _, f in some])
            w = np.linalg.solve(x.T @ x + np.diag([1e-9, 0.1, 0.1]), x.T @ np.array([v for v, _ in some]))
            assert models[f'lot "{k}"', n] == pytest.approx(w.tolist(), rel=1e-6, abs=1e-6)
    assert got == want and len(want) > 10
    out = trees.predict(df.where("value IS NOT NULL"))
    error = out.agg(F.avg(F.abs(F.col("prediction") - F.col("value")))).first()[0]
    flat = forecast.fit_lots(df.na.drop(), ["a", "b"], calendar=False)
    line = df.na.drop().join(flat, "station_code").agg(F.avg(F.abs(F.col("value") - F.get("weights", F.lit(0)) - F.get("weights", F.lit(1)) * F.col("a") - F.get("weights", F.lit(2)) * F.col("b")))).first()[0]
    assert error < 0.5 * line and out.where("prediction IS NULL").count() == 0
