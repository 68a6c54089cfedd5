"""Forecasting: signals, training sets, models and their evaluation."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

import numpy as np
import pandas as pd
from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StandardScalerModel, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .grids import asof_nearest, asof_pad, floor_ts, grid, interpolate_linear, lag_features, running_mean
from .incremental import begins, whole
from .parking import calendar_features

LAGS = (1, 2, 12, 288, 2016)


def parking_signals(m: DataFrame, holidays: DataFrame, meteo: DataFrame, interpolate: bool = False, step: int = 300) -> DataFrame:
    """M1: station_code, ts, value on a grid of step seconds, with calendar, is_school, is_holiday (holidays: ts, ...) and symbol (meteo: ts, symbol).

    Raw values are the nearest less than a step away; interpolate fills gaps of the grid's means.
    """
    g = grid(m, step, ["station_code"], start=floor_ts(F.min("ts"), step))
    if interpolate:
        means = m.groupBy("station_code", floor_ts("ts", step).alias("ts")).agg(F.avg("value").alias("value"))
        out = interpolate_linear(g.join(means, ["station_code", "ts"], "left"), ["station_code"])
    else:
        out = asof_nearest(g, m, ["station_code"], name="value", within_s=step)
    # daily tables: the last row at or before each day is found once a day, not once a row
    days = out.select(F.date_trunc("day", "ts").alias("ts")).distinct().withColumn("k", F.lit(1))
    for table, names in ((holidays, ("is_school", "is_holiday")), (meteo, ("symbol",))):
        for name in names:
            days = asof_pad(days, table.select(F.lit(1).alias("k"), F.col("ts").cast("timestamp").alias("ts"), F.col(name).cast("double").alias(name)), ["k"], name, name)
    days = days.drop("k").withColumnRenamed("ts", "_day")
    out = out.withColumn("_day", F.date_trunc("day", "ts")).join(days, "_day", "left").drop("_day")
    return calendar_features(out, 86400 // step if 86400 // step in (24, 96, 288) else 24)


def training_set(signals: DataFrame, cutoff: Column, lags: Sequence[int] = LAGS, window: int = 2016) -> DataFrame:
    """M2: signals up to cutoff with lags and running mean; rows with a NULL are dropped."""
    rows = running_mean(lag_features(signals, lags), window).where(F.col("ts") <= cutoff)
    return rows.na.drop()


CATEGORIES = ("slot", "weekday", "month", "symbol")


def features(rows: DataFrame, numbers: Sequence[str], categories: Sequence[str] = CATEGORIES, station: bool = True) -> list:
    """Stages that make the vector column features: one-hot categories (and stations), standardised numbers."""
    stages: list = []
    vectors: list[str] = []
    present = [c for c in categories if c in rows.columns]
    if present:
        stages.append(OneHotEncoder(inputCols=present, outputCols=[f"{c}_vec" for c in present], handleInvalid="keep", dropLast=False))
        vectors += [f"{c}_vec" for c in present]
    if station:
        stages.append(StringIndexer(inputCol="station_code", outputCol="station_index", handleInvalid="keep"))
        stages.append(OneHotEncoder(inputCols=["station_index"], outputCols=["station_vec"], handleInvalid="keep", dropLast=False))
        vectors.append("station_vec")
    stages.append(VectorAssembler(inputCols=list(numbers), outputCol="numbers_raw"))
    stages.append(StandardScaler(inputCol="numbers_raw", outputCol="numbers", withMean=True))
    stages.append(VectorAssembler(inputCols=[*vectors, "numbers"], outputCol="features"))
    return stages


def augment(train: DataFrame, noise: float = 0.0, lags: Sequence[int] = LAGS, blank: bool = False, seed: int = 1, share: float = 0.98) -> tuple[DataFrame, DataFrame]:
    """M3: training and test rows (98 to 2): lag columns times 1 +- noise in training, or all 0 if blank."""
    names = [f"lag_{n}" for n in lags if f"lag_{n}" in train.columns]
    if blank:
        train = train.withColumns({c: F.lit(0.0) for c in names})
    a, b = train.randomSplit([share, 1 - share], seed)
    if noise and not blank:
        a = a.withColumns({c: F.col(c) * (1 + noise * (2 * F.rand(seed + i) - 1)) for i, c in enumerate(names)})
    return a, b


def fit_linear(train: DataFrame, numbers: Sequence[str], categories: Sequence[str] = CATEGORIES, station: bool = True) -> PipelineModel:
    """M4: linear model; the Huber loss stands for the absolute error. Rows are kept while its stages read them one after another."""
    held = train.persist()
    model = Pipeline(stages=[*features(train, numbers, categories, station), LinearRegression(labelCol="value", loss="huber", maxIter=50)]).fit(held)
    held.unpersist()
    return model


def fit_absolute(train: DataFrame, numbers: Sequence[str], categories: Sequence[str] = CATEGORIES, station: bool = True, quantile: float = 0.5, rounds: int = 12, least: float = 1e-3) -> PipelineModel:
    """M4 with the absolute error (or another quantile's): weighed least squares, round by round, where a row counts by one over its last error.

    Errors below `least` standard deviations of value count as that; it begins a hundred times larger and comes down from
    round to round. Features are made and kept once.
    """
    made = Pipeline(stages=features(train, numbers, categories, station)).fit(train)
    held = made.transform(train).select("value", "features").persist()
    scale = held.agg(F.stddev_pop("value")).first()[0] or 1.0
    model = LinearRegression(labelCol="value", regParam=1e-9).fit(held)
    for k in range(rounds):
        floor = scale * least * 100 ** (1 - k / max(rounds - 1, 1))
        error = F.col("value") - F.col("prediction")
        side = F.when(error >= 0, quantile).otherwise(1 - quantile)
        weighed = model.transform(held).select("value", "features", (side / F.greatest(F.abs(error), F.lit(floor))).alias("w"))
        model = LinearRegression(labelCol="value", weightCol="w", regParam=1e-9, standardization=False).fit(weighed)
    held.unpersist()
    return PipelineModel([*made.stages, model])


ROWS = 20_000  # rows of a partition that trees are fitted on


def fit_ensemble(train: DataFrame, numbers: Sequence[str], n: int = 5, categories: Sequence[str] = CATEGORIES, station: bool = True, iterations: int = 20) -> list[PipelineModel]:
    """M5: n boosted-tree models that differ by their seed and the rows they are fitted on; the features are made and kept once.

    Every level of every tree is a job over all partitions, so these have ROWS rows, whatever the shuffle's number of
    partitions is, and the models, which don't depend on each other, are fitted at the same time.
    """
    rows = train.persist()
    made = Pipeline(stages=features(rows, numbers, categories, station)).fit(rows)
    held = made.transform(rows).select("value", "features").repartition(max(1, -(-rows.count() // ROWS))).persist()
    held.count()  # kept before several models ask for it
    fit = inheritable_thread_target(train.sparkSession)(lambda s: GBTRegressor(labelCol="value", maxIter=iterations, subsamplingRate=0.8, seed=s).fit(held))
    with ThreadPoolExecutor(max(n, 1)) as pool:
        trees = list(pool.map(fit, range(n)))
    held.unpersist()
    rows.unpersist()
    return [PipelineModel([*made.stages, t]) for t in trees]


def _tree(node, x: Callable[[int], Column]) -> Column:
    """A regression tree's value for features x(i)."""
    if node.subtreeDepth() == 0:
        return F.lit(float(node.prediction()))
    split = node.split()
    value = x(split.featureIndex())
    if hasattr(split, "threshold") and "Continuous" in split.getClass().getSimpleName():
        left = value <= float(split.threshold())
    else:
        left = value.isin([float(c) for c in split.leftCategories()])
    return F.when(left, _tree(node.leftChild(), x)).otherwise(_tree(node.rightChild(), x))


def tree_value(model, x: Callable[[int], Column]) -> Column:
    """What boosted trees predict for features x(i), as an expression."""
    return reduce(lambda a, b: a + b, [F.lit(float(w)) * _tree(tree._java_obj.rootNode(), x) for tree, w in zip(model.trees, model.treeWeights)])


def forecast_recursive(signals: DataFrame, model: PipelineModel, numbers: Sequence[str], steps: int = 576, step: int = 300, lags: Sequence[int] = LAGS, future: DataFrame | None = None) -> DataFrame:
    """M6: station_code, ts and value of the next steps by a fitted model (fit_linear(), or one of fit_ensemble()); predictions feed later lags.

    future: the features of the next steps but for lags (station_code, ts and what the model takes); without it, rows
    of the same time a week before stand for them. The running mean stays at its last value. The pipeline makes one
    vector of features for each step with lags of 0; then the last values of each station are an array that an aggregate
    extends step by step inside of the plan, where lags take their places in the vector. Stations are independent.
    """
    micros = step * 1_000_000
    span = F.make_dt_interval(secs=F.lit(steps * step))
    ends = signals.groupBy("station_code").agg(F.max("ts").alias("_last"))
    recent = signals.join(ends, "station_code").where(F.unix_micros("_last") - F.unix_micros("ts") <= max(*lags, 2016) * micros)
    state = recent.groupBy("station_code").agg(F.transform(F.array_sort(F.collect_list(F.struct("ts", "value"))), lambda s: s.value.cast("double")).alias("past"), F.max("_last").alias("last"), F.avg("value").alias("mean"))
    if future is None:
        ahead = -(-steps * step // 604800) * 604800
        moved = signals.withColumn("ts", F.timestamp_micros(F.unix_micros("ts") + ahead * 1_000_000)).drop("value")
        future = moved.join(ends, "station_code").where((F.col("ts") > F.col("_last")) & (F.col("ts") <= F.col("_last") + span)).drop("_last")
    blank = {f"lag_{n}": F.lit(0.0) for n in lags}
    rows = future.join(state.select("station_code", "mean", "last"), "station_code").withColumns(blank | ({"running_mean": F.col("mean")} if "running_mean" in numbers else {}))
    rows = rows.na.fill(0.0, [c for c in numbers if c in rows.columns])
    last, linear = model.stages[-1], hasattr(model.stages[-1], "coefficients")
    ready = model.transform(rows)
    size = next(s for s in model.stages if isinstance(s, StandardScalerModel))
    first = last.numFeatures - len(numbers)
    place = {first + i: (int(c.removeprefix("lag_")), float(size.mean[i]), float(size.std[i]) or 1.0) for i, c in enumerate(numbers) if c.startswith("lag_")}
    # a linear model's lags add to its prediction for lags of 0; trees are asked for each step's whole vector
    made = ready.select("station_code", "ts", (F.array("prediction") if linear else vector_to_array("features")).alias("x"))
    made = made.groupBy("station_code").agg(F.transform(F.array_sort(F.collect_list(F.struct("ts", "x"))), lambda s: s.x).alias("xs"), F.array_sort(F.collect_list("ts")).alias("times"))

    def step_of(lag: Callable[[int], Column], i: Column) -> Column:
        vector = F.get("xs", i)

        def feature(k: int) -> Column:
            n, mean, std = place.get(k, (0, 0.0, 1.0))
            return (lag(n) - mean) / std if n else F.get(vector, k)

        if linear:
            added = [F.lit(float(last.coefficients[k]) / std) * lag(n) for k, (n, _, std) in place.items()]
            return reduce(lambda a, b: a + b, added, F.get(vector, 0))
        return tree_value(last, feature)

    return extended(state.join(made, "station_code"), step_of)


def extended(state: DataFrame, step_of: Callable[[Callable[[int], Column], Column], Column]) -> DataFrame:
    """station_code, ts and value of the times of each station, one after another: step_of(lag, i) tells the value of step i.

    state: station_code, past (values in order), mean (in place of values before them) and times. lag(n) is the value n
    steps before: of the past, or one that was told. Only what was told grows from step to step.
    """

    def following(told: Column, i: Column) -> Column:
        lag = lambda n: F.coalesce(F.when(i >= n, F.get(told, i - n)).otherwise(F.try_element_at("past", i.cast("int") - n)), F.col("mean"))
        return F.concat(told, F.array(step_of(lag, i)))

    steps = F.when(F.size("times") > 0, F.sequence(F.lit(0), F.size("times") - 1)).otherwise(F.array().cast("array<int>"))
    out = state.withColumn("told", F.aggregate(steps, F.array().cast("array<double>"), following))
    return out.select("station_code", "times", F.posexplode("told").alias("i", "value")).select("station_code", F.get("times", F.col("i")).alias("ts"), "value")


def forecast_linear(signals: DataFrame, base: DataFrame, weights: dict[int, float]) -> DataFrame:
    """M6 for given weights: station_code, ts and value of the rows of base (station_code, ts, base), each its base and the weighed values so many steps before.

    Lags before a station's first value are its mean. base's rows follow the signals' last one on their grid.
    """
    state = signals.groupBy("station_code").agg(F.transform(F.array_sort(F.collect_list(F.struct("ts", "value"))), lambda s: s.value.cast("double")).alias("past"), F.avg("value").alias("mean"))
    made = base.groupBy("station_code").agg(F.array_sort(F.collect_list(F.struct("ts", "base"))).alias("b"))
    made = made.select("station_code", F.col("b.ts").alias("times"), F.transform("b", lambda x: x.base.cast("double")).alias("xs"))
    return extended(state.join(made, "station_code"), lambda lag, i: reduce(lambda a, n: a + F.lit(float(weights[n])) * lag(n), weights, F.get("xs", i)))


def forecast_direct(model: PipelineModel, signals: DataFrame, lags: Sequence[int] = LAGS) -> DataFrame:
    """M7: predictions of all rows at once, with blank lags."""
    blank = signals.withColumns({f"lag_{n}": F.lit(0.0) for n in lags})
    return model.transform(blank).select("station_code", "ts", F.col("prediction").alias("value"))


def ensemble_direct(models: Sequence[PipelineModel], signals: DataFrame, lags: Sequence[int] = LAGS) -> DataFrame:
    """M7 of all models of fit_ensemble(), a row for each: their features are made once, and rows are read once."""
    blank = PipelineModel(models[0].stages[:-1]).transform(signals.withColumns({f"lag_{n}": F.lit(0.0) for n in lags}))
    names = [f"prediction_{i}" for i in range(len(models))]
    for name, model in zip(names, models):
        blank = model.stages[-1].copy().setPredictionCol(name).transform(blank)
    return blank.select("station_code", "ts", F.explode(F.array(*names)).alias("value"))


PRODUCTS = 1 << 21  # products of features that are held at once


def fit_lots(rows: DataFrame, numbers: Sequence[str], slots: int = 24, ridge: float = 0.1, calendar: bool = True) -> DataFrame:
    """M8: station_code, weights and deviation of a linear model of value for each lot, on numbers and (calendar) slot and weekday.

    Partitions add up the products of features of all lots of a frame, so that only these sums travel, and the equations
    of a frame of lots are solved together (with a ridge that leaves the intercept alone).
    """
    width = 1 + len(numbers) + (slots + 7 if calendar else 0)

    def vectors(f: pd.DataFrame) -> np.ndarray:
        x = np.zeros((len(f), width + 1))
        x[:, 0] = 1.0
        x[:, 1 : 1 + len(numbers)] = f[list(numbers)].to_numpy(float)
        if calendar:
            at = np.arange(len(f))
            x[at, 1 + len(numbers) + f.slot.to_numpy(int)] = 1.0
            x[at, 1 + len(numbers) + slots + f.weekday.to_numpy(int)] = 1.0
        x[:, width] = f["value"].to_numpy(float)
        return x

    cells = (width + 1) ** 2

    def added(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            f = f[f.station_code.notna()].sort_values("station_code")
            if f.empty:
                continue
            first = begins(f, ["station_code"])
            lot = np.repeat(np.arange(len(first)), np.diff([*first, len(f)]))
            x, sums = vectors(f), np.zeros((len(first), cells))
            step = max(1, PRODUCTS // cells)
            for a in range(0, len(x), step):  # all lots at once: most have a few rows of a frame
                part, of = x[a : a + step], lot[a : a + step]
                at = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
                sums[of[at]] += np.add.reduceat((part[:, :, None] * part[:, None, :]).reshape(-1, cells), at)
            yield pd.DataFrame({"station_code": f.station_code.to_numpy()[first], "n": np.diff([*first, len(f)]), "sums": list(sums)})

    def solved(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in whole(frames, ["station_code"]):
            first = begins(f, ["station_code"])
            both = np.add.reduceat(np.stack(f.sums.to_numpy()), first).reshape(-1, width + 1, width + 1)
            n = np.add.reduceat(f.n.to_numpy(), first)
            a, b, c = both[:, :width, :width], both[:, :width, width:], both[:, width, width]
            if ridge:
                w = np.linalg.solve(a + np.diag(np.r_[1e-9, np.full(width - 1, ridge)]), b)
            else:
                w = np.linalg.pinv(a, rcond=np.finfo(float).eps * width) @ b
            left = np.maximum(c - (2 * b * w).sum(axis=(1, 2)) + (w * (a @ w)).sum(axis=(1, 2)), 0.0)
            yield pd.DataFrame({"station_code": f.station_code.to_numpy()[first], "weights": list(w[:, :, 0]), "deviation": np.sqrt(left / np.maximum(n - 1, 1))})

    taken = rows.select("station_code", *(F.col(c).cast("int").alias(c) for c in ("slot", "weekday") if calendar), "value", *numbers)
    return taken.mapInPandas(added, "station_code string, n long, sums array<double>").repartition("station_code").sortWithinPartitions("station_code").mapInPandas(solved, "station_code string, weights array<double>, deviation double")


def forecast_lots(m: DataFrame, overlays: Sequence[Callable[[DataFrame], DataFrame]] = (), lags: Sequence[int] = (1, 24, 168), horizon: int = 24, step: int = 3600) -> DataFrame:
    """station_code, ts and free (truncated, with lo and hi of two deviations of the lot's own errors) for the next horizon steps, by one model for each lot.

    overlays add columns that start with overlay_ to a frame of station_code and ts. Lags are those of the same step
    in earlier periods, so only lags of at least the horizon are used for it.
    """
    usable = [n for n in lags if n >= horizon] or [max(lags)]
    hours = m.groupBy("station_code", floor_ts("ts", step).alias("ts")).agg(F.min("value").cast("double").alias("value"))
    last = hours.agg(F.max("ts").alias("m"))
    future = hours.select("station_code").distinct().join(F.broadcast(last), F.lit(True)).select("station_code", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("i"), "m")
    future = future.select("station_code", F.timestamp_micros(F.unix_micros("m") + F.col("i").cast("long") * (step * 1_000_000)).alias("ts"), F.lit(None).cast("double").alias("value"))
    rows = hours.unionByName(future)
    for n in usable:
        back = hours.select("station_code", F.timestamp_micros(F.unix_micros("ts") + n * step * 1_000_000).alias("ts"), F.col("value").alias(f"lag_{n}"))
        rows = rows.join(back, ["station_code", "ts"], "left")
    rows = calendar_features(rows)
    for add in overlays:
        rows = add(rows)
    numbers = [f"lag_{n}" for n in usable] + [c for c in rows.columns if c.startswith("overlay_")]
    rows = rows.fillna(0.0, numbers)
    models = fit_lots(rows.where("value IS NOT NULL"), numbers)
    out = rows.where("value IS NULL").join(models, "station_code")
    at = lambda i: F.get("weights", i)
    value = at(0) + at(F.lit(1 + len(numbers)) + F.col("slot").cast("int")) + at(F.lit(1 + len(numbers) + 24) + F.col("weekday").cast("int"))
    for i, c in enumerate(numbers):
        value = value + at(1 + i) * F.col(c)
    out = out.withColumn("v", value)
    return out.select("station_code", "ts", F.col("v").cast("int").alias("free"), (F.col("v") - 2 * F.col("deviation")).alias("lo"), (F.col("v") + 2 * F.col("deviation")).alias("hi"))


def evaluate_steps(model: PipelineModel, rows: DataFrame, share: float = 0.1) -> DataFrame:
    """M9: root mean squared error by hour of the day on each station's last rows."""
    return step_errors(model.transform(rows), share)


def step_errors(predicted: DataFrame, share: float = 0.1) -> DataFrame:
    """M9: the same of rows that have a prediction."""
    held = predicted.withColumn("_r", F.percent_rank().over(Window.partitionBy("station_code").orderBy("ts"))).where(F.col("_r") >= 1 - share).drop("_r")
    return held.groupBy(F.hour("ts").alias("hour")).agg(F.sqrt(F.avg(F.pow(F.col("prediction") - F.col("value"), F.lit(2.0)))).alias("rmse"), F.count(F.lit(1)).alias("rows"))


