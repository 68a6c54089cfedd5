"""Ensembles of feed-forward regressions, fitted by gradients that tasks sum over blocks of rows."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from ..sources import forget, held

BLOCK_ROWS = 4096


@dataclass
class Network:
    """Members of equal shape: for each layer the weights (members, inputs, outputs) and biases (members, 1, outputs)."""

    columns: list[str]
    mean: np.ndarray
    std: np.ndarray
    target: tuple[float, float]
    layers: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)

    def values(self, x: np.ndarray) -> np.ndarray:
        """Predictions (members, rows) for rows of columns."""
        h = ((x - self.mean) / self.std)[None]
        for k, (w, b) in enumerate(self.layers):
            h = h @ w + b
            if k < len(self.layers) - 1:
                h = np.maximum(h, 0.0)
        return h[:, :, 0] * self.target[1] + self.target[0]

    def transform(self, rows: DataFrame) -> DataFrame:
        """rows with predictions (one of each member) and their mean as prediction; NULL in a column gives NULL."""
        model = rows.sparkSession.sparkContext.broadcast(self)  # a few hundred kilobytes
        names = rows.columns
        kept = rows.withColumn("_x", F.array(*(F.col(c).cast("double") for c in self.columns)))

        def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = batch.column("_x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                y = model.value.values(np.nan_to_num(x))
                y[:, np.isnan(x).any(axis=1)] = np.nan
                each = pa.ListArray.from_arrays(np.arange(0, y.size + 1, len(y), dtype=np.int32), pa.array(y.T.ravel(), from_pandas=True))
                yield pa.record_batch([*(batch.column(c) for c in names), each, pa.array(y.mean(axis=0), from_pandas=True)], [*names, "predictions", "prediction"])

        out = StructType([*rows.schema.fields, StructField("predictions", ArrayType(DoubleType())), StructField("prediction", DoubleType())])
        return kept.mapInArrow(predict, out)


def gradients(layers: list[tuple[np.ndarray, np.ndarray]], x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[list[np.ndarray], float]:
    """Sums over rows of the gradients of the weighed squared errors (weight: members, rows), and those errors' sum."""
    inputs, h = [], np.broadcast_to(x[None], (len(weight), *x.shape))
    for k, (w, b) in enumerate(layers):
        inputs.append(h)
        h = h @ w + b
        if k < len(layers) - 1:
            h = np.maximum(h, 0.0)
    error = h[:, :, 0] - y[None]
    back, out = (2 * weight * error)[:, :, None], []
    for k in range(len(layers) - 1, -1, -1):
        out = [inputs[k].transpose(0, 2, 1) @ back, back.sum(axis=1, keepdims=True), *out]
        if k:
            back = (back @ layers[k][0].transpose(0, 2, 1)) * (inputs[k] > 0)
    return out, float((weight * error**2).sum())


def fit_network(rows: DataFrame, columns: Sequence[str], members: int = 5, hidden: Sequence[int] = (32, 16), steps: int = 200, rate: float = 0.02, share: float = 0.5, seed: int = 1) -> Network:
    """M5: members that differ by their first weights and by how often each row counts for them, of value on columns.

    Rows with a NULL are left out. They are written once as blocks of matrices. For each step tasks add up the
    gradients of about `share` of the blocks for all members at once, those sums are added in a second stage, and the
    driver makes an Adam step: it never holds more than weights and a few sums of their size.
    """
    spark, columns = rows.sparkSession, list(columns)
    some = rows.select(*(F.col(c).cast("double").alias(c) for c in (*columns, "value"))).na.drop()
    stats = some.agg(*(f(c).alias(f"{n}_{i}") for i, c in enumerate((*columns, "value")) for n, f in (("m", F.avg), ("s", F.stddev_pop))), F.count(F.lit(1)).alias("n")).first()
    if not stats.n:
        raise ValueError("no rows to fit")
    mean, std = (np.array([stats[f"{n}_{i}"] for i in range(len(columns) + 1)]) for n in "ms")
    std = np.where(std > 0, std, 1.0)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = (np.column_stack([batch.column(c).to_numpy() for c in (*columns, "value")]) - mean) / std
            for a in range(0, len(x), BLOCK_ROWS):
                part = x[a : a + BLOCK_ROWS].astype(np.float32)
                yield pa.record_batch([pa.array([len(part)], pa.int32()), pa.array([part.tobytes()], pa.binary())], ["n", "x"])

    blocks = held(some.mapInArrow(pack, "n int, x binary"), "blocks")
    sizes = [len(columns), *hidden, 1]
    rng = np.random.default_rng(seed)
    layers = [(rng.normal(0, (2 / a) ** 0.5, (members, a, b)), np.zeros((members, 1, b))) for a, b in zip(sizes[:-1], sizes[1:])]
    flat = [p for layer in layers for p in layer]
    first, second, width = [np.zeros_like(p) for p in flat], [np.zeros_like(p) for p in flat], len(columns) + 1

    def one(step: int, shared) -> tuple[list[np.ndarray], float]:
        def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, count = None, 0.0
            for batch in batches:
                for n, x in zip(batch.column("n").to_pylist(), batch.column("x").to_pylist()):
                    x = np.frombuffer(x, np.float32).reshape(n, width).astype(np.float64)
                    weight = np.random.default_rng([seed, n, int(abs(x[0]).sum() * 1e6) % (1 << 31)]).poisson(1.0, (members, n)).astype(np.float64)
                    grads, _ = gradients(shared.value, x[:, :-1], x[:, -1], weight)
                    vector = np.concatenate([g.ravel() for g in grads])
                    total, count = vector if total is None else total + vector, count + weight.sum()
            if total is not None:
                yield pa.record_batch([pa.array([total.tobytes()], pa.binary()), pa.array([count], pa.float64())], ["g", "n"])

        def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, count = None, 0.0
            for batch in batches:
                for g, n in zip(batch.column("g").to_pylist(), batch.column("n").to_pylist()):
                    g = np.frombuffer(g)
                    total, count = g.copy() if total is None else total + g, count + n
            if total is not None:
                yield pa.record_batch([pa.array([total.tobytes()], pa.binary()), pa.array([count], pa.float64())], ["g", "n"])

        chosen = blocks.where(F.rand(seed + step) < share) if share < 1 and stats.n > 4 * BLOCK_ROWS else blocks
        sums = chosen.mapInArrow(added, "g binary, n double")
        if blocks.rdd.getNumPartitions() > 32:  # a second level, so that the driver adds up a few vectors
            sums = sums.repartition(8).mapInArrow(summed, "g binary, n double")
        found = sums.collect()
        if not found:
            return [], 0.0
        total, out, at = np.sum([np.frombuffer(r.g) for r in found], axis=0), [], 0
        for p in flat:
            out.append(total[at : at + p.size].reshape(p.shape))
            at += p.size
        return out, sum(r.n for r in found) / members

    for step in range(1, steps + 1):
        shared = spark.sparkContext.broadcast([(flat[2 * k], flat[2 * k + 1]) for k in range(len(layers))])
        grads, n = one(step, shared)
        shared.unpersist()
        pace = rate * min(1.0, 3 * (1 - step / (steps + 1)))
        for k, g in enumerate(grads):
            g = g / max(n, 1.0)
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g * g
            flat[k] = flat[k] - pace * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    forget(blocks)
    return Network(columns, mean[:-1], std[:-1], (float(mean[-1]), float(std[-1])), [(flat[2 * k], flat[2 * k + 1]) for k in range(len(layers))])
