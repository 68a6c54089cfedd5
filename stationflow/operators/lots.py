"""A model tree for each lot: regression trees with linear models in their leaves, grown for all lots in one pass a level."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources import held
from .forecast import fit_lots


@dataclass
class LotTrees:
    """bounds: station_code, lo and hi (arrays) of the features; splits: station_code, node, feature (its number), bin (rows up to it go left);
    models: station_code, leaf, weights and deviation. Nodes count from 1, the children of n are 2 n and 2 n + 1."""

    features: list[str]
    bins: int
    depth: int
    bounds: DataFrame
    splits: list[DataFrame]
    models: DataFrame

    def predict(self, rows: DataFrame) -> DataFrame:
        """rows with leaf, prediction and deviation; NULL for lots without a model."""
        at = assigned(binned(rows, self.bounds, self.features, self.bins), self.splits).drop("_bins").withColumnRenamed("node", "leaf")
        out = at.join(self.models, ["station_code", "leaf"], "left")
        value = reduce(lambda a, b: a + b, (F.get("weights", i + 1) * F.col(c) for i, c in enumerate(self.features)), F.get("weights", 0))
        return out.withColumn("prediction", value).drop("weights")


def binned(rows: DataFrame, bounds: DataFrame, features: Sequence[str], bins: int) -> DataFrame:
    """Adds _bins, the bin of each feature between its lot's bounds, and node 1."""
    share = [F.coalesce(F.try_divide(F.col(c) - F.get("lo", i), F.get("hi", i) - F.get("lo", i)), F.lit(0.0)) for i, c in enumerate(features)]
    cut = F.array(*(F.greatest(F.lit(0), F.least(F.lit(bins - 1), F.floor(s * bins))).cast("int") for s in share))
    return rows.join(bounds, "station_code", "left").withColumns({"_bins": cut, "node": F.lit(1).cast("long")}).drop("lo", "hi")


def assigned(rows: DataFrame, splits: Sequence[DataFrame]) -> DataFrame:
    """Rows of binned() with the node that they are in after all levels' splits."""
    for level in splits:
        rows = rows.join(level.select("station_code", "node", "feature", "bin"), ["station_code", "node"], "left")
        down: Column = F.col("node") * 2 + (F.get("_bins", F.col("feature")) > F.col("bin")).cast("int")
        rows = rows.withColumn("node", F.coalesce(down, F.col("node"))).drop("feature", "bin")
    return rows


def best_splits(rows: DataFrame, least: int) -> DataFrame:
    """station_code, node, feature, bin and gain of the split of each node that takes most off the squared errors, both sides having `least` rows.

    Sums of each bin are made in the tasks that read the rows; only those are shuffled. Equal gains: the first feature, then the first bin.
    """
    each = rows.select("station_code", "node", "value", F.posexplode("_bins").alias("feature", "bin"))
    sums = each.groupBy("station_code", "node", "feature", "bin").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("s"))
    of = Window.partitionBy("station_code", "node", "feature")
    upto = of.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    sums = sums.withColumns({"nl": F.sum("n").over(upto), "sl": F.sum("s").over(upto), "na": F.sum("n").over(of), "sa": F.sum("s").over(of)})
    sums = sums.where((F.col("nl") >= least) & (F.col("na") - F.col("nl") >= least))
    gain = F.col("sl") * F.col("sl") / F.col("nl") + (F.col("sa") - F.col("sl")) * (F.col("sa") - F.col("sl")) / (F.col("na") - F.col("nl")) - F.col("sa") * F.col("sa") / F.col("na")
    found = sums.withColumn("gain", gain).where("gain > 1e-9")
    best = found.groupBy("station_code", "node").agg(F.max(F.struct("gain", -F.col("feature"), -F.col("bin"))).alias("b"))
    return best.select("station_code", "node", (-F.col("b.col2")).alias("feature"), (-F.col("b.col3")).alias("bin"), F.col("b.gain").alias("gain"))


def fit_trees(rows: DataFrame, features: Sequence[str], depth: int = 3, bins: int = 32, least: int = 50, ridge: float = 0.1) -> LotTrees:
    """M8: rows (station_code, value, features) as a tree for each lot, whose leaves have linear models of the features.

    A feature is cut between its lot's least and largest value into bins. A level is one pass over all rows of all
    lots; its splits, a few rows a lot, are a table. Rows with a NULL are left out.
    """
    features = list(features)
    rows = rows.select("station_code", *(F.col(c).cast("double").alias(c) for c in ("value", *features))).na.drop()
    bounds = held(rows.groupBy("station_code").agg(F.array(*map(F.min, features)).alias("lo"), F.array(*map(F.max, features)).alias("hi")), "bounds")
    splits: list[DataFrame] = []
    for _ in range(depth):
        splits.append(held(best_splits(assigned(binned(rows, bounds, features, bins), splits), least), "splits"))
    leaves = assigned(binned(rows, bounds, features, bins), splits)
    models = fit_lots(leaves.withColumn("station_code", F.to_json(F.struct("station_code", "node"))), features, ridge=ridge, calendar=False)
    key = F.from_json("station_code", "station_code string, node long")
    models = held(models.select(key.alias("k"), "weights", "deviation").select("k.station_code", F.col("k.node").alias("leaf"), "weights", "deviation"), "leaf-models")
    return LotTrees(features, bins, depth, bounds, splits, models)
