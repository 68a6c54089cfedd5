"""Counts, means and squared deviations that can be merged and taken apart, so that statistics follow a history day by day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def moments(value: str, name: str) -> list[Column]:
    """Aggregates {name}_n, {name}_mean and {name}_m2 (sum of squared deviations) of a column, without NULL."""
    n = F.count(value)
    return [n.alias(f"{name}_n"), F.coalesce(F.avg(value).cast("double"), F.lit(0.0)).alias(f"{name}_mean"), F.coalesce(F.var_pop(value) * n, F.lit(0.0)).alias(f"{name}_m2")]


def deviation(name: str, sample: bool = True) -> Column:
    """The sample (of less than two values NULL) or population deviation."""
    n = F.col(f"{name}_n") - 1 if sample else F.col(f"{name}_n")
    return F.when(n > 0, F.sqrt(F.greatest(F.col(f"{name}_m2"), F.lit(0.0)) / n))


def average(name: str) -> Column:
    return F.when(F.col(f"{name}_n") > 0, F.col(f"{name}_mean"))


def combined(a: DataFrame, b: DataFrame, key: Sequence[str], names: Sequence[str], counts: Sequence[str] = (), sign: int = 1) -> DataFrame:
    """The moments of the values of both tables (sign 1), or of those of a without those of b, which a has to contain (sign -1).

    One row for each key on either side: names are moments(), counts are added (or taken off). Keys that no value and
    no count is left of have no row. The formulas are those of parallel variance, which don't cancel as sums of
    squares do.
    """
    fields = [*(f"{n}_{f}" for n in names for f in ("n", "mean", "m2")), *counts]
    both = a.select(*key, *(F.col(c).alias(f"a_{c}") for c in fields)).join(b.select(*key, *(F.col(c).alias(f"b_{c}") for c in fields)), list(key), "full")
    of = lambda side, c: F.coalesce(F.col(f"{side}_{c}"), F.lit(0))
    out = {c: of("a", c) + sign * of("b", c) for c in counts}
    for n in names:
        na, nb, gap = of("a", f"{n}_n"), of("b", f"{n}_n"), of("b", f"{n}_mean") - of("a", f"{n}_mean")
        left = na + sign * nb
        if sign > 0:
            mean = of("a", f"{n}_mean") + F.coalesce(F.try_divide(gap * nb, left), F.lit(0.0))
            m2 = of("a", f"{n}_m2") + of("b", f"{n}_m2") + F.coalesce(F.try_divide(gap * gap * na * nb, left), F.lit(0.0))
        else:
            mean = of("a", f"{n}_mean") - F.coalesce(F.try_divide(gap * nb, left), F.lit(0.0))
            m2 = of("a", f"{n}_m2") - of("b", f"{n}_m2") - F.coalesce(F.try_divide(gap * gap * na * nb, left), F.lit(0.0))
        some = left > 0
        out |= {f"{n}_n": left, f"{n}_mean": F.when(some, mean).otherwise(0.0), f"{n}_m2": F.when(some, F.greatest(m2, F.lit(0.0))).otherwise(0.0)}
    rows = both.select(*key, *(c.alias(k) for k, c in out.items()))
    kept = F.lit(False)
    for c in [*(f"{n}_n" for n in names), *counts]:
        kept = kept | (F.col(c) != 0)
    return rows.where(kept)
