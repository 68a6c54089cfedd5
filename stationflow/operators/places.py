"""Nearest places of any layout: points or polylines, found ring by ring in cells whose size doubles, without a cross join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources import forget, held


def _cell(c: Column, size: float) -> Column:
    return F.floor(c / size).cast("long")


def segments(lines: DataFrame, id: str = "link_code", points: str = "geometry") -> DataFrame:
    """id, ax, ay, bx, by of each stretch between neighbouring points (array of x, y) of lines; a line of one point is a stretch of no length."""
    p = F.col(points)
    pairs = F.when(F.size(p) == 1, F.array(F.struct(p[0].alias("a"), p[0].alias("b")))).otherwise(F.zip_with(F.slice(p, 1, F.size(p) - 1), F.slice(p, 2, F.size(p) - 1), lambda a, b: F.struct(a.alias("a"), b.alias("b"))))
    each = lines.where(F.size(p) > 0).select(F.col(id), F.explode(pairs).alias("s"))
    return each.select(id, *(F.col(f"s.{e}.{c}").cast("double").alias(f"{e}{c}") for e in "ab" for c in "xy"))


def _distance(x: Column, y: Column) -> Column:
    """From a point to the stretch ax, ay, bx, by."""
    dx, dy = F.col("bx") - F.col("ax"), F.col("by") - F.col("ay")
    along = F.coalesce(F.try_divide((x - F.col("ax")) * dx + (y - F.col("ay")) * dy, dx * dx + dy * dy), F.lit(0.0))
    at = F.greatest(F.lit(0.0), F.least(F.lit(1.0), along))
    return F.hypot(x - (F.col("ax") + at * dx), y - (F.col("ay") + at * dy))


def nearest_place(probes: DataFrame, places: DataFrame, probe: str, place: str, cell: float, levels: int = 24) -> DataFrame:
    """Probe, place and distance of the place nearest to each probe (x, y), of equal distances the lowest.

    places: stretches as segments() makes them, or points (x, y). Both are put into cells, a probe into the nine around
    it, so all places within one cell's width are met. A probe is done if the nearest it met isn't farther than that;
    the others go on with cells of twice the size, in which far fewer probes are left. Probes that no level brought to
    an end (farther than cell * 2 ** levels from all places), and those without coordinates, have no row.
    """
    if "x" in places.columns:
        places = places.select(place, F.col("x").cast("double").alias("ax"), F.col("y").cast("double").alias("ay")).withColumns({"bx": F.col("ax"), "by": F.col("ay")})
    places = places.where("ax IS NOT NULL AND ay IS NOT NULL AND bx IS NOT NULL AND by IS NOT NULL")
    left = probes.select(probe, F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y")).where("x IS NOT NULL AND y IS NOT NULL").distinct()
    found: DataFrame | None = None
    tables: list[DataFrame] = []
    for level in range(levels + 1):
        size = cell * 2**level
        span = lambda a, b: F.sequence(_cell(F.least(a, b), size), _cell(F.greatest(a, b), size))
        there = places.withColumn("cx", F.explode(span("ax", "bx"))).withColumn("cy", F.explode(span("ay", "by")))
        around = F.array(*(F.lit(k) for k in (-1, 0, 1)))
        asked = left.withColumn("dx", F.explode(around)).withColumn("dy", F.explode(around)).select(probe, "x", "y", (_cell(F.col("x"), size) + F.col("dx")).alias("cx"), (_cell(F.col("y"), size) + F.col("dy")).alias("cy"))
        met = asked.join(there, ["cx", "cy"]).select(probe, "x", "y", F.struct(_distance(F.col("x"), F.col("y")).alias("distance"), F.col(place).alias("place")).alias("m"))
        best = met.groupBy(probe, "x", "y").agg(F.min("m").alias("m"))
        state = held(left.join(best, [probe, "x", "y"], "left").withColumn("done", F.coalesce(F.col("m.distance") <= size, F.lit(False))), "nearest")
        tables.append(state)
        done = state.where("done").select(probe, F.col("m.place").alias(place), F.col("m.distance").alias("distance"))
        found = done if found is None else found.unionByName(done)
        left = state.where("NOT done").select(probe, "x", "y")
        if left.isEmpty():
            break
    out = held(found, "nearest-places")
    for t in tables:
        forget(t)
    return out
