"""Ordered lines from relocations and from steps.

A line is returned as parts: one row per (key, part) with at most ``spark.trajspark.linePoints`` vertices, in
order, so a group of any size stays in bounded rows. Every group below that size has the single part 0; the whole
line is the parts one after another. ``length`` of a part includes the way from the last vertex before it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trajspark import settings
from trajspark.functions import planar
from trajspark.operators.steps import BURST, ordered
from trajspark.operators.summary import burst_summary
from trajspark.plans.segments import Known, Laid, Previous, RowNumber, RunningSum, lay_out, with_prefix


def _collect(df: DataFrame, keys: Sequence[str], max_points: int) -> DataFrame:
    """Gather numbered vertices (_n, x, y, _way) into parts."""
    part = F.floor((F.col("_n") - 1) / max_points).cast("long").alias("part")
    vertices = F.array_sort(F.collect_list(F.struct("_n", "x", "y")))
    return df.groupBy(*keys, part).agg(
        F.transform(vertices, lambda v: F.struct(v["x"].alias("x"), v["y"].alias("y"))).alias("line"),
        F.count(F.lit(1)).alias("n_points"),
        F.coalesce(F.sum("_way"), F.lit(0.0)).alias("length"),
    )


def point_lines(laid: Laid, names: Sequence[str], max_points: int | None = None) -> DataFrame:
    """Line through the known points of each group; missing fixes are skipped."""
    max_points = max_points or settings.line_points(laid.df.sparkSession)
    laid = with_prefix(laid, _n=RowNumber(), _last=Previous(F.struct("x", "y")))
    way = planar.length(F.col("x") - F.col("_last.x"), F.col("y") - F.col("_last.y"))
    return _collect(laid.df.withColumn("_way", way), names, max_points)


def burst_lines(relocations: DataFrame, kind: int = 2, order: Sequence[str] | None = None, known: Known | None = None) -> DataFrame:
    """The line of each burst in parts; one part without a line when no fix is known. ``order`` names an order already stored.

    Bursts are repeated per part before the join, so the join key is as even as the parts are. ``known`` are stored burst sizes.
    """
    max_points = settings.line_points(relocations.sparkSession)
    fixed = relocations.filter(F.col("x").isNotNull() & F.col("y").isNotNull())
    laid = lay_out(fixed, BURST, order, known=known) if order else ordered(fixed, kind, known=known)
    parts = point_lines(laid, BURST, max_points)
    summary = burst_summary(relocations)
    last = F.greatest(F.lit(0), F.ceil((F.col("num_relocations") - F.col("num_na")) / max_points) - 1).cast("long")
    numbered = summary.select(*BURST, F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("part"))
    return numbered.join(parts, [*BURST, "part"], "left")


def burst_view(relocations: DataFrame, parts: DataFrame) -> DataFrame:
    """One row per burst: its summary and what its whole line (``parts``) adds up to. The line itself stays in its parts."""
    whole = parts.groupBy(*BURST).agg(
        F.count("n_points").alias("n_parts"), F.coalesce(F.sum("n_points"), F.lit(0)).alias("n_points"), F.sum("length").alias("length"))
    return burst_summary(relocations).join(whole, list(BURST), "left")


def whole_lines(bursts: DataFrame, parts: DataFrame, on: Sequence[str] = BURST) -> DataFrame:
    """Rows of a burst view with every part of their lines (``part``, ``line``), one row a part; no vertex is left out."""
    return bursts.join(parts.select(*on, "part", "line"), list(on), "left")


def step_lines(
    view: DataFrame, keys: Sequence[str], max_points: int | None = None, at_most: DataFrame | None = None, known: Known | None = None
) -> DataFrame:
    """One line per key from step lines, in step order.

    ``view`` has step_id and step_geom (two vertices). A step adds its end, and its start too unless the step
    before ended there. ``at_most`` is a cheap table with as many rows per key, for a view that is not written yet;
    ``known`` are stored sizes.
    """
    max_points = max_points or settings.line_points(view.sparkSession)
    drawn = view.filter(F.col("step_geom").isNotNull())
    drawn = drawn.select(*keys, "step_id", F.col("step_geom")[0].alias("_a"), F.col("step_geom")[1].alias("_b"))
    laid = with_prefix(lay_out(drawn, keys, ("step_id",), at_most=at_most, known=known), _last=Previous(F.col("_b")))
    joined = F.coalesce(F.col("_last") == F.col("_a"), F.lit(False))
    laid = laid.on(laid.df.withColumn("_adds", F.when(joined, 1).otherwise(2)))
    laid = with_prefix(laid, _upto=RunningSum(F.col("_adds")))

    inside = planar.length(F.col("_b.x") - F.col("_a.x"), F.col("_b.y") - F.col("_a.y"))
    jump = planar.length(F.col("_a.x") - F.col("_last.x"), F.col("_a.y") - F.col("_last.y"))
    start = F.struct((F.col("_upto") - 1).alias("n"), F.col("_a.x").alias("x"), F.col("_a.y").alias("y"), jump.alias("way"))
    end = F.struct(F.col("_upto").alias("n"), F.col("_b.x").alias("x"), F.col("_b.y").alias("y"), inside.alias("way"))
    vertices = F.when(F.col("_adds") == 1, F.array(end)).otherwise(F.array(start, end))
    df = laid.df.select(*keys, F.explode(vertices).alias("_v"))
    df = df.select(*keys, F.col("_v.n").alias("_n"), "_v.x", "_v.y", F.col("_v.way").alias("_way"))
    return _collect(df, keys, max_points)


def animal_lines(view: DataFrame, at_most: DataFrame | None = None) -> DataFrame:
    """The whole path of each animal."""
    return step_lines(view, ["pgtraj_name", "animal_name"], at_most=at_most)


def line_facts(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Vertex count, ends and length of whole lines, reduced from their parts."""
    first, last = F.col("line")[0], F.element_at("line", -1)
    slim = parts.withColumns({"_first": first, "_last": last}).drop("line")
    has = F.col("n_points").isNotNull()
    return slim.groupBy(*keys).agg(
        F.coalesce(F.sum("n_points"), F.lit(0)).alias("n_points"),
        F.min_by("_first", F.when(has, F.col("part"))).alias("first_point"),
        F.max_by("_last", F.when(has, F.col("part"))).alias("last_point"),
        F.sum("length").alias("length"),
    )
