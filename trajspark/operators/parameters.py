"""Step parameters: displacement, distance, duration, angles and net displacement."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trajspark import settings
from trajspark.functions import planar, times
from trajspark.plans.segments import SEGMENT, FirstRow, Laid, LastKnown, Previous, RowNumber, lay_out, with_prefix

FILL_BURST, FILL_PGTRAJ, FILL_LATER = "burst", "pgtraj", "later"


def shape(df: DataFrame) -> DataFrame:
    """dx, dy, dist and abs_angle of each step, from its own two ends."""
    df = df.withColumns({"dx": F.col("x2") - F.col("x"), "dy": F.col("y2") - F.col("y")})
    df = df.withColumn("dist", planar.length(F.col("dx"), F.col("dy")))
    return df.withColumn("abs_angle", planar.direction(F.col("dx"), F.col("dy"), F.col("dist")))


def step_parameters(steps: Laid, fill: str = FILL_BURST) -> Laid:
    """All parameters computed from raw steps.

    ``rel_angle`` is the turn since the step before. After a stationary step the direction of the last moving
    step is used; ``fill`` says how far back it is looked for: inside the burst, or through all earlier bursts
    of the pgtraj in name order. A step of unknown length before gives a null turn. With ``FILL_LATER`` it is looked for
    inside the burst, and steps whose turn depends on earlier bursts are marked ``open`` (one in a burst at most, its first
    moving step) for ``turns_of_open``, so that the steps are computed once.
    """
    laid = steps.on(shape(steps.df))
    before = F.struct("dist", "abs_angle")
    running = {"seq": RowNumber()} if "seq" not in laid.df.columns else {}
    running |= {"_before": Previous(before), "_start": FirstRow(F.struct("x", "y"))}
    if fill in (FILL_BURST, FILL_LATER):
        laid = with_prefix(laid, **running, _moving=LastKnown(F.col("abs_angle")))
    elif fill == FILL_PGTRAJ:
        laid = _fill_through_bursts(laid, running)
    else:
        raise ValueError(f"fill must be {FILL_BURST!r}, {FILL_PGTRAJ!r} or {FILL_LATER!r}")

    from_x, from_y = F.col("x") - F.col("_start.x"), F.col("y") - F.col("_start.y")
    still = F.col("_before.dist") < planar.STATIONARY
    turn = F.col("abs_angle") - F.when(still, F.col("_moving")).otherwise(F.col("_before.abs_angle"))
    df = laid.df.withColumns(
        {
            "dt": times.seconds(F.col("dt_us")),
            "r2n": from_x * from_x + from_y * from_y,
            "rel_angle": planar.wrap(turn),
        }
    )
    if fill == FILL_LATER:
        df = df.withColumn("open", F.coalesce(still, F.lit(False)) & F.col("_moving").isNull() & F.col("abs_angle").isNotNull())
    return laid.on(df.drop("_before", "_start", "_moving"))


def turns_of_open(opened: DataFrame, steps: DataFrame, bursts: int) -> DataFrame:
    """Turns of steps that were left open, by the last moving direction in earlier bursts of the pgtraj.

    ``steps`` are all steps, written, with pgtraj_name, burst_id (in name order), seq and abs_angle; they are reduced to a row for each of the
    ``bursts`` and the directions carried forward in that small table.
    """
    end = F.max_by("abs_angle", F.when(F.col("abs_angle").isNotNull(), F.col("seq")))
    ends = steps.groupBy("pgtraj_name", "burst_id").agg(end.alias("_end"))
    names = steps.select("pgtraj_name", "burst_id").distinct()
    chain = lay_out(ends, ("pgtraj_name",), ("burst_id",), count_on=names, known_rows=bursts)
    carried = with_prefix(chain, _moving=LastKnown(F.col("_end"))).rows().select("burst_id", "_moving").filter("_moving IS NOT NULL")
    found = opened.join(settings.broadcast_if(carried, bursts), "burst_id", "left")
    return found.withColumn("rel_angle", planar.wrap(F.col("abs_angle") - F.col("_moving"))).drop("_moving")


def _fill_through_bursts(laid: Laid, running: dict) -> Laid:
    """Last moving direction before each step, across segments and earlier bursts of the pgtraj.

    Inside a segment a window finds it. For what lies before the segment, one row per segment (its last moving
    direction) is carried forward in (burst, segment) order; that small table is itself laid out safely.
    """
    laid = with_prefix(laid, **running)
    inside = LastKnown(F.col("abs_angle"))
    df = laid.df.withColumn("_inside", inside.local(laid.window()))
    ends = laid.df.groupBy(*laid.groups).agg(inside.part(laid.position()).alias("_end"))
    names = laid.df.select(*laid.groups).distinct()
    if laid.split:
        ends, names = (t.withColumnRenamed(SEGMENT, "_piece") for t in (ends, names))
    known = None if laid.n_groups is None else laid.n_groups + laid.segments
    within_pgtraj = ("burst_name", "_piece") if laid.split else ("burst_name",)
    chain = lay_out(ends, ("pgtraj_name",), within_pgtraj, count_on=names, known_rows=known)
    carried = with_prefix(chain, _earlier=LastKnown(F.col("_end"))).rows().drop("_end")
    if laid.split:
        carried = carried.withColumnRenamed("_piece", SEGMENT)
    df = df.join(carried, laid.groups, "left")
    return laid.on(df.withColumn("_moving", F.coalesce("_inside", "_earlier")).drop("_inside", "_earlier"))


def stored_parameters(steps: DataFrame) -> DataFrame:
    """Parameters of imported steps: r2n and rel_angle as imported, the rest from the two ends."""
    return shape(steps).withColumn("dt", times.seconds(F.col("dt_us")))
