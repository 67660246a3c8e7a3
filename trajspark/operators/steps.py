"""Steps: each relocation linked to its successor in the burst."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trajspark.functions import planar
from trajspark.plans.segments import Known, Laid, RowNumber, lay_out, with_prefix, with_strict_next

BURST = ("pgtraj_name", "burst_name")
TYPE_II, TYPE_I = 2, 1
# Fixed value: rows without a time come last in their burst.
LAST = 2**63 - 1


def ordered(relocations: DataFrame, kind: int = TYPE_II, keys=BURST, within: Laid | None = None, known: Known | None = None) -> Laid:
    """Relocations laid out by burst, in time order (Type II, ties by rid) or in rid order (Type I)."""
    if kind == TYPE_I:
        return lay_out(relocations, keys, ("rid",), within, known=known)
    df = relocations.withColumn("_when", F.coalesce("us", F.lit(LAST)))
    return lay_out(df, keys, ("_when", "rid"), within, known=known)


def build_steps(
    relocations: DataFrame, kind: int = TYPE_II, within: Laid | None = None, numbered: bool = False, known: Known | None = None, keys=BURST
) -> Laid:
    """One step per relocation.

    Type II: the successor is the first relocation with a strictly later time, so tied fixes share it, and a
    fix without a time has none. Type I: the successor is the next rid. Added columns: rid2, us2, x2, y2, dt_us,
    and with ``numbered`` seq and seq2, the positions of both ends in the burst.
    """
    laid = ordered(relocations, kind, keys, within=within, known=known)
    if numbered:
        laid = with_prefix(laid, seq=RowNumber())
    at = "us" if kind == TYPE_II else "rid"
    payload = [c for c in ("rid", "us", "x", "y", *(["seq"] if numbered else [])) if c != at]
    laid = with_strict_next(laid, at, payload)
    ends = {"rid2": F.col("_next.rid"), "us2": F.col("_next.us"), "x2": F.col("_next.x"), "y2": F.col("_next.y")}
    if numbered:
        ends["seq2"] = F.col("_next.seq")
    df = laid.df.withColumns(ends).drop("_next")
    return laid.on(df.withColumn("dt_us", F.col("us2") - F.col("us")))


def computed_steps(trajectory: DataFrame) -> DataFrame:
    """Steps of a trajectory whose parameters are already known.

    Each row brings its own pair of relocations, (x, y, t) and (x+dx, y+dy, t+dt), so steps need not be
    continuous. Times and durations are cut to whole seconds; the second relocation exists even when its
    position is unknown. Input columns: x, y, us, dx, dy, dt (seconds), r2n, rel_angle and the names.
    """
    whole = F.floor(F.col("us") / F.lit(1_000_000)) * 1_000_000
    dt_us = F.round(F.col("dt")).cast("long") * 1_000_000
    return trajectory.withColumns(
        {
            "us": whole,
            "dt_us": dt_us,
            "us2": whole + dt_us,
            "x2": F.col("x") + F.col("dx"),
            "y2": F.col("y") + F.col("dy"),
        }
    ).drop("dist", "abs_angle", "dx", "dy", "dt")


def step_geometry(steps: DataFrame) -> DataFrame:
    """Two-vertex line per step. Steps without a second relocation are left out; a missing end gives a null line."""
    line: Column = planar.segment(F.col("x"), F.col("y"), F.col("x2"), F.col("y2"))
    return steps.filter(F.col("rid2").isNotNull()).withColumn("step_geom", line)
