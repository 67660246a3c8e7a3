"""Reshaping trajectories: regularise, fill, interpolate, subsample, cut, bind, combine.

All operators take and return bound relocations; parameters are computed again from the result with ``recompute``.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trajspark import settings
from trajspark.functions.walk import STATE, walkers
from trajspark.operators.parameters import FILL_BURST, step_parameters
from trajspark.operators.steps import BURST, TYPE_II, build_steps, ordered
from trajspark.plans.segments import SEGMENT, FirstRow, Laid, Previous, RowNumber, RunningSum, with_prefix
from trajspark.sources.tables import check_names

STRETCH = 10_000


def recompute(relocations: DataFrame, kind: int = TYPE_II, fill: str = FILL_BURST, within: Laid | None = None) -> Laid:
    """Steps and parameters from scratch."""
    return step_parameters(build_steps(relocations, kind, within), fill)


def _stretches(df: DataFrame, first: Column, last: Column, name: str) -> DataFrame:
    """One row per whole number first..last; long ranges are opened in two levels so no array grows large."""
    df = df.withColumns({"_lo": first, "_hi": last}).filter(F.col("_lo") <= F.col("_hi"))
    blocks = F.sequence(F.lit(0).cast("long"), F.floor((F.col("_hi") - F.col("_lo")) / STRETCH).cast("long"))
    df = df.withColumn("_block", F.explode(blocks)).withColumn("_from", F.col("_lo") + F.col("_block") * STRETCH)
    df = df.withColumn(name, F.explode(F.sequence("_from", F.least(F.col("_from") + (STRETCH - 1), F.col("_hi")))))
    return df.drop("_lo", "_hi", "_block", "_from")


def _nearest(us: Column, ref_us: int, step_us: int) -> Column:
    """Index of the nearest grid point, halves up, in whole-number arithmetic."""
    twice = (us - ref_us) * 2 + step_us
    return ((twice - F.pmod(twice, F.lit(2 * step_us))) / (2 * step_us)).cast("long")


def off_grid(relocations: DataFrame, ref_us: int, step_us: int, tolerance_us: int) -> DataFrame:
    """Fixes further than the tolerance from their grid point."""
    away = F.abs(F.col("us") - (ref_us + _nearest(F.col("us"), ref_us, step_us) * step_us))
    return relocations.filter(away > tolerance_us)


def set_na(relocations: DataFrame, ref_us: int, step_us: int, tolerance_us: int | None = None) -> DataFrame:
    """Add the missing relocations of a regular schedule: grid times without coordinates.

    Every fix takes its nearest grid point; the grid points between two successive fixes are added with a null
    rid. Existing fixes keep their time. With a tolerance, a fix further off its grid point is an error.
    """
    if tolerance_us is not None and off_grid(relocations, ref_us, step_us, tolerance_us).limit(1).collect():
        raise ValueError("the trajectory is irregular: a fix is further from the grid than the tolerance")
    laid = build_steps(relocations)
    here = _nearest(F.col("us"), ref_us, step_us)
    after = _nearest(F.col("us2"), ref_us, step_us)
    # Tied fixes share a successor; only the first of them opens the gap.
    opens = with_prefix(laid, _same=Previous(F.col("us")))
    rows = opens.rows().filter(F.col("us2").isNotNull() & ~F.coalesce(F.col("_same") == F.col("us"), F.lit(False)))
    gaps = _stretches(rows, here + 1, after - 1, "_grid")
    missing = gaps.withColumns(
        {
            "us": F.lit(ref_us).cast("long") + F.col("_grid") * step_us,
            "rid": F.lit(None).cast("long"),
            "x": F.lit(None).cast("double"),
            "y": F.lit(None).cast("double"),
        }
    )
    return relocations.unionByName(missing.select(*relocations.columns))


def set_t0(relocations: DataFrame, ref_us: int, step_us: int) -> DataFrame:
    """Move every time to its nearest grid point."""
    return relocations.withColumn("us", F.lit(ref_us).cast("long") + _nearest(F.col("us"), ref_us, step_us) * step_us)


def omit_missing(relocations: DataFrame) -> DataFrame:
    """Only relocations with coordinates."""
    return relocations.filter(F.col("x").isNotNull() & F.col("y").isNotNull())


def redistribute_time(relocations: DataFrame, step_us: int) -> DataFrame:
    """Linear interpolation on a regular schedule that starts at the first known fix of each burst."""
    laid = build_steps(omit_missing(relocations).filter(F.col("us").isNotNull()))
    laid = with_prefix(laid, _begin=FirstRow(F.col("us")), _same=Previous(F.col("us")))
    rows = laid.rows().filter(~F.coalesce(F.col("_same") == F.col("us"), F.lit(False)))

    def ceiled(us):
        since = us - F.col("_begin")
        return ((since + F.pmod(-since, F.lit(step_us))) / step_us).cast("long")

    # A fix owns the schedule points from its time up to, not including, the next fix; the last fix owns its own.
    last = F.when(F.col("us2").isNull(), ceiled(F.col("us") + 1) - 1).otherwise(ceiled(F.col("us2")) - 1)
    grid = _stretches(rows, ceiled(F.col("us")), last, "_grid").withColumn("_at", F.col("_begin") + F.col("_grid") * step_us)
    share = F.when(F.col("us2").isNull(), 0.0).otherwise((F.col("_at") - F.col("us")) / (F.col("us2") - F.col("us")))
    moved = grid.withColumns(
        {
            "x": F.col("x") + F.coalesce((F.col("x2") - F.col("x")) * share, F.lit(0.0)),
            "y": F.col("y") + F.coalesce((F.col("y2") - F.col("y")) * share, F.lit(0.0)),
        }
    )
    return moved.withColumns({"us": F.col("_at"), "rid": F.col("_grid") + 1}).select(*relocations.columns)


def subset(parameters: DataFrame, condition: str) -> DataFrame:
    """Steps that meet a condition on their parameters; nothing is computed again."""
    return parameters.filter(condition)


def subsample(relocations: DataFrame, step_us: int) -> DataFrame:
    """Keep the fixes a whole number of ``step_us`` after the first fix of their burst."""
    laid = with_prefix(ordered(relocations), _begin=FirstRow(F.col("us")))
    kept = laid.rows().filter(F.pmod(F.col("us") - F.col("_begin"), F.lit(step_us)) == 0)
    return kept.select(*relocations.columns)


def cut(parameters: Laid, condition: str) -> Laid:
    """Start a new burst after each step that meets the condition (unknown counts as not met).

    The relocation such a step starts from ends its piece; the next one begins piece n+1. Pieces are named
    ``<burst>.<n>`` from 1, and short pieces are kept.
    """
    meets = F.coalesce(F.expr(condition), F.lit(False)).cast("long")
    laid = parameters.on(parameters.df.withColumn("_meets", meets))
    laid = with_prefix(laid, _upto=RunningSum(F.col("_meets")))
    piece = F.col("_upto") - F.col("_meets") + 1
    named = F.concat_ws(".", F.col("burst_name"), piece.cast("string"))
    return replace(laid, df=laid.df.withColumn("burst_name", named).drop("_meets", "_upto"), n_groups=None)


def bind(relocations: DataFrame) -> DataFrame:
    """All bursts of an animal in one burst, named after the animal."""
    return relocations.withColumn("burst_name", F.col("animal_name"))


def rename_bursts(relocations: DataFrame, suffix: str, separator: str = "-") -> DataFrame:
    return relocations.withColumn("burst_name", F.concat(F.col("burst_name"), F.lit(f"{separator}{suffix}")))


def combine(*trajectories: DataFrame, check: bool = True) -> DataFrame:
    """Several trajectories as one; burst names must stay unique inside a pgtraj."""
    out = trajectories[0]
    for other in trajectories[1:]:
        out = out.unionByName(other)
    if check:
        keys = ["pgtraj_name", "animal_name", "burst_name"]
        names = trajectories[0].select(*keys).distinct()
        for other in trajectories[1:]:
            theirs = other.select(*keys).distinct()
            taken = names.join(theirs, ["pgtraj_name", "burst_name"], "left_semi").limit(1).collect()
            if taken:
                raise ValueError(f"burst {taken[0]['burst_name']!r} is in more than one trajectory")
            names = names.unionByName(theirs)
        check_names(out)
    return out


def to_type1(relocations: DataFrame) -> DataFrame:
    """Drop the times and keep the order: rid becomes the position in the burst."""
    laid = with_prefix(ordered(relocations), _seq=RowNumber())
    df = laid.rows().withColumns({"rid": F.col("_seq"), "us": F.lit(None).cast("long")})
    return df.select(*relocations.columns)


# -- constant step length ---------------------------------------------------------------------------------


def _nullable(schema: T.StructType) -> list[T.StructField]:
    return [T.StructField(f.name, f.dataType) for f in schema.fields]


def redistribute_space(relocations: DataFrame, length: float) -> DataFrame:
    """Rebuild each burst with a constant step length; times are interpolated, the rest shorter than a step is left.

    Each point depends on the one before, so a burst is walked in order. Bursts that fit a task are walked
    in parallel. A larger burst is walked segment by segment: its segments are written once under their turn, one job reads
    the next segment of every such burst, and only the walking position (one row per large burst) passes from job to job.
    Tasks hand on points in chunks, so a length far shorter than the steps needs no more memory.
    """
    if length <= 0:
        raise ValueError("length must be positive")
    keys = list(BURST)
    laid = ordered(omit_missing(relocations).filter(F.col("us").isNotNull()))
    columns, fields = relocations.columns, _nullable(relocations.schema)
    whole_bursts, continued = walkers(length, BURST, columns)
    small = laid.df.filter(F.col(SEGMENT) == 0) if laid.split else laid.df
    tasks = int(relocations.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    small = small.select(*columns).repartition(tasks, *keys).sortWithinPartitions(*keys, "us", "rid")
    walk_small = small.mapInPandas(whole_bursts, T.StructType(fields))
    if not laid.split:
        return walk_small

    large = laid.df.filter(F.col(SEGMENT) > 0)
    spark = relocations.sparkSession
    in_order = Window.partitionBy(*keys).orderBy(SEGMENT)
    ranks = large.select(*laid.groups).distinct().withColumn("_turn", F.row_number().over(in_order))
    ranks = settings.write_through(ranks, "turns")
    turns = ranks.agg(F.max("_turn")).first()[0]
    state_fields = [T.StructField(c, T.LongType() if c == "_made" else T.DoubleType()) for c in STATE]
    state_schema = T.StructType([*[T.StructField(k, T.StringType()) for k in keys], *state_fields])
    states = spark.createDataFrame([], state_schema)
    step_schema = T.StructType([*fields, T.StructField("_is_state", T.BooleanType()), *state_fields])

    folder = settings.new_folder(spark, "walk")
    queued = settings.new_folder(spark, "walk-turns")
    turned = large.join(settings.broadcast_if(ranks, laid.segments), laid.groups)
    turned.select(*columns, "_turn").write.partitionBy("_turn").parquet(queued)
    queue_schema = T.StructType(fields)
    for turn in range(1, turns + 1):
        now = spark.read.schema(queue_schema).parquet(f"{queued}/_turn={turn}")
        now = now.join(settings.broadcast_if(states, laid.segments), keys, "left")
        now = now.repartition(tasks, *keys).sortWithinPartitions(*keys, "us", "rid")
        now.mapInPandas(continued, step_schema).write.parquet(f"{folder}/turn={turn}")
        states = spark.read.schema(step_schema).parquet(f"{folder}/turn={turn}").filter("_is_state").select(*state_schema.names)
    walked = spark.read.schema(step_schema).parquet(folder).filter(~F.col("_is_state")).select(*columns)
    return walk_small.unionByName(walked)
