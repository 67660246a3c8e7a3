"""Summaries per pgtraj and burst, time defaults and name lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trajspark.functions import times
from trajspark.plans.segments import Known, RunningSum, lay_out, with_prefix


def burst_summary(steps: DataFrame) -> DataFrame:
    """Relocations, missing fixes and time span of each burst; one step is one relocation."""
    known = F.col("x").isNotNull() & F.col("y").isNotNull()
    return (
        steps.groupBy("pgtraj_name", "animal_name", "burst_name")
        .agg(
            F.count(F.lit(1)).alias("num_relocations"),
            F.count_if(~known).alias("num_na"),
            F.min("us").alias("_begin"),
            F.max("us").alias("_end"),
        )
        .withColumns({"date_begin": times.wall_time(F.col("_begin")), "date_end": times.wall_time(F.col("_end"))})
        .drop("_begin", "_end")
    )


def pgtraj_summary(steps: DataFrame, pgtrajs: DataFrame | None = None, info_tables: DataFrame | None = None) -> DataFrame:
    """Burst names, relocations and time span of each pgtraj; a name that several animals share is one burst.

    Built on the burst summary, so a pgtraj that holds most rows is already reduced to one row per burst before
    its own shuffle. ``pgtrajs`` adds descriptions (pgtraj_id, last_update); ``info_tables`` (columns pgtraj_name and
    infolocs_table, or table_name alone) adds the name of the infolocs table.
    """
    facts = (
        F.sum("num_relocations").alias("num_relocations"), F.min("date_begin").alias("date_begin"), F.max("date_end").alias("date_end"),
    )
    out = (
        burst_summary(steps)
        .groupBy("pgtraj_name", "burst_name")
        .agg(*facts)
        .groupBy("pgtraj_name")
        .agg(
            F.count(F.lit(1)).alias("num_bursts"),
            F.sum("num_relocations").alias("num_relocations"),
            F.min("date_begin").alias("earliest_date"),
            F.max("date_end").alias("latest_date"),
        )
    )
    if pgtrajs is not None:
        out = pgtrajs.join(out, "pgtraj_name")
    if info_tables is not None:
        named = info_tables
        if "table_name" in info_tables.columns:
            named = info_tables.filter(F.col("table_name").startswith("infolocs_")).select(
                F.substring("table_name", 10, 1_000_000).alias("pgtraj_name"), F.col("table_name").alias("infolocs_table")
            )
        out = out.join(named, "pgtraj_name", "left")
    return out


def distinct_bursts(steps: DataFrame) -> DataFrame:
    return steps.select("burst_name").distinct()


def distinct_animals(steps: DataFrame) -> DataFrame:
    return steps.select("animal_name").distinct()


def bursts_by_name(bursts: DataFrame, names, pgtraj: str | None = None) -> DataFrame:
    """Rows of the named bursts. The names are looked up in every pgtraj unless one is given."""
    names = [names] if isinstance(names, str) else list(names or [])
    found = bursts.filter(F.col("burst_name").isin(names)) if names else bursts.limit(0)
    return found if pgtraj is None else found.filter(F.col("pgtraj_name") == pgtraj)


def _durations(steps: DataFrame, keys) -> DataFrame:
    """Steps counted by duration, with the first and last time among them."""
    return steps.groupBy(*keys, "dt_us").agg(F.count(F.lit(1)).alias("_n"), F.min("us").alias("_start"), F.max("us").alias("_last"))


def _median(durations: DataFrame, keys, at_most: DataFrame, known: Known | None) -> DataFrame:
    counts = durations.filter(F.col("dt_us").isNotNull()).select(*keys, "dt_us", "_n")
    total = counts.groupBy(*keys).agg(F.sum("_n").alias("_total"))
    laid = with_prefix(lay_out(counts, keys, ("dt_us",), at_most=at_most, known=known), _upto=RunningSum(F.col("_n")))
    laid = laid.join_groups(total)
    low, high = F.floor((F.col("_total") - 1) / 2), F.ceil((F.col("_total") - 1) / 2)

    def holds(rank):
        return (F.col("_upto") > rank) & (F.col("_upto") - F.col("_n") <= rank)

    middle = laid.df.filter(holds(low) | holds(high)).groupBy(*keys).agg((F.min("dt_us") + F.max("dt_us")).alias("_twice"))
    return middle.select(*keys, (F.col("_twice") / F.lit(2.0 * times.SECOND)).alias("increment"))


def median_duration(steps: DataFrame, keys=("pgtraj_name",), at_most: DataFrame | None = None, known: Known | None = None) -> DataFrame:
    """Exact continuous median of dt in seconds per key.

    Durations are first reduced to (value, count); the two middle ranks are then read off running counts, so
    memory does not grow with the number of steps or of different durations. ``at_most`` is a cheap table with as
    many rows per key (see ``lay_out``), by default the key columns of ``steps``; ``known`` are stored numbers of steps.
    """
    return _median(_durations(steps, keys), keys, steps.select(*keys) if at_most is None else at_most, known)


def time_defaults(steps: DataFrame, known: Known | None = None) -> DataFrame:
    """First and last time and median step duration (seconds) of each pgtraj, all from steps counted by duration."""
    keys = ("pgtraj_name",)
    durations = _durations(steps, keys)
    span = durations.groupBy(*keys).agg(F.min("_start").alias("_start"), F.max("_last").alias("_last"))
    return span.join(_median(durations, keys, steps.select(*keys), known), "pgtraj_name", "left").select(
        "pgtraj_name",
        times.wall_time(F.col("_start")).alias("tstamp_start"),
        times.wall_time(F.col("_last")).alias("tstamp_last"),
        "increment",
    )


def default_window(defaults: DataFrame, steps: int = 10) -> DataFrame:
    """Width in seconds of the first view: ``steps`` median durations, or the whole span when that is shorter."""
    span = F.timestamp_diff("MICROSECOND", "tstamp_start", "tstamp_last") / F.lit(float(times.SECOND))
    wide = F.col("increment") * steps
    return defaults.withColumn("interval", F.when(wide < span, wide).otherwise(span))


def is_regular(parameters: DataFrame) -> DataFrame:
    """Whether all steps of every burst have one duration, per pgtraj. Bursts are reduced first."""
    bursts = parameters.groupBy("pgtraj_name", "burst_name").agg(
        F.coalesce(F.min("dt_us") == F.max("dt_us"), F.lit(True)).alias("_same")
    )
    return bursts.groupBy("pgtraj_name").agg(F.bool_and("_same").alias("regular"))


def selection_changes(wanted: DataFrame, shown: DataFrame, key: str = "burst_name") -> DataFrame:
    """Names to add to and to remove from a shown selection."""
    add = wanted.join(shown, key, "left_anti").select(key, F.lit("add").alias("change"))
    return add.unionByName(shown.join(wanted, key, "left_anti").select(key, F.lit("remove").alias("change")))
