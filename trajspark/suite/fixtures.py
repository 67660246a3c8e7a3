"""Trajectories made from the given tables, for the registered queries."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trajspark.operators.ids import with_step_ids
from trajspark.operators.parameters import FILL_BURST, step_parameters
from trajspark.operators.steps import TYPE_II, build_steps
from trajspark.operators.views import step_view
from trajspark.plans.segments import Laid
from trajspark.sources.tables import bind_relocations

SRID = 3395
ZONE = "Europe/Paris"
START = datetime(2024, 1, 1)
HOUR_US = 3_600_000_000
DAY_US = 24 * HOUR_US
START_US = round((START - datetime(1970, 1, 1)) / timedelta(microseconds=1))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fixes(spark: SparkSession, sf_dir: str, variant: str = "base") -> DataFrame:
    """Events as a source table of fixes on a coarse grid, some missing, some stationary.

    Variants: ``ties`` cuts times to days, ``null_time`` drops some times.
    """
    events = table(spark, sf_dir, "events")
    missing = (F.col("event_type") == "error") & (F.col("event_id") % 7 == 0)
    at: Column = F.col("ts")
    if variant == "ties":
        at = F.date_trunc("day", "ts").cast("timestamp_ntz")
    elif variant == "null_time":
        at = F.when(F.col("event_id") % 97 != 0, F.col("ts"))
    return events.select(
        "event_id",
        F.concat(F.lit("p"), (F.col("user_id") % 4).cast("string")).alias("grp"),
        F.concat(F.lit("a"), F.col("user_id").cast("string")).alias("animal"),
        F.concat(F.lit("a"), F.col("user_id").cast("string"), F.lit("-"), F.col("event_type")).alias("burst"),
        at.alias("ts"),
        F.when(~missing, F.floor(F.col("value") / 40.0) * 10.5).alias("x"),
        F.when(~missing, (F.col("event_id") % 3) * 7.25).alias("y"),
        "event_type",
        "props",
    )


def relocations(
    spark: SparkSession, sf_dir: str, variant: str = "base", kind: int = TYPE_II, burst: str | None = "burst", clauses: str | None = None
) -> DataFrame:
    return bind_relocations(
        fixes(spark, sf_dir, variant),
        relocations=["x", "y"], pgtraj="grp", animal="animal", burst=burst, rid="event_id",
        timestamps="ts" if kind == TYPE_II else None, srid=SRID, time_zone=ZONE, clauses=clauses,
    )


def parameters(spark: SparkSession, sf_dir: str, fill: str = FILL_BURST, kind: int = TYPE_II, ids: bool = False) -> Laid:
    laid = step_parameters(build_steps(relocations(spark, sf_dir, kind=kind), kind, numbered=ids), fill)
    return with_step_ids(laid) if ids else laid


def view(spark: SparkSession, sf_dir: str, infolocs: DataFrame | None = None) -> DataFrame:
    """The step view of all pgtrajs."""
    return step_view(parameters(spark, sf_dir, ids=True).rows(), SRID, infolocs)


def supplier_fixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as one fix per supplier, part and day: long bursts with many equal times."""
    items = table(spark, sf_dir, "lineitem")
    day = F.unix_date(F.to_date("l_shipdate"))
    rid = (F.col("l_suppkey") * 1_000_000 + F.col("l_partkey")) * 100_000 + day
    once = items.groupBy("l_suppkey", "l_partkey", "l_shipdate").agg(F.min("l_quantity").alias("x"), F.max("l_quantity").alias("y"))
    return bind_relocations(
        once.select(rid.alias("rid"), F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("supplier"), "l_shipdate", "x", "y"),
        relocations=["x", "y"], pgtraj="suppliers", animal="supplier", timestamps="l_shipdate", srid=SRID, time_zone=ZONE,
    )


def infolocs_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extra columns per event, one of them under the reserved name; every eleventh event has none."""
    events = table(spark, sf_dir, "events").filter("event_id % 11 <> 0")
    return events.select(
        "event_id",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        F.col("event_type").alias("status"),
        (F.col("value") * 2).alias("step_id"),
        F.col("ts").alias("seen"),
        F.col("ts").cast("string").alias("written"),
    )
