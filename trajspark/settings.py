"""Session settings and the shared folder for written intermediate tables.

All limits are read from the Spark session, so a cluster can tune them without code changes:

``spark.trajspark.hotRows``        rows a group may hold before it is split into ordered segments
``spark.trajspark.broadcastRows``  rows a small table may hold before its broadcast hint is dropped
``spark.trajspark.linePoints``     vertices (or nested rows) one output row may hold
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

HOT_ROWS = 1_000_000
BROADCAST_ROWS = 100_000
LINE_POINTS = 50_000


def _limit(spark: SparkSession, key: str, default: int) -> int:
    return int(spark.conf.get(f"spark.trajspark.{key}", str(default)))


def hot_rows(spark: SparkSession) -> int:
    return _limit(spark, "hotRows", HOT_ROWS)


def broadcast_rows(spark: SparkSession) -> int:
    return _limit(spark, "broadcastRows", BROADCAST_ROWS)


def line_points(spark: SparkSession) -> int:
    return _limit(spark, "linePoints", LINE_POINTS)


def broadcast_if(df: DataFrame, rows: int | None) -> DataFrame:
    """Hint a broadcast only when the row count is known and within the limit.

    A table known to be larger is kept from being broadcast at all: Spark goes by the size of its compressed files, which says little about
    what the rows take in the driver.
    """
    if rows is None:
        return df
    return F.broadcast(df) if rows <= broadcast_rows(df.sparkSession) else df.hint("merge")


def join_small(facts: DataFrame, table: DataFrame, on: str, how: str = "left", largest: int | None = None, count_on: DataFrame | None = None) -> DataFrame:
    """Join facts to a table with one row per ``on``, when one value of ``on`` may hold most facts.

    The table is broadcast when its counted rows allow it. Otherwise both sides are shuffled, no row more than once, except for values with more facts
    than a task should hold (``hotRows``): these are few, and their rows of the table are broadcast. They are found by counting facts (or ``count_on``,
    which is cheaper), unless the rows of the ``largest`` value are known to be within the limit.
    """
    spark, limit = facts.sparkSession, hot_rows(facts.sparkSession)
    if table.limit(broadcast_rows(spark) + 1).count() <= broadcast_rows(spark):
        return facts.join(F.broadcast(table), on, how)
    if largest is not None and largest <= limit:
        return facts.join(table.hint("merge"), on, how)
    sizes = (facts if count_on is None else count_on).groupBy(on).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > limit)
    hot = write_through(sizes.select(F.col(on).alias("_hot")), "large-values")
    n = hot.count()
    if not n:
        return facts.join(table.hint("merge"), on, how)
    values, same = broadcast_if(hot, n), F.col(on).eqNullSafe(F.col("_hot"))
    large = facts.join(values, same, "left_semi").join(broadcast_if(table.join(values, same, "left_semi"), n), on, how)
    return facts.join(values, same, "left_anti").join(table.hint("merge"), on, how).unionByName(large)


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``.

    A local session without the setting gets a fresh folder under the system temporary folder; a cluster
    session without it is an error, because a machine-local folder would be lost with its machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="trajspark-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_folder(spark)}/trajspark/{label}-{uuid.uuid4().hex}"


def write_through(df: DataFrame, label: str) -> DataFrame:
    """Cut lineage: write ``df`` as Parquet in the shared folder and read it back."""
    spark = df.sparkSession
    path = new_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
