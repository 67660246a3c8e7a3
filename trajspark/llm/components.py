"""Connected components of a link table with large-star and small-star steps, as in Kiveris et al. (2014).

Each step is a grouped minimum, merged before the shuffle, and a join; links are written to the shared folder between rounds.
Nothing is collected but one number for the end test.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trajspark.llm.common import saved


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("_m")).select("a", F.least("a", "_m").alias("m"))
    return both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame, label: str) -> DataFrame:
    """(a, b) links of one orderable type to (node, component): the smallest node of each component, itself included."""
    ordered = links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    current, mark = saved(ordered, f"{label}-links"), None
    while True:
        state = current.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
        if (state["n"], state["x"]) == mark:
            break
        mark = (state["n"], state["x"])
        current = saved(_small_star(_large_star(current)), f"{label}-stars")
    members = current.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return members.unionByName(current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
