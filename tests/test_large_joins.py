"""Tables with a row per burst that are too many to broadcast are shuffled as they are, never repeated and never gathered in the driver."""

import pytest
from pyspark.sql import functions as F

from trajspark import settings


@pytest.fixture
def large_tables(spark):
    spark.conf.set("spark.trajspark.broadcastRows", "3")
    yield
    spark.conf.unset("spark.trajspark.broadcastRows")


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString() + df._jdf.queryExecution().sparkPlan().toString()


@pytest.mark.parametrize("how", ["left", "inner", "left_semi"])
@pytest.mark.parametrize("hot", [1000, 50])
def test_join_small_beyond_the_limit(spark, large_tables, how, hot):
    facts = spark.range(400).select(F.col("id").alias("n"), F.when(F.col("id") < 200, 0).when(F.col("id") % 50 > 0, F.col("id") % 50).alias("k"))
    table = spark.range(20).select(F.col("id").cast("long").alias("k"), (F.col("id") * 3).alias("v"))
    spark.conf.set("spark.trajspark.hotRows", str(hot))
    try:
        joined = settings.join_small(facts, table, "k", how)
        assert sorted(map(tuple, joined.collect()), key=repr) == sorted(map(tuple, facts.join(table, "k", how).collect()), key=repr)
        assert "explode" not in plan(joined)
        if hot == 1000:
            assert "Broadcast" not in plan(joined)
            assert "Broadcast" not in plan(settings.join_small(facts, table, "k", how, largest=200))
    finally:
        spark.conf.unset("spark.trajspark.hotRows")


def test_a_table_counted_as_large_is_not_broadcast_by_its_file_size(spark, large_tables):
    facts, table = spark.range(100), settings.write_through(spark.range(10), "few")
    assert "Broadcast" in plan(facts.join(table, "id"))
    assert "Broadcast" not in plan(facts.join(settings.broadcast_if(table, 10), "id"))
