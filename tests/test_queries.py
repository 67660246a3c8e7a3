"""Every registered query against its SQL counterpart, over the whole small tables."""

import pytest

from compare import compare
from inputs import TINY
from trajspark.suite.oracles import ORACLES
from trajspark.suite.queries import QUERIES

# whose plans change when groups are split into segments or lines into parts
ORDERED = [
    "steps_type2", "steps_type2_ties", "steps_null_time", "steps_type1", "steps_heavy_ties", "step_ids", "step_burst_relation",
    "step_parameters_computed", "step_parameters_pgtraj_fill", "step_parameters_ties", "step_parameters_heavy_ties", "burst_lines",
    "animal_lines", "window_lines", "time_defaults", "infolocs_attach", "export_type1", "export_nested", "nested_to_long", "set_na",
    "redistribute_time", "redistribute_space", "subsample", "cut", "bind", "to_type1",
]


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, name):
    assert compare(QUERIES[name](spark, TINY), ORACLES[name], TINY) == ""


@pytest.mark.parametrize("name", ORDERED)
def test_query_with_split_groups(spark, small_groups, name):
    spark.conf.set("spark.trajspark.hotRows", "20")
    assert compare(QUERIES[name](spark, TINY), ORACLES[name], TINY) == ""


def test_entry_point(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.count() == 1000 and "rel_angle" in df.columns
    assert entry.queries().keys() >= entry.oracle_sql().keys()
