"""Steps of a store are computed by one plan with one wide shuffle, whatever turns depend on earlier bursts."""

import uuid

import pytest
from pyspark.sql import Row

from trajspark import settings
from trajspark.operators import ids
from trajspark.operators.ids import PLACED, placed, with_burst_ids
from trajspark.operators.parameters import FILL_LATER, FILL_PGTRAJ, step_parameters
from trajspark.operators.steps import TYPE_II, build_steps
from trajspark.plans.segments import Known
from trajspark.sources.tables import bind_relocations
from trajspark.store import TrajectoryStore

BIND = dict(relocations=["x", "y"], pgtraj="grp", animal="animal", burst="burst", rid="gid", timestamps="at", srid=3395, time_zone="UTC")


@pytest.fixture
def source(spark):
    """Bursts that begin stationary, after bursts with and without a direction; tied, missing and undated fixes."""
    rows, gid = [], 0
    paths = {
        "a": [(0, 0), (0, 0), (1, 0), (1, 1)], "b": [(5, 5), (5, 5), (5, 5)], "c": [(2, 2), (2, 2), (2, 2), (3, 3), (3, 3), (3, 4)],
        "d": [(None, None), (0, 0), (0, 0), (0, 1)], "e": [(7, 7)], "f": [(1, 1), (1, 1), (0, 1), (0, 1), (0, 0)],
    }
    for grp in ("p", "q"):
        for name, path in paths.items():
            for n, (x, y) in enumerate(path):
                gid += 1
                second = None if name == "f" and n == 4 else n - (name == "c" and n == 5)
                rows.append(Row(gid=gid, grp=grp, animal=f"{grp}{name}", burst=f"{grp}{name}", at=second, x=None if x is None else float(x), y=None if y is None else float(y)))
    held = spark.createDataFrame(rows, "gid long, grp string, animal string, burst string, at long, x double, y double")
    return held.selectExpr("* except (at)", "TIMESTAMP_NTZ '2024-01-01' + at * INTERVAL '1' SECOND AS at")


def stored(spark, source):
    store = TrajectoryStore(spark, f"trajspark_{uuid.uuid4().hex}", settings.new_folder(spark, "store"))
    store.build(source, **BIND)
    return store


COLUMNS = ["pgtraj_name", "burst_name", "animal_name", "step_id", "relocation_id_2", "seq", "rid", "rid2", "dt_us", "dist", "abs_angle", "rel_angle", "r2n"]


@pytest.mark.parametrize("hot, a_range", [(1_000_000, 4), (3, 100_000)])
def test_stored_steps_are_those_of_the_operators(spark, source, monkeypatch, hot, a_range):
    monkeypatch.setattr("trajspark.store.ROWS_A_RANGE", a_range)
    steps = step_parameters(build_steps(bind_relocations(source, **BIND), TYPE_II, numbered=True), FILL_PGTRAJ)
    expected = sorted(map(tuple, ids.with_step_ids(steps).rows().select(*COLUMNS).collect()), key=repr)
    inside = step_parameters(build_steps(bind_relocations(source, **BIND), TYPE_II, numbered=True), FILL_LATER).rows()
    assert inside.filter("open").count() >= 4
    spark.conf.set("spark.trajspark.hotRows", str(hot))
    try:
        store = stored(spark, source)
        assert sorted(map(tuple, store.table("step").select(*COLUMNS).collect()), key=repr) == expected
        assert len({p[1] for p in store._partitions("step")}) == 1
    finally:
        spark.conf.unset("spark.trajspark.hotRows")


def test_placed_rows_are_shuffled_no_more(spark, source):
    bound = bind_relocations(source, **BIND)
    bursts = spark.createDataFrame([("p", "pa", 1, 0)], "pgtraj_name string, burst_name string, burst_id long, _earlier long")
    rows, keys = placed(bound, bursts, Known(6, 1), 4, 2)
    assert keys == PLACED
    before = rows._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
    laid = with_burst_ids(step_parameters(build_steps(rows, TYPE_II, numbered=True, known=Known(6, 1), keys=keys), FILL_LATER), bursts)
    plan = laid.rows()._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == before and plan.count("Sort [pgtraj_name") == 1
