import uuid
import warnings
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from inputs import TINY
from trajspark.operators.infolocs import InfoType
from trajspark.store import TrajectoryStore, transfer
from trajspark.suite import fixtures as fx


@pytest.fixture
def store(spark):
    return TrajectoryStore(spark, f"traj_{uuid.uuid4().hex[:8]}")


def built(spark, store, **more):
    options = dict(
        relocations=["x", "y"], pgtraj="grp", animal="animal", burst="burst", rid="event_id", timestamps="ts", srid=fx.SRID,
        time_zone=fx.ZONE, clauses="WHERE grp IN ('p0', 'p1')",
    )
    return store.build(fx.fixes(spark, TINY), **{**options, **more})


def rows(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=repr)


def test_build_reads_back_the_computed_parameters(spark, store):
    assert sorted(built(spark, store)) == store.pgtrajs() == ["p0", "p1"]
    stored = store.parameters("p0")
    computed = fx.parameters(spark, TINY, "pgtraj").rows().filter("pgtraj_name = 'p0'")
    numbers = ["x", "y", "dx", "dist", "dt", "r2n", "abs_angle", "rel_angle"]
    assert rows(stored, "burst", "date", *numbers) == rows(
        computed.withColumn("date", F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00' + us * INTERVAL '0.000001' SECOND")),
        "burst_name", "date", *numbers,
    )
    assert stored.columns[:6] == ["step_id", "r_rowname", "x", "y", "date", "dx"]
    assert store.burst_summary().count() == computed.select("burst_name").distinct().count() + store.table("animal_burst").filter(
        "pgtraj_name = 'p1'"
    ).count()


def test_build_refuses_existing_names_and_bad_sources(spark, store):
    built(spark, store)
    with pytest.raises(ValueError, match="already exist"):
        built(spark, store)
    with pytest.raises(ValueError, match="does not exist"):
        store.build("no_such_table", relocations="geom")
    with pytest.raises(ValueError, match="not present"):
        built(spark, store, relocations=["x", "nope"])
    with pytest.raises(ValueError, match="projection"):
        built(spark, store, srid=None)
    with pytest.raises(ValueError, match="zone"):
        built(spark, store, time_zone="Mars/Olympus")
    with pytest.raises(ValueError, match="several animals"):
        built(spark, store, burst="event_type", pgtraj="everything")


def test_foreign_schema_is_refused(spark):
    name = f"other_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {name}")
    spark.sql(f"CREATE TABLE {name}.something (a INT) USING parquet")
    with pytest.raises(ValueError, match="not a trajectory schema"):
        TrajectoryStore(spark, name).ensure()


def test_import_of_an_export_gives_the_same_trajectory(spark, store):
    built(spark, store)
    first = store.export("p0").withColumn("r.row.names", F.col("seq").cast("string"))
    store.import_trajectory(first, "copy", proj4string=None, time_zone=fx.ZONE, note="again")
    again = store.export("copy")
    columns = ["x", "y", "id", "burst", "burst_order", "R2n", "`rel.angle`"]
    def plain(df):
        shift = df.agg(F.min("burst_order")).first()[0]
        return df.withColumn("burst_order", F.col("burst_order") - shift)
    assert rows(plain(first), *columns) == rows(plain(again), *columns)
    # dates and durations are cut to whole seconds
    whole = first.withColumns({"date": F.date_trunc("second", "date").cast("timestamp_ntz")})
    assert rows(whole, "burst", "seq", "date") == rows(again, "burst", "seq", "date")
    assert again.filter(F.abs(F.col("dt") - F.round("dt")) > 0).isEmpty()
    with pytest.raises(ValueError, match="already exists"):
        store.import_trajectory(first, "copy")
    with pytest.raises(ValueError, match="begin with"):
        store.import_trajectory(first, "_copy")


def test_overwrite_replaces_one_trajectory_only(spark, store):
    built(spark, store)
    long = store.export("p0").withColumn("r.row.names", F.col("seq").cast("string"))
    store.import_trajectory(long, "copy", time_zone=fx.ZONE)
    before = store.parameters("p1").count()
    few = store.export("copy").filter("seq <= 2")
    n = few.count()
    store.import_trajectory(few, "copy", time_zone=fx.ZONE, overwrite=True)
    assert store.parameters("copy").count() == n
    assert store.parameters("copy").groupBy("burst").count().agg(F.max("count")).first()[0] <= 2
    assert store.parameters("p1").count() == before


def test_a_failed_overwrite_leaves_the_old_trajectory(spark, store, monkeypatch):
    built(spark, store, info_cols=["k"], info_table=fx.infolocs_source(spark, TINY), info_rid="event_id")
    long = store.export("p0").withColumn("r.row.names", F.col("seq").cast("string"))
    info = long.select(F.col("`r.row.names`").alias("r_rowname"), F.col("burst").alias("burst_name"), "k")
    store.import_trajectory(long.drop("k"), "copy", time_zone=fx.ZONE, infolocs=info)
    before, infos = rows(store.export("copy"), "burst", "seq", "x", "y", "k"), store.infolocs("copy").count()
    few = store.export("copy").filter("seq <= 2").drop("k")
    n = few.count()
    for step in ("_append", "_replace", "_publish"):
        for call in (1, 2) if step == "_append" else (1,):
            real, calls = getattr(TrajectoryStore, step), []

            def failing(self, *args, _real=real, _calls=calls, _call=call, **more):
                _calls.append(1)
                if len(_calls) == _call:
                    raise RuntimeError("no space")
                return _real(self, *args, **more)

            with monkeypatch.context() as patch:
                patch.setattr(TrajectoryStore, step, failing)
                with pytest.raises(RuntimeError, match="no space"):
                    store.import_trajectory(few, "copy", time_zone=fx.ZONE, overwrite=True, infolocs=info.limit(5))
            assert rows(store.export("copy"), "burst", "seq", "x", "y", "k") == before
            assert store.infolocs("copy").count() == infos
            assert store.burst_summary().filter("pgtraj_name = 'copy'").agg(F.sum("num_relocations")).first()[0] == len(before)
    store.import_trajectory(few, "copy", time_zone=fx.ZONE, overwrite=True, infolocs=info.limit(5))
    assert store.export("copy").count() == n < len(before)
    store.drop(full_clean=True)
    assert store.table("step").filter("pgtraj_name = 'copy'").select("version").distinct().count() == 1


def test_any_projection_and_order_without_times(spark, store):
    schema = "x double, y double, date int, dx double, dy double, dist double, dt double, R2n double, `rel.angle` double, id string, burst string"
    data = [(float(i), 0.0, i, 1.0, 0.0, 1.0, None, 0.0, 0.0, "a", "b") for i in (3, 1, 10, 2)]
    text = "+proj=tmerc +lat_0=49 +lon_0=-2 +ellps=airy"
    store.import_trajectory(spark.createDataFrame(data, schema), "grid", proj4string=text, type_i=True)
    assert [r.x for r in store.parameters("grid").orderBy("step_id").collect()] == [1.0, 2.0, 3.0, 10.0]
    assert store.table("pgtraj").first()["proj4string"] == text and store.table("pgtraj").first()["srid"] > 0
    with pytest.raises(ValueError, match="reproject"):
        store.create_views("grid")
    with pytest.raises(ValueError, match="order"):
        store.import_trajectory(spark.createDataFrame(data, schema).drop("date"), "lost", type_i=True)
    two = spark.createDataFrame([(*d[:-1], n) for n, d in zip("bcbc", data, strict=True)], schema).withColumn("burst_order", F.lit(1))
    with pytest.raises(ValueError, match="number of its own"):
        store.import_trajectory(two, "same", type_i=True)


def test_geometry_keeps_or_drops_the_last_step_by_source(spark, store):
    built(spark, store)
    bursts = store.table("animal_burst").filter("pgtraj_name = 'p0'").count()
    steps = store.parameters("p0").count()
    # from a table: the last step of a burst has no second relocation and no geometry
    assert store.geometry("p0").count() == steps - bursts
    # from a trajectory: the second relocation exists, its line is null
    store.import_trajectory(store.export("p0").withColumn("r.row.names", F.col("seq").cast("string")), "copy")
    assert store.geometry("copy").count() == steps
    assert store.geometry("copy").filter("step_geom IS NULL").count() >= bursts


def test_infolocs_attach_type_and_export(spark, store):
    built(spark, store, info_cols=["k", "status", "step_id", "not_here"], info_table=fx.infolocs_source(spark, TINY), info_rid="event_id")
    found = store.infolocs("p0")
    assert set(found.columns) == {"step_id", "k", "status", "step_id_1"}
    exported = store.export("p0")
    assert exported.count() == store.parameters("p0").count()
    assert exported.filter("k IS NOT NULL").count() == found.filter("k IS NOT NULL").count()
    # typed import: a factor keeps only its levels
    long = exported.withColumn("r.row.names", F.col("seq").cast("string"))
    info = long.select(F.col("`r.row.names`").alias("r_rowname"), F.col("burst").alias("burst_name"), "status", "k")
    types = {"status": InfoType("factor", levels=("click", "view"))}
    store.import_trajectory(long.drop("k", "status", "step_id_1"), "typed", infolocs=info, info_types=types)
    kept = {r[0] for r in store.infolocs("typed").select("status").distinct().collect()}
    assert kept == {"click", "view", None}
    registered = store.table("animal_burst").filter("pgtraj_name = 'typed'").select("info_cols").first()[0]
    assert {(e["name"], e["type"]) for e in registered} == {("status", "factor"), ("k", "integer")}
    summary = {r["pgtraj_name"]: r["infolocs_table"] for r in store.pgtraj_summary().collect()}
    assert summary == {"p0": "infolocs_p0", "p1": "infolocs_p1", "typed": "infolocs_typed"}


def test_repeated_infolocs_rows_only_warn(spark, store):
    info = fx.infolocs_source(spark, TINY)
    with pytest.warns(UserWarning, match="several rows"):
        built(spark, store, info_cols=["k"], info_table=info.unionByName(info), info_rid="event_id")
    assert store.infolocs("p0") is None and store.parameters("p0").count() > 0


def test_drop_and_full_clean(spark, store):
    built(spark, store, info_cols=["k"], info_table=fx.infolocs_source(spark, TINY), info_rid="event_id")
    with pytest.raises(ValueError, match="nothing to do"):
        store.drop(None, full_clean=False)
    with pytest.raises(ValueError, match="does not exist"):
        store.drop("nobody")
    store.drop("p0", full_clean=False)
    assert store.pgtrajs() == ["p1"] and store.infolocs("p0") is None
    assert store.table("step").filter("pgtraj_name = 'p0'").count() > 0, "steps stay as orphans"
    assert {r[0] for r in store.burst_summary().select("pgtraj_name").distinct().collect()} == {"p1"}
    store.drop(full_clean=True)
    assert store.table("step").filter("pgtraj_name = 'p0'").isEmpty()
    assert store.parameters("p1").count() > 0
    store.analyze()


def test_views_windows_and_defaults(spark, store):
    built(spark, store)
    store.create_views("p0")
    view = store.view("p0")
    last = view.agg(F.max("date")).first()[0]
    day = timedelta(days=1)
    assert store.step_window("p0", datetime(2023, 1, 1), day).isEmpty()
    assert store.step_window("p0", last + timedelta(microseconds=1), day).isEmpty()
    assert store.step_window("p0", last, timedelta(0)).isEmpty(), "a closed window is empty"
    assert store.step_window("p0", last, day).count() == 1, "the start is included"
    assert store.step_window("p0", last - day, day).filter(F.col("date") == last).isEmpty(), "the end is not"
    lines = store.step_window("p0", datetime(2024, 1, 1), timedelta(days=40), step_mode=False)
    assert lines.columns[:3] == ["pgtraj_name", "burst_name", "animal_name"]
    defaults = store.time_defaults("p0").first()
    assert defaults["time_zone"] == fx.ZONE and defaults["tstamp_last"] == last
    name = store.table("animal_burst").filter("pgtraj_name = 'p0'").first()["burst_name"]
    assert store.bursts(name).count() == 1 and store.bursts([]).isEmpty()
    n = view.count()
    store.create_views("p0")  # kept
    assert view.count() == n
    store.create_views("p0", force=True)
    assert store.view("p0").count() == n


def test_views_of_unprojected_data_are_refused(spark, store):
    built(spark, store, srid=None, allow_unprojected=True)
    with pytest.raises(ValueError, match="unprojected"):
        store.create_views("p0")


def test_type_one_round_trip(spark, store):
    built(spark, store, timestamps=None)
    exported = store.export("p1")
    assert dict(exported.dtypes)["date"] == "bigint"
    n = exported.count()
    assert sorted(r[0] for r in exported.select("date").collect()) == list(range(1, n + 1))
    assert exported.filter("dt IS NULL").count() == exported.select("burst").distinct().count()
    store.import_trajectory(exported.withColumn("r.row.names", F.col("date").cast("string")), "one", type_i=True)
    again = store.export("one")
    assert rows(exported, "burst", "seq", "x", "y", "date", "dt") == rows(again, "burst", "seq", "x", "y", "date", "dt")


def test_transfer_between_stores(spark, store):
    built(spark, store, info_cols=["k"], info_table=fx.infolocs_source(spark, TINY), info_rid="event_id")
    other = TrajectoryStore(spark, f"traj_{uuid.uuid4().hex[:8]}")
    with warnings.catch_warnings():
        warnings.simplefilter("error")
        transfer(store, other, "p1")
        transfer(store, other, "p1")
    assert rows(store.parameters("p1"), "burst", "x", "y", "r2n", "rel_angle") == rows(
        other.parameters("p1"), "burst", "x", "y", "r2n", "rel_angle"
    )
    assert store.infolocs("p1").count() == other.infolocs("p1").count()


def test_model_tables_agree_with_the_store(spark, store):
    built(spark, store)
    m = store.model()
    assert m.relocation.count() == m.step.count() == m.s_b_rel.count()
    orphans = m.step.join(m.relocation.select(F.col("id").alias("relocation_id_1")), "relocation_id_1", "left_anti")
    assert orphans.isEmpty()
    assert m.animal_burst.join(m.pgtraj.select(F.col("id").alias("pgtraj_id")), "pgtraj_id").count() == m.animal_burst.count()
