"""Registered queries: each operator over whole given tables."""

from __future__ import annotations

import functools
import uuid
import warnings
from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trajspark import settings
from trajspark.functions import times
from trajspark.functions.reproject import reproject
from trajspark.operators import export, infolocs, lifecycle, lines, reshape, summary, windows
from trajspark.operators.ids import model_tables, with_step_ids
from trajspark.operators.infolocs import InfoType
from trajspark.operators.parameters import FILL_PGTRAJ, step_parameters, stored_parameters
from trajspark.operators.steps import TYPE_I, build_steps, computed_steps, step_geometry
from trajspark.operators.views import step_view
from trajspark.sources import gps, layers, tables
from trajspark.store import TrajectoryStore, transfer
from trajspark.suite import fixtures as fx

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

WINDOW_START, WINDOW = datetime(2024, 1, 10), timedelta(days=2)
STATUS_LEVELS = ("view", "click", "purchase")


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def rounded(name: str, places: int = 6, source: Column | str | None = None) -> Column:
    """A rounded column without negative zeros, so engines agree."""
    value = F.col(f"`{name}`") if source is None else F.col(source) if isinstance(source, str) else source
    near_zero = F.abs(value) < 0.5 * 10.0**-places
    return F.when(near_zero, 0.0).otherwise(F.round(value, places)).alias(name)


PARAMETERS = ("dx", "dy", "dist", "dt", "r2n", "abs_angle", "rel_angle")


def shown(df: DataFrame, *keys: str) -> DataFrame:
    return df.select(*keys, "x", "y", *[rounded(p) for p in PARAMETERS])


# -- binding ----------------------------------------------------------------------------------------------


@query
def relocations_bound(spark, sf):
    return fx.relocations(spark, sf)


@query
def relocations_point_column(spark, sf):
    source = fx.fixes(spark, sf).withColumn("geom", F.struct("x", "y", F.lit(fx.SRID).alias("srid")))
    return tables.bind_relocations(
        source, relocations="geom", pgtraj="grp", animal="animal", burst="burst", timestamps="ts", rid="event_id", time_zone=fx.ZONE,
        note="from points",
    )


@query
def clauses_filter(spark, sf):
    bound = fx.relocations(spark, sf, clauses="WHERE event_type IN ('click', 'error') AND extract(DAY FROM ts) <= 10")
    return build_steps(bound).rows().select("rid", "rid2", "dt_us")


@query
def burst_default(spark, sf):
    bound = fx.relocations(spark, sf, burst=None)
    return bound.groupBy("pgtraj_name", "animal_name", "burst_name").agg(F.count(F.lit(1)).alias("n"))


@query
def name_conflicts(spark, sf):
    return tables.name_conflicts(fx.relocations(spark, sf, burst="event_type"))


# -- steps ------------------------------------------------------------------------------------------------


def _pairs(spark, sf, variant="base", kind=2):
    steps = build_steps(fx.relocations(spark, sf, variant, kind), kind)
    return steps.rows().select("rid", "rid2", "dt_us", "x2", "y2")


@query
def steps_type2(spark, sf):
    return _pairs(spark, sf)


@query
def steps_type2_ties(spark, sf):
    return _pairs(spark, sf, "ties")


@query
def steps_null_time(spark, sf):
    return _pairs(spark, sf, "null_time")


@query
def steps_type1(spark, sf):
    return _pairs(spark, sf, kind=TYPE_I)


@query
def steps_heavy_ties(spark, sf):
    return build_steps(fx.supplier_fixes(spark, sf)).rows().select("animal_name", "rid", "rid2", "dt_us")


def _computed(spark, sf):
    """Parameters as an imported trajectory."""
    df = fx.parameters(spark, sf).rows().withColumn("r_rowname", F.col("rid").cast("string"))
    return computed_steps(df.drop("rid2", "us2", "x2", "y2", "dt_us"))


@query
def steps_from_computed(spark, sf):
    return _computed(spark, sf).select("r_rowname", "us", "us2", "dt_us", "x", "y", rounded("x2"), rounded("y2"))


@query
def step_ids(spark, sf):
    laid = with_step_ids(build_steps(fx.relocations(spark, sf), numbered=True))
    return laid.rows().select("step_id", "burst_id", "relocation_id_1", "relocation_id_2", "rid")


@query
def step_burst_relation(spark, sf):
    m = model_tables(fx.relocations(spark, sf))
    bursts = m.animal_burst.withColumnRenamed("id", "animal_burst_id")
    return (
        m.s_b_rel.groupBy("animal_burst_id").agg(F.count("step_id").alias("n"), F.min("step_id").alias("first_step"))
        .join(bursts, "animal_burst_id").join(m.pgtraj.select(F.col("id").alias("pgtraj_id"), "pgtraj_name", "proj4string"), "pgtraj_id")
    )


# -- parameters -------------------------------------------------------------------------------------------


@query
def step_parameters_computed(spark, sf):
    return shown(fx.parameters(spark, sf).rows(), "pgtraj_name", "animal_name", "burst_name", "seq", "rid")


@query
def step_parameters_pgtraj_fill(spark, sf):
    return shown(fx.parameters(spark, sf, FILL_PGTRAJ).rows(), "pgtraj_name", "burst_name", "seq", "rid")


@query
def step_parameters_ties(spark, sf):
    laid = step_parameters(build_steps(fx.relocations(spark, sf, "ties")), FILL_PGTRAJ)
    return shown(laid.rows(), "pgtraj_name", "burst_name", "seq", "rid")


@query
def step_parameters_heavy_ties(spark, sf):
    laid = step_parameters(build_steps(fx.supplier_fixes(spark, sf)))
    return shown(laid.rows(), "burst_name", "seq", "rid")


@query
def stored_parameters_imported(spark, sf):
    return shown(stored_parameters(_computed(spark, sf)), "pgtraj_name", "burst_name", "r_rowname")


@query
def step_geometry_lines(spark, sf):
    df = step_geometry(build_steps(fx.relocations(spark, sf)).rows())
    ends = F.col("step_geom")[0], F.col("step_geom")[1]
    return df.select("rid", ends[0]["x"].alias("x1"), ends[0]["y"].alias("y1"), ends[1]["x"].alias("x2"), ends[1]["y"].alias("y2"))


# -- summaries --------------------------------------------------------------------------------------------


@query
def pgtraj_summary(spark, sf):
    return summary.pgtraj_summary(fx.relocations(spark, sf))


@query
def pgtraj_summary_shared_names(spark, sf):
    """Burst names that all animals share count once."""
    return summary.pgtraj_summary(fx.relocations(spark, sf, burst="event_type"))


@query
def burst_summary(spark, sf):
    return summary.burst_summary(fx.relocations(spark, sf))


def _line_facts(parts, *keys):
    df = lines.line_facts(parts, keys)
    ends = [rounded(f"{e}_{c}", 9, F.col(f"{e}_point")[c]) for e in ("first", "last") for c in ("x", "y")]
    return df.select(*keys, "n_points", *ends, rounded("length", 9))


@query
def burst_lines(spark, sf):
    return _line_facts(lines.burst_lines(fx.relocations(spark, sf)), "pgtraj_name", "burst_name")


@query
def animal_lines(spark, sf):
    return _line_facts(lines.animal_lines(fx.view(spark, sf), fx.relocations(spark, sf)), "pgtraj_name", "animal_name")


@query
def bursts_by_name(spark, sf):
    bound = fx.relocations(spark, sf)
    found = summary.bursts_by_name(lines.burst_view(bound, lines.burst_lines(bound)), ["a1-click", "a2-error", "nobody"])
    return found.select("pgtraj_name", "animal_name", "burst_name", "num_relocations", "num_na", "n_points", rounded("length", 9))


@query
def distinct_bursts(spark, sf):
    return summary.distinct_bursts(fx.relocations(spark, sf))


@query
def distinct_animals(spark, sf):
    return summary.distinct_animals(fx.relocations(spark, sf))


@query
def time_defaults(spark, sf):
    return summary.time_defaults(fx.view(spark, sf))


@query
def default_window(spark, sf):
    return summary.default_window(summary.time_defaults(fx.view(spark, sf)))


@query
def selection_changes(spark, sf):
    bound = fx.relocations(spark, sf)
    wanted = bound.filter(F.month(times.wall_time(F.col("us"))) == 1).filter("x > 0")
    return summary.selection_changes(summary.distinct_bursts(wanted), summary.distinct_bursts(bound.filter("y > 0")))


# -- windows ----------------------------------------------------------------------------------------------


@query
def window_steps(spark, sf):
    df = windows.window_steps(fx.view(spark, sf), WINDOW_START, WINDOW)
    ends = [rounded(f"{c}{i + 1}", 9, F.col("step_geom")[i][c]) for i in (0, 1) for c in ("x", "y")]
    numbers = [rounded(c) for c in ("dx", "dy", "dist", "dt", "abs_angle", "rel_angle")]
    return df.select("step_id", "date", *ends, *numbers, "animal_name", "burst_name", "pgtraj_name")


@query
def window_lines(spark, sf):
    parts = windows.window_lines(fx.view(spark, sf), WINDOW_START, WINDOW, fx.relocations(spark, sf))
    return _line_facts(parts, "pgtraj_name", "burst_name", "animal_name")


@query
def sliding_windows(spark, sf):
    df = windows.pages_summary(fx.view(spark, sf), fx.START, timedelta(days=3), timedelta(days=1))
    return df.withColumn("dist", F.round("dist", 6))


# -- infolocs ---------------------------------------------------------------------------------------------


def _numbered(spark, sf):
    return with_step_ids(build_steps(fx.relocations(spark, sf), numbered=True))


@query
def infolocs_attach(spark, sf):
    wanted = ["k", "status", "step_id", "not_here"]
    return infolocs.attach_from_table(_numbered(spark, sf).rows(), fx.infolocs_source(spark, sf), "event_id", wanted)


@query
def infolocs_from_trajectory(spark, sf):
    steps = _numbered(spark, sf).rows().withColumn("r_rowname", F.col("rid").cast("string"))
    named = fx.relocations(spark, sf).select(F.col("rid").alias("event_id"), "burst_name")
    rows = fx.infolocs_source(spark, sf).join(named, "event_id")
    rows = rows.select(F.col("event_id").cast("string").alias("r_rowname"), "burst_name", "k", "step_id")
    return infolocs.attach_from_trajectory(steps, rows)


@query
def infolocs_union(spark, sf):
    source = fx.infolocs_source(spark, sf)
    clicks = source.filter("status = 'click'").select("event_id", "k")
    others = source.filter("status <> 'click'").select("event_id", "status")
    return infolocs.union_bursts([clicks, others])


@query
def infolocs_typed(spark, sf):
    rows = infolocs.attach_from_table(
        _numbered(spark, sf).rows(), fx.infolocs_source(spark, sf), "event_id", ["k", "status", "seen", "written"]
    )
    types = {
        "k": InfoType("numeric"),
        "status": InfoType("ordered", levels=STATUS_LEVELS),
        "seen": InfoType("POSIXct", zone=fx.ZONE),
        "written": InfoType("POSIXlt", zone="UTC"),
    }
    return infolocs.typed(rows, types)


@query
def infolocs_typed_by_burst(spark, sf):
    steps = _numbered(spark, sf).rows()
    rows = infolocs.attach_from_table(steps, fx.infolocs_source(spark, sf), "event_id", ["k", "status"])
    kinds = infolocs.registry({"status": InfoType("factor", levels=STATUS_LEVELS)})
    bursts = steps.groupBy("burst_id", "animal_name").agg(F.lit(None).alias("_"))
    even = F.substring("animal_name", -1, 1).isin("0", "2", "4", "6", "8")
    bursts = bursts.select("burst_id", F.when(even, kinds).alias("info_cols"))
    return infolocs.typed_by_burst(rows, steps, bursts)


@query
def view_with_infolocs(spark, sf):
    steps = fx.parameters(spark, sf, ids=True).rows()
    rows = infolocs.attach_from_table(steps, fx.infolocs_source(spark, sf), "event_id", ["k", "status"])
    return fx.view(spark, sf, rows).select("step_id", "date", rounded("dist"), "k", "status", "burst_name", "pgtraj_name")


# -- life cycle -------------------------------------------------------------------------------------------


@query
def drop_pgtraj(spark, sf):
    """What each table holds after one pgtraj is dropped and the rest is cleaned."""
    m = lifecycle.full_clean(lifecycle.drop_pgtraj(model_tables(fx.relocations(spark, sf)), "p1"))
    return (
        m.step.withColumnRenamed("id", "step_id").join(m.s_b_rel, "step_id")
        .join(m.animal_burst.withColumnRenamed("id", "animal_burst_id"), "animal_burst_id")
        .join(m.relocation.withColumnRenamed("id", "relocation_id_1"), "relocation_id_1")
        .select("step_id", "relocation_id_1", "relocation_id_2", "burst_name", "animal_name", "orig_id")
    )


@query
def unused_relocations(spark, sf):
    m = lifecycle.drop_pgtraj(model_tables(fx.relocations(spark, sf)), "p2")
    return lifecycle.unused_relocations(m).select("id", "orig_id", "us")


@query
def overwrite(spark, sf):
    stored = fx.relocations(spark, sf).select("pgtraj_name", "burst_name", "rid")
    incoming = stored.filter("pgtraj_name = 'p3'").withColumn("burst_name", F.concat(F.col("burst_name"), F.lit("-new")))
    after = lifecycle.overwritten(stored, incoming, overwrite=True)
    return after.groupBy("pgtraj_name", "burst_name").agg(F.count(F.lit(1)).alias("n"), F.max("rid").alias("last_rid"))


# -- export -----------------------------------------------------------------------------------------------


def _exported(df):
    numbers = ("dx", "dy", "dist", "dt", "R2n", "abs.angle", "rel.angle")
    return df.select("pgtraj_name", "seq", "x", "y", "date", *[rounded(c) for c in numbers], "id", "burst")


@query
def export_long(spark, sf):
    return _exported(export.export_long(fx.parameters(spark, sf), fx.ZONE, kind=2, named=False))


@query
def export_type1(spark, sf):
    return _exported(export.export_long(fx.parameters(spark, sf, kind=TYPE_I), fx.ZONE, kind=TYPE_I, named=False))


@query
def export_nested(spark, sf):
    long = export.export_long(fx.parameters(spark, sf), fx.ZONE, kind=2, named=False)
    nested = export.nest(long, ["x", "y", "date", "dist", "R2n"])
    parts = nested.select(
        "pgtraj_name", "id", "burst", "n_rows",
        F.aggregate("rows", F.lit(0.0), lambda a, r: a + F.coalesce(r["dist"], F.lit(0.0))).alias("way"),
        F.size(F.filter("rows", lambda r: r["x"].isNull())).alias("n_missing"),
    )
    return parts.groupBy("pgtraj_name", "id", "burst").agg(
        F.sum("n_rows").alias("n_rows"), F.round(F.sum("way"), 6).alias("way"), F.sum("n_missing").alias("n_missing")
    )


@query
def nested_to_long(spark, sf):
    long = export.export_long(fx.parameters(spark, sf), fx.ZONE, kind=2, named=False)
    return export.unnest(export.nest(long, ["x", "y", "date", "dist"])).withColumn("dist", F.round("dist", 6))


# -- store ------------------------------------------------------------------------------------------------


def _store(spark, sf):
    """All events as four stored pgtrajs, in a fresh database under the shared folder."""
    store = TrajectoryStore(spark, f"trajspark_{uuid.uuid4().hex}", settings.new_folder(spark, "store"))
    store.build(
        fx.fixes(spark, sf), relocations=["x", "y"], pgtraj="grp", animal="animal", burst="burst", rid="event_id", timestamps="ts",
        srid=fx.SRID, time_zone=fx.ZONE, info_cols=["k", "status"], info_table=fx.infolocs_source(spark, sf), info_rid="event_id",
    )
    return store


@query
def store_parameters(spark, sf):
    """Built from a table, read back."""
    store = _store(spark, sf)
    parts = [store.parameters(name) for name in store.pgtrajs()]
    return shown(functools.reduce(DataFrame.unionByName, parts), "step_id", "date", "animal_name", "burst", "pgtraj")


@query
def store_import(spark, sf):
    """Exported with infolocs, imported under another name over an older one, exported again."""
    store = _store(spark, sf)
    long = store.export("p0").withColumn("r.row.names", F.col("seq").cast("string"))
    info = long.select(F.col("`r.row.names`").alias("r_rowname"), F.col("burst").alias("burst_name"), "k", "status")
    store.import_trajectory(store.export("p1"), "copy", time_zone=fx.ZONE)
    types = {"status": InfoType("factor", levels=STATUS_LEVELS)}
    store.import_trajectory(long.drop("k", "status"), "copy", time_zone=fx.ZONE, overwrite=True, infolocs=info, info_types=types)
    again = store.export("copy")
    numbers = [rounded(c) for c in ("dx", "dy", "dist", "dt", "R2n", "abs.angle", "rel.angle")]
    return again.select("seq", "x", "y", "date", *numbers, "id", "burst", "k", "status")


@query
def store_views(spark, sf):
    """The written step view after another pgtraj was dropped, cut to a window and joined into lines."""
    store = _store(spark, sf)
    store.drop("p2")
    store.create_views("p1")
    return _line_facts(store.step_window("p1", WINDOW_START, WINDOW, step_mode=False), "pgtraj_name", "burst_name", "animal_name")


@query
def store_summaries(spark, sf):
    """Burst lines and summaries of what is left after a drop."""
    store = _store(spark, sf)
    store.drop("p2")
    store.create_views("p1")
    found = store.table("burst_view").select("pgtraj_name", "burst_name", "num_relocations", "num_na", "date_begin", "n_points")
    groups = store.pgtraj_summary().select("pgtraj_id", "pgtraj_name", "num_bursts", "latest_date", "infolocs_table")
    return found.join(groups, "pgtraj_name")


@query
def store_burst_lines(spark, sf):
    """The written lines of all bursts, in longitude/latitude."""
    store = _store(spark, sf)
    store.create_views("p0")
    return _line_facts(store.table("burst_lines"), "pgtraj_name", "burst_name")


@query
def store_export_import(spark, sf):
    """An export alone is enough: projection and zone travel with it."""
    store = _store(spark, sf)
    store.import_trajectory(store.export("p3").withColumn("r.row.names", F.col("seq").cast("string")), "copy")
    again = store.export("copy")
    return again.select("seq", "x", "y", "date", rounded("dist"), rounded("R2n"), "id", "burst", "proj4string", "time_zone")


@query
def store_export_import_all(spark, sf):
    """Every pgtraj exported and imported under another name."""
    store, parts = _store(spark, sf), []
    for name in store.pgtrajs():
        store.import_trajectory(store.export(name).withColumn("r.row.names", F.col("seq").cast("string")), f"copy_{name}")
        parts.append(store.export(f"copy_{name}").withColumn("pgtraj_name", F.lit(name)))
    again = functools.reduce(DataFrame.unionByName, parts)
    return again.select("pgtraj_name", "seq", "x", "y", "date", rounded("dist"), rounded("R2n"), "id", "burst", "proj4string", "time_zone")


@query
def store_transfer(spark, sf):
    """One pgtraj copied to a second store, twice, the second time over the first."""
    source = _store(spark, sf)
    target = TrajectoryStore(spark, f"trajspark_{uuid.uuid4().hex}", settings.new_folder(spark, "store"))
    transfer(source, target, "p2")
    transfer(source, target, "p2")
    return target.parameters("p2").select("x", "y", rounded("dx"), rounded("dy"), rounded("r2n"), rounded("rel_angle"), "animal_name", "burst")


@query
def store_transfer_all(spark, sf):
    """Every pgtraj copied to a second store, twice, the second time over the first."""
    source, parts = _store(spark, sf), []
    target = TrajectoryStore(spark, f"trajspark_{uuid.uuid4().hex}", settings.new_folder(spark, "store"))
    transfer(source, target)
    transfer(source, target)
    for name in target.pgtrajs():
        parts.append(target.parameters(name).withColumn("pgtraj_name", F.lit(name)))
    found = functools.reduce(DataFrame.unionByName, parts)
    return found.select("pgtraj_name", "x", "y", rounded("dx"), rounded("dy"), rounded("r2n"), rounded("rel_angle"), "animal_name", "burst")


@query
def store_import_type1(spark, sf):
    """Rows without times in no order, in a system of unknown formulas: the integer date orders them."""
    store = TrajectoryStore(spark, f"trajspark_{uuid.uuid4().hex}", settings.new_folder(spark, "store"))
    named = export.export_long(fx.parameters(spark, sf, kind=TYPE_I), None, kind=TYPE_I, named=False).filter("pgtraj_name = 'p1'")
    rows = named.drop("pgtraj_name", "seq", "burst_order").withColumn("date", F.col("date").cast("int"))
    store.import_trajectory(rows.orderBy(F.xxhash64("date")), "grid", proj4string="+proj=tmerc +lat_0=49 +lon_0=-2 +ellps=airy", type_i=True)
    again = store.export("grid")
    return again.select("seq", "x", "y", "date", "dt", rounded("dist"), "id", "burst", "proj4string")


@query
def store_import_type1_all(spark, sf):
    """The rows of every pgtraj without times in no order, imported as one."""
    store = TrajectoryStore(spark, f"trajspark_{uuid.uuid4().hex}", settings.new_folder(spark, "store"))
    named = export.export_long(fx.parameters(spark, sf, kind=TYPE_I), None, kind=TYPE_I, named=False)
    rows = named.drop("pgtraj_name", "seq", "burst_order").withColumn("date", F.col("date").cast("int"))
    store.import_trajectory(rows.orderBy(F.xxhash64("date")), "grid", proj4string="+proj=tmerc +lat_0=49 +lon_0=-2 +ellps=airy", type_i=True)
    again = store.export("grid")
    return again.select("seq", "x", "y", "date", "dt", rounded("dist"), "id", "burst", "proj4string")


@query
def store_page(spark, sf):
    """The third page of a day after the start, from the written view."""
    store = _store(spark, sf)
    store.create_views("p2")
    store.create_views("p2", force=True)
    found = windows.page(store.view("p2"), fx.START, timedelta(days=2), timedelta(days=1), 3, ["k"])
    return found.select("step_id", "date", rounded("dist"), rounded("dt"), "animal_name", "burst_name", "k")


@query
def store_page_all(spark, sf):
    """The third page of a day after the start, from the written view of every pgtraj."""
    store, parts = _store(spark, sf), []
    store.create_views(store.pgtrajs())
    for name in store.pgtrajs():
        found = windows.page(store.view(name), fx.START, timedelta(days=2), timedelta(days=1), 3, ["k"])
        parts.append(found.withColumn("pgtraj_name", F.lit(name)))
    pages = functools.reduce(DataFrame.unionByName, parts)
    return pages.select("pgtraj_name", "step_id", "date", rounded("dist"), rounded("dt"), "animal_name", "burst_name", "k")


def _fresh(spark) -> TrajectoryStore:
    return TrajectoryStore(spark, f"trajspark_{uuid.uuid4().hex}", settings.new_folder(spark, "store"))


@query
def store_import_all(spark, sf):
    """Every pgtraj with its infolocs in one import, over a first import of the same names."""
    source, target, parts = _store(spark, sf), _fresh(spark), []
    transfer(source, target)
    transfer(source, target)
    for name in target.pgtrajs():
        parts.append(target.export(name).withColumn("pgtraj_name", F.lit(name)))
    again = functools.reduce(DataFrame.unionByName, parts)
    return again.select("pgtraj_name", "seq", "x", "y", "date", rounded("dist"), "id", "burst", "k", "status", "time_zone")


@query
def store_infolocs_by_burst(spark, sf):
    """One info column whose class, levels and zone are other ones in each kind of burst, of all events, imported and exported."""
    source, store = _store(spark, sf), _fresh(spark)
    long = functools.reduce(DataFrame.unionByName, [source.export(n) for n in source.pgtrajs()]).withColumn("r.row.names", F.col("seq").cast("string"))
    long = long.drop("burst_order", "k", "status", "time_zone", "proj4string")
    kind = F.substring_index("burst", "-", -1)
    value = F.when(kind == "view", F.col("seq").cast("string")).when(kind == "click", F.date_format("date", "yyyy-MM-dd HH:mm:ss")).otherwise(
        F.when(F.col("seq") % 3 == 0, "low").when(F.col("seq") % 3 == 1, "high").otherwise("odd"))
    info = long.select(F.col("`r.row.names`").alias("r_rowname"), F.col("burst").alias("burst_name"), value.alias("what"))
    bursts = long.select(F.col("burst").alias("burst_name"), kind.alias("kind")).distinct()
    types = {
        "view": InfoType("numeric"), "click": InfoType("POSIXct", zone="Asia/Tokyo"), "purchase": InfoType("ordered", levels=("low", "high")),
        "error": InfoType("factor", levels=("odd", "high")),
    }
    own = F.lit(None).cast(infolocs.REGISTRY)
    for name, t in types.items():
        own = F.when(F.col("kind") == name, infolocs.registry({"what": t})).otherwise(own)
    registry = bursts.select("burst_name", own.alias("info_cols")).filter("info_cols is not null")
    store.import_trajectory(long, "all of them", proj4string=source.table("pgtraj").first()["proj4string"], time_zone=fx.ZONE, infolocs=info, info_registry=registry)
    return store.export("all of them").select("burst", "seq", "what", "what_level")


@query
def store_any_names(spark, sf):
    """Names with blanks, marks and capitals through build, overwrite, views, summaries and a drop."""
    store = _fresh(spark)
    name = F.concat(F.lit("Roe-deer no. "), F.substring("grp", 2, 1), F.lit(" 'a/b' ü"))
    store.build(
        fx.fixes(spark, sf).withColumn("name", name), relocations=["x", "y"], pgtraj="name", animal="animal", burst="burst", rid="event_id",
        timestamps="ts", srid=fx.SRID, time_zone=fx.ZONE, info_cols=["k"], info_table=fx.infolocs_source(spark, sf), info_rid="event_id",
    )
    names = store.pgtrajs()
    transfer(store, store, names[0])
    store.drop(names[1])
    store.create_views(store.pgtrajs())
    parts = [store.view(n).select("pgtraj_name", "burst_name", "date", "k") for n in store.pgtrajs()]
    facts = functools.reduce(DataFrame.unionByName, parts).groupBy("pgtraj_name").agg(F.count(F.lit(1)).alias("n"), F.count("k").alias("with_k"))
    named = store.pgtraj_summary().select("pgtraj_name", "num_bursts", "infolocs_table")
    shown = [spark.table(f"`{store.schema}`.`{r['infolocs_table']}`").select(F.lit(r["pgtraj_name"]).alias("pgtraj_name"), "k") for r in named.collect()]
    rows = functools.reduce(DataFrame.unionByName, shown).groupBy("pgtraj_name").agg(F.count(F.lit(1)).alias("in_table"))
    return facts.join(named.drop("infolocs_table"), "pgtraj_name").join(rows, "pgtraj_name")


@query
def store_whole_lines(spark, sf):
    """Every vertex of every burst's line, as the burst reader gives them."""
    store = _store(spark, sf)
    store.create_views("p0")
    parts = store.bursts().filter("line is not null").select("pgtraj_name", "burst_name", "n_points", "part", F.posexplode("line").alias("at", "p"))
    place = (F.col("part") * settings.line_points(spark) + F.col("at") + 1).alias("place")
    return parts.select("pgtraj_name", "burst_name", "n_points", place, rounded("lon", 9, F.col("p.x")), rounded("lat", 9, F.col("p.y")))


@query
def store_refresh(spark, sf):
    """The burst view after one pgtraj was replaced, one added and one dropped."""
    store = _store(spark, sf)
    store.create_views("p0")
    transfer(store, store, "p1")
    store.import_trajectory(store.export("p2").withColumn("r.row.names", F.col("seq").cast("string")), "more")
    store.drop("p3")
    store.create_views("p0")
    return store.table("burst_view").select("pgtraj_name", "burst_name", "num_relocations", "num_na", "n_points", rounded("length", 6))


@query
def store_ordered_files(spark, sf):
    """Exports written as ordered files: each row's place by manifest and place in its file."""
    store, parts = _store(spark, sf), []
    for name in store.pgtrajs():
        path = settings.new_folder(spark, "ordered")
        files = store.export_files(name, path, rows_a_file=500)
        held = spark.read.parquet(path).select("pgtraj_name", "burst", "seq", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("at"))
        starts = files.withColumn("before", F.sum("n_rows").over(Window.orderBy("number").rowsBetween(Window.unboundedPreceding, -1)))
        parts.append(held.join(F.broadcast(starts.select("file", F.coalesce("before", F.lit(0)).alias("before"))), "file"))
    found = functools.reduce(DataFrame.unionByName, parts)
    return found.select("pgtraj_name", "burst", "seq", (F.col("before") + F.col("at") + 1).alias("place"))


@query
def store_ids(spark, sf):
    """Ids are never given twice: of steps, relocations and bursts over build, import, drop and import."""
    store = _store(spark, sf)
    long = store.export("p0").withColumn("r.row.names", F.col("seq").cast("string"))
    store.import_trajectory(long, "copy")
    store.drop("copy")
    store.import_trajectory(long, "again")
    model = store.model()
    every = F.lit("everything").alias("pgtraj_name")

    def counted(df, key, name):
        numbers = F.count(F.lit(1)).alias("n"), F.count_distinct(key).alias("ids")
        return df.groupBy("pgtraj_name").agg(*numbers).unionByName(df.groupBy(every).agg(*numbers)).withColumn("what", F.lit(name))

    relocations = model.relocation.withColumn("pgtraj_name", every)
    parts = [counted(store.table("step"), "step_id", "steps"), counted(store.table("animal_burst"), "burst_id", "bursts")]
    return parts[0].unionByName(parts[1]).unionByName(counted(relocations, "id", "relocations").distinct())


def _refused(action, expected: str) -> bool:
    """Whether an action raises a ``ValueError`` that says so."""
    try:
        action()
    except ValueError as err:
        return expected in str(err)
    return False


@query
def store_refusals(spark, sf):
    """What must be refused, asked for with the events: each case, whether it was, and the steps that the store holds afterwards."""
    store, fixes = _store(spark, sf), fx.fixes(spark, sf)
    bind = dict(relocations=["x", "y"], pgtraj="grp", animal="animal", burst="burst", rid="event_id", timestamps="ts", srid=fx.SRID, time_zone=fx.ZONE)
    other = f"trajspark_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE `{other}` LOCATION '{settings.new_folder(spark, 'other')}'")
    fixes.select("event_id").write.saveAsTable(f"`{other}`.`something`")
    long = store.export("p0").withColumn("r.row.names", F.col("seq").cast("string"))
    flat = _fresh(spark)
    flat.build(fixes, **{**bind, "srid": None}, allow_unprojected=True)
    cases = {
        "missing table": _refused(lambda: store.build("no_such_table", **bind), "does not exist"),
        "missing column": _refused(lambda: store.build(fixes, **{**bind, "relocations": ["x", "nope"]}), "not present"),
        "foreign schema": _refused(lambda: TrajectoryStore(spark, other).ensure(), "not a trajectory schema"),
        "unknown zone": _refused(lambda: store.build(fixes, **{**bind, "time_zone": "Mars/Olympus"}), "zone"),
        "no projection": _refused(lambda: store.build(fixes, **{**bind, "srid": None}), "projection"),
        "unprojected view": _refused(lambda: flat.create_views("p0"), "unprojected"),
        "three coordinate columns": _refused(lambda: store.build(fixes, **{**bind, "relocations": ["x", "y", "ts"]}), "relocations"),
        "text for a system": _refused(lambda: store.build(fixes, **{**bind, "srid": "3395"}), "srid"),
        "blank name": _refused(lambda: store.build(fixes, **{**bind, "animal": ""}), "animal"),
        "name of one trajectory twice": _refused(lambda: store.build(fixes, **bind), "already exist"),
        "import without overwrite": _refused(lambda: store.import_trajectory(long, "p1"), "already exists"),
        "name that begins with a mark": _refused(lambda: store.import_trajectory(long, "_p"), "begin with"),
        "burst of several animals": _refused(lambda: store.build(fixes, **{**bind, "pgtraj": "all", "burst": "event_type"}), "several animals"),
        "nothing to drop": _refused(lambda: store.drop(None, full_clean=False), "nothing to do"),
        "unknown trajectory": _refused(lambda: store.drop("nobody"), "does not exist"),
        "order of a trajectory without times": _refused(
            lambda: store.import_trajectory(long.drop("date", "seq", "r.row.names"), "lost", type_i=True), "order"),
    }
    held = store.table("step").agg(F.count(F.lit(1)).alias("steps"))
    told = spark.createDataFrame(sorted(cases.items()), "what string, refused boolean")
    return told.withColumn("one", F.lit(1)).join(held.withColumn("one", F.lit(1)), "one").drop("one")


@query
def store_failed_overwrite(spark, sf):
    """An overwrite that fails after its steps were written leaves every row of the old trajectory as it was."""
    store = _store(spark, sf)
    long = store.export("p0").withColumn("r.row.names", F.col("seq").cast("string"))
    broken = TrajectoryStore(spark, store.schema)

    def fail(*_, **__):
        raise RuntimeError("no space")

    broken._publish = fail
    try:
        broken.import_trajectory(long.filter("seq <= 2").drop("k", "status"), "p0", overwrite=True)
    except RuntimeError:
        pass
    parts = [store.parameters(name) for name in store.pgtrajs()]
    return shown(functools.reduce(DataFrame.unionByName, parts), "date", "animal_name", "burst", "pgtraj")


@query
def store_summaries_in_order(spark, sf):
    """Both summaries with the places of their rows as they come, and whether each pgtraj carries the time it was written."""
    store = _store(spark, sf)
    place = F.row_number().over(Window.orderBy("at")).alias("place")
    bursts = store.burst_summary().withColumn("at", F.monotonically_increasing_id())
    groups = store.pgtraj_summary().withColumn("at", F.monotonically_increasing_id())
    fresh = F.timestamp_diff("MINUTE", F.col("last_update"), F.current_timestamp()) < 60
    shown_groups = groups.select("pgtraj_name", F.lit(None).cast("string").alias("burst_name"), place, fresh.alias("fresh"))
    return bursts.select("pgtraj_name", "burst_name", place, F.lit(None).cast("boolean").alias("fresh")).unionByName(shown_groups)


@query
def export_type_flags(spark, sf):
    """The type and the regularity that a nested export tells of each pgtraj, with times, on one grid of days, and without times."""
    kinds = {"times": fx.parameters(spark, sf), "none": fx.parameters(spark, sf, kind=TYPE_I)}
    parts = []
    for name, laid in kinds.items():
        nested = export.nest(export.export_long(laid, fx.ZONE), ["x", "y", "date"])
        parts.append(nested.groupBy("pgtraj_name").agg(
            F.bool_and("type_ii").alias("type_ii"), F.bool_and("regular").alias("regular"), F.sum("n_rows").alias("n_rows")).withColumn("kind", F.lit(name)))
    return parts[0].unionByName(parts[1])


@query
def window_steps_raw(spark, sf):
    """The window straight from relocations, ordered work on the window alone."""
    steps = windows.relocations_window(fx.relocations(spark, sf), WINDOW_START, WINDOW)
    df = windows.window_steps(step_view(steps, fx.SRID), WINDOW_START, WINDOW)
    ends = [rounded(f"{c}{i + 1}", 9, F.col("step_geom")[i][c]) for i in (0, 1) for c in ("x", "y")]
    numbers = [rounded(c) for c in ("dx", "dy", "dist", "dt", "abs_angle", "rel_angle")]
    return df.select("step_id", "date", *ends, *numbers, "animal_name", "burst_name", "pgtraj_name")


@query
def window_lines_raw(spark, sf):
    steps = windows.relocations_window(fx.relocations(spark, sf), WINDOW_START, WINDOW)
    return _line_facts(windows.window_lines(step_view(steps, fx.SRID), WINDOW_START, WINDOW), "pgtraj_name", "burst_name", "animal_name")


@query
def sliding_windows_hourly(spark, sf):
    """Thirty days, moved on by an hour."""
    df = windows.pages_summary(fx.view(spark, sf), fx.START, timedelta(days=30), timedelta(hours=1))
    return df.withColumn("dist", F.round("dist", 6))


# -- reference systems, layers, sensors -------------------------------------------------------------------


def _spread_points(spark, sf):
    """Events spread over the whole range of the projection."""
    at = (F.col("event_id") % 3601) / 10.0 - 180.0, (F.col("event_id") % 1601) / 10.0 - 80.0
    return fx.table(spark, sf, "events").select("event_id", at[0].alias("lon"), at[1].alias("lat"))


@query
def reproject_3395(spark, sf):
    df = _spread_points(spark, sf).withColumns({"x": F.col("lon") * 111319.0, "y": F.col("lat") * 190000.0})
    out = reproject(df, 3395, 4326)
    return out.select("event_id", rounded("x", 9), rounded("y", 9))


@query
def reproject_round_trip(spark, sf):
    """There and back again, in all supported kinds of systems; the result must be the start."""
    df = _spread_points(spark, sf).withColumns({"x": F.col("lon") / 60.0 - 81.0, "y": F.col("lat")})
    there = reproject(df, 4326, 26917)
    back = reproject(reproject(reproject(there, 26917, 4326), 4326, 3395), 3395, 4326)
    return back.select("event_id", rounded("x", 8), rounded("y", 8))


def _layers(spark, sf):
    f = fx.fixes(spark, sf)
    steps = build_steps(fx.relocations(spark, sf)).rows().filter("x2 IS NOT NULL")
    points = f.select(F.lit("points").alias("layer"), F.when(F.col("x").isNull(), "MULTIPOINT").otherwise("POINT").alias("geom_type"))
    return points.unionByName(steps.select(F.lit("lines").alias("layer"), F.lit("LINESTRING").alias("geom_type")))


@query
def layer_types(spark, sf):
    df = _layers(spark, sf)
    found = [layers.geometry_types(df.filter(F.col("layer") == name)).withColumn("layer", F.lit(name)) for name in ("points", "lines")]
    return functools.reduce(DataFrame.unionByName, found).groupBy("layer").agg(
        F.count(F.lit(1)).alias("types"), F.sum("n").alias("n"), F.max(F.col("geom_type").contains("MULTIPOINT")).alias("multi")
    )


@query
def layer_mixed_systems(spark, sf):
    """A layer whose rows are in two reference systems."""
    f = fx.fixes(spark, sf).filter("x IS NOT NULL")
    mixed = f.select("event_id", "x", "y", F.when(F.col("event_id") % 2 == 0, 3395).otherwise(4326).alias("srid"))
    return layers.checked(mixed, "mixed").select("event_id", "srid", rounded("x", 9), rounded("y", 9))


@query
def layers_by_name(spark, sf):
    """Layers read and sorted out by their table names."""
    name = f"trajspark_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE `{name}` LOCATION '{settings.new_folder(spark, 'layers')}'")
    f = fx.fixes(spark, sf).filter("x IS NOT NULL").select("event_id", "x", "y", F.lit(3395).alias("srid"))
    f.write.saveAsTable(f"`{name}`.`fixes`")
    fx.table(spark, sf, "events").select("event_id", F.lit(None).cast("binary").alias("rast")).write.saveAsTable(f"`{name}`.`pictures`")
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        found = layers.read_layers(spark, [f"{name}.fixes", f"{name}.pictures"])
    parts = [df.withColumn("layer", F.lit(n.split(".")[1])) for n, df in found.items()]
    return functools.reduce(DataFrame.unionByName, parts).select("layer", "event_id", "srid", rounded("x", 9), rounded("y", 9))


@query
def layer_to_longlat(spark, sf):
    f = fx.fixes(spark, sf).filter("x IS NOT NULL").select("event_id", "x", "y", F.lit(3395).alias("srid"))
    return layers.checked(f, "fixes").select("event_id", "srid", rounded("x", 9), rounded("y", 9))


@query
def relocations_type1_points(spark, sf):
    source = fx.fixes(spark, sf).withColumn("geom", F.struct("x", "y", F.lit(fx.SRID).alias("srid")))
    bound = tables.bind_relocations(source, relocations="geom", pgtraj="grp", animal="animal", burst="burst", rid="event_id", time_zone=fx.ZONE)
    return build_steps(bound, TYPE_I).rows().select("rid", "rid2", "us", "srid", "x2", "y2")


@query
def export_type1_named(spark, sf):
    """Row names that are all given become the date of a Type I export."""
    laid = fx.parameters(spark, sf, kind=TYPE_I)
    laid = laid.on(laid.df.withColumn("r_rowname", (F.col("rid") * 2).cast("string")))
    return _exported(export.export_long(laid, fx.ZONE))


def _sensor_lines(spark, sf):
    events = fx.table(spark, sf, "events")
    short = F.date_format("ts", "dd/MM/yy")
    values = {
        "gps_sensors_code": F.lit("S1"), "line_no": F.col("event_id").cast("string"), "utc_date": short,
        "utc_time": F.date_format("ts", "HH:mm:ss"), "lmt_date": F.date_format("ts", "dd/MM/yyyy"),
        "latitude": F.col("value").cast("string"), "easting": (F.col("user_id") * 10).cast("string"), "remarks": F.col("event_type"),
    }
    line = F.concat_ws(";", *[values.get(c, F.lit("")) for c in gps.FIX_COLUMNS])
    return events.select(line.alias("line"), F.concat(F.lit("s"), (F.col("user_id") % 5).cast("string")).alias("sensor"))


def _shown_fixes(parsed):
    at = gps.fix_time(F.col("utc_date"), F.col("utc_time"))
    return parsed.select("sensor", "line_no", "utc_date", "lmt_date", "latitude", "easting", "remarks", at.alias("acquired"))


@query
def gps_fixes(spark, sf):
    """Events as sensor file lines, parsed."""
    return _shown_fixes(gps.parse_fixes(_sensor_lines(spark, sf)))


@query
def gps_files(spark, sf):
    """Events written as the files of five sensors, each with a header, and read back from them."""
    folder = settings.new_folder(spark, "sensors")
    _sensor_lines(spark, sf).write.partitionBy("sensor").option("lineSep", "\n").format("csv").options(
        header=True, quote="", escapeQuotes=False, sep="\u0001").save(folder)
    return _shown_fixes(gps.read_sensors(spark, {f"s{i}": f"{folder}/sensor=s{i}" for i in range(5)}))


@query
def gps_folder(spark, sf):
    """Events as the files of every user's sensor in one folder, read by one scan; the sensor is the file's place."""
    folder = settings.new_folder(spark, "sensors")
    user = fx.table(spark, sf, "events").select(F.col("event_id").cast("string").alias("line_no"), F.concat(F.lit("u"), "user_id").alias("user"))
    rows = _sensor_lines(spark, sf).withColumn("line_no", F.split("line", ";")[1]).join(user, "line_no").select("line", "user")
    rows.repartition("user").write.partitionBy("user").option("lineSep", "\n").format("csv").options(
        header=True, quote="", escapeQuotes=False, sep="\u0001").save(folder)
    sensor = F.regexp_extract(F.col("_metadata.file_path"), "user=([^/]*)/", 1)
    fixes = gps.read_sensors(spark, f"{folder}/*", sensor=sensor, check=False)
    return _shown_fixes(fixes)


@query
def gps_descriptions(spark, sf):
    """Users as the headerless description tables of animals, sensors and their pairs, read back and joined."""
    folder = settings.new_folder(spark, "descriptions")
    users = fx.table(spark, sf, "events").select("user_id").distinct()
    key = F.col("user_id").cast("string")
    tables_ = {
        "animals": (key, F.concat(F.lit("A"), key), F.concat(F.lit("name "), key), F.when(F.col("user_id") % 2 == 0, "f").otherwise("m"), F.lit("3"), F.lit("1")),
        "sensors": (key, F.concat(F.lit("GSM"), key), F.lit("2005-01-01"), F.lit("150.25"), F.lit("maker"), F.lit("m1"), F.lit("")),
        "pairs": (key, key, F.lit("2005-01-01 00:00:00"), F.lit(""), F.lit("note")),
    }
    for name, cells in tables_.items():
        users.select(F.concat_ws(";", *cells)).write.text(f"{folder}/{name}")
    animals = gps.read_description(spark, f"{folder}/animals", gps.ANIMALS)
    sensors = gps.read_description(spark, f"{folder}/sensors", gps.SENSORS)
    pairs = gps.read_description(spark, f"{folder}/pairs", gps.SENSORS_ANIMALS)
    found = pairs.join(animals, "animals_id").join(sensors, "gps_sensors_id")
    return found.select("animals_id", "animals_code", "animal_name", "sex", "gps_sensors_code", "frequency", "start_time", "notes")


# -- reshaping --------------------------------------------------------------------------------------------


@query
def set_na(spark, sf):
    df = reshape.set_na(fx.relocations(spark, sf), fx.START_US, 4 * fx.HOUR_US)
    return df.select("pgtraj_name", "burst_name", "rid", "us", "x", "y")


@query
def set_t0(spark, sf):
    df = reshape.set_t0(fx.relocations(spark, sf), fx.START_US, 4 * fx.HOUR_US)
    return df.select("rid", "us")


@query
def redistribute_time(spark, sf):
    df = reshape.redistribute_time(fx.relocations(spark, sf), 6 * fx.HOUR_US)
    return df.select("pgtraj_name", "burst_name", "rid", "us", rounded("x"), rounded("y"))


@query
def redistribute_space(spark, sf):
    df = reshape.redistribute_space(fx.relocations(spark, sf), 4.0)
    second = F.round(F.col("us") / 1e6).cast("long").alias("second")
    return df.select("pgtraj_name", "burst_name", "rid", second, rounded("x"), rounded("y"))


@query
def subset_params(spark, sf):
    kept = reshape.subset(fx.parameters(spark, sf).rows(), "dist < 15")
    return shown(kept, "burst_name", "seq", "rid")


@query
def subsample(spark, sf):
    regular = reshape.set_t0(fx.relocations(spark, sf), fx.START_US, 4 * fx.HOUR_US)
    kept = reshape.subsample(regular, 8 * fx.HOUR_US)
    return build_steps(kept).rows().select("rid", "us", "rid2", "dt_us")


@query
def cut(spark, sf):
    laid = reshape.cut(fx.parameters(spark, sf), "dist > 12")
    again = reshape.recompute(laid.rows().select(*fx.relocations(spark, sf).columns), within=laid)
    return shown(again.rows(), "burst_name", "seq", "rid")


@query
def bind(spark, sf):
    laid = reshape.recompute(reshape.bind(fx.relocations(spark, sf)))
    return shown(laid.rows(), "burst_name", "seq", "rid")


@query
def combine(spark, sf):
    first = fx.relocations(spark, sf)
    second = reshape.rename_bursts(first, "2")
    both = reshape.combine(first, second, check=False)
    return summary.burst_summary(both)


@query
def combine_checked(spark, sf):
    """Two trajectories whose names keep the rules; the check is part of the query."""
    first = fx.relocations(spark, sf)
    second = reshape.rename_bursts(first, "2").withColumn("pgtraj_name", F.concat(F.lit("q"), F.substring("pgtraj_name", 2, 9)))
    return summary.burst_summary(reshape.combine(first, second))


@query
def omit_missing(spark, sf):
    laid = reshape.recompute(reshape.omit_missing(fx.relocations(spark, sf)))
    return shown(laid.rows(), "burst_name", "seq", "rid")


@query
def to_type1(spark, sf):
    laid = build_steps(reshape.to_type1(fx.relocations(spark, sf)), TYPE_I)
    return laid.rows().select("burst_name", "rid", "rid2", "us", "x2", "y2")


@query
def is_regular(spark, sf):
    return summary.is_regular(build_steps(fx.relocations(spark, sf, "ties")).rows())


@query
def recompute(spark, sf):
    regular = reshape.set_t0(fx.relocations(spark, sf), fx.START_US, 4 * fx.HOUR_US)
    return shown(reshape.recompute(regular).rows(), "burst_name", "seq", "rid")


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    return step_parameters_computed(spark, sf)

