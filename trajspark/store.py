"""A trajectory store: one catalog database of Parquet tables, partitioned by pgtraj and version.

Facts are stored once, in step order and with both ends of each step (``step``), so parameters, geometry, summaries and exports are scans of one pruned
partition. The normalised tables of the model are projections (``model()``). Infolocs of all trajectories are one table too, whatever their columns, as
are the step views, burst views and burst lines; names of trajectories are values of a partition column and may be any text.

A pgtraj exists when its row is in ``pgtraj``; that row names the version of its steps, bursts and infolocs and holds what was counted while they were
written (steps, bursts, the largest burst), so nothing is counted again before ordered work. Writing always makes a new version beside what is there; the
row is written last and removed first. So readers see the old trajectory or the new one, whole, wherever a write fails, and only then are older
versions removed. Ids come from ranges that a write takes for itself before it begins (``allocated``) and are never given twice.

The number of Spark jobs of a call doesn't depend on the number of trajectories it is about.
"""

from __future__ import annotations

import re
import uuid
import warnings
import zlib
from collections.abc import Iterable, Mapping, Sequence
from datetime import datetime, timedelta
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trajspark import settings
from trajspark.functions import times
from trajspark.functions.reproject import reproject_line, srid_of, supported
from trajspark.operators import export as exporting
from trajspark.operators import infolocs as info
from trajspark.operators import lines, summary, windows
from trajspark.operators.ids import PLACED, Model, placed, with_burst_ids
from trajspark.operators.parameters import FILL_LATER, step_parameters, stored_parameters, turns_of_open
from trajspark.operators.steps import BURST, LAST, TYPE_I, TYPE_II, build_steps, computed_steps, step_geometry
from trajspark.operators.views import VIEW_COLUMNS, step_view
from trajspark.plans.segments import Known, Laid, RowNumber, RunningSum, lay_out, with_prefix
from trajspark.sources import tables

DATABASE_SOURCE, TRAJECTORY_SOURCE = "table", "trajectory"
ROWS_A_FILE = 2_000_000
#: ids of one range, which one task sorts and writes
ROWS_A_RANGE = 100_000
_POINT = "STRUCT<x: DOUBLE, y: DOUBLE>"
_REGISTRY = "ARRAY<STRUCT<name: STRING, type: STRING, zone: STRING, levels: ARRAY<STRING>>>"

SCHEMAS = {
    "pgtraj": (
        "proj4string STRING, time_zone STRING, note STRING, insert_timestamp TIMESTAMP, source STRING, type_i BOOLEAN, srid INT, version STRING, "
        "infolocs STRING, n_steps BIGINT, n_bursts BIGINT, largest BIGINT, named BOOLEAN, pgtraj_name STRING"
    ),
    "animal_burst": (
        f"burst_id BIGINT, burst_name STRING, animal_name STRING, num_steps BIGINT, info_cols {_REGISTRY}, pgtraj_name STRING, version STRING"
    ),
    "step": (
        "step_id BIGINT, burst_id BIGINT, burst_name STRING, animal_name STRING, seq BIGINT, rid BIGINT, us BIGINT, x DOUBLE, "
        "y DOUBLE, srid INT, rid2 BIGINT, us2 BIGINT, x2 DOUBLE, y2 DOUBLE, relocation_id_1 BIGINT, relocation_id_2 BIGINT, "
        "dt_us BIGINT, r_rowname STRING, r2n DOUBLE, rel_angle DOUBLE, abs_angle DOUBLE, dx DOUBLE, dy DOUBLE, dist DOUBLE, "
        "dt DOUBLE, pgtraj_name STRING, version STRING"
    ),
    "infolocs": "step_id BIGINT, registry BIGINT, info MAP<STRING, STRING>, pgtraj_name STRING, version STRING",
    "info_registry": (
        f"registry BIGINT, info_cols {_REGISTRY}, columns ARRAY<STRUCT<name: STRING, kind: STRING>>, pgtraj_name STRING, version STRING"
    ),
    "step_view": (
        f"step_id BIGINT, step_geom ARRAY<{_POINT}>, date TIMESTAMP_NTZ, us BIGINT, dx DOUBLE, dy DOUBLE, dist DOUBLE, dt DOUBLE, dt_us BIGINT, "
        "abs_angle DOUBLE, rel_angle DOUBLE, animal_name STRING, burst_name STRING, registry BIGINT, info MAP<STRING, STRING>, "
        "pgtraj_name STRING, version STRING"
    ),
    "burst_view": (
        "animal_name STRING, burst_name STRING, num_relocations BIGINT, num_na BIGINT, date_begin TIMESTAMP_NTZ, date_end TIMESTAMP_NTZ, "
        "n_parts BIGINT, n_points BIGINT, length DOUBLE, pgtraj_name STRING, version STRING"
    ),
    "burst_lines": f"burst_name STRING, part BIGINT, line ARRAY<{_POINT}>, n_points BIGINT, length DOUBLE, pgtraj_name STRING, version STRING",
    "allocated": "last_step BIGINT, last_burst BIGINT, version STRING",
}
PARTITIONS = {name: "pgtraj_name, version" for name in SCHEMAS} | {"pgtraj": "pgtraj_name", "allocated": None}
VIEWS = ("step_view", "burst_view", "burst_lines")
FACTS = ("step", "animal_burst", "infolocs", "info_registry")


class TrajectoryStore:
    def __init__(self, spark: SparkSession, schema: str = "traj", location: str | None = None):
        self.spark, self.schema, self.location = spark, schema, location

    # -- model ----------------------------------------------------------------------------------------

    def _name(self, table: str) -> str:
        return f"`{self.schema}`.`{table}`"

    def table(self, name: str) -> DataFrame:
        return self.spark.table(self._name(name))

    def ensure(self) -> TrajectoryStore:
        """Create the tables in an empty schema, accept a complete one, refuse anything else."""
        where = f" LOCATION '{self.location}'" if self.location else ""
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{self.schema}`{where}")
        present = {r["tableName"] for r in self.spark.sql(f"SHOW TABLES IN `{self.schema}`").collect() if not r["isTemporary"]}
        if not present:
            for name, columns in SCHEMAS.items():
                parts = f" PARTITIONED BY ({PARTITIONS[name]})" if PARTITIONS[name] else ""
                self.spark.sql(f"CREATE TABLE {self._name(name)} ({columns}) USING parquet{parts}")
            return self
        if not set(SCHEMAS) <= present:
            raise ValueError(f"schema {self.schema} exists and is not a trajectory schema")
        for name, columns in SCHEMAS.items():
            expected = {(f.name, f.dataType) for f in T.StructType.fromDDL(columns)}
            if {(f.name, f.dataType) for f in self.table(name).schema} != expected:
                raise ValueError(f"table {name} of schema {self.schema} has other columns than expected")
        return self

    def _append(self, df: DataFrame, name: str, order: Sequence[str] = (), together: bool = False) -> None:
        """Add rows, files sorted by ``order``. The first of it is an id, and rows are clustered into ranges of it, which needs no sampling, unless they
        are ``together`` already."""
        columns = self.table(name).columns
        df = df.withColumns({c: F.lit(None) for c in columns if c not in df.columns}).select(*columns)
        if order:
            df = df if together else df.repartition(F.floor(F.col(order[0]) / ROWS_A_RANGE))
            df = df.sortWithinPartitions("pgtraj_name", "version", *order)
        df.write.insertInto(self._name(name))

    def _replace(self, df: DataFrame, name: str, held: Iterable[tuple[str, str]] = (), by: str | None = None) -> None:
        """Write rows of some versions, in the place of the partitions ``held``; ``by`` clusters and sorts them."""
        self._drop_partitions(name, held)
        columns = self.table(name).columns
        df = df.withColumns({c: F.lit(None) for c in columns if c not in df.columns}).select(*columns)
        if by:
            df = df.repartitionByRange("pgtraj_name", by).sortWithinPartitions("pgtraj_name", by)
        df.write.insertInto(self._name(name))

    def _publish(self, described: DataFrame, replaced: Sequence[str] = ()) -> None:
        """Write the pgtraj rows, which makes their versions the ones that are read; those in ``replaced`` take the place of older ones."""
        described = described.select(*self.table("pgtraj").columns)
        if not replaced:
            described.write.insertInto(self._name("pgtraj"))
            return
        described.createOrReplaceTempView(view := f"publish_{uuid.uuid4().hex}")
        try:
            self.spark.sql(f"INSERT OVERWRITE TABLE {self._name('pgtraj')} WITH (partitionOverwriteMode = 'dynamic') SELECT * FROM {view}")
        finally:
            self.spark.catalog.dropTempView(view)

    def pgtrajs(self) -> list[str]:
        return sorted(r[0] for r in self.table("pgtraj").select("pgtraj_name").collect())

    def _row(self, pgtraj: str):
        row = self.table("pgtraj").filter(F.col("pgtraj_name") == pgtraj).first()
        if row is None:
            raise ValueError(f"the pgtraj {pgtraj!r} does not exist in schema {self.schema}")
        return row

    def _allocate(self, steps: int, bursts: int, version: str) -> tuple[int, int]:
        """Take ranges of step and burst ids for a version; returns what lies before them. A range is never given again."""
        top = self.table("allocated").agg(F.max("last_step"), F.max("last_burst")).first()
        last_step, last_burst = top[0] or 0, top[1] or 0
        taken = [(last_step + steps, last_burst + bursts, version)]
        self.spark.createDataFrame(taken, SCHEMAS["allocated"]).coalesce(1).write.insertInto(self._name("allocated"))
        return last_step, last_burst

    # -- writing --------------------------------------------------------------------------------------

    def _save(self, laid: Laid, bursts: DataFrame, version: str, base: tuple[int, int]) -> tuple[DataFrame, DataFrame]:
        """Write placed steps and bursts as a new version; returns both as written. Nothing shows them yet.

        Steps marked ``open`` wait under a version of their own until the others, from which their turns come, are written.
        """
        steps, waiting = laid.rows(), f"{version}-open"
        own = F.when(F.col("open"), F.lit(waiting)).otherwise(F.lit(version)) if "open" in steps.columns else F.lit(version)
        shifted = {c: F.col(c) + base[0] for c in ("step_id", "relocation_id_1", "relocation_id_2")}
        steps = steps.withColumns({**shifted, "burst_id": F.col("burst_id") + base[1], "version": own})
        self._append(steps, "step", ["step_id"], together=laid.keys == PLACED)
        held = [p for p in self._partitions("step") if p[1] == waiting]
        if held:
            every = self.table("step").filter(F.col("version").isin(version, waiting))
            rows = turns_of_open(every.filter(F.col("version") == waiting), every, laid.n_groups)
            self._append(rows.withColumn("version", F.lit(version)), "step", ["step_id"])
            self._drop_partitions("step", held)
        self._append(bursts.withColumns({"burst_id": F.col("burst_id") + base[1], "version": F.lit(version)}), "animal_burst", ["burst_id"])
        return tuple(self.table(t).filter(F.col("version") == version) for t in ("step", "animal_burst"))

    @staticmethod
    def _counted(bursts: DataFrame) -> DataFrame:
        """What the pgtraj rows keep of their bursts."""
        named = F.min("num_named").isNotNull() & (F.sum("num_named") == F.sum("num_steps"))
        return bursts.groupBy("pgtraj_name").agg(
            F.sum("num_steps").alias("n_steps"), F.count(F.lit(1)).alias("n_bursts"), F.max("num_steps").alias("largest"), named.alias("named"))

    def _described(self, described: DataFrame, bursts: DataFrame, version: str, source: str, kind: int, infolocs: Mapping[str, str]) -> DataFrame:
        names = self.spark.createDataFrame(list(infolocs.items()), "pgtraj_name string, infolocs string")
        columns = {
            "insert_timestamp": F.current_timestamp(), "source": F.lit(source), "type_i": F.lit(kind == TYPE_I), "version": F.lit(version),
        }
        return described.join(self._counted(bursts), "pgtraj_name").join(names, "pgtraj_name", "left").withColumns(columns).coalesce(1)

    def build(
        self,
        relocations_table: str | DataFrame,
        *,
        info_cols: Sequence[str] | None = None,
        info_table: str | DataFrame | None = None,
        info_rid: str | None = None,
        check: bool = True,
        **binding,
    ) -> list[str]:
        """Build trajectories from a table of relocations (arguments of ``bind_relocations``).

        Parameters are computed once, here, and stored with the steps. The source is read once for its names, values and sizes and once for the
        steps. An existing pgtraj is an error. Returns the names written.
        """
        source = self._source(relocations_table)
        extra = None if info_cols is None else self._source(info_table) if info_table is not None else source
        self.ensure()
        bound = tables.bind_relocations(source, **binding)
        bursts = settings.write_through(tables.burst_facts(bound), "bursts")
        if check:
            if bursts.filter("num_known > 0").isEmpty():
                warnings.warn("column x does not contain values", stacklevel=2)
            tables.check_names(bursts)
        kind = TYPE_II if binding.get("timestamps") else TYPE_I
        described = tables.pgtraj_rows(bursts)
        names = [r[0] for r in described.select("pgtraj_name").collect()]
        for name in names:
            tables.check_name(name)
        taken = sorted(set(names) & set(self.pgtrajs()))
        if taken:
            raise ValueError(f"pgtrajs already exist: {', '.join(taken)}")
        known, total = self._known(bursts)
        sizes = bursts.select(*BURST, "animal_name", F.col("num_steps").alias("burst_steps"))
        numbered = self._numbered_bursts(sizes, known.groups)
        rows, keys = placed(bound, numbered, known, total, ROWS_A_RANGE)
        laid = step_parameters(build_steps(rows, kind, numbered=True, known=known, keys=keys), FILL_LATER)
        version = uuid.uuid4().hex
        base = self._allocate(total, known.groups, version)
        stored, held = self._save(with_burst_ids(laid, numbered), numbered, version, base)
        infolocs: dict[str, str] = {}
        if extra is not None:
            rid = info_rid or binding.get("rid", "rid")
            present = [c for c in info_cols if c in extra.columns]
            rows = extra.select(F.col(rid).cast("long").alias("rid"), info.packed(extra, present).alias("info"))
            rows = settings.broadcast_if(stored.select("step_id", "rid", "pgtraj_name"), total).join(rows, "rid").drop("rid").withColumn("registry", F.lit(0))
            kinds = info.stored_columns(extra, present)
            registry = described.select("pgtraj_name", F.lit(0).alias("registry"))
            infolocs = self._write_infos(rows, registry, kinds, names, version)
        srid = bursts.groupBy("pgtraj_name").agg(F.max("srid").alias("srid"))
        described = described.join(srid, "pgtraj_name")
        self._publish(self._described(described, bursts, version, DATABASE_SOURCE, kind, infolocs))
        self._name_infolocs(infolocs, version, kinds if infolocs else [])
        return names

    @staticmethod
    def _known(bursts: DataFrame) -> tuple[Known, int]:
        row = bursts.agg(F.max("num_steps").alias("largest"), F.count(F.lit(1)).alias("groups"), F.sum("num_steps").alias("rows")).first()
        return Known(row["largest"] or 0, row["groups"]), row["rows"] or 0

    @staticmethod
    def _numbered_bursts(sizes: DataFrame, groups: int) -> DataFrame:
        """Bursts with their ids in name order and the steps of earlier bursts, written."""
        chain = with_prefix(lay_out(sizes, (), BURST, known_rows=groups), burst_id=RowNumber(), _upto=RunningSum(F.col("burst_steps")))
        rows = chain.rows().withColumns({"num_steps": F.col("burst_steps"), "_earlier": F.col("_upto") - F.col("burst_steps")})
        return settings.write_through(rows.drop("_upto", "burst_steps"), "numbered-bursts")

    def _source(self, source: str | DataFrame) -> DataFrame:
        return tables.source_table(self.spark, source) if isinstance(source, str) else source

    def import_trajectory(
        self,
        trajectory: DataFrame,
        pgtraj: str,
        *,
        proj4string: str | None = None,
        time_zone: str | None = None,
        note: str | None = None,
        overwrite: bool = False,
        type_i: bool = False,
        infolocs: DataFrame | None = None,
        info_types: Mapping[str, info.InfoType] | None = None,
        info_registry: DataFrame | None = None,
    ) -> None:
        """Store a computed trajectory: one row per relocation with x, y, date, dx, dy, dt, R2n, rel.angle, id, burst and
        r.row.names (or the plain names of those columns), in burst_order if given.

        R2n and rel.angle are kept as they are. An existing pgtraj is replaced with ``overwrite`` and an error without. Without times
        (``type_i``) the order is ``seq``, an integer ``date`` or the row names; none of them is an error. Columns ``proj4string``
        and ``time_zone`` (as in an export) stand in for the arguments. ``infolocs`` are met by r_rowname and burst_name; ``info_types`` are the classes
        of their columns for all bursts and ``info_registry`` (burst_name, info_cols) those of bursts that have classes of their own.
        """
        tables.check_name(pgtraj)
        told = [c for c in ("proj4string", "time_zone") if c in trajectory.columns]
        if told:
            row = trajectory.select(*told).first()
            given = dict(zip(told, row, strict=True)) if row else {}
            proj4string, time_zone = proj4string or given.get("proj4string"), time_zone or given.get("time_zone")
            trajectory = trajectory.drop(*told)
        described = self.spark.createDataFrame(
            [(pgtraj, proj4string, time_zone, note, srid_of(proj4string))],
            "pgtraj_name string, proj4string string, time_zone string, note string, srid int",
        )
        own = F.lit(pgtraj).alias("pgtraj_name")
        self._import(
            self._plain(trajectory, time_zone, type_i).withColumn("pgtraj_name", own), described, overwrite, type_i,
            None if infolocs is None else infolocs.withColumn("pgtraj_name", own), info_types,
            None if info_registry is None else info_registry.select("burst_name", "info_cols", own),
        )

    def _import(
        self, df: DataFrame, described: DataFrame, overwrite: bool, type_i: bool, infolocs: DataFrame | None,
        info_types: Mapping[str, info.InfoType] | None, info_registry: DataFrame | None, kinds: list[tuple[str, str]] | None = None,
    ) -> None:
        """Store computed trajectories, as many as ``described`` has rows, by one set of jobs. With ``kinds`` the infolocs are packed already."""
        self.ensure()
        names = [r[0] for r in described.select("pgtraj_name").collect()]
        present = {r["pgtraj_name"]: r["version"] for r in self.table("pgtraj").select("pgtraj_name", "version").collect()}
        old = {n: present[n] for n in names if n in present}
        if old and not overwrite:
            raise ValueError(f"the pgtraj {sorted(old)[0]!r} already exists in schema {self.schema}")
        ordered = "burst_order" in df.columns
        keys = ["pgtraj_name", "animal_name", "burst_name", *(["burst_order"] if ordered else [])]
        unplaced = F.expr("seq IS NULL AND order_date IS NULL AND try_cast(r_rowname AS BIGINT) IS NULL")
        facts = df.groupBy(*keys).agg(
            F.count(F.lit(1)).alias("num_steps"), F.count("r_rowname").alias("num_named"), F.count_if(unplaced).alias("unplaced"))
        bursts = settings.write_through(facts, "bursts")
        if type_i and not bursts.filter("unplaced > 0").isEmpty():
            raise ValueError("a trajectory without times needs seq, an integer date or numbered row names for its order")
        if ordered:
            shared = bursts.groupBy("pgtraj_name", "burst_order").agg(F.min("burst_name").alias("a"), F.max("burst_name").alias("b"))
            several = bursts.groupBy(*BURST).count().filter("count > 1")
            if not shared.filter("burst_order IS NULL OR a <> b").isEmpty() or not several.isEmpty():
                raise ValueError("burst_order must give every burst a number of its own")
        tables.check_names(bursts.join(described, "pgtraj_name").drop("srid"))
        known, total = self._known(bursts)
        place = F.format_string("%020d", F.col("burst_order")) if ordered else F.col("burst_name")
        sizes = bursts.select("pgtraj_name", "animal_name", F.col("burst_name").alias("_name"), place.alias("burst_name"), F.col("num_steps").alias("burst_steps"))

        srids = settings.broadcast_if(described.select("pgtraj_name", "srid"), len(names))
        steps = computed_steps(df.drop("srid").join(srids, "pgtraj_name")).withColumns(
            {
                "_when": F.coalesce("us", F.lit(LAST)),
                "_place": F.coalesce("seq", "order_date", F.col("r_rowname").try_cast("long"), F.lit(0).cast("long")),
                "_name": F.col("burst_name"), "burst_name": place,
            }
        ).drop("order_date")
        numbered = self._numbered_bursts(sizes, known.groups)
        near, by = placed(steps.drop("seq"), numbered, known, total, ROWS_A_RANGE)
        laid = with_burst_ids(with_prefix(lay_out(near, by, ("_when", "_place", "r_rowname"), known=known), seq=RowNumber()), numbered)
        rows = laid.df.withColumn("burst_name", F.col("_name")).drop("_name")
        rows = laid.on(stored_parameters(rows).withColumns(
            {"relocation_id_1": F.col("step_id") * 2 - 1, "relocation_id_2": F.col("step_id") * 2, "rid": F.lit(None).cast("long")}
        ).withColumn("rid2", F.col("relocation_id_2")))
        held = numbered.withColumn("burst_name", F.col("_name")).drop("_name")
        version, written = uuid.uuid4().hex, {}
        base = self._allocate(2 * total, known.groups, version)
        if infolocs is None:
            self._save(rows, held, version, base)
        else:
            columns = [c for c in infolocs.columns if c not in ("r_rowname", "burst_name", "pgtraj_name")]
            own = kinds if kinds is not None else info.stored_columns(infolocs, columns)
            held = self._with_registry(held, described, own, info_types, info_registry)
            stored, saved = self._save(rows, held, version, base)
            packed = F.col("info") if kinds is not None else info.packed(infolocs, columns)
            met = infolocs.select("pgtraj_name", "burst_name", "r_rowname", packed.alias("info"))
            ids = settings.broadcast_if(stored.select("step_id", "burst_id", "pgtraj_name", "burst_name", "r_rowname"), total)
            found = ids.join(met, ["pgtraj_name", "burst_name", "r_rowname"])
            number = F.xxhash64("info_cols").alias("registry")
            if info_registry is None:
                registry = saved.select("pgtraj_name", number, "info_cols").distinct()
                found = found.join(settings.broadcast_if(registry.drop("info_cols"), len(names)), "pgtraj_name")
            else:
                registry = saved.select("pgtraj_name", number, "info_cols").distinct()
                found = settings.join_small(found, saved.select("burst_id", number), "burst_id", largest=known.largest)
            written = self._write_infos(found.select("step_id", "registry", "info", "pgtraj_name"), registry, own, names, version)
        kind = TYPE_I if type_i else TYPE_II
        self._publish(self._described(described, bursts, version, TRAJECTORY_SOURCE, kind, written), sorted(old))
        self._name_infolocs(written, version, own if written else [])
        if old:
            self._forget(old.items())

    @staticmethod
    def _with_registry(bursts, described, columns, info_types, info_registry) -> DataFrame:
        """Each burst's registry: its own, else the classes given for all, else those of the Spark types."""
        default = info.default_registry(columns, F.coalesce("time_zone", F.lit("UTC")))
        if info_types:
            given = [(n, info_types[n]) for n, _ in columns if n in info_types]
            rest = info.default_registry([c for c in columns if c[0] not in info_types], F.coalesce("time_zone", F.lit("UTC")))
            default = F.concat(info.registry(dict(given)), rest)
        bursts = bursts.join(described.select("pgtraj_name", "time_zone"), "pgtraj_name").withColumn("info_cols", default).drop("time_zone")
        if info_registry is None:
            return bursts
        own = info_registry.select("pgtraj_name", "burst_name", F.col("info_cols").cast(info.REGISTRY).alias("_own"))
        return bursts.join(own, list(BURST), "left").withColumn("info_cols", F.coalesce("_own", "info_cols")).drop("_own")

    @staticmethod
    def _plain(df: DataFrame, zone: str | None, type_i: bool) -> DataFrame:
        """Exported column names to stored ones. Dates without a zone of their own are read in ``zone``."""
        renames = {
            "R2n": "r2n", "abs.angle": "abs_angle", "rel.angle": "rel_angle", "id": "animal_name", "burst": "burst_name",
            "r.row.names": "r_rowname",
        }
        df = df.select(*[F.col(f"`{c}`").alias(renames.get(c, c)) for c in df.columns])
        numbered = type_i and dict(df.dtypes).get("date") in ("tinyint", "smallint", "int", "bigint")
        df = df.withColumn("order_date", F.col("date").cast("long") if numbered else F.lit(None).cast("long"))
        if type_i:
            df = df.withColumns({"us": F.lit(None).cast("long"), "dt": F.lit(None).cast("double")})
        elif "us" not in df.columns:
            if zone and isinstance(df.schema["date"].dataType, T.TimestampNTZType):
                df = df.withColumn("date", F.convert_timezone(F.lit(zone), F.lit("UTC"), F.col("date")))
            df = df.withColumn("us", times.micros(df, "date"))
        for name, kind in (("r_rowname", "string"), ("seq", "long")):
            df = df.withColumn(name, F.col(name).cast(kind) if name in df.columns else F.lit(None).cast(kind))
        return df

    def _write_infos(
        self, rows: DataFrame, registry: DataFrame, columns: Sequence[tuple[str, str]], names: Sequence[str], version: str
    ) -> dict[str, str]:
        """Write packed infolocs and their registries as partitions of the version; returns pgtraj and name of what is there. Infolocs
        with several rows for one step are taken back with a warning."""
        self._replace(rows.withColumn("version", F.lit(version)), "infolocs")
        written = self.table("infolocs").filter(F.col("version") == version)
        repeated = written.groupBy("pgtraj_name", "step_id").count().filter("count > 1").select("pgtraj_name").distinct()
        wrong = sorted(r[0] for r in repeated.collect())
        for pgtraj in wrong:
            warnings.warn(f"infolocs of {pgtraj!r} not written: several rows for one step", stacklevel=3)
        self._drop_partitions("infolocs", [(n, version) for n in wrong])
        kinds = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(k).alias("kind")) for n, k in columns])
        kept = registry.filter(~F.col("pgtraj_name").isin(wrong)) if wrong else registry
        self._replace(kept.withColumns({"columns": kinds.cast(T.StructType.fromDDL(SCHEMAS["info_registry"])["columns"].dataType), "version": F.lit(version)}), "info_registry")
        return {n: _relation(n) for n in names if n not in wrong}

    def _name_infolocs(self, infolocs: Mapping[str, str], version: str, columns: Sequence[tuple[str, str]]) -> None:
        """A view for each pgtraj that shows its infolocs as a table under its own name (a change of the catalog, no job)."""
        for pgtraj, name in infolocs.items():
            cells = "".join(f", {info.value_sql(n, k)} AS {_quoted(n)}" for n, k in columns)
            where = f"pgtraj_name = {_literal(pgtraj)} AND version = {_literal(version)}"
            select = f"SELECT step_id{cells} FROM {self._name('infolocs')} WHERE {where}"
            self.spark.sql(f"CREATE OR REPLACE VIEW {self._name(name)} AS {select}")

    # -- reading --------------------------------------------------------------------------------------

    def _held(self, table: str, pgtraj: str, version: str) -> DataFrame:
        return self.table(table).filter((F.col("pgtraj_name") == pgtraj) & (F.col("version") == version))

    def _steps(self, pgtraj: str) -> DataFrame:
        return self._held("step", pgtraj, self._row(pgtraj)["version"])

    def _unpacked(self, rows: DataFrame, pgtraj: str, version: str, keep: Sequence[str]) -> DataFrame:
        """Packed infolocs of a version as columns, each row by the registry of its burst."""
        registries = self._held("info_registry", pgtraj, version)
        entry = F.explode_outer("info_cols").alias("e")
        facts = registries.select("registry", "columns", entry).groupBy("e.name", "e.type").agg(
            F.count(F.lit(1)).alias("n"), F.first("columns").alias("columns"), F.count_distinct("registry").alias("registries")).collect()
        if not facts:
            return rows.select(*[c for c in rows.columns if c in keep])
        columns = [(c["name"], c["kind"]) for c in facts[0]["columns"]]
        total = registries.count()
        if total == 1:
            types = info.types_from_registry(registries.first()["info_cols"])
            return info.unpacked(rows, columns, types, keep=keep)
        classes: dict[str, set] = {n: set() for n, _ in columns}
        for n, _ in columns:
            own = [f for f in facts if f["name"] == n]
            classes[n] = {f["type"] for f in own} | (set() if sum(f["n"] for f in own) == total else {None})
        return info.unpacked(rows, columns, registries=registries, classes=classes, keep=keep)

    def infolocs(self, pgtraj: str) -> DataFrame | None:
        """Infolocs of a pgtraj, each burst's typed by its registry; None when there are none."""
        found = self.table("pgtraj").filter(F.col("pgtraj_name") == pgtraj).first()
        if found is None or found["infolocs"] is None:
            return None
        rows = self._unpacked(self._held("infolocs", pgtraj, found["version"]), pgtraj, found["version"], [info.RESERVED])
        return rows if info.info_columns(rows) else None

    def parameters(self, pgtraj: str) -> DataFrame:
        """The parameter columns of a pgtraj, one pruned scan."""
        df = self._steps(pgtraj).withColumn("date", times.wall_time(F.col("us")))
        return df.select(
            "step_id", "r_rowname", "x", "y", "date", "dx", "dy", "dist", "dt", "r2n", "abs_angle", "rel_angle",
            "animal_name", F.col("burst_name").alias("burst"), F.col("pgtraj_name").alias("pgtraj"),
        )

    def geometry(self, pgtraj: str) -> DataFrame:
        df = step_geometry(self._steps(pgtraj).withColumn("rid2", F.col("relocation_id_2")))
        return df.select(
            "step_id", "step_geom", times.wall_time(F.col("us")).alias("relocation_time"), times.seconds(F.col("dt_us")).alias("dt"),
            "r_rowname", "burst_name", "animal_name", "pgtraj_name", F.col("burst_id").alias("ab_id"),
        )

    def export(self, pgtraj: str) -> DataFrame:
        """The trajectory in long form under its exported names, in the zone of the pgtraj, with infolocs.

        ``proj4string`` and ``time_zone`` are columns, so the export alone is enough to import it again.
        """
        row = self._row(pgtraj)
        held = self._held("step", pgtraj, row["version"])
        steps = lay_out(held, BURST, ("seq",), known=_known(row)) if row["type_i"] else Laid(held, BURST, ("seq",))
        sizes = self._held("animal_burst", pgtraj, row["version"]).select(*BURST, F.col("num_steps").alias("burst_steps"))
        kind = TYPE_I if row["type_i"] else TYPE_II
        infos = self.infolocs(pgtraj)
        infos = None if infos is None else settings.broadcast_if(infos, row["n_steps"])
        long = exporting.export_long(steps, row["time_zone"], infos, kind, row["named"], sizes)
        return long.withColumns({c: F.lit(row[c]).cast("string") for c in ("proj4string", "time_zone")})

    def export_files(self, pgtraj: str, path: str, rows_a_file: int = ROWS_A_FILE) -> DataFrame:
        """Write the export as files that read in order one after another; returns their manifest (file number, rows, first and last place)."""
        return exporting.write_ordered(self.export(pgtraj), path, self._row(pgtraj)["n_steps"], rows_a_file)

    def pgtraj_summary(self) -> DataFrame:
        names = self.table("pgtraj").filter("infolocs IS NOT NULL").select("pgtraj_name", F.col("infolocs").alias("infolocs_table"))
        described = self._numbered().select("pgtraj_id", "pgtraj_name", F.col("insert_timestamp").alias("last_update"))
        return summary.pgtraj_summary(self._living("step"), described, names).orderBy("pgtraj_id")

    def burst_summary(self) -> DataFrame:
        found = summary.burst_summary(self._living("step"))
        bursts = self._living("animal_burst").select("pgtraj_name", "animal_name", "burst_name", "burst_id")
        found = found.join(bursts, ["pgtraj_name", "animal_name", "burst_name"]).join(self._numbered().select("pgtraj_id", "pgtraj_name"), "pgtraj_name")
        return found.orderBy("pgtraj_id", "burst_id").drop("burst_id")

    def _numbered(self) -> DataFrame:
        """The pgtraj rows with their ids."""
        return with_prefix(lay_out(self.table("pgtraj"), (), ("pgtraj_name",)), pgtraj_id=RowNumber()).rows()

    def _living(self, table: str) -> DataFrame:
        """Rows of the versions that are read; orphans of dropped pgtrajs and failed writes are left out by partition."""
        return self.table(table).join(self.table("pgtraj").select("pgtraj_name", "version"), ["pgtraj_name", "version"], "left_semi")

    def _whole_steps(self) -> DataFrame:
        """Steps of existing pgtrajs and orphans of dropped ones, but none of versions that a later one replaced."""
        current = self.table("pgtraj").select("pgtraj_name", F.col("version").alias("_current"))
        held = self.table("step").join(current, "pgtraj_name", "left")
        return held.filter("_current IS NULL OR version = _current").drop("_current")

    def model(self) -> Model:
        """The normalised tables."""
        steps, bursts = self._whole_steps(), self._living("animal_burst")
        numbered = self._numbered().select(
            F.col("pgtraj_id").alias("id"), "pgtraj_name", "proj4string", "time_zone", "note", "insert_timestamp")
        ids = numbered.select("pgtraj_name", F.col("id").alias("pgtraj_id"))
        first = steps.select(F.col("relocation_id_1").alias("id"), "x", "y", "srid", "us", F.col("rid").alias("orig_id"))
        imported = self.table("pgtraj").filter(F.col("source") == TRAJECTORY_SOURCE).select("pgtraj_name")
        second = steps.join(imported, "pgtraj_name", "left_semi").select(
            F.col("relocation_id_2").alias("id"), F.col("x2").alias("x"), F.col("y2").alias("y"), "srid",
            F.col("us2").alias("us"), F.lit(None).cast("long").alias("orig_id"),
        )
        columns = [F.col("step_id").alias("id"), "relocation_id_1", "relocation_id_2", "dt_us", "r_rowname", "r2n", "rel_angle"]
        return Model(
            pgtraj=numbered,
            animal_burst=bursts.join(ids, "pgtraj_name").select(F.col("burst_id").alias("id"), "burst_name", "animal_name", "pgtraj_id"),
            relocation=first.unionByName(second),
            step=steps.select(*columns),
            s_b_rel=self._living("step").select("step_id", F.col("burst_id").alias("animal_burst_id")),
        )

    # -- views ----------------------------------------------------------------------------------------

    def _partitions(self, table: str) -> set[tuple[str, str]]:
        """(pgtraj, version) of the partitions in the catalog."""
        rows = self.spark.sql(f"SHOW PARTITIONS {self._name(table)}").collect()
        return {tuple(unquote(part.split("=", 1)[1]) for part in r[0].split("/")) for r in rows}

    def create_views(self, pgtraj: str | Sequence[str], force: bool = False) -> None:
        """Write the step views of one or more pgtrajs and bring the burst view of the schema up to date.

        What is there already is kept unless ``force``. The burst view knows the versions it holds: only pgtrajs that were written since are
        added and only those that are gone are removed, as partitions. Pgtrajs that can't be shown in longitude/latitude are left out with a
        warning, or an error when they are asked for.
        """
        wanted = [pgtraj] if isinstance(pgtraj, str) else list(pgtraj)
        living = {r["pgtraj_name"]: r for r in self.table("pgtraj").collect()}
        for name in wanted:
            if name not in living:
                raise ValueError(f"the pgtraj {name!r} does not exist in schema {self.schema}")
            if not living[name]["srid"]:
                raise ValueError("cannot show unprojected relocations (SRID 0)")
            if not supported(living[name]["srid"]):
                raise ValueError(f"cannot reproject SRID {living[name]['srid']}")
        held = self._partitions("step_view")
        fresh = [living[n] for n in wanted if force or (n, living[n]["version"]) not in held]
        if fresh:
            again = [(r["pgtraj_name"], r["version"]) for r in fresh if (r["pgtraj_name"], r["version"]) in held]
            self._replace(self._step_views(fresh), "step_view", again, by="date")
        held = self._partitions("burst_view")
        shown = {n: r for n, r in living.items() if r["srid"] and supported(r["srid"])}
        for name in sorted(set(living) - set(shown)):
            warnings.warn(f"the pgtraj {name!r} can't be shown in longitude/latitude and is left out of the burst view", stacklevel=2)
        current = {(n, r["version"]) for n, r in shown.items()}
        stale = held - current | ({(n, shown[n]["version"]) for n in wanted} & held if force else set())
        missing = [shown[n] for n, v in sorted(current - (held - stale))]
        if missing:
            versions = F.col("version").isin([r["version"] for r in missing]) & F.col("pgtraj_name").isin([r["pgtraj_name"] for r in missing])
            steps = self._living("step").filter(versions)
            self._replace(self._burst_lines(steps, missing), "burst_lines", stale)
            parts = self._living("burst_lines").filter(versions)
            self._replace(self._with_version(lines.burst_view(steps, parts), missing), "burst_view", stale)
        elif stale:
            for name in ("burst_lines", "burst_view"):
                self._drop_partitions(name, stale)

    def _with_version(self, df: DataFrame, rows: Sequence) -> DataFrame:
        versions = self.spark.createDataFrame([(r["pgtraj_name"], r["version"], r["srid"]) for r in rows], "pgtraj_name string, version string, _srid int")
        return df.join(settings.broadcast_if(versions, len(rows)), "pgtraj_name")

    def _step_views(self, rows: Sequence) -> DataFrame:
        """Step views of pgtrajs, one branch for each reference system and for those with and without infolocs."""
        out, packed = None, self.table("infolocs").select("step_id", "registry", "info", "pgtraj_name", "version")
        for srid, attached in sorted({(r["srid"], r["infolocs"] is not None) for r in rows}):
            own = [r for r in rows if (r["srid"], r["infolocs"] is not None) == (srid, attached)]
            which = F.col("pgtraj_name").isin([r["pgtraj_name"] for r in own]) & F.col("version").isin([r["version"] for r in own])
            steps = self.table("step").filter(which & F.col("relocation_id_2").isNotNull())
            n_steps = sum(r["n_steps"] for r in own)
            infos = settings.broadcast_if(packed.filter(which).drop("pgtraj_name", "version"), n_steps) if attached else None
            view = self._with_version(step_view(steps, srid, infos), own)
            out = view if out is None else out.unionByName(view, allowMissingColumns=True)
        return out

    def _burst_lines(self, steps: DataFrame, rows: Sequence) -> DataFrame:
        """Burst lines in longitude/latitude."""
        line: Column = F.lit(None)
        for srid in sorted({r["srid"] for r in rows}):
            line = F.when(F.col("_srid") == srid, reproject_line(F.col("line"), srid)).otherwise(line)
        known = Known(max(r["largest"] for r in rows), sum(r["n_bursts"] for r in rows))
        return self._with_version(lines.burst_lines(steps, order=("seq",), known=known), rows).withColumn("line", line)

    def view(self, pgtraj: str) -> DataFrame:
        """The written step view of a pgtraj."""
        row = self._row(pgtraj)
        held = self._held("step_view", pgtraj, row["version"])
        base = [*VIEW_COLUMNS, "animal_name", "burst_name", "pgtraj_name"]
        if (pgtraj, row["version"]) not in self._partitions("step_view"):
            raise ValueError(f"the step view of {pgtraj!r} is not written")
        if row["infolocs"] is None:
            return held.select(*base)
        found = self._unpacked(held, pgtraj, row["version"], base)
        extra = [c for c in found.columns if c not in base]
        return found.select(*VIEW_COLUMNS, *extra, *base[len(VIEW_COLUMNS) :])

    def step_window(self, pgtraj: str, time: datetime, interval: timedelta, step_mode: bool = True) -> DataFrame:
        view = self.view(pgtraj)
        if not step_mode:
            return windows.window_lines(view, time, interval, known=_known(self._row(pgtraj)))
        base = (*windows.STEP_COLUMNS, *windows.NAME_COLUMNS, "us", "dt_us")
        return windows.window_steps(view, time, interval, [c for c in view.columns if c not in base])

    def bursts(self, names=None, pgtraj: str | None = None) -> DataFrame:
        """The named bursts (all with ``names`` None) with their whole lines, one row a part of a line."""
        view = self.table("burst_view")
        if names is not None:
            view = summary.bursts_by_name(view, names, pgtraj)
        elif pgtraj is not None:
            view = view.filter(F.col("pgtraj_name") == pgtraj)
        return lines.whole_lines(view, self.table("burst_lines"), [*BURST, "version"]).drop("version")

    def time_defaults(self, pgtraj: str) -> DataFrame:
        row = self._row(pgtraj)
        return summary.time_defaults(self.view(pgtraj), Known(row["n_steps"], 1)).withColumn("time_zone", F.lit(row["time_zone"]))

    # -- life cycle -----------------------------------------------------------------------------------

    def drop(self, pgtraj: str | None = None, full_clean: bool = True) -> None:
        """Drop a pgtraj with its bursts, views and infolocs; with ``full_clean`` also remove what no pgtraj uses.

        Both are changes of whole partitions, one statement a table; no rows are rewritten.
        """
        if pgtraj is None and not full_clean:
            raise ValueError("nothing to do: name a pgtraj or ask for a full clean")
        if pgtraj is not None:
            row = self._row(pgtraj)
            self.spark.sql(f"ALTER TABLE {self._name('pgtraj')} DROP IF EXISTS PARTITION (pgtraj_name = {_literal(pgtraj)})")
            for name in (*FACTS[1:], *VIEWS):
                self._drop_partitions(name, [(pgtraj, row["version"])])
            if row["infolocs"] is not None:
                self.spark.sql(f"DROP VIEW IF EXISTS {self._name(row['infolocs'])}")
        if full_clean:
            living = {(r["pgtraj_name"], r["version"]) for r in self.table("pgtraj").select("pgtraj_name", "version").collect()}
            for name in (*FACTS, *VIEWS):
                self._drop_partitions(name, self._partitions(name) - living)

    def _forget(self, versions: Iterable[tuple[str, str]]) -> None:
        """Remove versions that newer ones replaced."""
        versions = list(versions)
        for name in (*FACTS, *VIEWS):
            self._drop_partitions(name, versions)

    def _drop_partitions(self, table: str, held: Iterable[tuple[str, str]]) -> None:
        which = [f"PARTITION (pgtraj_name = {_literal(n)}, version = {_literal(v)})" for n, v in held]
        if which:
            self.spark.sql(f"ALTER TABLE {self._name(table)} DROP IF EXISTS {', '.join(which)}")

    def analyze(self) -> None:
        """Refresh table statistics."""
        for name in SCHEMAS:
            self.spark.sql(f"ANALYZE TABLE {self._name(name)} COMPUTE STATISTICS")


def _known(row) -> Known:
    """Sizes that a pgtraj row holds."""
    return Known(row["largest"], row["n_bursts"])


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _relation(pgtraj: str) -> str:
    """The catalog name of a pgtraj's infolocs; names that a catalog can't hold as they are get a checksum."""
    plain = re.sub(r"[^0-9a-z_]", "_", pgtraj.lower())
    return f"infolocs_{plain}" if plain == pgtraj else f"infolocs_{plain}_{zlib.crc32(pgtraj.encode()):08x}"


def transfer(source: TrajectoryStore, target: TrajectoryStore, pgtraj: str | Sequence[str] | None = None, overwrite: bool = True) -> None:
    """Copy pgtrajs (one, several or, with None, all) from one store to another through their exported form.

    Pgtrajs of one type whose infolocs have the same columns are one set of jobs, however many there are. Infolocs keep the registries of
    their bursts.
    """
    rows = {r["pgtraj_name"]: r for r in source.table("pgtraj").collect()}
    wanted = sorted(rows) if pgtraj is None else [pgtraj] if isinstance(pgtraj, str) else list(pgtraj)
    for name in wanted:
        if name not in rows:
            raise ValueError(f"the pgtraj {name!r} does not exist in schema {source.schema}")
    held = source.table("info_registry").select("pgtraj_name", "version", "columns").distinct().collect()
    columns = {(r["pgtraj_name"], r["version"]): tuple((c["name"], c["kind"]) for c in r["columns"]) for r in held}
    groups: dict[tuple, list] = {}
    for name in wanted:
        row = rows[name]
        groups.setdefault((row["type_i"], columns.get((name, row["version"])) if row["infolocs"] is not None else None), []).append(row)
    for (type_i, kinds), own in sorted(groups.items(), key=repr):
        which = F.col("pgtraj_name").isin([r["pgtraj_name"] for r in own]) & F.col("version").isin([r["version"] for r in own])
        steps = source.table("step").filter(which)
        plain = steps.withColumns({
            "r_rowname": F.coalesce("r_rowname", F.col("step_id").cast("string")), "burst_order": F.col("burst_id"),
            "date": times.wall_time(F.col("us")), "order_date": F.lit(None).cast("long"),
        })
        if type_i:
            plain = plain.withColumns({"us": F.lit(None).cast("long"), "dt": F.lit(None).cast("double")})
        infolocs = registry = None
        if kinds is not None:
            infos = settings.broadcast_if(source.table("infolocs").filter(which).select("step_id", "info"), sum(r["n_steps"] for r in own))
            infolocs = plain.select("step_id", "pgtraj_name", "burst_name", "r_rowname").join(infos, "step_id")
            bursts = source.table("animal_burst").filter(which & F.col("info_cols").isNotNull())
            registry = bursts.select("pgtraj_name", "burst_name", "info_cols")
        described = source.spark.createDataFrame(
            [(r["pgtraj_name"], r["proj4string"], r["time_zone"], r["note"], srid_of(r["proj4string"])) for r in own],
            "pgtraj_name string, proj4string string, time_zone string, note string, srid int")
        target._import(
            plain.drop("step_id", "version", "relocation_id_1", "relocation_id_2", "burst_id"), described, overwrite, type_i, infolocs, None, registry,
            list(kinds) if kinds is not None else None)
