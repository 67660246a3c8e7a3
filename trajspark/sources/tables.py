"""Relocations from any Spark table: source checks, name binding and filtering.

The result of ``bind_relocations`` is one narrow projection of the source, so filters and column pruning reach
the scan. Columns: rid, us (microseconds UTC, null for Type I), x, y (both null for a missing fix), srid,
pgtraj_name, animal_name, burst_name, proj4string, time_zone, note.
"""

from __future__ import annotations

import re
import warnings
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trajspark.functions import times
from trajspark.functions.reproject import projection_text

# Fixed value: names given as text must begin with a letter or digit.
NAME_PATTERN = "^[0-9A-Za-z]"

BOUND = ("rid", "us", "x", "y", "srid", "pgtraj_name", "animal_name", "burst_name", "proj4string", "time_zone", "note")


def is_blank(value) -> bool:
    """None, NaN, empty text or an empty or all-blank sequence."""
    if value is None:
        return True
    if isinstance(value, float):
        return value != value
    if isinstance(value, str):
        return value == ""
    if isinstance(value, Sequence):
        return all(is_blank(v) for v in value)
    return False


def check_name(name: str) -> str:
    if not re.match(NAME_PATTERN, name):
        raise ValueError(f"invalid trajectory name {name!r}: it must begin with a letter or a digit")
    return name


def check_arguments(pgtraj, animal, relocations, burst, srid) -> None:
    """Types and lengths of the binding arguments."""
    for label, value in (("pgtraj", pgtraj), ("animal", animal)):
        if not isinstance(value, str) or is_blank(value):
            raise ValueError(f"{label} must be one column name or text")
    if not is_blank(burst) and not isinstance(burst, str):
        raise ValueError("burst must be one column name or text")
    columns = [relocations] if isinstance(relocations, str) else list(relocations)
    if len(columns) not in (1, 2) or not all(isinstance(c, str) and c for c in columns):
        raise ValueError("relocations must be one point column or an x,y pair of columns")
    if srid is not None and (isinstance(srid, bool) or not isinstance(srid, int)):
        raise ValueError("srid must be an integer")


def source_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table; a missing one is a ``ValueError``."""
    if not spark.catalog.tableExists(name):
        raise ValueError(f"table {name} does not exist")
    return spark.table(name)


def check_columns(df: DataFrame, columns: Sequence[str]) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"columns not present in the source: {', '.join(missing)}")


def filtered(df: DataFrame, clauses: str | None) -> DataFrame:
    """Apply a user condition, with or without the leading WHERE. Only conditions are accepted."""
    if is_blank(clauses):
        return df
    return df.filter(re.sub(r"^\s*where\s+", "", clauses, flags=re.IGNORECASE))


def has_values(df: DataFrame, column: str) -> bool:
    """Whether a column holds any non-null value; warns when it does not."""
    found = bool(df.filter(F.col(column).isNotNull()).select(column).limit(1).collect())
    if not found:
        warnings.warn(f"column {column} does not contain values", stacklevel=2)
    return found


def detect_srid(df: DataFrame, point: str) -> int:
    """SRID of the first known point; 0 when the point column carries none."""
    if "srid" not in df.select(f"{point}.*").columns:
        return 0
    row = df.filter(F.col(point).isNotNull()).select(F.col(point)["srid"]).limit(1).collect()
    return int(row[0][0] or 0) if row else 0


def _bound(df: DataFrame, value: str) -> Column:
    """A column of that name, otherwise the text itself."""
    return F.col(value).cast("string") if value in df.columns else F.lit(value)


def bind_relocations(
    source: DataFrame,
    *,
    relocations: str | Sequence[str],
    pgtraj: str = "pgtraj",
    animal: str = "animal",
    burst: str | None = None,
    timestamps: str | None = None,
    rid: str = "rid",
    srid: int | None = None,
    time_zone: str | None = None,
    note: str | None = None,
    clauses: str | None = None,
    allow_unprojected: bool = False,
) -> DataFrame:
    """Turn a source table into bound relocations.

    ``relocations`` is a point column (a struct with fields x, y and optionally srid) or an x,y pair of columns.
    ``pgtraj``, ``animal``, ``burst`` and ``note`` name a column or give a text; a blank burst is the animal.
    Without ``timestamps`` the trajectories are of Type I, ordered by ``rid``. ``clauses`` is a condition on the
    source, applied before anything else.
    """
    check_arguments(pgtraj, animal, relocations, burst, srid)
    columns = [relocations] if isinstance(relocations, str) else list(relocations)
    check_columns(source, [*columns, rid, *([timestamps] if timestamps else [])])
    if pgtraj not in source.columns:
        check_name(pgtraj)
    rows = filtered(source, clauses)

    if len(columns) == 1:
        x, y = F.col(columns[0])["x"], F.col(columns[0])["y"]
        srid = detect_srid(rows, columns[0]) if srid is None else srid
    else:
        x, y = F.col(columns[0]), F.col(columns[1])
        srid = srid or 0
    if srid == 0 and not allow_unprojected:
        raise ValueError("the projection is not defined: give srid, or allow_unprojected=True to go on without")

    spark = source.sparkSession
    if is_blank(time_zone):
        time_zone = spark.conf.get("spark.sql.session.timeZone")
    else:
        times.check_zone(spark, time_zone)

    known = x.isNotNull() & y.isNotNull()
    animal_name = _bound(source, animal)
    return rows.select(
        F.col(rid).cast("long").alias("rid"),
        (times.micros(rows, timestamps) if timestamps else F.lit(None).cast("long")).alias("us"),
        F.when(known, x.cast("double")).alias("x"),
        F.when(known, y.cast("double")).alias("y"),
        F.lit(srid).alias("srid"),
        _bound(source, pgtraj).alias("pgtraj_name"),
        animal_name.alias("animal_name"),
        (animal_name if is_blank(burst) else _bound(source, burst)).alias("burst_name"),
        F.lit(projection_text(srid)).alias("proj4string"),
        F.lit(time_zone).alias("time_zone"),
        (F.lit(None).cast("string") if is_blank(note) else _bound(source, note)).alias("note"),
    )


def name_conflicts(relocations: DataFrame) -> DataFrame:
    """Rows that break the naming rules of the model, one per offending name.

    Rules: names are not null; a burst name belongs to one animal inside a pgtraj; projection, zone and note do
    not vary inside a pgtraj. Both counts run on already distinct, pre-aggregated names.
    """
    bursts = relocations.select("pgtraj_name", "animal_name", "burst_name").distinct()
    unnamed = bursts.filter(
        F.col("pgtraj_name").isNull() | F.col("animal_name").isNull() | F.col("burst_name").isNull()
    ).select(F.lit("name missing").alias("problem"), "pgtraj_name", "burst_name", F.lit(1).cast("long").alias("n"))
    shared = (
        bursts.groupBy("pgtraj_name", "burst_name")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .select(F.lit("burst of several animals").alias("problem"), "pgtraj_name", "burst_name", "n")
    )
    varying = (
        relocations.select("pgtraj_name", "proj4string", "time_zone", "note")
        .distinct()
        .groupBy("pgtraj_name")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .select(
            F.lit("several descriptions").alias("problem"), "pgtraj_name", F.lit(None).cast("string").alias("burst_name"), "n"
        )
    )
    return unnamed.unionByName(shared).unionByName(varying)


def check_names(relocations: DataFrame) -> None:
    """Raise ``ValueError`` when a naming rule is broken."""
    found = name_conflicts(relocations).limit(5).collect()
    if found:
        shown = "; ".join(f"{r['problem']}: {r['pgtraj_name']}/{r['burst_name']}" for r in found)
        raise ValueError(f"names break the model rules: {shown}")


def burst_facts(relocations: DataFrame) -> DataFrame:
    """One row per burst and description: names, relocations, known positions. What the naming rules, the descriptions and the layout of
    the steps need, in one pass over the source."""
    names = ("pgtraj_name", "animal_name", "burst_name", "proj4string", "time_zone", "note")
    return relocations.groupBy(*names).agg(
        F.count(F.lit(1)).alias("num_steps"), F.count("x").alias("num_known"), F.max("srid").alias("srid"), F.lit(0).cast("long").alias("num_named"))


def pgtraj_rows(relocations: DataFrame) -> DataFrame:
    """One row per pgtraj with its projection, zone and note."""
    return relocations.select("pgtraj_name", "proj4string", "time_zone", "note").distinct()


def burst_rows(relocations: DataFrame) -> DataFrame:
    """One row per burst."""
    return relocations.select("pgtraj_name", "animal_name", "burst_name").distinct()
