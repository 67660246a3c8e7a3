"""Infolocs: extra columns per relocation, kept per step.

A stored table holds the infolocs of every trajectory, whatever their columns are: each row has its step, the values as text by column name (``info``)
and the number of the type registry of its burst. ``packed`` writes that form and ``unpacked`` reads it back, by one expression a column
that dispatches on the registry entry of the row, however many registries there are.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trajspark import settings
from trajspark.functions import times

# The reserved column and the class names of the type registry.
RESERVED = "step_id"
FACTORS = ("factor", "ordered")
ZONED, WRITTEN = "POSIXct", "POSIXlt"

REGISTRY = T.ArrayType(
    T.StructType(
        [
            T.StructField("name", T.StringType()),
            T.StructField("type", T.StringType()),
            T.StructField("zone", T.StringType()),
            T.StructField("levels", T.ArrayType(T.StringType())),
        ]
    )
)


@dataclass(frozen=True)
class InfoType:
    """Class of an info column: its zone for times, its levels for factors."""

    type: str
    zone: str | None = None
    levels: tuple[str, ...] | None = None


def safe_name(name: str) -> str:
    """The reserved name is stored under another one."""
    return f"{RESERVED}_1" if name == RESERVED else name


def info_columns(infolocs: DataFrame) -> list[str]:
    return [c for c in infolocs.columns if c != RESERVED]


def attach_from_table(
    steps: DataFrame, info: DataFrame, info_rid: str, columns: Sequence[str], keep: Sequence[str] = ()
) -> DataFrame:
    """Infolocs of steps from a table, met by the id of the step's first relocation.

    Columns the table does not have are ignored. Steps without a row in the table get none. ``keep`` names step
    columns to carry along.
    """
    present = [c for c in columns if c in info.columns]
    rows = info.select(F.col(info_rid).cast("long").alias("rid"), *[F.col(c).alias(safe_name(c)) for c in present])
    return steps.select("step_id", "rid", *keep).join(rows, "rid").drop("rid")


def union_bursts(frames: Sequence[DataFrame]) -> DataFrame:
    """Infolocs of several bursts as one table; columns a burst lacks are null."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def attach_from_trajectory(steps: DataFrame, info: DataFrame) -> DataFrame:
    """Infolocs of an imported trajectory, met by row name and burst."""
    columns = [c for c in info.columns if c not in ("r_rowname", "burst_name")]
    rows = info.select("r_rowname", "burst_name", *[F.col(c).alias(safe_name(c)) for c in columns])
    return steps.select("step_id", "r_rowname", "burst_name").join(rows, ["r_rowname", "burst_name"]).drop("r_rowname", "burst_name")


def _class_of(kind: T.DataType) -> str:
    if isinstance(kind, T.TimestampType | T.TimestampNTZType):
        return ZONED
    if isinstance(kind, T.BooleanType):
        return "logical"
    if isinstance(kind, T.IntegralType):
        return "integer"
    return "numeric" if isinstance(kind, T.NumericType) else "character"


def default_types(info: DataFrame, zone: str = "UTC") -> dict[str, InfoType]:
    """Classes read off the Spark schema."""
    found = {f.name: _class_of(f.dataType) for f in info.schema}
    return {name: InfoType(kind, zone=zone if kind == ZONED else None) for name, kind in found.items()}


def registry(types: Mapping[str, InfoType]) -> Column:
    """The type registry of a burst as one array column."""
    entries = [
        F.struct(
            F.lit(safe_name(name)).alias("name"),
            F.lit(t.type).alias("type"),
            F.lit(t.zone).cast("string").alias("zone"),
            (F.array(*[F.lit(v) for v in t.levels]) if t.levels else F.lit(None)).cast("array<string>").alias("levels"),
        )
        for name, t in types.items()
    ]
    return F.array(*entries).cast(REGISTRY)


def default_registry(columns: Sequence[tuple[str, str]], zone: Column) -> Column:
    """The registry that the Spark types of columns (name, type) give, times in ``zone``."""
    kinds = T.StructType([T.StructField(n, T.StructType.fromDDL(f"a {k}")[0].dataType) for n, k in columns])
    entries = []
    for field in kinds:
        found = _class_of(field.dataType)
        entries.append(
            F.struct(
                F.lit(field.name).alias("name"), F.lit(found).alias("type"),
                (zone if found == ZONED else F.lit(None).cast("string")).alias("zone"), F.lit(None).cast("array<string>").alias("levels"),
            )
        )
    return F.array(*entries).cast(REGISTRY)


#: Spark type that a class is read back as
READ_AS = {
    **dict.fromkeys(FACTORS, "string"), ZONED: "timestamp_ntz", WRITTEN: "timestamp_ntz", "integer": "bigint", "numeric": "double",
    "logical": "boolean", "character": "string",
}


def _read(value: Column, kind: str, zone: Column, levels: Column) -> Column:
    """A value by its class; ``zone`` and ``levels`` may differ from row to row."""
    text = value.cast("string")
    if kind in FACTORS:
        return F.when(F.array_contains(levels, text), text)
    if kind == ZONED:
        return F.convert_timezone(F.lit("UTC"), F.coalesce(zone, F.lit("UTC")), value.try_cast("timestamp_ntz"))
    if kind == WRITTEN:
        return text.try_cast("timestamp_ntz")
    return value.try_cast(READ_AS[kind])


def _rank(value: Column, levels: Column) -> Column:
    """1-based place among the levels of an ordered factor, null outside them."""
    place = F.array_position(levels, value.cast("string"))
    return F.when(place > 0, place)


def typed(infolocs: DataFrame, types: Mapping[str, InfoType]) -> DataFrame:
    """Read infolocs back with their classes.

    Factors: values outside the levels become null; an ordered factor also gets ``<name>_level``, its 1-based rank.
    POSIXct: wall time in its zone. POSIXlt: parsed from text. Others are cast; unregistered columns pass through.
    """
    out = {}
    for name in info_columns(infolocs):
        t = types.get(name)
        if t is None or t.type not in READ_AS:
            continue
        levels = (F.array(*[F.lit(v) for v in t.levels]) if t.levels else F.array()).cast("array<string>")
        out[name] = _read(F.col(f"`{name}`"), t.type, F.lit(t.zone).cast("string"), levels)
        if t.type == "ordered":
            out[f"{name}_level"] = _rank(F.col(f"`{name}`"), levels)
    return infolocs.withColumns(out)


# -- the stored form ---------------------------------------------------------------------------------------------


def stored_columns(infolocs: DataFrame, names: Sequence[str]) -> list[tuple[str, str]]:
    """(stored name, Spark type) of info columns."""
    return [(safe_name(n), infolocs.schema[n].dataType.simpleString()) for n in names]


def packed(infolocs: DataFrame, names: Sequence[str]) -> Column:
    """Info columns as one map of texts. Times become microseconds in UTC, binary values base64, nested values JSON."""
    if not names:
        return F.create_map().cast("map<string, string>")
    cells = []
    for name in names:
        kind, value = infolocs.schema[name].dataType, F.col(f"`{name}`")
        if isinstance(kind, T.TimestampType | T.TimestampNTZType):
            value = times.micros(infolocs, f"`{name}`")
        elif isinstance(kind, T.BinaryType):
            value = F.base64(value)
        elif isinstance(kind, T.ArrayType | T.MapType | T.StructType):
            value = F.to_json(F.struct(value.alias("v")))
        cells += [F.lit(safe_name(name)), value.cast("string")]
    return F.create_map(*cells)


def _value(name: str, kind: str) -> Column:
    """A column of Spark type ``kind`` out of the packed map."""
    text = F.col("info")[name]
    if kind == "timestamp_ntz":
        return times.wall_time(text.cast("long"))
    if kind == "timestamp":
        return F.timestamp_micros(text.cast("long"))
    if kind == "binary":
        return F.unbase64(text)
    if kind.startswith(("array", "map", "struct")):
        return F.from_json(text, f"v {kind}")["v"]
    return text.cast(kind)


def value_sql(name: str, kind: str) -> str:
    """The same as SQL text, for a view."""
    text = "info['" + name.replace("\\", "\\\\").replace("'", "\\'") + "']"
    if kind == "timestamp_ntz":
        return f"TIMESTAMP_NTZ '1970-01-01 00:00:00' + CAST({text} AS BIGINT) * INTERVAL '0.000001' SECOND"
    if kind == "timestamp":
        return f"timestamp_micros(CAST({text} AS BIGINT))"
    if kind == "binary":
        return f"unbase64({text})"
    if kind.startswith(("array", "map", "struct")):
        return f"from_json({text}, 'v {kind}').v"
    return f"CAST({text} AS {kind})"


def _instant(name: str, kind: str) -> Column:
    """The value that classes are read from: instants as UTC wall time."""
    return times.wall_time(F.col("info")[name].cast("long")) if kind == "timestamp" else _value(name, kind)


def unpacked(
    rows: DataFrame,
    columns: Sequence[tuple[str, str]],
    types: Mapping[str, InfoType] | None = None,
    registries: DataFrame | None = None,
    classes: Mapping[str, set] | None = None,
    keep: Sequence[str] = (RESERVED,),
) -> DataFrame:
    """Packed rows as columns again, after the ``keep`` ones.

    ``types`` are the classes when all rows share one registry. Otherwise ``registries`` has (registry, info_cols), rows carry ``registry`` and
    ``classes`` names the classes that each column has in any of them (None where one lacks it); a column whose classes differ in type is text.
    """
    kept = [c for c in rows.columns if c in keep]
    if registries is None:
        own = {n: t for n, t in (types or {}).items() if n in {c for c, _ in columns}}
        return typed(rows.select(*kept, *[(_instant if n in own else _value)(n, k).alias(n) for n, k in columns]), own)
    rows = settings.join_small(rows, registries.select("registry", "info_cols"), "registry")
    out, more = [], []
    for name, kind in columns:
        entry, known = _entry(name), (classes or {}).get(name, {None})
        found, value = sorted(c for c in known if c in READ_AS), _instant(name, kind)
        target = {READ_AS[c] for c in found} | ({kind} if known - set(READ_AS) else set())
        shared = target.pop() if len(target) == 1 else "string"
        read = _value(name, kind).cast(shared)
        for c in found:
            read = F.when(entry["type"] == c, _read(value, c, entry["zone"], entry["levels"]).cast(shared)).otherwise(read)
        out.append(read.alias(name))
        if "ordered" in found:
            more.append(F.when(entry["type"] == "ordered", _rank(value, entry["levels"])).alias(f"{name}_level"))
    return rows.select(*kept, *out, *more)


def _entry(name: str) -> Column:
    """Registry entry of a column, null when there is none."""
    return F.get(F.filter("info_cols", lambda e: e["name"] == name), F.lit(0))


def typed_by_burst(infolocs: DataFrame, steps: DataFrame, bursts: DataFrame) -> DataFrame:
    """Read factors back by the registry of each row's own burst.

    ``bursts`` has burst_id and info_cols (the registry array, null for a burst without one); ``steps`` relates
    step_id to burst_id. Bursts without a registry, and columns without an entry, pass through.
    """
    df = infolocs.join(steps.select("step_id", "burst_id"), "step_id")
    df = settings.join_small(df, bursts.select("burst_id", "info_cols"), "burst_id", count_on=steps)
    out = {}
    for name in info_columns(infolocs):
        entry = _entry(name)
        value = F.col(name)
        inside = F.array_contains(entry["levels"], value.cast("string"))
        is_factor = F.coalesce(entry["type"].isin(*FACTORS), F.lit(False))
        out[name] = F.when(is_factor, F.when(inside, value)).otherwise(value)
    return df.withColumns(out).drop("burst_id", "info_cols")


def types_from_registry(entries) -> dict[str, InfoType]:
    """Registry rows (of one burst) back to classes."""
    return {e["name"]: InfoType(e["type"], e["zone"], tuple(e["levels"]) if e["levels"] else None) for e in entries or ()}
