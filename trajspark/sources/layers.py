"""Background layers: tables of geometries next to trajectories.

A vector layer has either columns x, y (points) or coords (array of x,y structs) with geom_type, and optionally
srid. A raster layer is named by a column ``rast``; rasters are recognised but not read.
"""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trajspark.functions.reproject import LONGLAT, SUPPORTED, reproject_line, transformed

VECTOR, RASTER, MISSING = "vector", "raster", "missing"


def layer_kind(df: DataFrame) -> str:
    columns = set(df.columns)
    if {"x", "y"} <= columns or "coords" in columns:
        return VECTOR
    return RASTER if "rast" in columns else MISSING


def is_vector(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name) and layer_kind(spark.table(name)) == VECTOR


def is_raster(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name) and layer_kind(spark.table(name)) == RASTER


def classify(spark: SparkSession, names: Sequence[str]) -> dict[str, list[str]]:
    """Layer names by kind, from the catalog alone; a table that is neither only warns."""
    if not isinstance(names, list | tuple) or not names:
        raise ValueError("layers must be a list of at least one table name")
    found: dict[str, list[str]] = {VECTOR: [], RASTER: []}
    for name in names:
        if is_vector(spark, name):
            found[VECTOR].append(name)
        elif is_raster(spark, name):
            found[RASTER].append(name)
        else:
            warnings.warn(f"could not find a layer table {name}", stacklevel=2)
    return found


def geometry_types(df: DataFrame) -> DataFrame:
    """Geometry types of a layer with their counts."""
    kind = F.upper("geom_type") if "geom_type" in df.columns else F.lit("POINT")
    return df.groupBy(kind.alias("geom_type")).agg(F.count(F.lit(1)).alias("n"))


def checked(df: DataFrame, name: str = "layer") -> DataFrame:
    """The layer in longitude/latitude, after checking that it holds one geometry type other than MULTIPOINT."""
    kinds = [r[0] for r in geometry_types(df).limit(10).collect()]
    if len(kinds) > 1:
        raise ValueError(f"{name} contains geometries of type {' and '.join(sorted(kinds))}; use a single type")
    if kinds and "MULTIPOINT" in kinds[0]:
        raise ValueError(f"{name} contains MULTIPOINT geometries; use POINT")
    return to_longlat(df)


def to_longlat(df: DataFrame) -> DataFrame:
    """Coordinates of a layer in longitude/latitude, each row from its own reference system; none means longitude/latitude."""
    if "srid" not in df.columns:
        return df
    found = [r[0] for r in df.filter(F.col("srid").isNotNull()).select("srid").distinct().limit(len(SUPPORTED) + 1).collect()]
    columns = ["coords"] if "coords" in df.columns else ["x", "y"]
    out = {c: F.col(c) for c in columns}
    for srid in found:
        if columns == ["coords"]:
            new = [reproject_line(F.col("coords"), srid, LONGLAT)]
        else:
            new = list(transformed(F.col("x"), F.col("y"), srid, LONGLAT))
        out = {c: F.when(F.col("srid") == srid, n).otherwise(out[c]) for c, n in zip(columns, new, strict=True)}
    return df.withColumns(out).withColumn("srid", F.lit(LONGLAT))


def read_layers(spark: SparkSession, names: Sequence[str]) -> dict[str, DataFrame]:
    """All vector layers by name. Rasters only warn; no layer at all is an error."""
    found = classify(spark, names)
    for name in found[RASTER]:
        warnings.warn(f"raster layer {name} is not read", stacklevel=2)
    if not found[VECTOR] and not found[RASTER]:
        raise ValueError("no layer could be read")
    return {name: checked(spark.table(name), name) for name in found[VECTOR]}
