"""Planar step geometry as column expressions (map units, not geodetic)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: a step shorter than this (map units) is stationary and has no direction.
STATIONARY = 1e-07


def length(dx: Column, dy: Column) -> Column:
    return F.sqrt(dx * dx + dy * dy)


def direction(dx: Column, dy: Column, dist: Column) -> Column:
    """Absolute angle of a moving step, null for a stationary or unknown one."""
    return F.when(dist >= STATIONARY, F.atan2(dy, dx))


def wrap(angle: Column) -> Column:
    """Bring a difference of two directions into (-pi, pi]."""
    return (
        F.when(angle <= -math.pi, angle + 2 * math.pi)
        .when(angle > math.pi, angle - 2 * math.pi)
        .otherwise(angle)
    )


def point(x: Column, y: Column) -> Column:
    """A vertex, or null when either coordinate is missing."""
    return F.when(x.isNotNull() & y.isNotNull(), F.struct(x.alias("x"), y.alias("y")))


def segment(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Two-vertex line, or null when either end is missing."""
    a, b = point(x1, y1), point(x2, y2)
    return F.when(a.isNotNull() & b.isNotNull(), F.array(a, b))


def wkt(line: Column) -> Column:
    """Text form of an ordered array of vertices."""
    vertices = F.transform(line, lambda p: F.concat_ws(" ", p["x"].cast("string"), p["y"].cast("string")))
    return F.concat(F.lit("LINESTRING("), F.array_join(vertices, ","), F.lit(")"))
