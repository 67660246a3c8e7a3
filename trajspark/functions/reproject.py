"""Reprojection between the named reference systems, as column expressions.

Supported SRIDs: 4326 (longitude/latitude), 3395 (ellipsoidal Mercator) and the northern UTM zones on GRS80,
26901-26923 (26917 is zone 17). Formulas are the published ones: isometric latitude with a fixed number of
fixed-point rounds for Mercator, and the Krueger series to the fourth order of the third flattening for UTM.
Every value enters an expression once per round, so plans stay small.
"""

from __future__ import annotations

import math
import re
import zlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Ellipsoids (semi-major axis in metres, inverse flattening) and projection texts.
WGS84 = (6378137.0, 298.257223563)
GRS80 = (6378137.0, 298.257222101)
LONGLAT, MERCATOR = 4326, 3395
UTM_NAD83 = range(26901, 26924)
UTM_SCALE, UTM_EASTING = 0.9996, 500000.0
SUPPORTED = (LONGLAT, MERCATOR, *UTM_NAD83)
# SRIDs that stand for a projection text without a number of its own
OWN_SRIDS = range(910_000, 999_000)

ROUNDS = 6


def supported(srid: int) -> bool:
    return srid in SUPPORTED


def projection_text(srid: int) -> str | None:
    """Projection text of a SRID: the full one when its formulas are known, else its name; ``None`` for 0 (unprojected)."""
    if srid == LONGLAT:
        return "+proj=longlat +datum=WGS84 +no_defs"
    if srid == MERCATOR:
        return "+proj=merc +lon_0=0 +k=1 +x_0=0 +y_0=0 +datum=WGS84 +units=m +no_defs"
    if srid in UTM_NAD83:
        return f"+proj=utm +zone={srid - 26900} +datum=NAD83 +units=m +no_defs"
    return f"+init=epsg:{srid}" if srid else None


def srid_of(text: str | None) -> int:
    """SRID of a projection text: of a known text or the number it names, else one of its own, 0 when it is missing.

    Only reprojection needs a system whose formulas are known; any other is stored and given back as it is.
    """
    if text is None or not text.strip():
        return 0
    named = re.search(r"\+init=epsg:(\d+)", text, re.IGNORECASE)
    if named:
        return int(named[1])
    plain = " ".join(text.split())
    for srid in SUPPORTED:
        if projection_text(srid) == plain:
            return srid
    return OWN_SRIDS[zlib.crc32(plain.encode()) % len(OWN_SRIDS)]


def _first_eccentricity(ellipsoid: tuple[float, float]) -> float:
    f = 1.0 / ellipsoid[1]
    return math.sqrt(f * (2.0 - f))


def _mercator_to_longlat(x: Column, y: Column) -> tuple[Column, Column]:
    a, e = WGS84[0], _first_eccentricity(WGS84)
    isometric = y / a
    sine = F.tanh(isometric)
    for _ in range(ROUNDS):
        sine = F.tanh(isometric + e * F.atanh(e * sine))
    return F.degrees(x / a), F.degrees(F.asin(sine))


def _longlat_to_mercator(lon: Column, lat: Column) -> tuple[Column, Column]:
    a, e = WGS84[0], _first_eccentricity(WGS84)
    sine = F.sin(F.radians(lat))
    return F.radians(lon) * a, (F.atanh(sine) - e * F.atanh(e * sine)) * a


def _krueger(ellipsoid: tuple[float, float]) -> tuple[float, list[float], list[float]]:
    """Rectifying radius, forward and inverse series coefficients in the third flattening ``n``."""
    f = 1.0 / ellipsoid[1]
    n = f / (2.0 - f)
    radius = ellipsoid[0] / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    forward = [
        n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16 + 41 * n**4 / 180,
        13 * n**2 / 48 - 3 * n**3 / 5 + 557 * n**4 / 1440,
        61 * n**3 / 240 - 103 * n**4 / 140,
        49561 * n**4 / 161280,
    ]
    inverse = [
        n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96 - n**4 / 360,
        n**2 / 48 + n**3 / 15 - 437 * n**4 / 1440,
        17 * n**3 / 480 - 37 * n**4 / 840,
        4397 * n**4 / 161280,
    ]
    return radius, forward, inverse


def _series(coefficients: list[float], sign: int, xi: Column, eta: Column) -> tuple[Column, Column]:
    north, east = xi, eta
    for j, c in enumerate(coefficients, start=1):
        north = north + sign * c * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
        east = east + sign * c * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
    return north, east


def _utm_to_longlat(x: Column, y: Column, zone: int) -> tuple[Column, Column]:
    radius, _, inverse = _krueger(GRS80)
    e = _first_eccentricity(GRS80)
    scale = UTM_SCALE * radius
    xi, eta = _series(inverse, -1, y / scale, (x - UTM_EASTING) / scale)
    conformal = F.atanh(F.sin(xi) / F.cosh(eta))
    sine = F.tanh(conformal)
    for _ in range(ROUNDS):
        sine = F.tanh(conformal + e * F.atanh(e * sine))
    return F.degrees(F.atan2(F.sinh(eta), F.cos(xi))) + (zone * 6 - 183), F.degrees(F.asin(sine))


def _longlat_to_utm(lon: Column, lat: Column, zone: int) -> tuple[Column, Column]:
    radius, forward, _ = _krueger(GRS80)
    e = _first_eccentricity(GRS80)
    sine = F.sin(F.radians(lat))
    t = F.sinh(F.atanh(sine) - e * F.atanh(e * sine))
    away = F.radians(lon - (zone * 6 - 183))
    xi, eta = _series(forward, 1, F.atan2(t, F.cos(away)), F.atanh(F.sin(away) / F.sqrt(1 + t * t)))
    return eta * (UTM_SCALE * radius) + UTM_EASTING, xi * (UTM_SCALE * radius)


def transformed(x: Column, y: Column, from_srid: int, to_srid: int = LONGLAT) -> tuple[Column, Column]:
    """Coordinates in ``to_srid``. Unknown or undefined reference systems raise ``ValueError``."""
    for srid in (from_srid, to_srid):
        if not supported(srid):
            raise ValueError(f"cannot reproject SRID {srid}")
    if from_srid == to_srid:
        return x, y
    if from_srid == MERCATOR:
        x, y = _mercator_to_longlat(x, y)
    elif from_srid in UTM_NAD83:
        x, y = _utm_to_longlat(x, y, from_srid - 26900)
    if to_srid == MERCATOR:
        x, y = _longlat_to_mercator(x, y)
    elif to_srid in UTM_NAD83:
        x, y = _longlat_to_utm(x, y, to_srid - 26900)
    return x, y


def reproject(df: DataFrame, from_srid: int, to_srid: int = LONGLAT, x: str = "x", y: str = "y") -> DataFrame:
    """Replace the coordinate columns by their values in ``to_srid``."""
    new_x, new_y = transformed(F.col(x), F.col(y), from_srid, to_srid)
    return df.withColumns({x: new_x, y: new_y})


def reproject_line(line: Column, from_srid: int, to_srid: int = LONGLAT) -> Column:
    """An array of vertices in ``to_srid``."""

    def vertex(p: Column) -> Column:
        new_x, new_y = transformed(p["x"], p["y"], from_srid, to_srid)
        return F.struct(new_x.alias("x"), new_y.alias("y"))

    return F.transform(line, vertex)
