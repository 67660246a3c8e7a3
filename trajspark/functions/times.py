"""Instants as whole microseconds since 1970 (UTC), free of the session time zone.

Wall-clock columns (``TIMESTAMP_NTZ``) are read as UTC; instants (``TIMESTAMP``) are taken as they are. Results
are ``TIMESTAMP_NTZ`` holding UTC wall time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SECOND = 1_000_000


def micros(df: DataFrame, column: str) -> Column:
    """Microseconds since 1970 of a time column."""
    kind = df.select(F.col(column)).schema[0].dataType
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(F.col(column))
    wall = F.col(column)
    if not isinstance(kind, T.TimestampNTZType):
        wall = wall.cast("timestamp_ntz")
    span = wall - F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'")
    minutes = (F.extract(F.lit("DAY"), span).cast("long") * 24 + F.extract(F.lit("HOUR"), span)) * 60
    minutes = minutes + F.extract(F.lit("MINUTE"), span)
    return minutes * (60 * SECOND) + (F.extract(F.lit("SECOND"), span) * SECOND).cast("long")


def wall_time(us: Column) -> Column:
    """``TIMESTAMP_NTZ`` in UTC from microseconds."""
    return F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'") + us * F.expr("INTERVAL '0.000001' SECOND")


def seconds(us: Column) -> Column:
    return us / F.lit(float(SECOND))


def in_zone(us: Column, zone: Column) -> Column:
    """Wall time shown in a named zone; a null zone leaves UTC."""
    utc = wall_time(us)
    return F.when(zone.isNull(), utc).otherwise(F.convert_timezone(F.lit("UTC"), zone, utc))


def check_zone(spark, zone: str) -> None:
    """Raise ``ValueError`` for a zone name Spark does not know."""
    try:
        spark.sql("SELECT convert_timezone('UTC', :zone, TIMESTAMP_NTZ '2000-01-01 00:00:00')", {"zone": zone}).collect()
    except Exception as err:
        raise ValueError(f"invalid time zone name: {zone}") from err
