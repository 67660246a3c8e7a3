"""The step view read by windows and lines: parameters, reprojected step line and infolocs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trajspark.functions import times
from trajspark.functions.reproject import LONGLAT, transformed
from trajspark.operators.infolocs import info_columns

VIEW_COLUMNS = (
    "step_id", "step_geom", "date", "us", "dx", "dy", "dist", "dt", "dt_us", "abs_angle", "rel_angle",
)


def step_view(parameters: DataFrame, srid: int, infolocs: DataFrame | None = None) -> DataFrame:
    """Steps with a line, in longitude/latitude. With infolocs, only steps that have an infolocs row.

    Unprojected data (SRID 0) is refused.
    """
    if not srid:
        raise ValueError("cannot show unprojected relocations (SRID 0)")
    ends = [transformed(F.col(x), F.col(y), srid, LONGLAT) for x, y in (("x", "y"), ("x2", "y2"))]
    line = F.array(*[F.struct(x.alias("x"), y.alias("y")) for x, y in ends])
    df = parameters.filter("x IS NOT NULL AND y IS NOT NULL AND x2 IS NOT NULL AND y2 IS NOT NULL")
    df = df.withColumns({"step_geom": line, "date": times.wall_time(F.col("us"))})
    columns = list(VIEW_COLUMNS)
    if infolocs is not None and info_columns(infolocs):
        df = df.join(infolocs, "step_id")
        columns += info_columns(infolocs)
    return df.select(*columns, "animal_name", "burst_name", "pgtraj_name")
