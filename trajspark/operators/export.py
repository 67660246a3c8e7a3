"""Export: long form (one row per relocation) and nested form (bounded arrays of rows per burst)."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trajspark import settings
from trajspark.functions import times
from trajspark.operators.ids import burst_sizes
from trajspark.operators.infolocs import info_columns
from trajspark.operators.steps import TYPE_I, TYPE_II
from trajspark.plans.segments import Laid

#: rows of small files that one task writes
ROWS_A_TASK = 100_000


def trajectory_kind(df: DataFrame) -> tuple[int, bool]:
    """Type (I when no row has a time) and whether every row has a row name; one counting pass."""
    named = F.count("r_rowname") if "r_rowname" in df.columns else F.lit(0)
    row = df.agg(F.count(F.lit(1)).alias("n"), F.count("us").alias("dated"), named.alias("named")).first()
    return (TYPE_I if row["dated"] == 0 else TYPE_II), bool(row["n"]) and row["named"] == row["n"]


def export_long(
    parameters: Laid,
    zone: str | None = None,
    infolocs: DataFrame | None = None,
    kind: int | None = None,
    named: bool | None = None,
    sizes: DataFrame | None = None,
) -> DataFrame:
    """Trajectory columns under their exported names, with burst_order and seq to sort by.

    Type II dates are shown in ``zone``. For Type I, ``date`` is the integer row name when every row has one and
    otherwise the row number in the whole pgtraj, and ``dt`` is 1 except for the last relocation of a burst. ``sizes`` are stored burst sizes.
    """
    if kind is None or named is None:
        found_kind, found_named = trajectory_kind(parameters.rows())
        kind, named = kind or found_kind, found_named if named is None else named
    laid = parameters
    date, dt = times.in_zone(F.col("us"), F.lit(zone).cast("string")), F.col("dt")
    if kind == TYPE_I:
        laid = laid.join_groups(burst_sizes(laid.on(laid.df.drop("burst_id")), inside=("pgtraj_name",), sizes=sizes).drop("burst_id"))
        number = F.col("_earlier") + F.col("seq")
        date = (F.col("r_rowname").cast("long") if named else number).alias("date")
        dt = F.when(F.col("seq") < F.col("burst_steps"), 1.0)
    df = laid.rows()
    columns = [
        "x", "y", date.alias("date"), "dx", "dy", "dist", dt.alias("dt"),
        F.col("r2n").alias("R2n"), F.col("abs_angle").alias("abs.angle"), F.col("rel_angle").alias("rel.angle"),
        F.col("animal_name").alias("id"), F.col("burst_name").alias("burst"),
    ]
    if named:
        columns.append(F.col("r_rowname").alias("r.row.names"))
    if infolocs is not None and info_columns(infolocs):
        df = df.join(infolocs, "step_id", "left")
        columns += info_columns(infolocs)
    order = [F.col("burst_id").alias("burst_order")] if "burst_id" in df.columns else []
    return df.select("pgtraj_name", *order, "seq", *columns)


def write_ordered(long: DataFrame, path: str, rows: int, rows_a_file: int) -> DataFrame:
    """Write an export as files of ranges of (burst_order, seq), each sorted, of about ``rows_a_file`` rows. A task writes as many files as its
    range has, so small files don't make many tasks.

    Their manifest is written beside them (``_manifest``, which readers of the folder pass over) and returned: number, file, n_rows and the first
    and last place of each. The files one after another are the export in order; nothing is sorted as a whole.
    """
    place = F.struct("burst_order", "seq")
    ranged = long.repartitionByRange(max(1, -(-rows // max(rows_a_file, ROWS_A_TASK))), "burst_order", "seq").sortWithinPartitions("burst_order", "seq")
    ranged.write.option("maxRecordsPerFile", rows_a_file).parquet(path)
    spark = long.sparkSession
    written = spark.read.schema(long.schema).parquet(path).select("burst_order", "seq", F.col("_metadata.file_name").alias("file"))
    files = written.groupBy("file").agg(F.count(F.lit(1)).alias("n_rows"), F.min(place).alias("first"), F.max(place).alias("last"))
    number = F.row_number().over(Window.orderBy("first")) - 1  # one row a file
    files.select(number.alias("number"), "file", "n_rows", "first", "last").coalesce(1).write.parquet(f"{path}/_manifest")
    return spark.read.parquet(f"{path}/_manifest")


def read_ordered(spark: SparkSession, path: str) -> Iterator[DataFrame]:
    """The files of ``write_ordered`` in order, one DataFrame a file with its rows in order."""
    for row in spark.read.parquet(f"{path}/_manifest").orderBy("number").toLocalIterator():
        yield spark.read.parquet(f"{path}/{row['file']}").coalesce(1)


def nest(long: DataFrame, columns, max_rows: int | None = None) -> DataFrame:
    """Long to nested form: per burst, arrays of at most ``max_rows`` rows in order (part 0, 1, ...), with the marks
    ``type_ii`` and, where there is ``dt``, ``regular`` (all steps of every burst of the pgtraj last equally long).

    ``long`` has pgtraj_name, id, burst and seq. Keys of the arrays are evenly sized, so a burst of any length
    stays in bounded rows; a burst under the bound is one row.
    """
    max_rows = max_rows or settings.line_points(long.sparkSession)
    part = F.floor((F.col("seq") - 1) / max_rows).cast("long").alias("part")
    typed = F.col("date").isNotNull() if "date" in long.columns else F.lit(False)
    numbered = dict(long.dtypes).get("date") in ("int", "bigint")
    rows = F.array_sort(F.collect_list(F.struct("seq", *[F.col(f"`{c}`") for c in columns])))
    order = [F.min("burst_order").alias("burst_order")] if "burst_order" in long.columns else []
    nested = long.groupBy("pgtraj_name", "id", "burst", part).agg(
        *order,
        rows.alias("rows"),
        F.count(F.lit(1)).alias("n_rows"),
        (F.lit(False) if numbered else F.bool_or(typed)).alias("type_ii"),
    )
    if "dt" not in long.columns:
        return nested
    bursts = long.groupBy("pgtraj_name", "burst").agg((F.max("dt") - F.min("dt")).alias("_spread"))
    regular = bursts.groupBy("pgtraj_name").agg(F.bool_and(F.coalesce(F.col("_spread") < 1e-7, F.lit(True))).alias("regular"))
    return nested.join(regular, "pgtraj_name")


def unnest(nested: DataFrame) -> DataFrame:
    """Nested to long form."""
    names = nested.schema["rows"].dataType.elementType.names
    rows = nested.select("pgtraj_name", "id", "burst", F.explode("rows").alias("_row"))
    return rows.select("pgtraj_name", "id", "burst", *[F.col("_row")[n].alias(n) for n in names])
