"""GPS sensor files: semicolon-separated fixes with one fixed column list, one or many files per sensor."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The column lists of the sensor files and of the three description tables.
_TEXT = ("utc_date", "utc_time", "lmt_date", "lmt_time")
_REAL = ("latitude", "longitude", "height", "dop", "main_vol", "bu_vol", "temp")
_CHANNELS = tuple(f"ch{n:02d}_sat_{what}" for n in range(1, 13) for what in ("id", "cnr"))
FIX_COLUMNS = (
    ("gps_sensors_code", "line_no", *_TEXT, "ecef_x", "ecef_y", "ecef_z", "latitude", "longitude", "height")
    + ("dop", "nav", "validated", "sats_used", *_CHANNELS, "main_vol", "bu_vol", "temp", "easting", "northing", "remarks")
)
ANIMALS = "animals_id INT, animals_code STRING, animal_name STRING, sex STRING, age_class_code INT, species_code INT"
SENSORS = (
    "gps_sensors_id INT, gps_sensors_code STRING, purchase_date STRING, frequency DOUBLE, vendor STRING, model STRING, sim STRING"
)
SENSORS_ANIMALS = "animals_id INT, gps_sensors_id INT, start_time STRING, end_time STRING, notes STRING"


def _kind(name: str) -> str:
    if name in _REAL:
        return "DOUBLE"
    text = (*_TEXT, "gps_sensors_code", "nav", "validated", "remarks")
    return "STRING" if name in text else "INT"


FIX_SCHEMA = ", ".join(f"{name} {_kind(name)}" for name in FIX_COLUMNS)


def four_digit_year(date: Column) -> Column:
    """dd/mm/yy as dd/mm/yyyy (00-68 are 20yy, 69-99 are 19yy); longer dates are left as they are."""
    year = F.substring(date, 7, 2)
    century = F.when(year <= "68", "20").otherwise("19")
    return F.when(F.length(date) == 8, F.concat(F.substring(date, 1, 6), century, year)).otherwise(date)


def _tidy(fixes: DataFrame, sensor: str | Column | None) -> DataFrame:
    fixes = fixes.withColumns({c: four_digit_year(F.col(c)) for c in ("utc_date", "lmt_date")})
    if sensor is None:
        return fixes
    return fixes.withColumn("sensor", F.lit(sensor) if isinstance(sensor, str) else sensor)


def read_fixes(spark: SparkSession, path: str, sensor: str | None = None) -> DataFrame:
    """Fixes of one sensor from its file or folder; the header row is skipped and the schema is given, not guessed."""
    return _tidy(spark.read.csv(path, schema=FIX_SCHEMA, sep=";", header=True, enforceSchema=True), sensor)


def read_sensors(spark: SparkSession, paths: Mapping[str, str] | str, sensor: Column | None = None, check: bool = False) -> DataFrame:
    """Fixes of any number of sensors in one table with a sensor column, by one scan.

    ``paths`` maps a sensor to its file or folder, or is a folder (or pattern) whose files are of a sensor each; then ``sensor`` is read off the file's
    path, by default its name without the suffix. Columns are taken by position, whatever the header calls them. With ``check`` a
    file whose lines don't have all columns is refused by name.
    """
    file = F.url_decode(F.regexp_replace(F.col("_metadata.file_path"), "\\+", "%2B"))
    if isinstance(paths, str):
        places, name = [paths], F.regexp_extract(file, "([^/]*?)(\\.[^./]*)?$", 1) if sensor is None else sensor
    else:
        places = list(paths.values())
        told = F.from_json(F.lit(json.dumps({_absolute(spark, p): k for k, p in paths.items()})), "map<string, string>")
        file = F.regexp_replace(file, "^[A-Za-z0-9+.-]+:(//[^/]*)?", "")
        name = F.coalesce(told[file], told[F.regexp_replace(file, "/[^/]*$", "")])  # the file itself, or the folder it is in
    if check:
        _check_width(spark, places)
    fixes = spark.read.csv(places, schema=FIX_SCHEMA, sep=";", header=True, enforceSchema=True)
    return _tidy(fixes.select("*", name.alias("sensor")), None)


def _absolute(spark: SparkSession, path: str) -> str:
    """A path without scheme and host, as file metadata shows it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place).toUri().getPath()


def _check_width(spark: SparkSession, places: list[str]) -> None:
    """Raise ``ValueError`` naming files with a line that doesn't have as many columns as sensor files have."""
    lines = spark.read.text(places).select("value", F.col("_metadata.file_path").alias("file")).filter("trim(value) <> ''")
    wrong = lines.filter(F.size(F.split("value", ";", -1)) != len(FIX_COLUMNS)).groupBy("file").agg(F.count(F.lit(1)).alias("n"))
    found = sorted((r["file"], r["n"]) for r in wrong.limit(5).collect())
    if found:
        raise ValueError(f"files without {len(FIX_COLUMNS)} columns: " + ", ".join(f"{f} ({n} lines)" for f, n in found))


def parse_fixes(lines: DataFrame, line: str = "line", sensor: Column | None = None) -> DataFrame:
    """Fixes from a column of already read text lines."""
    parsed = lines.withColumn("_fix", F.from_csv(F.col(line), FIX_SCHEMA, {"sep": ";"}))
    kept = [c for c in lines.columns if c != line]
    return _tidy(parsed.select(*kept, "_fix.*"), sensor)


def read_description(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One of the headerless description tables (ANIMALS, SENSORS, SENSORS_ANIMALS)."""
    return spark.read.csv(path, schema=schema, sep=";", header=False)


def fix_time(date: Column, time: Column) -> Column:
    """UTC wall time of a fix from its dd/mm/yyyy date and hh:mm:ss time; null when it cannot be read."""
    return F.try_to_timestamp(F.concat_ws(" ", date, time), F.lit("dd/MM/yyyy HH:mm:ss")).cast("timestamp_ntz")
