"""Helpers shared by the operators of this package."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trajspark.settings import write_through


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else; null stays null."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def constant_array(values: list[int], kind: str) -> Column:
    """A constant array that the optimizer folds once; one literal however many values there are."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{kind}>")


def unused(name: str, *frames: DataFrame) -> str:
    """A column name like ``name`` that none of the frames has."""
    taken = {c.lower() for df in frames for c in df.columns}
    while name in taken:
        name = f"_{name}"
    return name


def text_digest(text: Column) -> Column:
    """SHA-256 of a text's bytes; null counts as empty."""
    return F.sha2(F.coalesce(text.cast("string"), F.lit("")), 256)


def kept_rows(docs: DataFrame, id_col: str, digest: Column, kept: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose id and digest are among ``kept`` (id, digest, copies), one of those that share both, with all their columns.

    Rows are told apart by id and digest, so null and repeated ids are judged like others. Only the rows that have copies are grouped.
    """
    own, id_, copies = unused("digest", docs), unused("kept_id", docs), unused("copies", docs)
    other = unused("kept_digest", docs)
    names = kept.select(F.col("id").alias(id_), F.col("digest").alias(other), F.col("copies").alias(copies))
    rows = docs.withColumn(own, digest)
    same = rows[id_col].eqNullSafe(F.col(id_)) & (F.col(own) == F.col(other))
    once = rows.join(names.filter(F.col(copies) == 1), same, "left_semi")
    several = rows.join(names.filter(F.col(copies) > 1), same, "left_semi").dropDuplicates([id_col, own])
    return once.unionByName(several).drop(own)


def discard(df: DataFrame) -> None:
    """Delete the files of a table that ``saved`` wrote, once what was made of it is written too."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def saved(df: DataFrame, label: str) -> DataFrame:
    """Written to the shared folder and read back, so that a lost executor never repeats the work before it.

    The shuffle files behind it are of no more use then and are freed at once; the session's own choice is put back.
    """
    conf, key = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(key, None)
    conf.set(key, "true")
    try:
        return write_through(df, f"llm-{label}")
    finally:
        conf.set(key, before) if before is not None else conf.unset(key)
