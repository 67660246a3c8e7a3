"""Small ordered files don't make many tasks."""

from pyspark.sql import functions as F

from trajspark import settings
from trajspark.operators.export import write_ordered


def test_one_task_writes_many_files_in_order(spark):
    long = spark.range(1000).select((F.col("id") % 7).alias("burst_order"), F.col("id").alias("seq"))
    path = settings.new_folder(spark, "ordered")
    files = write_ordered(long, path, 1000, 100).orderBy("number").collect()
    assert [f["n_rows"] for f in files] == [100] * 10
    assert len({f["file"].split("-")[1] for f in files}) == 1
    assert all(tuple(a["last"]) < tuple(b["first"]) for a, b in zip(files, files[1:]))
