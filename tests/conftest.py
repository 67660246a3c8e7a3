import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    work = tempfile.mkdtemp(prefix="trajspark-tests-")
    session = (
        SparkSession.builder.master("local[8]")
        .appName("trajspark-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", f"{work}/warehouse")
        .config("spark.checkpoint.dir", f"{work}/checkpoints")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def small_groups(spark):
    """Force splitting: almost every burst is larger than a segment, lines have three vertices a row."""
    spark.conf.set("spark.trajspark.hotRows", "5")
    spark.conf.set("spark.trajspark.linePoints", "3")
    yield
    spark.conf.unset("spark.trajspark.hotRows")
    spark.conf.unset("spark.trajspark.linePoints")


@pytest.fixture
def make(spark):
    """Bound relocations from (burst, rid, seconds, x, y) tuples."""

    def build(rows, pgtraj="t", animal=None):
        data = [
            (rid, None if at is None else at * 1_000_000, x, y, 3395, pgtraj, animal or burst, burst, None, "UTC", None)
            for burst, rid, at, x, y in rows
        ]
        return spark.createDataFrame(
            data,
            "rid long, us long, x double, y double, srid int, pgtraj_name string, animal_name string, burst_name string, "
            "proj4string string, time_zone string, note string",
        )

    return build
