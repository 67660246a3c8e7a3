import math
import warnings
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from trajspark.functions import planar, times
from trajspark.functions.reproject import projection_text, reproject, srid_of
from trajspark.sources import gps, layers, tables


@pytest.fixture
def source(spark):
    rows = [(1, "g", "wolf", "w1", datetime(2024, 7, 1, 12), 1.0, 2.0), (2, "g", "wolf", "w1", datetime(2024, 7, 1, 13), None, 2.0)]
    return spark.createDataFrame(rows, "rid long, grp string, who string, run string, at timestamp_ntz, x double, y double")


def bind(source, **more):
    options = dict(relocations=["x", "y"], pgtraj="grp", animal="who", timestamps="at", srid=3395)
    return tables.bind_relocations(source, **{**options, **more})


def test_names_are_columns_or_text(source):
    row = bind(source, pgtraj="study 1", animal="who", note="by hand").first()
    assert (row["pgtraj_name"], row["animal_name"], row["burst_name"], row["note"]) == ("study 1", "wolf", "wolf", "by hand")
    row = bind(source, animal="lynx").first()
    assert (row["animal_name"], row["burst_name"]) == ("lynx", "lynx")
    assert bind(source, burst="run", note="run").first()["note"] == "w1"
    assert bind(source, burst="all").first()["burst_name"] == "all"


def test_a_missing_coordinate_makes_a_missing_fix(source):
    assert bind(source).filter("rid = 2 AND x IS NULL AND y IS NULL").count() == 1


def test_binding_errors(source):
    for bad in (
        dict(pgtraj="_x"), dict(relocations=["x", "y", "z"]), dict(relocations=["nope"]), dict(srid="3395"), dict(pgtraj=""),
        dict(timestamps="nope"), dict(rid="nope"), dict(srid=0), dict(time_zone="Nowhere/City"), dict(burst=3),
    ):
        with pytest.raises(ValueError):
            bind(source, **bad)
    assert bind(source, srid=None, allow_unprojected=True).first()["proj4string"] is None


def test_point_columns_bring_their_srid(source):
    points = source.withColumn("geom", F.struct("x", "y", F.lit(4326).alias("srid")))
    assert bind(points, relocations="geom", srid=None).first()["srid"] == 4326
    bare = source.withColumn("geom", F.struct("x", "y"))
    assert tables.detect_srid(bare, "geom") == 0


def test_clauses_with_and_without_where(source):
    assert bind(source, clauses="WHERE extract(HOUR FROM at) = 13").count() == 1
    assert bind(source, clauses="rid = 1").count() == 1


def test_conditions_and_columns_reach_the_scan(spark, source, tmp_path):
    source.write.parquet(str(tmp_path / "s"))
    bound = bind(spark.read.parquet(str(tmp_path / "s")), clauses="WHERE rid > 1").select("rid", "x")
    plan = bound._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(rid,1)" in plan and "who" not in plan


def test_source_checks(spark, source):
    with pytest.raises(ValueError):
        tables.source_table(spark, "no_such_table")
    with pytest.warns(UserWarning):
        assert not tables.has_values(source.filter("rid = 2"), "x")
    assert tables.has_values(source, "x")


@pytest.mark.parametrize("value", [None, "", [], float("nan"), ["", None]])
def test_blank(value):
    assert tables.is_blank(value)


@pytest.mark.parametrize("value", ["a", 0, ["", "a"], False])
def test_not_blank(value):
    assert not tables.is_blank(value)


def test_name_rules(source):
    tables.check_names(bind(source))
    both = bind(source).unionByName(bind(source.withColumn("who", F.lit("fox")), burst="run"))
    both = both.unionByName(bind(source, burst="run"))
    with pytest.raises(ValueError, match="several animals"):
        tables.check_names(both)
    with pytest.raises(ValueError, match="several descriptions"):
        tables.check_names(bind(source, note="run").unionByName(bind(source, note="other")))
    with pytest.raises(ValueError, match="missing"):
        tables.check_names(bind(source.withColumn("run", F.lit(None).cast("string")), burst="run"))


def test_times_do_not_depend_on_the_session_zone(spark, source):
    def us(zone):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            df = spark.createDataFrame([(datetime(1969, 12, 31, 23, 59, 59, 250000),), (datetime(2024, 3, 31, 2, 30),)], "at timestamp_ntz")
            df = df.withColumn("us", times.micros(df, "at"))
            df = df.withColumn("back", times.wall_time(F.col("us")))
            assert df.filter("back <> at").isEmpty()
            return [r["us"] for r in df.collect()]
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")

    assert us("UTC") == us("Europe/Paris") == us("America/New_York") == [-750000, 1711852200000000]


def test_wkt(spark):
    line = planar.segment(F.lit(0.0), F.lit(1.0), F.lit(2.5), F.lit(3.0))
    assert spark.range(1).select(planar.wkt(line)).first()[0] == "LINESTRING(0.0 1.0,2.5 3.0)"


# -- reference systems ------------------------------------------------------------------------------------


def at(spark, x, y, a, b):
    row = reproject(spark.createDataFrame([(x, y)], "x double, y double"), a, b).first()
    return row["x"], row["y"]


def test_mercator_known_point(spark):
    # World Mercator of longitude 10, latitude 50, by the closed formula
    e = math.sqrt((1 / 298.257223563) * (2 - 1 / 298.257223563))
    s = math.sin(math.radians(50))
    y = 6378137 * (math.atanh(s) - e * math.atanh(e * s))
    assert at(spark, 10.0, 50.0, 4326, 3395) == pytest.approx((6378137 * math.radians(10), y), abs=1e-6)


def test_utm_known_point(spark):
    # on the central meridian of zone 17 the easting is 500000 and the northing the scaled meridian arc
    x, y = at(spark, -81.0, 45.0, 4326, 26917)
    assert x == pytest.approx(500000.0, abs=1e-6)
    assert y == pytest.approx(0.9996 * 4984944.378, abs=0.01)


@pytest.mark.parametrize("srid", [3395, 26917, 26911])
def test_there_and_back(spark, srid):
    lon, lat = (-82.5, 29.65) if srid != 26911 else (-118.2, 34.0)
    assert at(spark, *at(spark, lon, lat, 4326, srid), srid, 4326) == pytest.approx((lon, lat), abs=1e-10)


def test_unknown_systems_raise(spark):
    with pytest.raises(ValueError):
        at(spark, 1.0, 1.0, 27700, 4326)
    with pytest.raises(ValueError):
        reproject(spark.createDataFrame([(1.0, 2.0)], "x double, y double"), srid_of("+proj=unknown"))
    assert srid_of(projection_text(26917)) == 26917 and srid_of(None) == 0 and projection_text(0) is None


# -- layers -----------------------------------------------------------------------------------------------


def test_layer_checks(spark):
    points = spark.createDataFrame([(1.0, 2.0, 4326)], "x double, y double, srid int")
    assert layers.layer_kind(points) == "vector"
    lines = spark.createDataFrame([("LINESTRING", [(0.0, 0.0), (111319.49, 0.0)], 3395)], "geom_type string, coords array<struct<x:double,y:double>>, srid int")
    assert layers.checked(lines).first()["coords"][1]["x"] == pytest.approx(1.0, abs=1e-6)
    mixed = lines.unionByName(lines.withColumn("geom_type", F.lit("POINT")))
    with pytest.raises(ValueError, match="LINESTRING and POINT"):
        layers.checked(mixed)
    with pytest.raises(ValueError, match="MULTIPOINT"):
        layers.checked(lines.withColumn("geom_type", F.lit("multipoint")))


def test_layers_by_name(spark):
    spark.createDataFrame([(1.0, 2.0)], "x double, y double").createOrReplaceTempView("some_points")
    spark.createDataFrame([(b"", 1)], "rast binary, band int").createOrReplaceTempView("some_raster")
    with pytest.warns(UserWarning, match="nothing_here"):
        found = layers.classify(spark, ["some_points", "some_raster", "nothing_here"])
    assert found == {"vector": ["some_points"], "raster": ["some_raster"]}
    with pytest.warns(UserWarning, match="raster"):
        assert list(layers.read_layers(spark, ["some_points", "some_raster"])) == ["some_points"]
    with pytest.raises(ValueError):
        layers.classify(spark, [])
    with pytest.raises(ValueError), warnings.catch_warnings():
        warnings.simplefilter("ignore")
        layers.read_layers(spark, ["nothing_here"])


# -- sensor files -----------------------------------------------------------------------------------------


def test_sensor_files(spark, tmp_path):
    assert len(gps.FIX_COLUMNS) == 46
    header = ";".join(f"C{k}" for k in range(46))

    def line(date, number):
        values = dict.fromkeys(gps.FIX_COLUMNS, "")
        values |= {"gps_sensors_code": "GSM1", "line_no": str(number), "utc_date": date, "utc_time": "08:00:30", "latitude": "46.5"}
        values |= {"easting": "1234", "remarks": "ok"}
        return ";".join(values.values())

    for name, dates in {"one": ["01/02/05", "03/04/99"], "two": ["05/06/2007"]}.items():
        (tmp_path / f"{name}.csv").write_text("\n".join([header, *[line(d, k) for k, d in enumerate(dates)]]) + "\n")
    df = gps.read_sensors(spark, {n: str(tmp_path / f"{n}.csv") for n in ("one", "two")})
    found = sorted((r["sensor"], r["line_no"], r["utc_date"], r["latitude"], r["easting"], r["ch01_sat_id"]) for r in df.collect())
    assert found == [
        ("one", 0, "01/02/2005", 46.5, 1234, None), ("one", 1, "03/04/1999", 46.5, 1234, None), ("two", 0, "05/06/2007", 46.5, 1234, None)
    ]
    first = df.filter("sensor = 'one' AND line_no = 0").select(gps.fix_time(F.col("utc_date"), F.col("utc_time"))).first()[0]
    assert first == datetime(2005, 2, 1, 8, 0, 30)


def test_description_tables(spark, tmp_path):
    (tmp_path / "animals.csv").write_text("1;a1;Bella;f;3;1\n2;a2;Max;m;1;1\n")
    df = gps.read_description(spark, str(tmp_path / "animals.csv"), gps.ANIMALS)
    assert [tuple(r) for r in df.orderBy("animals_id").collect()] == [(1, "a1", "Bella", "f", 3, 1), (2, "a2", "Max", "m", 1, 1)]


def test_a_folder_of_sensors_is_one_scan(spark, tmp_path):
    values = {c: "" for c in gps.FIX_COLUMNS} | {"line_no": "1", "utc_date": "01/02/05"}
    row, header = ";".join(values.values()), ";".join("C" for _ in gps.FIX_COLUMNS)
    for k in range(40):
        (tmp_path / f"GSM {k:03d}+ä.csv").write_text(f"{header}\n{row}\n")
    df = gps.read_sensors(spark, str(tmp_path), check=True)
    assert {r["sensor"] for r in df.collect()} == {f"GSM {k:03d}+ä" for k in range(40)}
    assert df._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 1
    (tmp_path / "broken.csv").write_text(f"{header}\n1;2;3\n")
    with pytest.raises(ValueError, match="broken.csv"):
        gps.read_sensors(spark, str(tmp_path), check=True)
