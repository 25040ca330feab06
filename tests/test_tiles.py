import pytest
from pyspark.sql import functions as F

from gridmill.functions import rules as R
from gridmill.functions import tiles as T
from gridmill.operators import cover


def ids(df):
    return [r.tile_id for r in df.orderBy("lat_floor", "lng_floor").collect()]


def box(spark, *b):
    return spark.createDataFrame([tuple(map(float, b))], "south double, west double, north double, east double")


@pytest.mark.parametrize(
    ("lat", "lng", "name"),
    [(45.2, -109.5, "N45W110"), (45.0, -110.0, "N45W110"), (0.5, 0.5, "N00E000"), (-0.5, -0.5, "S01W001"), (-33.9, 151.2, "S34E151"), (89.999, 179.999, "N89E179"), (-90.0, -180.0, "S90W180")],
)
def test_name_and_back(spark, lat, lng, name):
    p = spark.createDataFrame([(lat, lng)], "lat double, lng double")
    got = cover.assign(p).select("tile_id", *[c.alias(n) for c, n in zip(T.parse(F.col("tile_id")), ("a", "b"), strict=True)], "lat_floor", "lng_floor").first()
    assert got.tile_id == name
    assert (got.a, got.b) == (got.lat_floor, got.lng_floor)


@pytest.mark.parametrize("name", ["", "N45", "n45w110", "N45W1100", "X45W110", "N45W110\n", " N45W110", "N90E000", "S91E000", "N00E180", None])
def test_bad_names(spark, name):
    df = spark.createDataFrame([(name,)], "x string")
    a, b = T.parse(F.col("x"), strict=False)
    assert df.select(a.alias("a"), b.alias("b")).first() == (None, None)
    with pytest.raises(Exception, match="bad tile id"):
        df.select(T.parse(F.col("x"))[0]).collect()


def test_aliases_of_zero(spark):
    df = spark.createDataFrame([("S00W000",)], "x string")
    assert df.select(*(c.alias(n) for c, n in zip(T.parse(F.col("x")), "ab", strict=True))).first() == (0, 0)


def test_out_of_range(spark):
    with pytest.raises(Exception, match="out of range"):
        cover.assign(spark.createDataFrame([(90.0, 0.0)], "lat double, lng double")).collect()


def test_bbox_cover(spark):
    assert ids(cover.bbox_tiles(box(spark, 45, -110, 46, -109))) == ["N45W110"]
    assert ids(cover.bbox_tiles(box(spark, 44.5, -110.5, 45.5, -109.5))) == ["N44W111", "N44W110", "N45W111", "N45W110"]
    assert ids(cover.bbox_tiles(box(spark, -0.5, -0.5, 0.5, 0.5))) == ["S01W001", "S01E000", "N00W001", "N00E000"]
    with pytest.raises(Exception, match="empty"):
        cover.bbox_tiles(box(spark, 46, -110, 45, -109)).collect()


def test_polyline(spark):
    p = spark.createDataFrame([(1, 45.0, -109.5), (1, 45.0, -109.0)], "line int, lat double, lng double")
    assert ids(cover.polyline_tiles(p, "line", 10_000)) == ["N44W110", "N44W109", "N45W110", "N45W109"]
    assert cover.polyline_tiles(p.limit(0), "line", 10.0).collect() == []


def test_neighbours(spark):
    t = spark.createDataFrame([(89, 179), (45, -110)], "lat_floor int, lng_floor int")
    got = {(r.lat_floor, r.direction): r.neighbour for r in cover.neighbours(t).collect()}
    assert got[(45, "N")] == "N46W110" and got[(45, "SW")] == "N44W111" and got[(89, "N")] is None and got[(89, "E")] is None and got[(89, "W")] == "N89E178"


def test_corners(spark):
    df = spark.createDataFrame([(44, -113, 47, -109), (47, -109, 44, -113), (0, 179, 0, -180)], "a int, b int, c int, d int")
    x = [r.x for r in df.select(cover.corner_box(*map(F.col, "abcd")).alias("x")).collect()]
    assert tuple(x[0]) == tuple(x[1]) == (44, -113, 48, -108, 20, False)
    assert x[2].crosses
    assert cover.study_area(spark, "a", "N44W113", "N47W109").first().n_tiles == 20
    with pytest.raises(Exception, match="too many"):
        cover.study_area(spark, "a", "N40W113", "N47W109").collect()


def test_box_predicates(spark):
    b = T.bounds(F.lit(45), F.lit(-110))
    one = lambda c: spark.range(1).select(c.alias("x")).first().x
    assert one(T.contains(b, F.lit(45.0), F.lit(-110.0))) and not one(T.contains(b, F.lit(46.0), F.lit(-109.5)))
    assert not one(T.intersects(b, F.lit(46.0), F.lit(-110.0), F.lit(47.0), F.lit(-109.0)))
    assert one(T.is_standard_grid(F.lit(1 / 10800), F.lit(1 / 10800 * 1.00005))) and not one(T.is_standard_grid(F.lit(1 / 10800), F.lit(-1 / 10800)))
    assert one(R.estimated_mb(F.lit("GLO30"))) == 80.0 and one(R.estimated_mb(F.lit("other"))) == 250.0
