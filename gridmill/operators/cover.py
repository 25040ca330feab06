"""Which tiles cover an area: generators and joins on the tile key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import tiles as T

# Offsets of the eight neighbours (north, east).
NEIGHBOURS = (("N", 1, 0), ("S", -1, 0), ("E", 0, 1), ("W", 0, -1), ("NE", 1, 1), ("NW", 1, -1), ("SE", -1, 1), ("SW", -1, -1))
MAX_TILES = 25


def bbox_tiles(boxes: DataFrame, south: str = "south", west: str = "west", north: str = "north", east: str = "east") -> DataFrame:
    """``boxes`` with one row for each covering tile: lat_floor, lng_floor, tile_id.

    South to north, then west to east.  A box without extent raises.  Each box is exploded where it lies.
    """
    s, w, n, e = (F.col(c) for c in (south, west, north, east))
    good = F.when((s < n) & (w < e), F.lit(True)).otherwise(F.raise_error(F.lit("empty bounding box")).cast("boolean"))
    lat = F.sequence(F.floor(s).cast("int"), (F.ceil(n) - 1).cast("int"))
    lng = F.sequence(F.floor(w).cast("int"), (F.ceil(e) - 1).cast("int"))
    got = boxes.filter(good).withColumn("lat_floor", F.explode(lat)).withColumn("lng_floor", F.explode(lng))
    return got.withColumn("tile_id", T.tile_id(F.col("lat_floor"), F.col("lng_floor")))


def polyline_boxes(points: DataFrame, line: str, buffer_m: float) -> DataFrame:
    """Box of each line's points grown by a buffer in metres; one partial aggregation."""
    box = points.groupBy(line).agg(F.min("lat").alias("s"), F.max("lat").alias("n"), F.min("lng").alias("w"), F.max("lng").alias("e"))
    d = buffer_m / T.METRES_PER_DEGREE
    dx = d / F.greatest(F.cos(F.radians((F.col("s") + F.col("n")) / 2)), F.lit(1e-6))
    return box.select(line, (F.col("s") - d).alias("south"), (F.col("w") - dx).alias("west"), (F.col("n") + d).alias("north"), (F.col("e") + dx).alias("east"))


def polyline_tiles(points: DataFrame, line: str, buffer_m: float) -> DataFrame:
    return bbox_tiles(polyline_boxes(points, line, buffer_m)).drop("south", "west", "north", "east")


def neighbours(tiles: DataFrame) -> DataFrame:
    """Eight rows a tile (lat_floor, lng_floor): direction and neighbour's tile_id, null beyond the grid."""
    offsets = F.array(*[F.struct(F.lit(d).alias("direction"), F.lit(n).alias("n"), F.lit(e).alias("e")) for d, n, e in NEIGHBOURS])
    got = tiles.withColumn("o", F.explode(offsets))
    lat, lng = F.col("lat_floor") + F.col("o.n"), F.col("lng_floor") + F.col("o.e")
    return got.withColumn("direction", F.col("o.direction")).withColumn("neighbour", F.when(T.in_range(lat, lng), T.label(lat, lng))).drop("o")


def corner_box(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    """struct(south, west, north, east, n_tiles, crosses) spanned by two corner tiles, by the shorter arc."""
    ahead = T.signed_arc(lng1, lng2) >= 0
    south, north = F.least(lat1, lat2), F.greatest(lat1, lat2) + 1
    west, east = F.when(ahead, lng1).otherwise(lng2), F.when(ahead, lng2).otherwise(lng1) + 1
    n = (north - south) * (east - west)
    return F.struct(south.alias("south"), west.alias("west"), north.alias("north"), east.alias("east"), n.cast("long").alias("n_tiles"), (east <= west).alias("crosses"))


def checked_corner_box(box: Column, max_tiles: int = MAX_TILES, allow_large: bool = False) -> Column:
    """The box, or an error if it crosses the antimeridian or holds too many tiles."""
    fail = lambda m: F.raise_error(F.lit(m)).cast("struct<south:int,west:int,north:int,east:int,n_tiles:bigint,crosses:boolean>")
    out = F.when(box["crosses"], fail("the shorter arc crosses the antimeridian"))
    return (out if allow_large else out.when(box["n_tiles"] > max_tiles, fail("too many tiles"))).otherwise(box)


def study_area(spark: SparkSession, name: str, corner1: str, corner2: str, resolution: str = "best", max_tiles: int = MAX_TILES) -> DataFrame:
    """One row: name, bounds, size in kilometres and resolution of the area between two tiles."""
    row = spark.createDataFrame([(name, corner1, corner2, resolution)], "name string, a string, b string, resolution string")
    (la, lo), (lb, lp) = T.parse(F.col("a")), T.parse(F.col("b"))
    got = row.select("name", "resolution", checked_corner_box(corner_box(la, lo, lb, lp), max_tiles).alias("x")).select("name", "resolution", "x.*")
    width, height = T.area_km(*(F.col(c) for c in ("south", "west", "north", "east")))
    return got.withColumn("width_km", width).withColumn("height_km", height).drop("crosses")


def assign(points: DataFrame) -> DataFrame:
    """Points (lat, lng) with lat_floor, lng_floor and tile_id."""
    a, b = T.floors(F.col("lat"), F.col("lng"))
    return points.withColumn("lat_floor", a).withColumn("lng_floor", b).withColumn("tile_id", T.tile_id(F.col("lat_floor"), F.col("lng_floor")))
