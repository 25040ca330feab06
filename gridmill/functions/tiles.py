"""Tile algebra as Column expressions: one-degree tiles named by their south-west corner.

A tile covers the half-open box [south, south + 1) x [west, west + 1).  Everything here is built from
JVM-side functions, so it runs inside whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The standard grid, and metres to a degree as used for padding and for areas.
PIXELS = 10_800
GRID = 1.0 / PIXELS
GRID_TOLERANCE = 1e-4
METRES_PER_DEGREE = 111_320.0
KM_PER_DEGREE = 111.32
PATTERN = r"^([NS])(\d{2})([EW])(\d{3})\z"


def is_standard_grid(rx: Column, ry: Column) -> Column:
    return (F.abs(rx - GRID) <= GRID_TOLERANCE * GRID) & (F.abs(ry - GRID) <= GRID_TOLERANCE * GRID)


def floors(lat: Column, lng: Column) -> tuple[Column, Column]:
    return F.floor(lat).cast("int"), F.floor(lng).cast("int")


def in_range(lat_floor: Column, lng_floor: Column) -> Column:
    return lat_floor.between(-90, 89) & lng_floor.between(-180, 179)


def label(lat_floor: Column, lng_floor: Column) -> Column:
    """Tile name without a range check."""
    return F.format_string(
        "%s%02d%s%03d", F.when(lat_floor < 0, "S").otherwise("N"), F.abs(lat_floor).cast("int"), F.when(lng_floor < 0, "W").otherwise("E"), F.abs(lng_floor).cast("int")
    )


def tile_id(lat_floor: Column, lng_floor: Column) -> Column:
    """Tile name; raises beyond [-90, 90) x [-180, 180)."""
    bad = F.raise_error(F.format_string("tile floors out of range: %s, %s", lat_floor.cast("string"), lng_floor.cast("string")))
    return F.when(in_range(lat_floor, lng_floor), label(lat_floor, lng_floor)).otherwise(bad.cast("string"))


def tile_id_at(lat: Column, lng: Column) -> Column:
    return tile_id(*floors(lat, lng))


def parse(name: Column, strict: bool = True) -> tuple[Column, Column]:
    """(lat_floor, lng_floor) of a tile name; a bad name raises, or gives nulls if not ``strict``."""
    lat = F.when(F.regexp_extract(name, PATTERN, 1) == "S", -1).otherwise(1) * F.regexp_extract(name, PATTERN, 2).try_cast("int")
    lng = F.when(F.regexp_extract(name, PATTERN, 3) == "W", -1).otherwise(1) * F.regexp_extract(name, PATTERN, 4).try_cast("int")
    good = name.rlike(PATTERN) & in_range(lat, lng)
    other = F.raise_error(F.concat(F.lit("bad tile id: "), F.coalesce(name, F.lit("null")))).cast("int") if strict else F.lit(None).cast("int")
    return F.when(good, lat).otherwise(other), F.when(good, lng).otherwise(other)


def bounds(lat_floor: Column, lng_floor: Column) -> Column:
    """struct(south, west, north, east) of a tile."""
    d = [x.cast("double") for x in (lat_floor, lng_floor, lat_floor + 1, lng_floor + 1)]
    return F.struct(*(c.alias(n) for c, n in zip(d, ("south", "west", "north", "east"), strict=True)))


def centre(b: Column) -> Column:
    return F.struct(((b["south"] + b["north"]) / 2).alias("lat"), ((b["west"] + b["east"]) / 2).alias("lng"))


def contains(b: Column, lat: Column, lng: Column) -> Column:
    return (lat >= b["south"]) & (lat < b["north"]) & (lng >= b["west"]) & (lng < b["east"])


def intersects(b: Column, south: Column, west: Column, north: Column, east: Column) -> Column:
    """Strict overlap: boxes that only touch don't intersect."""
    return (b["south"] < north) & (south < b["north"]) & (b["west"] < east) & (west < b["east"])


def signed_arc(west1: Column, west2: Column) -> Column:
    """Shorter way in degrees from one meridian to another, in [-180, 180)."""
    return F.pmod(west2 - west1 + 180, F.lit(360)) - 180


def url_name(lat_floor: Column, lng_floor: Column) -> Column:
    """Name such as N45_00_W111, the form of global 30 m tiles."""
    return F.format_string(
        "%s%02d_00_%s%03d", F.when(lat_floor < 0, "S").otherwise("N"), F.abs(lat_floor).cast("int"), F.when(lng_floor < 0, "W").otherwise("E"), F.abs(lng_floor).cast("int")
    )


def area_km(south: Column, west: Column, north: Column, east: Column) -> tuple[Column, Column]:
    """(width, height) of a box in kilometres, the width at its middle latitude."""
    return (east - west) * KM_PER_DEGREE * F.cos(F.radians((south + north) / 2)), (north - south) * KM_PER_DEGREE


def tile_dir(name: Column) -> Column:
    return F.concat_ws("/", F.lit("tiles"), name)


def tile_file(name: Column, kind: str) -> Column:
    """Registry path of a tile's file; ``kind`` is dem, flat, boundary or meta."""
    ending = "meta.json" if kind == "meta" else f"{kind}.tif"
    return F.concat_ws("/", F.lit("tiles"), name, F.concat(name, F.lit(f"_{ending}")))


def pixel_of(lat: Column, lng: Column, per_degree: int) -> tuple[Column, Column]:
    """(row, col) of a point in its tile, counted from the north-west corner."""
    return F.floor((F.floor(lat) + 1 - lat) * per_degree).cast("int"), F.floor((lng - F.floor(lng)) * per_degree).cast("int")
