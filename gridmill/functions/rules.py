"""Value rules of elevation rasters and choices of data source, each a named Column expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NODATA = -9999.0

# Boxes (least and greatest latitude, least and greatest longitude) that hold land, inclusive.
LAND_BOXES = (
    (-56, 72, -168, -52),
    (34, 72, -25, 60),
    (-35, 38, -20, 52),
    (12, 82, 25, 180),
    (-48, -9, 110, 180),
    (-90, -60, -180, 180),
)
# Estimated size of a tile in MB by source.
TILE_MB = {"3dep_10": 250.0, "3dep_10m": 250.0, "glo30": 80.0}
# Still water among hydrography feature types (lake, playa/reservoir, estuary).
STILL_WATER = (390, 436, 493)


def is_gap(v: Column, nodata: float = NODATA, zero_is_gap: bool = True, zero_threshold: float = 0.0) -> Column:
    none = v <= nodata + 1
    return none | (F.abs(v) <= zero_threshold) if zero_is_gap else none


def has_elevation(v: Column, nodata: float = NODATA) -> Column:
    return v >= nodata + 1


def zero_filled(v: Column, nodata: float = NODATA) -> Column:
    return F.when(v < nodata + 1, F.lit(0)).otherwise(v)


def is_shore_sample(v: Column, unit: int = 1) -> Column:
    return (v > -1000 * unit) & (v < 9000 * unit)


def is_suspect(v: Column, ocean: Column, nodata: float = NODATA, unit: int = 1) -> Column:
    """A point value that a look-up answers with 0: no data, out of range, or a small value at sea."""
    return (v == nodata) | ~v.between(-500 * unit, 9000 * unit) | (ocean & v.between(-10 * unit, 20 * unit))


def is_land(lat: Column, lng: Column) -> Column:
    out = F.lit(False)
    for s, n, w, e in LAND_BOXES:
        out = out | (lat.between(s, n) & lng.between(w, e))
    return out


def in_10m_coverage(lat: Column, lng: Column) -> Column:
    return lat.between(17, 72) & lng.between(-180, -60)


def auto_source(lat: Column, lng: Column) -> Column:
    return F.when(in_10m_coverage(lat, lng), "3DEP_10").otherwise("GLO30")


def candidates(lat_floor: Column, lng_floor: Column, resolution: Column) -> Column:
    """Ordered source labels: 10m alone, 30m alone, else 10m (where there is a direct file) then 30m."""
    direct = (lng_floor < 0) & lat_floor.between(24, 72)
    ten = F.when(direct, F.array(F.lit("10m"))).otherwise(F.array().cast("array<string>"))
    return F.when(resolution == "10m", ten).when(resolution == "30m", F.array(F.lit("30m"))).otherwise(F.concat(ten, F.array(F.lit("30m"))))


def water_source(south: Column, west: Column, east: Column) -> Column:
    return F.when(south.between(24, 72) & (west >= -180) & (east <= -50), "nhd").otherwise("osm")


def estimated_mb(source: Column) -> Column:
    out = F.lit(250.0)
    for name, mb in TILE_MB.items():
        out = F.when(F.lower(source) == name, mb).otherwise(out)
    return out


def is_still_water(ftype: Column) -> Column:
    return ftype.isin(*STILL_WATER)
