"""Addresses of public elevation tiles as Column expressions; nothing is fetched here."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .tiles import url_name

# Public addresses of 10 m tiles (named by the north-west corner) and of global 30 m tiles.
TEN_METRE = "https://prd-tnm.s3.amazonaws.com/StagedProducts/Elevation/13/TIFF/current/{0}/USGS_13_{0}.tif"
THIRTY_METRE = "https://copernicus-dem-30m.s3.amazonaws.com/{0}/{0}.tif"
THIRTY_METRE_NAME = "Copernicus_DSM_COG_10_{0}_00_DEM"


def _fill(pattern: str, part: Column) -> Column:
    pieces = [F.lit(p) for p in pattern.split("{0}")]
    return F.concat(*[x for p in pieces[:-1] for x in (p, part)], pieces[-1])


def ten_metre(lat_floor: Column, lng_floor: Column) -> Column:
    """Null east of Greenwich and outside 24 to 72 degrees north."""
    name = F.format_string("n%02dw%03d", F.abs(lat_floor + 1).cast("int"), F.abs(lng_floor).cast("int"))
    return F.when((lng_floor < 0) & lat_floor.between(24, 72), _fill(TEN_METRE, name))


def thirty_metre(lat_floor: Column, lng_floor: Column) -> Column:
    return _fill(THIRTY_METRE, _fill(THIRTY_METRE_NAME, url_name(lat_floor, lng_floor)))
