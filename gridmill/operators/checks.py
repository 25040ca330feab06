"""Validation and build gates: each a projection over a table of headers or statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import tiles as T

# Codes of geographic reference systems (WGS 84, NAD27, NAD83 and its later forms, ETRS89,
# GDA94, GDA2020, JGD2000, JGD2011, CGCS2000, SIRGAS 2000).
GEOGRAPHIC = (4326, 4979, 4267, 4269, 4617, 6318, 4258, 4283, 7844, 4612, 6668, 4490, 4674)


def validate_headers(headers: DataFrame, size: int = T.PIXELS, tolerance: float = 1e-4) -> DataFrame:
    """``headers`` (tile_id, width, height, west, south, east, north; null width: no file) with ok and reason."""
    lat, lng = T.parse(F.col("tile_id"))
    b = T.bounds(lat, lng)
    off = lambda c: F.abs(F.col(c) - b[c]) > tolerance
    missing = F.when(F.col("width").isNull(), F.lit("file missing on disk"))
    wrong = F.when((F.col("width") != size) | (F.col("height") != size), F.format_string(f"wrong size %sx%s (expected {size}x{size})", F.col("width").cast("string"), F.col("height").cast("string")))
    moved = F.when(off("west") | off("south") | off("east") | off("north"), F.lit("bounds differ"))
    reason = F.when(missing.isNotNull(), missing).otherwise(F.concat_ws("; ", wrong, moved))
    return headers.withColumn("reason", F.when(reason == "", F.lit(None)).otherwise(reason)).withColumn("ok", F.col("reason").isNull())


def flat_gate(flat_pct: Column, elev_range: Column, ocean: Column) -> Column:
    """Null if a flat mask may pass, else why not."""
    return (
        F.when(elev_range.isNull(), "no valid pixels").when(flat_pct < 1.0, "flat share below 1 %")
        .when((flat_pct > 99.0) & (elev_range < 2.0) & ~ocean, "degenerate raster")
    )


def boundary_gate(boundary_cells: Column, flat_cells: Column) -> Column:
    return F.when(boundary_cells > flat_cells, "more boundary than flat cells")


def crs_gate(crs: Column) -> Column:
    """Null for geographic reference systems, else why not; a code that isn't known to be geographic is refused."""
    code = F.regexp_extract(crs, r"^EPSG:(\d+)$", 1).try_cast("int")
    return F.when(code.isNull(), "unknown reference system").when(~code.isin(*GEOGRAPHIC), F.concat(F.lit("not a geographic reference system: "), crs))


def union_box(boxes: DataFrame) -> DataFrame:
    """One row: the box around all of ``boxes`` (south, west, north, east), nulls without any."""
    return boxes.agg(F.min("south").alias("south"), F.min("west").alias("west"), F.max("north").alias("north"), F.max("east").alias("east"))


def coverage(values: DataFrame, valid: Column, least: float = 0.5) -> DataFrame:
    """share of valid values of a probe, and whether it is covered."""
    got = values.agg(F.avg(valid.cast("double")).alias("share"))
    return got.withColumn("covered", F.coalesce(F.col("share") >= least, F.lit(False)))
