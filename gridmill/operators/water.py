"""Still-water correction, diagnostics and centroids on label cells (row, col, label).

One label space for all bodies: a label is a body, overlaps have been decided before.  So the result does
not depend on any order of work, and each step is one aggregation or one join on cells.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules as R
from .focal import dilate_diamond, dilate_square
from .vector import reaches_out

Keys = Sequence[str]


def exchanged(pixels: DataFrame) -> DataFrame:
    """``pixels`` for a join that sends both sides to the tasks, never one of them through the driver.

    Exploded rasters and compressed cells have far more rows than their estimated size says.
    """
    return pixels.hint("merge")


def shoreline(cells: DataFrame, buffer: int, height: int, width: int, keys: Keys = ()) -> DataFrame:
    """Cells within ``buffer`` of a body that are no water: (keys, row, col, label), the greatest label wins."""
    band = dilate_square(cells, buffer, height, width, keys=keys)
    return band.join(exchanged(cells.select(*keys, "row", "col")), [*keys, "row", "col"], "left_anti")


def measure(dem: DataFrame, cells: DataFrame, height: int, width: int, buffer: int = 3, percentile: float = 0.1, unit: int = 1, keys: Keys = ()) -> DataFrame:
    """One row a body: keys, label, pixel_count, surface, orig_mean, water_std, shore_std, n_shore.

    The surface is the percentile of valid shoreline values, or of the body's own where it has no
    shoreline; standard deviations are of the population, 0 for a single value.
    """
    z = exchanged(dem.select(*keys, "row", "col", F.col("value").cast("double").alias("v")))
    inside = cells.join(z, [*keys, "row", "col"])
    ok = F.when(F.col("v") > -1000 * unit, F.col("v"))
    body = inside.groupBy(*keys, "label").agg(
        F.count(F.lit(1)).alias("pixel_count"), F.coalesce(F.avg(ok), F.lit(0.0)).alias("orig_mean"),
        F.coalesce(F.stddev_pop(ok), F.lit(0.0)).alias("water_std"), F.percentile(ok, F.lit(percentile)).alias("own"),
    )
    ring = shoreline(cells, buffer, height, width, keys).join(z, [*keys, "row", "col"]).filter(R.is_shore_sample(F.col("v"), unit))
    shore = ring.groupBy(*keys, "label").agg(F.percentile("v", F.lit(percentile)).alias("edge"), F.stddev_pop("v").alias("edge_std"), F.count(F.lit(1)).alias("n_shore"))
    got = body.join(exchanged(shore), [*keys, "label"], "left")
    return got.select(*keys, "label", "pixel_count", F.coalesce("edge", "own").alias("surface"), "orig_mean", "water_std", F.coalesce("edge_std", "water_std").alias("shore_std"), F.coalesce("n_shore", F.lit(0)).alias("n_shore"))


def boxes(cells: DataFrame, keys: Keys = ()) -> DataFrame:
    """keys, label, pixel_count and the bounding box of each label's cells."""
    return cells.groupBy(*keys, "label").agg(F.count(F.lit(1)).alias("pixel_count"), *(f(c).alias(f"{n}_{c}") for c in ("row", "col") for n, f in (("min", F.min), ("max", F.max))))


def masked_percentile(dem: DataFrame, mask: DataFrame, percentile: float = 0.1, valid: Column | None = None, keys: Keys = ()) -> DataFrame:
    """keys, surface, n: the percentile of the valid values under the mask's cells, 0.0 without any."""
    z = dem.select(*keys, "row", "col", F.col("value").cast("double").alias("value")).join(mask.select(*keys, "row", "col"), [*keys, "row", "col"])
    v = F.when(valid, F.col("value")) if valid is not None else F.col("value")
    return z.groupBy(*keys).agg(F.coalesce(F.percentile(v, F.lit(percentile)), F.lit(0.0)).alias("surface"), F.count(v).alias("n"))


def sample_shoreline(dem: DataFrame, mask: DataFrame, height: int, width: int, buffer: int = 3, percentile: float = 0.1, unit: int = 1) -> DataFrame:
    """surface, n of one body's shoreline: cells within ``buffer`` steps of the mask that aren't in it."""
    band = dilate_diamond(mask.select("row", "col", F.lit(1).alias("label")), buffer, height, width).join(mask.select("row", "col"), ["row", "col"], "left_anti")
    return masked_percentile(dem, band, percentile, R.is_shore_sample(F.col("value"), unit))


def judge(bodies: DataFrame, least_pixels: int = 12, most_change: float = 10.0, most_std: float = 2.5) -> DataFrame:
    """``bodies`` with status (too_small, no_samples, flagged, corrected), change and low_confidence."""
    change = F.col("surface") - F.col("orig_mean")
    status = (
        F.when(F.col("pixel_count") < least_pixels, "too_small").when(F.col("surface").isNull(), "no_samples")
        .when(F.abs(change) > most_change, "flagged").otherwise("corrected")
    )
    return bodies.withColumn("change", change).withColumn("status", status).withColumn("low_confidence", (status == "corrected") & (F.col("water_std") > most_std))


def apply(dem: DataFrame, cells: DataFrame, judged: DataFrame, keys: Keys = ()) -> DataFrame:
    """``dem`` (keys, row, col, value) with corrected bodies at their surface; others stay as they were."""
    level = cells.join(exchanged(judged.filter("status = 'corrected'").select(*keys, "label", "surface")), [*keys, "label"]).select(*keys, "row", "col", "surface")
    kind = dem.schema["value"].dataType
    return dem.join(exchanged(level), [*keys, "row", "col"], "left").select(*keys, "row", "col", F.coalesce(F.col("surface"), F.col("value").cast("double")).cast("double" if kind.typeName() != "float" else "float").alias("value"))


def zero_ocean(dem: DataFrame, ocean: DataFrame) -> DataFrame:
    """``dem`` with the cells of explicit ocean polygons at 0; nothing else is ever taken for ocean."""
    hit = ocean.select("row", "col").distinct().withColumn("o", F.lit(True))
    return dem.join(hit, ["row", "col"], "left").select("row", "col", F.when(F.col("o"), F.lit(0).cast(dem.schema["value"].dataType)).otherwise(F.col("value")).alias("value"))


def centroids(cells: DataFrame) -> DataFrame:
    """(label, row, col) of the body's pixel nearest to its mean place, the first of equals."""
    mean = cells.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.sum("row").alias("sr"), F.sum("col").alias("sc"))
    d = cells.join(mean, "label")
    a, b = F.col("n") * F.col("row") - F.col("sr"), F.col("n") * F.col("col") - F.col("sc")
    best = d.groupBy("label").agg(F.min(F.struct((a * a + b * b).alias("d2"), "row", "col")).alias("m"))
    return best.select("label", "m.row", "m.col")


def diagnostics(dem: DataFrame, cells: DataFrame, unit: int = 1, nodata: float = R.NODATA, most_std: float = 5.0, most_range: float = 20.0, polygons: DataFrame | None = None, height: int = 0, width: int = 0) -> DataFrame:
    """Values inside each polygon before correction: n, least, most, std, range, flagged and the reason.

    ``cells`` may overlap here: (pid, row, col) of each polygon by itself.  With ``polygons`` follow
    cross_tile, whether a vertex lies outside the raster, and the reason as a text.
    """
    z = dem.select("row", "col", F.col("value").cast("double").alias("v"))
    ok = F.when((F.col("v") > nodata + 1) & (F.col("v") < 9000 * unit), F.col("v"))
    got = cells.join(z, ["row", "col"]).groupBy("pid").agg(F.count(F.lit(1)).alias("pixel_count"), F.min(ok).alias("least"), F.max(ok).alias("most"), F.stddev_pop(ok).alias("std"))
    span = F.col("most") - F.col("least")
    got = got.withColumn("range", span).withColumn("flagged", (F.col("std") > most_std * unit) | (span > most_range * unit)).withColumn(
        "reason", F.when(F.col("std") > most_std * unit, "std").when(span > most_range * unit, "range")
    )
    if polygons is None:
        return got
    outside = polygons.select("pid", reaches_out(F.col("rings"), height, width).alias("cross_tile"))
    text = F.when(F.col("reason") == "std", F.format_string("std %.1f above %.1f", F.col("std") / unit, F.lit(most_std))).when(F.col("reason") == "range", F.format_string("range %.1f above %.1f", F.col("range") / unit, F.lit(most_range)))
    return got.join(outside, "pid").withColumn("text", text)
