"""Neighbourhood operators on pixel rows (keys, row, col, value).

A raster is partitioned by its keys and row (or column), so frames never span rasters and every shuffle
is on a key with as many values as there are raster lines.  Integer values stay exact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

Keys = Sequence[str]


def mirror_pad(df: DataFrame, k: int, height: int, width: int) -> DataFrame:
    """Rows and columns repeated beyond the edge in mirror order (the edge line itself comes first)."""

    def targets(c: str, n: int) -> Column:
        x = F.col(c)
        return F.filter(F.array(x, F.when(x < k, -1 - x), F.when(x >= n - k, 2 * n - 1 - x)), lambda v: v.isNotNull())

    return df.withColumn("row", F.explode(targets("row", height))).withColumn("col", F.explode(targets("col", width)))


def box_sums(df: DataFrame, value: Column, window: int, height: int, width: int, keys: Keys = ()) -> DataFrame:
    """keys, row, col, n, s, ss: sums of values and squares over a square window with mirrored edges."""
    if window % 2 == 0:
        raise ValueError("the window must be odd")
    k = window // 2
    p = mirror_pad(df.select(*keys, "row", "col", value.alias("z")), k, height, width)
    across = W.partitionBy(*keys, "row").orderBy("col").rangeBetween(-k, k)
    down = W.partitionBy(*keys, "col").orderBy("row").rangeBetween(-k, k)
    p = p.select(*keys, "row", "col", F.sum("z").over(across).alias("s"), F.sum(F.col("z") * F.col("z")).over(across).alias("ss"))
    # Padded columns have served; dropping them before the second shuffle keeps it small.
    p = p.filter(F.col("col").between(0, width - 1))
    p = p.select(*keys, "row", "col", F.sum("s").over(down).alias("s"), F.sum("ss").over(down).alias("ss"))
    return p.filter(F.col("row").between(0, height - 1)).withColumn("n", F.lit(window * window).cast("long"))


def flat_mask(df: DataFrame, value: Column, height: int, width: int, window: int = 5, threshold: float | int = 4.0, keys: Keys = ()) -> DataFrame:
    """keys, row, col, flat: 1 where the window's variance is below the threshold.

    ``n * ss - s * s < threshold * n * n`` is the same test without a division, exact for integers.
    """
    b = box_sums(df, value, window, height, width, keys)
    n = window * window
    return b.select(*keys, "row", "col", F.when(F.col("n") * F.col("ss") - F.col("s") * F.col("s") < F.lit(threshold * n * n), 1).otherwise(0).cast("int").alias("flat"))


def boundary_mask(mask: DataFrame, keys: Keys = ()) -> DataFrame:
    """keys, row, col, flat, boundary: flat pixels with a neighbour that is not flat or not there."""
    across, down = W.partitionBy(*keys, "row").orderBy("col"), W.partitionBy(*keys, "col").orderBy("row")
    none = F.lit(0)
    m = mask.withColumn("h", F.least(F.lag("flat", 1, 0).over(across), F.lead("flat", 1, 0).over(across)))
    m = m.withColumn("v", F.least(F.lag("flat", 1, 0).over(down), F.lead("flat", 1, 0).over(down)))
    edge = (F.col("flat") == 1) & (F.least(F.coalesce("h", none), F.coalesce("v", none)) == 0)
    return m.select(*keys, "row", "col", "flat", F.when(edge, 1).otherwise(0).cast("int").alias("boundary"))


def dilate_square(cells: DataFrame, radius: int, height: int, width: int, value: str = "label", keys: Keys = ()) -> DataFrame:
    """Greatest label within a square of sparse labelled cells."""
    near = F.sequence(F.lit(-radius), F.lit(radius))
    out = cells.select(*keys, "row", F.explode(near).alias("d"), "col", value).withColumn("row", F.col("row") + F.col("d")).drop("d")
    # The maximum over rows first: fewer cells go through the second step.
    out = out.filter(F.col("row").between(0, height - 1)).groupBy(*keys, "row", "col").agg(F.max(value).alias(value))
    out = out.withColumn("d", F.explode(near)).withColumn("col", F.col("col") + F.col("d")).filter(F.col("col").between(0, width - 1))
    return out.groupBy(*keys, "row", "col").agg(F.max(value).alias(value))


def dilate_diamond(cells: DataFrame, radius: int, height: int, width: int, value: str = "label", keys: Keys = ()) -> DataFrame:
    """Greatest label within a diamond (``radius`` steps to the four neighbours)."""
    steps = [F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a in range(-radius, radius + 1) for b in range(-radius, radius + 1) if abs(a) + abs(b) <= radius]
    out = cells.withColumn("s", F.explode(F.array(*steps))).withColumn("row", F.col("row") + F.col("s.a")).withColumn("col", F.col("col") + F.col("s.b"))
    out = out.filter(F.col("row").between(0, height - 1) & F.col("col").between(0, width - 1))
    return out.groupBy(*keys, "row", "col").agg(F.max(value).alias(value))


def gradient(df: DataFrame, value: Column, keys: Keys = ()) -> DataFrame:
    """Central differences dx, dy (one-sided at the edges)."""
    across, down = W.partitionBy(*keys, "row").orderBy("col"), W.partitionBy(*keys, "col").orderBy("row")
    z = value.cast("double")
    d = df.withColumn("z", z)

    def slope(w):
        a, b = F.lag("z").over(w), F.lead("z").over(w)
        return F.when(a.isNull(), b - F.col("z")).when(b.isNull(), F.col("z") - a).otherwise((b - a) / 2)

    return d.withColumn("dx", slope(across)).withColumn("dy", slope(down)).drop("z")


def hillshade(df: DataFrame, value: Column, azimuth: float = 315.0, altitude: float = 45.0, exaggeration: float = 1.5, pixel_m: float = 1.0, keys: Keys = ()) -> DataFrame:
    """keys, row, col, shade in 0..1."""
    g = gradient(df, value, keys)
    dx, dy = F.col("dx") * exaggeration / pixel_m, F.col("dy") * exaggeration / pixel_m
    az, alt = F.radians(F.lit(90.0 - azimuth)), F.radians(F.lit(altitude))
    dot = (F.cos(alt) * (-dx * F.cos(az) + dy * F.sin(az)) + F.sin(alt)) / F.sqrt(1 + dx * dx + dy * dy)
    return g.select(*keys, "row", "col", F.greatest(F.lit(0.0), F.least(F.lit(1.0), dot)).alias("shade"))
