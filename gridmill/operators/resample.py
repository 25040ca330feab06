"""Resampling, merging, cropping and gap filling of pixel rows (keys, row, col, value)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules as R

Keys = Sequence[str]


def average(df: DataFrame, k: int, value: Column, keys: Keys = ()) -> DataFrame:
    """Mean, sum and count over ``k`` x ``k`` blocks of pixels that are not null."""
    cell = df.select(*keys, F.floor(F.col("row") / k).cast("int").alias("row"), F.floor(F.col("col") / k).cast("int").alias("col"), value.alias("v"))
    return cell.groupBy(*keys, "row", "col").agg(F.sum("v").alias("total"), F.count("v").alias("n"), F.avg("v").alias("value"))


def decimate(df: DataFrame, k: int, keys: Keys = ()) -> DataFrame:
    """Every ``k``-th pixel, the one in the middle of its block: a filter, no shuffle."""
    mid = k // 2
    kept = df.filter((F.col("row") % k == mid) & (F.col("col") % k == mid))
    return kept.withColumn("row", F.floor(F.col("row") / k).cast("int")).withColumn("col", F.floor(F.col("col") / k).cast("int"))


def nearest(df: DataFrame, factor: int, keys: Keys = ()) -> DataFrame:
    """Finer grid by an integer factor: each pixel becomes a block of equal ones where it lies."""
    steps = F.sequence(F.lit(0), F.lit(factor - 1))
    out = df.withColumn("dr", F.explode(steps)).withColumn("dc", F.explode(steps))
    return out.withColumn("row", (F.col("row") * factor + F.col("dr")).cast("int")).withColumn("col", (F.col("col") * factor + F.col("dc")).cast("int")).drop("dr", "dc")


def nearest_to(df: DataFrame, scale_row: float, scale_col: float, height: int, width: int, grid: DataFrame, keys: Keys = ()) -> DataFrame:
    """Values at the cells of ``grid`` (keys, row, col) from the source cell under each cell's centre."""
    at = grid.withColumn("sr", F.floor((F.col("row") + 0.5) * scale_row).cast("int")).withColumn("sc", F.floor((F.col("col") + 0.5) * scale_col).cast("int"))
    source = df.withColumnRenamed("row", "sr").withColumnRenamed("col", "sc")
    return at.join(source, [*keys, "sr", "sc"], "left").drop("sr", "sc")


def bilinear(df: DataFrame, factor: int, height: int, width: int, value: Column, keys: Keys = ()) -> DataFrame:
    """Finer grid by an integer factor: keys, row, col, num, den with value num / den.

    A destination centre lies between four source centres; weights are those of valid (not null) cells
    inside the raster, in units of 1 / (2 * factor) ** 2, so integers stay exact.  Each source pixel sends
    its weighted value to the destinations it touches, and sums are made before the shuffle.
    """
    f2 = 2 * factor
    reach = F.sequence(F.lit(-factor), F.lit(2 * factor - 1))

    def weight(d: str) -> Column:
        # Distance of the destination centre to the source centre in 1 / (2 factor) pixels.
        return F.greatest(F.lit(0), f2 - F.abs(2 * F.col(d) + 1 - factor))

    src = df.select(*keys, F.col("row").alias("r0"), F.col("col").alias("c0"), value.alias("v")).filter("v IS NOT NULL")
    out = src.withColumn("dr", F.explode(reach)).withColumn("wr", weight("dr")).filter("wr > 0")
    out = out.withColumn("dc", F.explode(reach)).withColumn("w", weight("dc") * F.col("wr")).filter("w > 0")
    out = out.select(*keys, (F.col("r0") * factor + F.col("dr")).cast("int").alias("row"), (F.col("c0") * factor + F.col("dc")).cast("int").alias("col"), "w", "v")
    out = out.filter(F.col("row").between(0, height * factor - 1) & F.col("col").between(0, width * factor - 1))
    return out.groupBy(*keys, "row", "col").agg(F.sum(F.col("w") * F.col("v")).alias("num"), F.sum("w").cast("long").alias("den"))


@dataclass(frozen=True)
class Grid:
    """Where the pixels of a north-up raster lie: west and north edges, pixel sizes, height and width."""

    west: float
    north: float
    dx: float
    dy: float
    height: int
    width: int

    @classmethod
    def of_tile(cls, lat_floor: int, lng_floor: int, size: int) -> Grid:
        return cls(lng_floor, lat_floor + 1, 1 / size, 1 / size, size, size)

    def same(self, other: Grid, tolerance: float = 1e-6) -> bool:
        """The same shape, and edges that differ by less than a share of a pixel."""
        near = lambda a, b, px: abs(a - b) <= tolerance * px
        return (self.height, self.width) == (other.height, other.width) and near(self.west, other.west, self.dx) and near(self.north, other.north, self.dy) and near(self.dx * self.width, other.dx * self.width, self.dx) and near(self.dy * self.height, other.dy * self.height, self.dy)

    def window(self, south: float, west: float, north: float, east: float) -> tuple[int, int, int, int]:
        """(row0, row1, col0, col1) of the pixels that a box touches, within the raster."""
        r0, r1 = round((self.north - north) / self.dy, 6), round((self.north - south) / self.dy, 6)
        c0, c1 = round((west - self.west) / self.dx, 6), round((east - self.west) / self.dx, 6)
        return max(0, int(r0 // 1)), min(self.height, int(-(-r1 // 1))), max(0, int(c0 // 1)), min(self.width, int(-(-c1 // 1)))

    def cropped(self, row0: int, row1: int, col0: int, col1: int) -> Grid:
        return Grid(self.west + col0 * self.dx, self.north - row0 * self.dy, self.dx, self.dy, row1 - row0, col1 - col0)


def _axis(place: Column, scale: float, offset: float, reach: float, n: int) -> Column:
    """The targets j in [0, n) with (j + 0.5) * scale + offset within ``reach`` of ``place``, as an array."""
    first = F.greatest(F.ceil((place - reach - offset) / scale - 0.5), F.lit(0)).cast("int")
    last = F.least(F.floor((place + reach - offset) / scale - 0.5), F.lit(n - 1)).cast("int")
    return F.when(first <= last, F.sequence(first, last))


def reproject_nearest(df: DataFrame, source: Grid, target: Grid, keys: Keys = ()) -> DataFrame:
    """``df`` (keys, row, col, ...) on another grid: each target pixel takes the one its centre lies in.

    Each source pixel is exploded to the targets that it covers, so nothing is shuffled; targets outside
    the source have no row.
    """
    scale_r, scale_c = target.dy / source.dy, target.dx / source.dx
    off_r, off_c = (source.north - target.north) / source.dy, (target.west - source.west) / source.dx
    out = df.withColumn("tr", F.explode(_axis(F.col("row") + 0.5, scale_r, off_r, 0.5, target.height)))
    out = out.filter(F.floor((F.col("tr") + 0.5) * scale_r + off_r) == F.col("row"))
    out = out.withColumn("tc", F.explode(_axis(F.col("col") + 0.5, scale_c, off_c, 0.5, target.width)))
    out = out.filter(F.floor((F.col("tc") + 0.5) * scale_c + off_c) == F.col("col"))
    return out.withColumn("row", F.col("tr")).withColumn("col", F.col("tc")).drop("tr", "tc")


def reproject_bilinear(df: DataFrame, source: Grid, target: Grid, value: Column, keys: Keys = ()) -> DataFrame:
    """keys, row, col, value on another grid: the weighted mean of the valid ones of four source pixels.

    Each source pixel sends its value to the targets whose centres are less than a pixel away; sums are made
    before the shuffle.  Targets without a valid pixel near have no row.
    """
    scale_r, scale_c = target.dy / source.dy, target.dx / source.dx
    off_r, off_c = (source.north - target.north) / source.dy, (target.west - source.west) / source.dx
    src = df.select(*keys, F.col("row").alias("r0"), F.col("col").alias("c0"), value.cast("double").alias("v")).filter("v IS NOT NULL")
    out = src.withColumn("row", F.explode(_axis(F.col("r0") + 0.5, scale_r, off_r, 1.0, target.height)))
    out = out.withColumn("wr", 1 - F.abs((F.col("row") + 0.5) * scale_r + off_r - 0.5 - F.col("r0"))).filter("wr > 0")
    out = out.withColumn("col", F.explode(_axis(F.col("c0") + 0.5, scale_c, off_c, 1.0, target.width)))
    out = out.withColumn("w", F.col("wr") * (1 - F.abs((F.col("col") + 0.5) * scale_c + off_c - 0.5 - F.col("c0")))).filter("w > 0")
    return out.groupBy(*keys, "row", "col").agg((F.sum(F.col("w") * F.col("v")) / F.sum("w")).alias("value"))


def canonical(dem: DataFrame, source: Grid, target: Grid, other: DataFrame | None = None, nodata: float = R.NODATA) -> tuple[DataFrame, DataFrame]:
    """(raster, gaps) on the target grid: crop, gap mask, fill from ``other``, then resampling if need be.

    ``dem`` and ``other`` are (row, col, value) on the source grid.  The raster is bilinear and has nodata
    where nothing is valid; ``gaps`` (row, col, gap) says by nearest pixel what had no value before filling.
    """
    window = source.window(target.north - target.dy * target.height, target.west, target.north, target.west + target.dx * target.width)
    own = source.cropped(*window)
    part = crop(dem.select("row", "col", "value"), *window)
    gap = R.is_gap(F.col("value"), nodata)
    gaps = part.select("row", "col", gap.cast("int").alias("gap"))
    if other is not None:
        part = fill_gaps(part, crop(other.select("row", "col", "value"), *window), gap).drop("filled")
    if own.same(target):
        return part, gaps
    kind = dem.schema["value"].dataType
    smooth = reproject_bilinear(part, own, target, F.when(R.has_elevation(F.col("value"), nodata), F.col("value")))
    grid = dem.sparkSession.range(target.height * target.width).select(F.floor(F.col("id") / target.width).cast("int").alias("row"), (F.col("id") % target.width).cast("int").alias("col"))
    full = grid.join(smooth, ["row", "col"], "left").select("row", "col", F.coalesce("value", F.lit(float(nodata))).cast("double" if kind.typeName() != "float" else "float").alias("value"))
    return full, reproject_nearest(gaps, own, target)


def merge_first_valid(sources: Sequence[DataFrame], nodata: float = R.NODATA, keys: Keys = ()) -> DataFrame:
    """keys, row, col, value, source: of each cell the value of the first source that has one.

    One union and one aggregation with partial minima; a cell without any value has nodata.
    """
    ranked = [s.select(*keys, "row", "col", "value", F.lit(i).alias("rank")) for i, s in enumerate(sources)]
    both = reduce(DataFrame.unionByName, ranked)
    best = both.groupBy(*keys, "row", "col").agg(F.min(F.when(F.col("value") > nodata + 1, F.struct("rank", "value"))).alias("b"))
    return best.select(*keys, "row", "col", F.coalesce("b.value", F.lit(nodata).cast(both.schema["value"].dataType)).alias("value"), F.coalesce("b.rank", F.lit(-1)).alias("source"))


RESOLUTION_RANK = {"1m": 0, "10m": 1, "30m": 2}


def mosaic(tiles: DataFrame, nodata: float = R.NODATA, order: Sequence[str] = ()) -> DataFrame:
    """Tiles (resolution, row, col, value) on one global grid merged finest first.

    Of equal resolutions the first by the columns of ``order`` wins (a file's name or number); without
    them the least value does.
    """
    rank = F.coalesce(F.create_map(*[F.lit(x) for kv in RESOLUTION_RANK.items() for x in kv])[F.col("resolution")], F.lit(len(RESOLUTION_RANK)))
    best = tiles.filter(F.col("value") > nodata + 1).groupBy("row", "col").agg(F.min(F.struct(rank.alias("rank"), *order, "value")).alias("b"))
    return best.select("row", "col", F.col("b.value").alias("value"))


def crop(df: DataFrame, row0: int, row1: int, col0: int, col1: int) -> DataFrame:
    """Window [row0, row1) x [col0, col1), re-based; the filter reaches a Parquet scan."""
    inside = F.col("row").between(row0, row1 - 1) & F.col("col").between(col0, col1 - 1)
    return df.filter(inside).withColumn("row", F.col("row") - row0).withColumn("col", F.col("col") - col0)


def pixel_window(bounds: Sequence[float], west: float, north: float, px: float, pad: int = 0) -> tuple[int, int, int, int]:
    """(row0, row1, col0, col1) of a geographic box (south, west, north, east), truncated towards zero."""
    s, w, n, e = bounds
    return int((north - n) / px) - pad, int((north - s) / px) + pad, int((w - west) / px) - pad, int((e - west) / px) + pad


def pixel_corner(lat: Column, lng: Column, west: float, north: float, px: float, pad: int = 0) -> tuple[Column, Column]:
    """(row, col) of a point, truncated towards zero and moved up and left by ``pad``."""
    return ((north - lat) / px).cast("int") - pad, ((lng - west) / px).cast("int") - pad


def fill_gaps(dem: DataFrame, other: DataFrame, gap: Column, keys: Keys = ()) -> DataFrame:
    """``dem`` with gap values replaced by ``other``'s at the same cell: keys, row, col, value, filled."""
    second = other.select(*keys, "row", "col", F.col("value").alias("other"))
    both = dem.withColumn("gap", gap).join(second, [*keys, "row", "col"], "left")
    use = F.col("gap") & F.col("other").isNotNull()
    return both.select(*keys, "row", "col", F.when(use, F.col("other")).otherwise(F.col("value")).alias("value"), use.cast("int").alias("filled"))


def gap_stats(dem: DataFrame, value: Column, nodata: float, keys: Keys = (), zero_threshold: float = 0.0) -> DataFrame:
    """n_nodata, n_zero (that aren't nodata), n_gaps, n_pixels and the extent of the gaps."""
    none = value <= nodata + 1
    zero = ~none & (F.abs(value) <= zero_threshold)
    gap = none | zero
    r, c = F.when(gap, F.col("row")), F.when(gap, F.col("col"))
    return dem.groupBy(*keys).agg(
        F.count_if(none).alias("n_nodata"), F.count_if(zero).alias("n_zero"), F.count_if(gap).alias("n_gaps"), F.count(F.lit(1)).alias("n_pixels"),
        F.min(r).alias("min_row"), F.max(r).alias("max_row"), F.min(c).alias("min_col"), F.max(c).alias("max_col"),
    )


def window_slice(mask: DataFrame, row0: int, col0: int, height: int, width: int, value: str = "flat") -> DataFrame:
    """A window of a mask that may reach beyond it; zero outside.  row, col are the window's."""
    spark = mask.sparkSession
    grid = spark.range(height * width).select((F.floor(F.col("id") / width)).cast("int").alias("row"), (F.col("id") % width).cast("int").alias("col"))
    inside = crop(mask.select("row", "col", value), row0, row0 + height, col0, col0 + width)
    return grid.join(inside, ["row", "col"], "left").withColumn(value, F.coalesce(value, F.lit(0)))


def difference(after: DataFrame, before: DataFrame, keys: Keys = ()) -> DataFrame:
    """keys, row, col, change of every cell of both rasters."""
    b = before.select(*keys, "row", "col", F.col("value").alias("was"))
    return after.join(b, [*keys, "row", "col"]).select(*keys, "row", "col", (F.col("value") - F.col("was")).alias("change"))
