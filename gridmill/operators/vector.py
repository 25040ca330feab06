"""Polygons: features, bounding boxes, scanline rasterising and Morton order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import rules as R
from ..sources.rasters import stored

Keys = Sequence[str]
RINGS = "array<array<array<double>>>"
FEATURE = f"type string, geometry struct<type: string, coordinates: string>, properties map<string, string>"  # noqa: F541


def parse_features(raw: DataFrame, column: str = "feature") -> DataFrame:
    """Feature texts to rows (…, part, rings, name, ftype): one row for each polygon part.

    Property names are matched without regard to case; a quoted number is a number; features without
    geometry and parts of other kinds go.
    """
    got = raw.withColumn("f", F.from_json(column, FEATURE)).withColumn("p", F.transform_keys("f.properties", lambda k, _: F.lower(k)))
    kind = F.col("f.geometry.type")
    text = F.col("f.geometry.coordinates")
    parts = F.when(kind == "Polygon", F.array(F.from_json(text, RINGS))).when(kind == "MultiPolygon", F.from_json(text, f"array<{RINGS}>"))
    got = got.select(*[c for c in raw.columns if c != column], F.coalesce(F.col("p")["gnis_name"], F.col("p")["name"]).alias("name"), F.col("p")["ftype"].try_cast("int").alias("ftype"), F.posexplode(parts).alias("part", "rings"))
    return got


def still_water(features: DataFrame) -> DataFrame:
    return features.filter(R.is_still_water(F.col("ftype")))


def ring_box(ring: Column) -> Column:
    """struct(x0, y0, x1, y1) of a ring of [x, y] points."""
    x, y = F.transform(ring, lambda p: p[0]), F.transform(ring, lambda p: p[1])
    return F.struct(F.array_min(x).alias("x0"), F.array_min(y).alias("y0"), F.array_max(x).alias("x1"), F.array_max(y).alias("y1"))


def overlapping(polygons: DataFrame, x0: float, y0: float, x1: float, y1: float, rings: str = "rings") -> DataFrame:
    """Polygons whose outer ring's box overlaps the given one; boxes that touch are kept."""
    b = ring_box(F.col(rings)[0])
    return polygons.filter((b["x0"] <= x1) & (b["x1"] >= x0) & (b["y0"] <= y1) & (b["y1"] >= y0))


def edges(polygons: DataFrame, pid: str = "pid", rings: str = "rings", keys: Keys = ()) -> DataFrame:
    """(keys, pid, x1, y1, x2, y2) of all rings, holes too, closed if they aren't."""
    ring = polygons.select(*keys, pid, F.explode(rings).alias("r")).filter(F.size("r") >= 3)
    # The last of ring + first point pairs every point with its successor.
    pairs = F.arrays_zip(F.col("r").alias("a"), F.concat(F.slice("r", 2, F.size("r") - 1), F.slice("r", 1, 1)).alias("b"))
    e = ring.select(*keys, pid, F.explode(pairs).alias("e"))
    return e.select(*keys, pid, *[F.col(f"e.{p}")[i].alias(f"{n}{k}") for k, p in ((1, "a"), (2, "b")) for i, n in ((0, "x"), (1, "y"))]).filter("x1 <> x2 OR y1 <> y2")


def rasterize(edge: DataFrame, height: int, width: int, pid: str = "pid", keys: Keys = ()) -> DataFrame:
    """(keys, pid, row, col) of pixels whose centres are inside, by even-odd scanlines.

    An edge crosses the centre lines y = row + 0.5 with y_low <= y < y_high; crossings of a line are
    paired in order of x, and each pair is exploded to its columns.  No pixel is tested that isn't hit.
    """
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    r0, r1 = F.greatest(F.ceil(low - 0.5), F.lit(0)).cast("int"), F.least(F.ceil(high - 0.5) - 1, F.lit(height - 1)).cast("int")
    e = edge.withColumn("r0", r0).withColumn("r1", r1).filter("r0 <= r1").withColumn("row", F.explode(F.sequence("r0", "r1")))
    x = F.col("x1") + (F.col("row") + 0.5 - F.col("y1")) * (F.col("x2") - F.col("x1")) / (F.col("y2") - F.col("y1"))
    order = W.partitionBy(*keys, pid, "row").orderBy("x")
    c = e.select(*keys, pid, "row", x.alias("x")).withColumn("k", F.row_number().over(order)).withColumn("next", F.lead("x").over(order)).filter("k % 2 = 1")
    c0, c1 = F.greatest(F.ceil(F.col("x") - 0.5), F.lit(0)).cast("int"), F.least(F.ceil(F.col("next") - 0.5) - 1, F.lit(width - 1)).cast("int")
    return c.withColumn("c0", c0).withColumn("c1", c1).filter("c0 <= c1").select(*keys, pid, "row", F.explode(F.sequence("c0", "c1")).alias("col"))


def label_cells(cells: DataFrame, label: Column, keys: Keys = ()) -> DataFrame:
    """(keys, row, col, label): the greatest label of each cell."""
    return cells.groupBy(*keys, "row", "col").agg(F.max(label).alias("label"))


def reaches_out(rings: Column, height: int, width: int) -> Column:
    """Whether any vertex lies outside the raster: the body goes on in a neighbouring tile."""
    return F.exists(rings, lambda r: F.exists(r, lambda p: (p[0] < 0) | (p[0] > width) | (p[1] < 0) | (p[1] > height)))


def spread_bits(x: Column) -> Column:
    """The low 16 bits of ``x`` at the even places of a number."""
    v = x.bitwiseAND(F.lit(0xFFFF)).cast("long")
    for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
        v = v.bitwiseOR(F.shiftleft(v, shift)).bitwiseAND(F.lit(mask).cast("long"))
    return v


def morton(x: Column, y: Column) -> Column:
    """Interleaved code: ``x`` at even, ``y`` at odd bits."""
    return spread_bits(x).bitwiseOR(F.shiftleft(spread_bits(y), 1))


def morton_order(centres: DataFrame, lat: str = "lat", lng: str = "lng") -> DataFrame:
    """``centres`` with ``code``: both axes quantised to 16 bits over the extent of all rows.

    The extent is one row, joined back; sorting by (code, lat, lng) or range-partitioning by code is the
    caller's choice of layout.
    """
    box = centres.agg(*(f(c).alias(f"{n}_{c}") for c in (lat, lng) for n, f in (("lo", F.min), ("hi", F.max))))

    def quantised(c: str) -> Column:
        span = F.greatest(F.col(f"hi_{c}") - F.col(f"lo_{c}"), F.lit(1e-9))
        return F.least(F.greatest(((F.col(c) - F.col(f"lo_{c}")) / span * 65535).cast("int"), F.lit(0)), F.lit(65535))

    got = centres.crossJoin(F.broadcast(box)).withColumn("code", morton(quantised(lat), quantised(lng)))
    return got.drop(*[f"{n}_{c}" for c in (lat, lng) for n in ("lo", "hi")])


def numbered(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """``rows`` with ``n``, their place from 0 in the order of columns that make rows distinct.

    Rows are range-partitioned and numbered within their partition; the sizes of the partitions before,
    one number each, are added.  No task sees all rows.
    """
    spread = stored(rows.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "numbered")
    sizes = [(r.part, r["count"]) for r in spread.groupBy("part").count().collect()]
    before, total = [], 0
    for part, n in sorted(sizes):
        before.append((part, total))
        total += n
    offsets = rows.sparkSession.createDataFrame(before, "part int, before long")
    own = F.row_number().over(W.partitionBy("part").orderBy(*order)) - 1
    return spread.withColumn("n", own).join(F.broadcast(offsets), "part").withColumn("n", (F.col("n") + F.col("before")).cast("long")).drop("part", "before")


def batches(rows: DataFrame, size: int, order: Sequence[str]) -> DataFrame:
    """``batch`` number of consecutive slices of ``size`` rows."""
    return numbered(rows, order).withColumn("batch", F.floor(F.col("n") / size).cast("int")).drop("n")


def chunks(rows: DataFrame, many: int, order: Sequence[str]) -> DataFrame:
    """``chunk`` number of at most ``many`` slices of equal size, rounded up."""
    size = max(1, -(-rows.count() // many))
    return numbered(rows, order).withColumn("chunk", F.floor(F.col("n") / size).cast("int")).drop("n")
