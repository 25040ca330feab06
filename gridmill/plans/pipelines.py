"""Composite pipelines: tile builds, mosaics, corrections and repairs over Parquet rasters.

A pipeline chains the operators' DataFrames, writes what is to be kept, and collects one-row statistics
for its gates; pixels never reach the driver.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import rules as R
from ..operators import checks, cover, fetch, focal, registry, resample, stats, vector, water
from ..sources import rasters


@dataclass
class Step:
    name: str
    success: bool
    detail: dict = field(default_factory=dict)
    error: str | None = None


@dataclass
class Build:
    tile_id: str
    success: bool = True
    steps: list[Step] = field(default_factory=list)

    def add(self, name: str, error: str | None = None, **detail) -> bool:
        self.steps.append(Step(name, error is None, detail, error))
        self.success = self.success and error is None
        return error is None


def polygon_cells(polygons: DataFrame, height: int, width: int, keys: tuple[str, ...] = ()) -> DataFrame:
    """Label cells of still water (keys, pid, rings), stored: overlaps go to the greatest label."""
    cells = vector.rasterize(vector.edges(polygons, keys=keys), height, width, keys=keys)
    return rasters.stored(vector.label_cells(cells, F.col("pid") + 1, keys), "cells")


def correct(dem: DataFrame, polygons: DataFrame, height: int, width: int, ocean: DataFrame | None = None, buffer: int = 3, percentile: float = 0.1, least_pixels: int = 12, unit: int = 1) -> tuple[DataFrame, DataFrame]:
    """Flatten still water: (corrected raster, one judged row a body).

    Cells of explicit ocean polygons become 0 first and are shoreline samples for lakes beside them.
    Cells and judgements are stored, as both are read again.
    """
    if ocean is not None:
        dem = water.zero_ocean(dem, vector.rasterize(vector.edges(ocean), height, width))
    cells = polygon_cells(polygons, height, width)
    judged = rasters.stored(water.judge(water.measure(dem, cells, height, width, buffer, percentile, unit), least_pixels, 10.0 * unit, 2.5 * unit), "judged")
    return water.apply(dem, cells, judged), judged


def correction_summary(judged: DataFrame, n_polygons: int) -> DataFrame:
    """One row that adds up: polygons = no_pixels + too_small + no_samples + flagged + corrected."""
    kinds = ("too_small", "no_samples", "flagged", "corrected")
    got = judged.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.col("status") == k).alias(k) for k in kinds], F.count_if("low_confidence").alias("low_confidence"))
    return got.select(F.lit(n_polygons).alias("polygons"), (n_polygons - F.col("n")).alias("no_pixels"), *kinds, "low_confidence")


def build_tile(
    spark: SparkSession, tile_id: str, raw: DataFrame, out: str, height: int, width: int, fallback: DataFrame | None = None, polygons: DataFrame | None = None,
    header: DataFrame | None = None, ocean: bool = False, nodata: float = R.NODATA, unit: int = 1,
) -> Build:
    """Crop and fill, correct water, mask flat ground and its boundary; a step that fails ends the build.

    ``raw`` and ``fallback`` are pixel rows (row, col, value) on the tile's grid.  Rasters go to
    ``out``/dem, /flat; the step log is returned and written as ``out``/meta.json.
    """
    b = Build(tile_id)
    path = out.rstrip("/")

    def finish() -> Build:
        meta = {"tile_id": tile_id, "success": b.success, "steps": [vars(s) for s in b.steps]}
        rasters.replace_text(spark, f"{path}/meta.json", json.dumps(meta, default=str, sort_keys=True))
        return b

    if header is not None:
        row = checks.validate_headers(header, width).first()
        refused = header.select(checks.crs_gate(F.col("crs")).alias("why")).first().why if "crs" in header.columns else None
        if not b.add("download", refused or (None if row.ok else row.reason)):
            return finish()
    dem = resample.crop(raw.select("row", "col", "value"), 0, height, 0, width)
    if fallback is not None:
        dem = resample.fill_gaps(dem, fallback, R.is_gap(F.col("value"), nodata)).drop("filled")
    dem.write.mode("overwrite").parquet(f"{path}/filled")
    dem = spark.read.parquet(f"{path}/filled")
    size = dem.agg(F.count(F.lit(1)).alias("n"), F.count_if(R.is_gap(F.col("value"), nodata)).alias("gaps")).first()
    if not b.add("crop_and_fill", None if size.n == height * width else f"{size.n} pixels of {height * width}", gaps=size.gaps):
        return finish()
    if polygons is not None:
        still = polygons.filter(R.is_still_water(F.col("ftype"))) if "ftype" in polygons.columns else polygons
        diagnosis = water.diagnostics(dem, vector.rasterize(vector.edges(still), height, width), unit, nodata)
        flagged = diagnosis.filter("flagged").count()
        dem, judged = correct(dem, still, height, width, unit=unit)
        judged.write.mode("overwrite").json(f"{path}/water")
        b.add("water", None, **correction_summary(spark.read.schema(judged.schema).json(f"{path}/water"), still.count()).first().asDict(), diagnosed=flagged)
    dem.write.mode("overwrite").parquet(f"{path}/dem")
    dem = spark.read.parquet(f"{path}/dem")
    flat = focal.flat_mask(dem, R.zero_filled(F.col("value"), nodata), height, width, 5, 4.0 * unit * unit)
    focal.boundary_mask(flat).write.mode("overwrite").parquet(f"{path}/flat")
    masks = spark.read.parquet(f"{path}/flat")
    s = stats.flat_stats(masks, dem, F.col("value"), R.has_elevation(F.col("value"), nodata))
    s = s.withColumn("why", checks.flat_gate(F.col("flat_pct"), F.col("elev_range") / unit, F.lit(ocean))).first()
    if not b.add("flat_mask", s.why, flat_pct=s.flat_pct, elev_range=s.elev_range):
        return finish()
    e = stats.boundary_stats(masks)
    e = e.withColumn("why", checks.boundary_gate(F.col("boundary_cells"), F.col("flat_cells"))).first()
    b.add("boundary_mask", e.why, boundary_pct=e.boundary_pct, reduction_pct=e.reduction_pct)
    return finish()


def build_registered(
    spark: SparkSession, root: str, tile_id: str, make: Callable[[str], Build], now: str, estimate_mb: float = 250.0, cap_gb: float = 500.0, policy: str = "hard",
    protected: tuple[str, ...] = (), skip_if_ready: bool = True,
) -> Build:
    """Run ``make(folder)`` under the registry of ``root``; returns its build with the registry's steps.

    A tile that is ready is skipped.  Where the tile doesn't fit the cap, ``hard`` refuses, ``warn`` goes on
    and ``lru`` deletes ready tiles, least recently used first, but neither ``protected`` ones nor itself.
    The tile is pending while it is built, then ready with its size, or failed with the reason.
    """
    path, folder = f"{root}/registry.json", f"{root}/tiles/{tile_id}"
    state = rasters.read_registry(spark, path)
    state = spark.createDataFrame(state.collect(), state.schema)  # one row a tile of the globe at most
    held = state.filter(F.col("tile_id") == tile_id).first()
    b = Build(tile_id)
    if skip_if_ready and held is not None and held.status == "ready":
        b.add("skipped", None, reason="ready")
        return b
    cap = cap_gb * 1024
    keep = spark.createDataFrame([(t,) for t in {*protected, tile_id}], "tile_id string")
    used = registry.totals(state).first().total_size_mb
    gone = registry.evictions(state, used + estimate_mb - cap, ["tile_id"], keep, age="last_accessed_utc") if policy == "lru" else None
    room = registry.capacity(state, estimate_mb, cap, policy, gone).first() if not state.isEmpty() else None
    allowed = room.allowed if room is not None else policy == "warn" or estimate_mb <= cap
    evicted = [r.tile_id for r in gone.collect()] if policy == "lru" and room is not None and not room.fits and allowed else []
    fail = lambda why: rasters.update_registry(spark, path, lambda s: rasters.with_entry(s, tile_id, "failed", now, failed_reason=why), now)
    if not b.add("capacity", None if allowed else f"{used:g} MB used and {estimate_mb:g} MB needed of {cap:g}", evicted=evicted, warning=bool(room is not None and room.warning)):
        fail(b.steps[-1].error)
        return b
    for t in evicted:
        rasters.delete(spark, f"{root}/tiles/{t}")

    def pending(s: DataFrame) -> DataFrame:
        return rasters.with_entry(s.filter(~F.col("tile_id").isin(evicted)) if evicted else s, tile_id, "pending", now)

    rasters.update_registry(spark, path, pending, now)
    made = make(folder)
    b.steps += made.steps
    b.success = made.success
    if not b.success:
        fail(next((x.error for x in b.steps if x.error), "failed"))
        return b
    size = rasters.directory_mb(rasters.list_files(spark, folder, "*")).first().mb
    files = {"tile_dir": f"tiles/{tile_id}", "dem_file": f"tiles/{tile_id}/dem", "flat_file": f"tiles/{tile_id}/flat", "boundary_file": f"tiles/{tile_id}/flat", "meta_file": f"tiles/{tile_id}/meta.json"}
    rasters.update_registry(spark, path, lambda s: rasters.with_entry(s, tile_id, "ready", now, size_mb=float(size), **files), now)
    return b


def prune_failed(spark: SparkSession, root: str, now: str) -> list[str]:
    """Delete the files and rows of all failed tiles; returns their names."""
    path = f"{root}/registry.json"
    names = sorted(r.tile_id for r in rasters.read_registry(spark, path).filter("status = 'failed'").collect())
    for t in names:
        rasters.delete(spark, f"{root}/tiles/{t}")
    rasters.update_registry(spark, path, registry.prune_failed, now)
    return names


def mosaic(tiles: DataFrame, south: float, west: float, north: float, east: float, per_degree: int | dict[str, int], nodata: float = R.NODATA, order: tuple[str, ...] = ("tile_id",)) -> DataFrame:
    """Tiles (tile_id, resolution, row, col, value) merged finest first on the area's own grid.

    ``per_degree`` has the pixels of a degree, or those of each resolution: coarser tiles are then brought
    to the finest grid (bilinear, by whole factors) first.  Rows count from the area's north edge, columns
    from its west edge; the tile filter prunes partitions of a raster written by tile.
    """
    area = tiles.sparkSession.createDataFrame([(south, west, north, east)], "south double, west double, north double, east double")
    need = cover.bbox_tiles(area).select("tile_id", "lat_floor", "lng_floor")
    near = tiles.join(F.broadcast(need), "tile_id")  # at most the tiles of one area
    fine = per_degree if isinstance(per_degree, int) else max(per_degree.values())
    keys = list(dict.fromkeys(["tile_id", "resolution", "lat_floor", "lng_floor", *order]))
    if not isinstance(per_degree, int):
        parts = []
        for resolution, n in sorted(per_degree.items()):
            if fine % n:
                raise ValueError(f"{resolution}: {fine} is no multiple of {n}")
            own = near.filter(F.col("resolution") == resolution)
            if n < fine:
                own = resample.bilinear(own, fine // n, n, n, F.when(R.has_elevation(F.col("value"), nodata), F.col("value").cast("double")), keys).withColumn("value", F.col("num") / F.col("den"))
            parts.append(own.select(*keys, "row", "col", F.col("value").cast("double").alias("value")))
        near = parts[0]
        for p in parts[1:]:
            near = near.unionByName(p)
    row = F.round((north - F.col("lat_floor") - 1) * fine) + F.col("row")
    col = F.round((F.col("lng_floor") - west) * fine) + F.col("col")
    placed = near.select("resolution", *order, row.cast("int").alias("row"), col.cast("int").alias("col"), "value")
    inside = placed.filter(F.col("row").between(0, round((north - south) * fine) - 1) & F.col("col").between(0, round((east - west) * fine) - 1))
    return resample.mosaic(inside, nodata, order)


def build_mosaic(tiles: DataFrame, south: float, west: float, north: float, east: float, out: str, per_degree: int, polygons: DataFrame | None = None, buffer_deg: float = 0.1, nodata: float = R.NODATA, unit: int = 1) -> DataFrame:
    """The area's mosaic, with still water levelled, written to ``out`` and read again.

    ``polygons`` (pid, rings) are in pixels of the area grown by the buffer, which gives bodies at the edge
    their shoreline and is cut off afterwards.
    """
    pad = round(buffer_deg * per_degree)
    grow = pad / per_degree
    height, width = round((north - south) * per_degree), round((east - west) * per_degree)
    dem = mosaic(tiles, south - grow, west - grow, north + grow, east + grow, per_degree, nodata)
    if polygons is not None:
        dem, _ = correct(rasters.stored(dem, "mosaic"), polygons, height + 2 * pad, width + 2 * pad, unit=unit)
    resample.crop(dem, pad, pad + height, pad, pad + width).write.mode("overwrite").parquet(out)
    return dem.sparkSession.read.parquet(out)


def repair(dem: DataFrame, fetch: Callable[[], DataFrame], nodata: float = R.NODATA, dry_run: bool = False) -> tuple[str, DataFrame, dict]:
    """(status, raster, counts): no_gaps, dry_run or repaired.  ``fetch`` is only called if there are gaps."""
    before = resample.gap_stats(dem, F.col("value"), nodata).first()
    if before is None or not before.n_gaps:
        return "no_gaps", dem, {"before": 0, "after": 0}
    if dry_run:
        return "dry_run", dem, {"before": before.n_gaps, "after": before.n_gaps}
    filled = resample.fill_gaps(dem, fetch(), R.is_gap(F.col("value"), nodata)).drop("filled")
    after = resample.gap_stats(filled, F.col("value"), nodata).first()
    return "repaired", filled, {"before": before.n_gaps, "after": after.n_gaps}


def repair_stored(
    spark: SparkSession, path: str, fetch: Callable[[], DataFrame], height: int, width: int, polygons: DataFrame | None = None, nodata: float = R.NODATA, dry_run: bool = False, unit: int = 1,
) -> tuple[str, dict]:
    """Repair the raster at ``path`` in place: (status, counts).

    The raster as it was stays as ``path``.bak (the first one for good); the result is written beside it,
    with still water levelled, and takes the name once it is whole.
    """
    status, filled, n = repair(spark.read.parquet(path), fetch, nodata, dry_run)
    if status != "repaired":
        return status, n
    if polygons is not None:
        filled, judged = correct(rasters.stored(filled, "repaired"), polygons, height, width, unit=unit)
        n["water"] = correction_summary(judged, polygons.count()).first().asDict()
    filled.write.mode("overwrite").parquet(f"{path}.new")
    if rasters.exists(spark, f"{path}.bak"):
        rasters.delete(spark, path)
    else:
        rasters.rename(spark, path, f"{path}.bak")
    rasters.rename(spark, f"{path}.new", path)
    return status, n


def correct_keyed(dem: DataFrame, polygons: DataFrame, height: int, width: int, keys: tuple[str, ...] = ("tile_id",), unit: int = 1) -> tuple[DataFrame, DataFrame]:
    """Flatten still water of many rasters in one plan: (corrected rasters, one judged row a raster and body)."""
    cells = polygon_cells(polygons, height, width, keys)
    judged = rasters.stored(water.judge(water.measure(dem, cells, height, width, unit=unit, keys=keys), 12, 10.0 * unit, 2.5 * unit), "judged")
    return water.apply(dem, cells, judged, keys), judged


def correct_all(spark: SparkSession, path: str, out: str, polygons: DataFrame, height: int, width: int, unit: int = 1) -> DataFrame:
    """Correct every tile of a raster written by tile that ``out`` doesn't have yet; returns the summary by tile.

    ``polygons``: (tile_id, pid, rings) in each tile's pixels.  One plan works on all tiles.
    """
    dem = spark.read.parquet(path).select("tile_id", "row", "col", "value")
    if rasters.exists(spark, out):
        dem = dem.join(F.broadcast(spark.read.parquet(out).select("tile_id").distinct()), "tile_id", "left_anti")  # a name for each tile of the globe at most
    names = dem.select("tile_id").distinct()
    mine = polygons.join(names, "tile_id", "left_semi")
    fixed, judged = correct_keyed(dem, mine, height, width, unit=unit)
    summary = rasters.stored(keyed_summary(names, judged, mine), "summary")
    fixed.repartition("tile_id").sortWithinPartitions("tile_id", "row", "col").write.mode("append").partitionBy("tile_id").parquet(out)
    return summary


def keyed_summary(names: DataFrame, judged: DataFrame, polygons: DataFrame) -> DataFrame:
    """tile_id, polygons, no_pixels and the number of bodies of each status."""
    kinds = ("too_small", "no_samples", "flagged", "corrected")
    got = judged.groupBy("tile_id").agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.col("status") == k).alias(k) for k in kinds], F.count_if("low_confidence").alias("low_confidence"))
    many = polygons.groupBy("tile_id").agg(F.count(F.lit(1)).alias("polygons"))
    both = names.join(many, "tile_id", "left").join(got, "tile_id", "left").fillna(0)
    return both.select("tile_id", "polygons", (F.col("polygons") - F.col("n")).alias("no_pixels"), *kinds, "low_confidence")


def download_study_area(spark: SparkSession, name: str, corner1: str, corner2: str, out: str, transport: Callable[[str], bytes | None] | None = None, resolution: str = "best", dry_run: bool = False, max_tiles: int = cover.MAX_TILES) -> DataFrame:
    """Fetch the tiles between two corner tiles by ``transport`` (address -> bytes, or None if not there).

    One row a tile: tile_id, candidates, label, status (planned, fetched, missing), bytes, path, sha256.
    Dry runs only list.  Otherwise the rows are also written as ``out``/manifest.json.
    """
    area = cover.study_area(spark, name, corner1, corner2, resolution, max_tiles)
    plan = fetch.attempts(cover.bbox_tiles(area.select("south", "west", "north", "east")).drop("south", "west", "north", "east"), F.lit(resolution))
    if dry_run or transport is None:
        return plan.select("tile_id", F.transform("attempts", lambda a: a["label"]).alias("candidates"), F.lit(None).cast("string").alias("label"), F.lit("planned").alias("status"), *[F.lit(None).cast(k).alias(c) for c, k in (("bytes", "long"), ("path", "string"), ("sha256", "string"))])
    got = rasters.stored(fetch.download(plan, transport, f"{out}/tiles"), "manifest")
    tiles = [r.asDict() for r in got.orderBy("tile_id").collect()]  # max_tiles rows at most
    rasters.replace_text(spark, f"{out}/manifest.json", json.dumps({"name": name, "resolution": resolution, "tiles": tiles}, indent=2, sort_keys=True))
    return got


def preview(polygons: DataFrame, n: int = 20) -> tuple[int, DataFrame]:
    return polygons.count(), polygons.orderBy("pid").limit(n)


def tile_index(raw: DataFrame, corrected: DataFrame) -> DataFrame:
    """Which tiles exist raw and corrected: (name, raw_path, corrected_path, corrected)."""
    name = F.regexp_extract("path", r"([^/]+?)(_corrected)?\.tiff?$", 1)
    a = raw.select(name.alias("name"), F.col("path").alias("raw_path"))
    b = corrected.select(name.alias("name"), F.col("path").alias("corrected_path"))
    return a.join(b, "name", "left").withColumn("corrected", F.col("corrected_path").isNotNull())


def report(dem: DataFrame, masks: DataFrame | None = None, judged: DataFrame | None = None, after: DataFrame | None = None, gaps: DataFrame | None = None, nodata: float = R.NODATA) -> dict[str, DataFrame]:
    """The tables behind a tile's report panels; a panel is there if what it shows is."""
    out = {"relief": focal.hillshade(dem, F.col("value")), "void": stats.coverage_share(dem, R.is_gap(F.col("value"), nodata))}
    if gaps is not None:
        out["filled"] = stats.coverage_share(gaps, F.col("gap") == 1)
    if masks is not None:
        out |= {k: stats.coverage_share(masks, F.col(k) == 1) for k in ("flat", "boundary")}
    if after is not None:
        out["changed"] = stats.coverage_share(resample.difference(after, dem), F.col("change") != 0)
    if judged is not None:
        done = judged.filter("status = 'corrected'")
        out |= {"histogram": stats.histogram(done, "change"), "largest": stats.top_changes(done, 10)}
    return out
