"""Command line: ``python -m gridmill COMMAND ...`` over Parquet rasters."""

from __future__ import annotations

import argparse
import json
import sys
from datetime import datetime, timezone


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="gridmill", description=__doc__)
    sub = p.add_subparsers(dest="command", required=True)
    a = sub.add_parser("cover", help="tiles that cover a bounding box")
    a.add_argument("south", type=float), a.add_argument("west", type=float), a.add_argument("north", type=float), a.add_argument("east", type=float)
    a = sub.add_parser("mosaic", help="merge tiles of a raster between two corner tiles")
    a.add_argument("raster"), a.add_argument("corner1"), a.add_argument("corner2"), a.add_argument("out")
    a.add_argument("--per-degree", type=int, default=10_800), a.add_argument("--max-tiles", type=int, default=25)
    a = sub.add_parser("flat", help="flat and boundary masks of one tile")
    a.add_argument("raster"), a.add_argument("tile"), a.add_argument("out"), a.add_argument("--size", type=int, default=10_800)
    a = sub.add_parser("gaps", help="gap statistics of every tile")
    a.add_argument("raster"), a.add_argument("--nodata", type=float, default=-9999.0)
    a = sub.add_parser("registry", help="totals of a registry file")
    a.add_argument("path")
    a = sub.add_parser("build", help="build one tile of a raster under the registry of a folder")
    a.add_argument("raster"), a.add_argument("tile"), a.add_argument("root"), a.add_argument("--fallback"), a.add_argument("--polygons", help="table with tile_id, pid, rings")
    a.add_argument("--size", type=int, default=10_800), a.add_argument("--cap-gb", type=float, default=500.0), a.add_argument("--policy", choices=("hard", "warn", "lru"), default="hard")
    a.add_argument("--rebuild", action="store_true")
    a = sub.add_parser("correct", help="level still water in all tiles of a raster")
    a.add_argument("raster"), a.add_argument("polygons"), a.add_argument("out"), a.add_argument("--size", type=int, default=10_800)
    a = sub.add_parser("preview", help="number of polygons and the first of them")
    a.add_argument("polygons"), a.add_argument("-n", type=int, default=20)
    a = sub.add_parser("index", help="which files of a folder have a corrected form in another")
    a.add_argument("raw"), a.add_argument("corrected")
    a = sub.add_parser("repair", help="fill the gaps of a raster from another one")
    a.add_argument("raster"), a.add_argument("other"), a.add_argument("--size", type=int, default=10_800), a.add_argument("--dry-run", action="store_true")
    a = sub.add_parser("report", help="tables of a built tile's report")
    a.add_argument("folder"), a.add_argument("out")
    a = sub.add_parser("plan", help="addresses that a study area's download would try")
    a.add_argument("name"), a.add_argument("corner1"), a.add_argument("corner2"), a.add_argument("--resolution", default="best")
    a = sub.add_parser("prune", help="delete all failed tiles of a folder")
    a.add_argument("root")
    args = p.parse_args(argv)

    from pyspark.sql import SparkSession
    from pyspark.sql import functions as F

    from .functions import rules as R
    from .operators import cover, focal, registry, resample
    from .plans import pipelines
    from .sources import rasters

    now = datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    spark = SparkSession.builder.appName("gridmill").getOrCreate()
    if args.command == "cover":
        box = spark.createDataFrame([(args.south, args.west, args.north, args.east)], "south double, west double, north double, east double")
        print("\n".join(r.tile_id for r in cover.bbox_tiles(box).orderBy("lat_floor", "lng_floor").collect()))
    elif args.command == "mosaic":
        area = cover.study_area(spark, "area", args.corner1, args.corner2, max_tiles=args.max_tiles).first()
        got = pipelines.mosaic(rasters.read_pixels(spark, args.raster), area.south, area.west, area.north, area.east, args.per_degree)
        got.write.mode("overwrite").parquet(args.out)
    elif args.command == "flat":
        dem = rasters.read_pixels(spark, args.raster, [args.tile])
        focal.boundary_mask(focal.flat_mask(dem, R.zero_filled(F.col("value").cast("double")), args.size, args.size)).write.mode("overwrite").parquet(args.out)
    elif args.command == "gaps":
        for r in resample.gap_stats(rasters.read_pixels(spark, args.raster), F.col("value"), args.nodata, ["tile_id"]).orderBy("tile_id").toLocalIterator():
            print(json.dumps(r.asDict()))
    elif args.command == "registry":
        print(json.dumps(registry.totals(rasters.read_registry(spark, args.path)).first().asDict()))
    elif args.command == "build":
        mine = lambda path: rasters.read_pixels(spark, path, [args.tile]).select("row", "col", "value") if path else None
        polygons = spark.read.parquet(args.polygons).filter(F.col("tile_id") == args.tile) if args.polygons else None
        make = lambda out: pipelines.build_tile(spark, args.tile, mine(args.raster), out, args.size, args.size, mine(args.fallback), polygons)
        got = pipelines.build_registered(spark, args.root, args.tile, make, now, cap_gb=args.cap_gb, policy=args.policy, skip_if_ready=not args.rebuild)
        print(json.dumps({"tile_id": got.tile_id, "success": got.success, "steps": [vars(x) for x in got.steps]}, default=str))
        return 0 if got.success else 1
    elif args.command == "correct":
        for r in pipelines.correct_all(spark, args.raster, args.out, spark.read.parquet(args.polygons), args.size, args.size).orderBy("tile_id").toLocalIterator():
            print(json.dumps(r.asDict()))
    elif args.command == "preview":
        n, first = pipelines.preview(spark.read.parquet(args.polygons), args.n)
        print(json.dumps({"polygons": n, "first": [r.pid for r in first.collect()]}))
    elif args.command == "index":
        for r in pipelines.tile_index(rasters.list_files(spark, args.raw), rasters.list_files(spark, args.corrected)).orderBy("name").toLocalIterator():
            print(json.dumps(r.asDict()))
    elif args.command == "repair":
        status, n = pipelines.repair_stored(spark, args.raster, lambda: spark.read.parquet(args.other), args.size, args.size, dry_run=args.dry_run)
        print(json.dumps({"status": status, **n}))
    elif args.command == "report":
        has = lambda x: spark.read.parquet(f"{args.folder}/{x}") if rasters.exists(spark, f"{args.folder}/{x}") else None
        judged = spark.read.json(f"{args.folder}/water") if rasters.exists(spark, f"{args.folder}/water") else None
        for name, table in pipelines.report(has("filled"), has("flat"), judged, has("dem")).items():
            table.write.mode("overwrite").json(f"{args.out}/{name}")
    elif args.command == "plan":
        for r in pipelines.download_study_area(spark, args.name, args.corner1, args.corner2, "", resolution=args.resolution, dry_run=True).orderBy("tile_id").collect():
            print(json.dumps({"tile_id": r.tile_id, "candidates": r.candidates}))
    elif args.command == "prune":
        print(json.dumps(pipelines.prune_failed(spark, args.root, now)))
    return 0


if __name__ == "__main__":
    sys.exit(main())
