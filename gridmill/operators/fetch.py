"""Choosing among sources and fetching tiles; the transport (address -> bytes) is the caller's."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions import urls
from ..sources import rasters


def first_available(attempts: DataFrame, keys: Sequence[str], rank: str, ok: Column, fallback: Column) -> DataFrame:
    """(keys, label): of each tile's attempts (…, rank, label) the first that is ok, else the fallback.

    One aggregation with partial minima; ``fallback`` is an expression over the keys.
    """
    best = attempts.groupBy(*keys).agg(F.min(F.when(ok, F.struct(rank, "label"))).alias("b"))
    return best.select(*keys, F.coalesce("b.label", fallback).alias("label"))


def all_ocean(samples: DataFrame, keys: Sequence[str], ocean: Column) -> DataFrame:
    """(keys, ocean): whether every sample of a tile is ocean."""
    return samples.groupBy(*keys).agg(F.bool_and(ocean).alias("ocean"))


def constant_tile(spark: SparkSession, size: int, value: float = 0.0) -> DataFrame:
    """Pixel rows of one value, such as a tile of open sea."""
    return spark.range(size * size).select((F.col("id") / size).cast("int").alias("row"), (F.col("id") % size).cast("int").alias("col"), F.lit(value).cast("float").alias("value"))


def cache_evictions(files: DataFrame, cap_mb: float, keys: Sequence[str], keep: Column | None = None, size: str = "mb", age: str = "modified") -> DataFrame:
    """Oldest files to delete until the rest fits the cap; files that ``keep`` names stay but count.

    A cache directory holds at most a file for each tile and source, so the running sum is bounded.
    """
    total = files.agg(F.coalesce(F.sum(size), F.lit(0)).alias("total"))
    able = files.filter(~keep) if keep is not None else files
    before = W.partitionBy(F.lit(0)).orderBy(F.col(age).asc_nulls_first(), *keys).rowsBetween(W.unboundedPreceding, -1)
    freed = able.withColumn("freed_before", F.coalesce(F.sum(size).over(before), F.lit(0)))
    return freed.crossJoin(F.broadcast(total)).filter(F.col("total") - F.col("freed_before") > cap_mb).drop("total")


def attempts(tiles: DataFrame, resolution: Column) -> DataFrame:
    """``tiles`` (lat_floor, lng_floor) with ``attempts``: label and address of each candidate, best first."""
    address = lambda label: F.when(label == "10m", urls.ten_metre(F.col("lat_floor"), F.col("lng_floor"))).otherwise(urls.thirty_metre(F.col("lat_floor"), F.col("lng_floor")))
    each = F.transform(R.candidates(F.col("lat_floor"), F.col("lng_floor"), resolution), lambda x: F.struct(x.alias("label"), address(x).alias("url")))
    return tiles.withColumn("attempts", each)


def download(tiles: DataFrame, transport: Callable[[str], bytes | None], folder: str, least_bytes: int = 10_000, tries: int = 3, check: Callable[[bytes], bool] | None = None) -> DataFrame:
    """Fetch each tile's first candidate that is there and sound: one row a tile, files in ``folder``.

    tile_id, candidates, label, status (fetched, missing), bytes, path, sha256.  A transport that raises is
    asked again ``tries`` times; too few bytes or bytes that ``check`` refuses (by default: not a readable
    GeoTIFF) count as missing.  Each tile is a task's work of its own.
    """
    names = ["tile_id", "candidates", "label", "status", "bytes", "path", "sha256"]

    def sound(data: bytes) -> bool:
        try:
            return all(True for _ in rasters.Tiff(lambda o, n: data[o : o + n]).blocks())
        except Exception:
            return False

    def run(batches):
        import hashlib
        import uuid

        import pyarrow as pa
        from pyarrow import fs as pafs

        for batch in batches:
            out = []
            for tile, each in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                row = (tile, [a["label"] for a in each], None, "missing", None, None, None)
                for a in each:
                    data = None
                    for left in range(tries, 0, -1):
                        try:
                            data = transport(a["url"])
                            break
                        except Exception:
                            if left == 1:
                                data = None
                    if data is None or len(data) < least_bytes or not (check or sound)(data):
                        continue
                    uri = f"{folder}/{tile}-{a['label']}-{uuid.uuid4().hex}.tif"
                    system, path = pafs.FileSystem.from_uri(uri if not uri.startswith("file:/") or uri.startswith("file://") else "file://" + uri[5:])
                    system.create_dir(path.rpartition("/")[0], recursive=True)
                    with system.open_output_stream(path) as f:
                        f.write(data)
                    row = (tile, row[1], a["label"], "fetched", len(data), uri, hashlib.sha256(data).hexdigest())
                    break
                out.append(row)
            kinds = [pa.string(), pa.list_(pa.string()), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string()]
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out, strict=True) if out else [()] * 7, kinds, strict=True)], names=names)

    spread = tiles.select("tile_id", "attempts").repartition("tile_id")
    return spread.mapInArrow(run, "tile_id string, candidates array<string>, label string, status string, bytes long, path string, sha256 string")
