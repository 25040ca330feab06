"""Registry state from a stream of tile accesses (an extension: batch tables are the usual way)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import tiles as T


def tile_accesses(events: DataFrame, lateness: str = "10 minutes", every: str = "5 minutes") -> DataFrame:
    """(start, tile_id, n, last) by window; ``events`` has ts, lat, lng.  State is bounded by the watermark."""
    seen = events.withColumn("ts", F.col("ts").cast("timestamp")).withColumn("tile_id", T.tile_id_at(F.col("lat"), F.col("lng")))
    got = seen.withWatermark("ts", lateness).groupBy(F.window("ts", every), "tile_id").agg(F.count(F.lit(1)).alias("n"), F.max("ts").alias("last"))
    return got.select(F.col("window.start").alias("start"), "tile_id", "n", "last")


def append_to_log(accesses: DataFrame, path: str, checkpoint: str, once: bool = True):
    """Write access rows to a Parquet log, each window once; returns the running query."""
    writer = accesses.writeStream.outputMode("append").format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="1 minute")).start()
