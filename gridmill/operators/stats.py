"""Statistics and report tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Keys = Sequence[str]


def flat_stats(mask: DataFrame, dem: DataFrame, value: Column, valid: Column, keys: Keys = ()) -> DataFrame:
    """flat_cells, total, flat_pct and the range of valid values (null without any)."""
    v = F.when(valid, value)
    both = mask.join(dem, [*keys, "row", "col"])
    got = both.groupBy(*keys).agg(F.sum("flat").cast("long").alias("flat_cells"), F.count(F.lit(1)).alias("total"), F.min(v).alias("elev_min"), F.max(v).alias("elev_max"))
    return got.withColumn("flat_pct", F.round(100.0 * F.col("flat_cells") / F.col("total"), 2)).withColumn("elev_range", F.col("elev_max") - F.col("elev_min"))


def boundary_stats(mask: DataFrame, keys: Keys = ()) -> DataFrame:
    got = mask.groupBy(*keys).agg(F.sum("flat").cast("long").alias("flat_cells"), F.sum("boundary").cast("long").alias("boundary_cells"), F.count(F.lit(1)).alias("total"))
    got = got.withColumn("boundary_pct", F.round(100.0 * F.col("boundary_cells") / F.col("total"), 2))
    return got.withColumn("reduction_pct", F.round(100.0 * (1 - F.col("boundary_cells") / F.greatest(F.col("flat_cells"), F.lit(1))), 2))


def histogram(values: DataFrame, column: str) -> DataFrame:
    """(bin, n, low, high): equal bins over the extent, min(30, max(5, n // 2)) of them."""
    box = values.agg(F.count(column).alias("n"), F.min(column).alias("lo"), F.max(column).alias("hi"))
    box = box.withColumn("bins", F.least(F.lit(30), F.greatest(F.lit(5), F.floor(F.col("n") / 2))).cast("int"))
    span = F.col("hi") - F.col("lo")
    at = F.when(span == 0, 0).otherwise(F.least(F.floor((F.col(column) - F.col("lo")) * F.col("bins") / span), F.col("bins") - 1)).cast("int")
    got = values.select(column).filter(F.col(column).isNotNull()).crossJoin(F.broadcast(box)).withColumn("bin", at)
    return got.groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.min(column).alias("low"), F.max(column).alias("high"))


def top_changes(bodies: DataFrame, n: int, change: str = "change", tie: str = "label") -> DataFrame:
    """The ``n`` corrections of greatest size."""
    return bodies.orderBy(F.abs(F.col(change)).desc(), tie).limit(n)


def coverage_share(df: DataFrame, hit: Column, keys: Keys = ()) -> DataFrame:
    return df.groupBy(*keys).agg(F.round(100.0 * F.avg(hit.cast("double")), 2).alias("pct"), F.count_if(hit).alias("n"))
