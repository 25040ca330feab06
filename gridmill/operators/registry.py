"""The tile registry as an append-only log of events, and storage limits over its latest state.

A registry has at most one row for each of the 64,800 tiles of the globe, so windows over its latest state
are bounded; the log itself is only ever reduced by partial aggregation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

STATUSES = ("absent", "pending", "ready", "failed")


def latest(log: DataFrame, keys: Sequence[str], order: Sequence[str], kept: Sequence[str] = ()) -> DataFrame:
    """Latest row of each key by ``order``; fields in ``kept`` hold their last value that isn't null."""
    at = F.struct(*order)
    rest = [c for c in log.columns if c not in keys and c not in kept]
    out = log.groupBy(*keys).agg(F.max_by(F.struct(*rest), at).alias("r"), *(F.max_by(c, F.when(F.col(c).isNotNull(), at)).alias(c) for c in kept))
    return out.select(*keys, "r.*", *kept)


def live(state: DataFrame) -> DataFrame:
    """Without removed tiles."""
    return state.filter("status <> 'removed'")


def status_counts(state: DataFrame, size: str = "size_mb") -> DataFrame:
    return state.groupBy("status").agg(F.count(F.lit(1)).alias("n"), F.sum(size).alias("size_mb"))


def totals(state: DataFrame, size: str = "size_mb") -> DataFrame:
    """tile_count, ready_count, total_size_mb (of any status)."""
    return state.agg(F.count(F.lit(1)).alias("tile_count"), F.count_if(F.col("status") == "ready").alias("ready_count"), F.coalesce(F.sum(size), F.lit(0)).alias("total_size_mb"))


def status_of(asked: DataFrame, state: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``asked`` with the status of each tile, absent where the registry has none."""
    return asked.join(state.select(*keys, "status"), list(keys), "left").withColumn("status", F.coalesce("status", F.lit("absent")))


def evictions(state: DataFrame, shortfall: Column | float, keys: Sequence[str], protected: DataFrame | None = None, size: str = "size_mb", age: str = "ts") -> DataFrame:
    """The shortest run of ready tiles, least recently used first, that frees the shortfall.

    A tile goes if what goes before it is still short: a running sum over at most one row a tile.
    """
    able = state.filter("status = 'ready'")
    if protected is not None:
        able = able.join(protected.select(*keys), list(keys), "left_anti")
    before = W.partitionBy(F.lit(0)).orderBy(F.col(age).asc_nulls_first(), *keys).rowsBetween(W.unboundedPreceding, -1)
    freed = F.coalesce(F.sum(size).over(before), F.lit(0))
    short = shortfall if isinstance(shortfall, Column) else F.lit(shortfall)
    return able.withColumn("freed_before", freed).filter(F.col("freed_before") < short)


def capacity(state: DataFrame, needed: float, cap: float, policy: str, evictable: DataFrame | None = None, size: str = "size_mb") -> DataFrame:
    """One row: used, headroom, fits, allowed, warning, freed.

    ``hard`` refuses what doesn't fit, ``warn`` lets it through with a warning, ``lru`` allows it if what
    ``evictable`` (see :func:`evictions`) frees makes room.
    """
    used = state.agg(F.coalesce(F.sum(size), F.lit(0)).alias("used"))
    freed = evictable.agg(F.coalesce(F.sum(size), F.lit(0)).alias("freed")) if evictable is not None else state.limit(1).agg(F.lit(0).cast("long").alias("freed"))
    got = used.crossJoin(freed).withColumn("headroom", F.lit(cap) - F.col("used")).withColumn("fits", F.col("used") + needed <= cap)
    allowed = {"hard": F.col("fits"), "warn": F.lit(True), "lru": F.col("fits") | (F.col("used") - F.col("freed") + needed <= cap)}[policy]
    return got.withColumn("allowed", allowed).withColumn("warning", F.lit(policy == "warn") & ~F.col("fits"))


def prune_failed(state: DataFrame) -> DataFrame:
    return state.filter("status <> 'failed'")


def mark(keys: DataFrame, status: str, at: Column, **fields: Column) -> DataFrame:
    """Log rows that set a status; fields that aren't given are null and keep their value in the state."""
    if status not in (*STATUSES, "removed"):
        raise ValueError(f"no such status: {status}")
    return keys.select("*", F.lit(status).alias("status"), at.alias("ts"), *(c.alias(n) for n, c in fields.items()))
