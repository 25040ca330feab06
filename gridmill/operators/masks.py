"""Bit-packed masks and block layout."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Keys = Sequence[str]


def pack_bits(mask: DataFrame, value: str = "flat", keys: Keys = ()) -> DataFrame:
    """(keys, row, byte_no, byte): eight pixels a byte, the first in the highest bit, rows padded with 0."""
    bit = F.when(F.col(value) != 0, F.element_at(F.array(*[F.lit(1 << (7 - i)) for i in range(8)]), (F.col("col") % 8 + 1).cast("int"))).otherwise(0)
    return mask.groupBy(*keys, "row", F.floor(F.col("col") / 8).cast("int").alias("byte_no")).agg(F.sum(bit).cast("int").alias("byte"))


def pack_rows(mask: DataFrame, value: str = "flat", keys: Keys = ()) -> DataFrame:
    """(keys, row, width, bits): a raster line as one binary value."""
    b = pack_bits(mask, value, keys)
    width = mask.groupBy(*keys, "row").agg((F.max("col") + 1).alias("width"))
    line = b.groupBy(*keys, "row").agg(F.array_sort(F.collect_list(F.struct("byte_no", "byte"))).alias("b"))
    text = F.array_join(F.transform("b", lambda x: F.lpad(F.hex(x["byte"]), 2, "0")), "")
    return line.join(width, [*keys, "row"]).select(*keys, "row", "width", F.unhex(text).alias("bits"))


def unpack_rows(packed: DataFrame, value: str = "flat", keys: Keys = ()) -> DataFrame:
    text = F.hex("bits")
    cols = F.sequence(F.lit(0), F.col("width") - 1)
    got = packed.withColumn("t", text).withColumn("col", F.explode(cols))
    byte = F.conv(F.substring(F.col("t"), (F.floor(F.col("col") / 8) * 2 + 1).cast("int"), F.lit(2)), 16, 10).cast("int")
    return got.select(*keys, "row", F.col("col").cast("int").alias("col"), F.pmod(F.floor(byte / F.pow(F.lit(2), 7 - F.col("col") % 8)), F.lit(2)).cast("int").alias(value))


def to_blocks(pixels: DataFrame, size: int, keys: Keys = (), value: str = "value") -> DataFrame:
    """(keys, block_row, block_col, w, values): row-major arrays of ``size`` x ``size`` pixels.

    ``w`` is the block's width, less than ``size`` at the right edge.
    """
    br, bc = F.floor(F.col("row") / size).cast("int"), F.floor(F.col("col") / size).cast("int")
    pos = (F.col("row") % size) * size + F.col("col") % size
    got = pixels.groupBy(*keys, br.alias("block_row"), bc.alias("block_col")).agg((F.max(F.col("col") % size) + 1).cast("int").alias("w"), F.array_sort(F.collect_list(F.struct(pos.alias("p"), F.col(value).alias("v")))).alias("x"))
    return got.select(*keys, "block_row", "block_col", "w", F.transform("x", lambda e: e["v"]).alias("values"))


def from_blocks(blocks: DataFrame, size: int, keys: Keys = (), value: str = "value", values: Column | str = "values") -> DataFrame:
    w = F.col("w") if "w" in blocks.columns else F.lit(size)
    got = blocks.select(*keys, "block_row", "block_col", w.alias("w"), F.posexplode(values).alias("p", value))
    return got.select(*keys, (F.col("block_row") * size + F.floor(F.col("p") / F.col("w"))).cast("int").alias("row"), (F.col("block_col") * size + F.col("p") % F.col("w")).cast("int").alias("col"), value)
