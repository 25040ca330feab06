"""Focal kernels on block rows for full-size rasters (keys, block_row, block_col, values).

A block is one array of ``size`` x ``size`` pixels.  Each block sends its edge strips to its neighbours, one
shuffle on the block key brings a block and its halo together, and numpy does the rest on one block at a
time: memory is a block and its halo, whatever the raster's size.  Results equal the pixel-row operators.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Keys = Sequence[str]


def with_halo(blocks: DataFrame, halo: int, size: int, height: int, width: int, keys: Keys = ()) -> DataFrame:
    """(keys, block_row, block_col, pieces): a block's own values and the strips around it.

    A piece is (dr, dc, values): from the neighbour at that offset, cut to what the halo needs.
    """
    steps = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a in (-1, 0, 1) for b in (-1, 0, 1)])
    sent = blocks.withColumn("s", F.explode(steps))
    row, col = F.col("block_row") + F.col("s.a"), F.col("block_col") + F.col("s.b")
    sent = sent.withColumn("tr", row).withColumn("tc", col).filter((F.col("tr") >= 0) & (F.col("tc") >= 0) & (F.col("tr") * size < height) & (F.col("tc") * size < width))
    h = F.least(F.lit(size), height - F.col("block_row") * size)
    w = F.least(F.lit(size), width - F.col("block_col") * size)
    # The receiver at offset (a, b) needs this block's side that faces it.
    r0 = F.when(F.col("s.a") == 1, F.greatest(h - halo, F.lit(0))).otherwise(0)
    r1 = F.when(F.col("s.a") == -1, F.least(h, F.lit(halo))).otherwise(h)
    c0 = F.when(F.col("s.b") == 1, F.greatest(w - halo, F.lit(0))).otherwise(0)
    c1 = F.when(F.col("s.b") == -1, F.least(w, F.lit(halo))).otherwise(w)
    lines = F.flatten(F.transform(F.sequence(r0, r1 - 1), lambda r: F.slice("values", r * w + c0 + 1, c1 - c0)))
    piece = F.struct((-F.col("s.a")).alias("dr"), (-F.col("s.b")).alias("dc"), (r1 - r0).alias("h"), (c1 - c0).alias("w"), lines.alias("v"))
    # In a step of its own: beside the new block_row the old one could not be named.
    sent = sent.withColumn("p", piece).select(*keys, F.col("tr").alias("block_row"), F.col("tc").alias("block_col"), "p")
    return sent.groupBy(*keys, "block_row", "block_col").agg(F.collect_list("p").alias("pieces"))


def flat_and_boundary(blocks: DataFrame, size: int, height: int, width: int, window: int = 5, threshold: float = 4.0, nodata: float = -9999.0, keys: Keys = ()) -> DataFrame:
    """(keys, block_row, block_col, flat, boundary): masks as arrays of bytes, row-major."""
    k = window // 2
    halo = k + 1  # one more for the neighbours' flatness
    got = with_halo(blocks, halo, size, height, width, keys)
    schema = T.StructType([f for f in got.schema.fields if f.name != "pieces"] + [T.StructField(n, T.ArrayType(T.ByteType())) for n in ("flat", "boundary")])

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            rows, cols = (batch.column(n).to_pylist() for n in ("block_row", "block_col"))
            out_flat, out_edge = [], []
            for br, bc, pieces in zip(rows, cols, batch.column("pieces").to_pylist(), strict=True):
                parts = {(p["dr"], p["dc"]): np.array(p["v"], float).reshape(p["h"], p["w"]) for p in pieces}
                own = parts[(0, 0)]
                h, w = own.shape
                up, down = (parts[(d, 0)].shape[0] if (d, 0) in parts else 0 for d in (-1, 1))
                left, right = (parts[(0, d)].shape[1] if (0, d) in parts else 0 for d in (-1, 1))
                z = np.zeros((up + h + down, left + w + right))
                for (a, b), v in parts.items():
                    r = {-1: 0, 0: up, 1: up + h}[a]
                    c = {-1: 0, 0: left, 1: left + w}[b]
                    z[r : r + v.shape[0], c : c + v.shape[1]] = v
                z = np.where(z < nodata + 1, 0.0, z)
                # Mirror only at the raster's own edges; elsewhere the halo is real.
                top, bottom = br == 0, (br + 1) * size >= height
                west, east = bc == 0, (bc + 1) * size >= width
                z = np.pad(z, ((k * top, k * bottom), (k * west, k * east)), "symmetric")

                def box(x):
                    s = np.lib.stride_tricks.sliding_window_view(x, window, 0).sum(-1)
                    return np.lib.stride_tricks.sliding_window_view(s, window, 1).sum(-1)

                n = window * window
                flat = n * box(z * z) - box(z) ** 2 < threshold * n * n
                # flat now covers the block and one more line where there is a neighbour.
                flat = np.pad(flat, ((int(top), int(bottom)), (int(west), int(east))))
                inner = flat[1:-1, 1:-1] & flat[:-2, 1:-1] & flat[2:, 1:-1] & flat[1:-1, :-2] & flat[1:-1, 2:]
                mine = flat[1:-1, 1:-1]
                out_flat.append(mine.astype(np.int8).ravel())
                out_edge.append((mine & ~inner).astype(np.int8).ravel())
            cells = [batch.column(f.name) for f in schema.fields[:-2]]
            yield pa.record_batch([*cells, pa.array(out_flat, pa.list_(pa.int8())), pa.array(out_edge, pa.list_(pa.int8()))], names=schema.names)

    return got.mapInArrow(run, schema)
