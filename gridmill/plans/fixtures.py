"""Deterministic points, registry logs, rasters and polygons derived from the relational test tables.

All values are integers, so results can be compared exactly.  ``SQL`` has the same definitions for DuckDB.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SIDE = 120
UNIT = 10  # decimetres a metre
NODATA = -99990
SHIFT = 0.0625

POINTS = """event_id, user_id,
 CAST((CASE WHEN user_id % 4 = 0 THEN -1 ELSE 1 END) * (3000 + (event_id*7919 + user_id*104729) % 2000) AS INT) AS lat_c,
 CAST((CASE WHEN user_id % 3 = 0 THEN 1 ELSE -1 END) * (6500 + (event_id*15485 + user_id*31) % 6000) AS INT) AS lng_c,
 CAST((event_id*613) % 1200 - 150 AS INT) AS elev_dm"""
LOG = """o_orderkey AS ev_id, CAST(30 + (o_orderkey*37 + o_custkey) % 20 AS INT) AS lat_floor,
 CAST(-125 + (o_custkey*53 + o_orderkey*7) % 60 AS INT) AS lng_floor,
 CASE o_orderstatus WHEN 'O' THEN 'ready' WHEN 'P' THEN 'pending' ELSE 'failed' END AS status,
 CAST(50 + o_orderkey % 251 AS BIGINT) AS size_mb, o_orderdate AS ts"""
HEIGHT = """CAST(CASE WHEN (r*31 + c*17) % 97 = 0 THEN -99990 WHEN (r*13 + c*7) % 211 = 0 THEN 0
  ELSE 5000 + 80*(CAST(floor(r/16) + floor(c/16) AS BIGINT) % 7) + 14*COALESCE(k,0) END AS INT)"""
COARSE = "CAST(5000 + 20*(CAST(floor(r/3)+floor(c/3) AS BIGINT) % 11) AS INT)"
PONDS = """CAST(s_suppkey AS INT) AS pid, s_name AS name, CAST(8+(s_suppkey*29)%104 AS INT) AS cx, CAST(8+(s_suppkey*43)%104 AS INT) AS cy,
 CAST(2+s_suppkey%4 AS INT) AS hw, CAST(2+s_suppkey%3 AS INT) AS hh, CAST(s_suppkey%2 AS INT) AS is_rect,
 CAST(CASE s_suppkey%5 WHEN 0 THEN 466 WHEN 1 THEN 436 ELSE 390 END AS INT) AS ftype"""

# Rasters and ponds by tile, a tile for every ten suppliers: these grow with the tables.
PART = 60
TILE_HEIGHT = "CAST(4000 + 90 * ((t * 7 + CAST(floor(r / 12) + floor(c / 12) AS BIGINT)) % 5) + 13 * ((r * 5 + c * 3 + t) % 4) AS INT)"
TILE_PONDS = """CAST(s_suppkey DIV 10 AS INT) AS t, CAST(s_suppkey AS INT) AS pid, CAST(7 + (s_suppkey * 29) % 46 AS INT) AS cx, CAST(7 + (s_suppkey * 43) % 46 AS INT) AS cy, CAST(1 + s_suppkey % 4 AS INT) AS hw, CAST(1 + s_suppkey % 3 AS INT) AS hh"""

SQL = f"""
points AS (SELECT {POINTS} FROM events),
located AS (SELECT *, CAST(floor(lat_c / 100) AS INT) AS lat_floor, CAST(floor(lng_c / 100) AS INT) AS lng_floor FROM points),
log AS (SELECT {LOG} FROM orders),
state AS (SELECT * FROM log QUALIFY row_number() OVER (PARTITION BY lat_floor, lng_floor ORDER BY ts DESC, ev_id DESC) = 1),
noise AS (SELECT l_orderkey % 120 AS nr, l_partkey % 120 AS nc, max(l_suppkey + CAST(l_quantity AS BIGINT)) % 5 AS k FROM lineitem GROUP BY 1, 2),
grid AS (SELECT a.r, b.c FROM range(0, 120) AS a(r) CROSS JOIN range(0, 120) AS b(c)),
dem AS (SELECT CAST(r AS INT) AS r, CAST(c AS INT) AS c, {HEIGHT} AS z FROM grid LEFT JOIN noise ON r = nr AND c = nc),
coarse AS (SELECT CAST(r AS INT) AS r, CAST(c AS INT) AS c, {COARSE} AS z FROM grid),
ponds AS (SELECT {PONDS} FROM supplier),
inside AS (SELECT pid, name, ftype, CAST(r AS INT) AS r, CAST(c AS INT) AS c FROM ponds, grid
  WHERE CASE WHEN is_rect = 1 THEN abs(c + 0.5 - cx - {SHIFT}) < hw AND abs(r + 0.5 - cy) < hh ELSE abs(c + 0.5 - cx - {SHIFT}) / hw + abs(r + 0.5 - cy) / hh < 1 END),
labels_ AS (SELECT r, c, max(pid + 1) AS label FROM inside WHERE ftype IN (390, 436, 493) GROUP BY r, c),
tponds AS (SELECT {TILE_PONDS.replace("s_suppkey DIV 10", "s_suppkey // 10")} FROM supplier),
tdem AS (SELECT t, CAST(r AS INT) AS r, CAST(c AS INT) AS c, {TILE_HEIGHT} AS z FROM (SELECT DISTINCT t FROM tponds) CROSS JOIN range(0, {PART}) AS a(r) CROSS JOIN range(0, {PART}) AS b(c)),
tlabels AS (SELECT t, CAST(r AS INT) AS r, CAST(c AS INT) AS c, max(pid + 1) AS label FROM tponds, range(0, {PART}) AS a(r), range(0, {PART}) AS b(c) WHERE abs(c + 0.5 - cx - {SHIFT}) < hw AND abs(r + 0.5 - cy) < hh GROUP BY 1, 2, 3)
"""


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = _table(spark, sf_dir, "events").selectExpr(*_split(POINTS))
    return got.withColumn("lat", F.col("lat_c").cast("double") / 100).withColumn("lng", F.col("lng_c").cast("double") / 100)


def log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "orders").selectExpr(*_split(LOG))


def dem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(row, col, value) in decimetres."""
    noise = _table(spark, sf_dir, "lineitem").groupBy((F.col("l_orderkey") % SIDE).alias("nr"), (F.col("l_partkey") % SIDE).alias("nc")).agg((F.max(F.col("l_suppkey") + F.col("l_quantity").cast("long")) % 5).alias("k"))
    return grid(spark).join(noise, (F.col("r") == F.col("nr")) & (F.col("c") == F.col("nc")), "left").selectExpr("CAST(r AS INT) AS row", "CAST(c AS INT) AS col", f"{HEIGHT} AS value")


def grid(spark: SparkSession) -> DataFrame:
    return spark.range(SIDE * SIDE).selectExpr(f"id DIV {SIDE} AS r", f"id % {SIDE} AS c")


def coarse(spark: SparkSession) -> DataFrame:
    return grid(spark).selectExpr("CAST(r AS INT) AS row", "CAST(c AS INT) AS col", f"{COARSE} AS value")


def ponds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Polygons in pixel coordinates: pid, name, ftype, rings and the numbers they are made of."""
    got = _table(spark, sf_dir, "supplier").selectExpr(*_split(PONDS))
    x = f"(cx + {SHIFT}D)"
    rect = [("-", "-"), ("+", "-"), ("+", "+"), ("-", "+"), ("-", "-")]
    corners = ", ".join(f"array({x} {a} hw, CAST(cy {b} hh AS DOUBLE))" for a, b in rect)
    tips = f"array({x} - hw, CAST(cy AS DOUBLE)), array({x}, CAST(cy - hh AS DOUBLE)), array({x} + hw, CAST(cy AS DOUBLE)), array({x}, CAST(cy + hh AS DOUBLE)), array({x} - hw, CAST(cy AS DOUBLE))"
    return got.withColumn("rings", F.expr(f"array(CASE WHEN is_rect = 1 THEN array({corners}) ELSE array({tips}) END)"))


def tile_ponds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(t, pid, rings) in each tile's pixels, and the numbers they are made of."""
    got = _table(spark, sf_dir, "supplier").selectExpr(*_split(TILE_PONDS))
    corners = ", ".join(f"array(cx + {SHIFT}D {a} hw, CAST(cy {b} hh AS DOUBLE))" for a, b in [("-", "-"), ("+", "-"), ("+", "+"), ("-", "+"), ("-", "-")])
    return got.withColumn("rings", F.expr(f"array(array({corners}))"))


def tile_dem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(t, row, col, value): a raster a tile."""
    tiles = tile_ponds(spark, sf_dir).select("t").distinct()
    return tiles.selectExpr("t", f"explode(sequence(0, {PART - 1})) AS r").selectExpr("t", "r", f"explode(sequence(0, {PART - 1})) AS c").selectExpr("t", "r AS row", "c AS col", f"{TILE_HEIGHT} AS value")


def _split(columns: str) -> list[str]:
    """Select items of a list that has commas inside brackets too."""
    out, depth, last = [], 0, 0
    for i, ch in enumerate(columns):
        depth += (ch == "(") - (ch == ")")
        if ch == "," and not depth:
            out.append(columns[last:i])
            last = i + 1
    return [x.strip() for x in [*out, columns[last:]]]
