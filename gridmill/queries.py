"""Registered queries of the elevation operators, each with the same result in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import rules as R
from .functions import tiles as T
from .functions import urls
from .operators import blocks, checks, cover, fetch, focal, masks, registry, resample, stats, vector, water
from .plans import fixtures as X
from .plans import pipelines
from .sources import rasters

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

S = X.SIDE
U = X.UNIT
NONE = X.NODATA
# Tile name of (lat_floor, lng_floor) for DuckDB.
ID = "(CASE WHEN {0} < 0 THEN 'S' ELSE 'N' END || lpad(CAST(abs({0}) AS VARCHAR), 2, '0') || CASE WHEN {1} < 0 THEN 'W' ELSE 'E' END || lpad(CAST(abs({1}) AS VARCHAR), 3, '0'))"
TID = ID.format("lat_floor", "lng_floor")


def query(sql: str | None = None, fixtures: bool = True):
    """Register a function (spark, sf_dir) with its SQL, which may use the fixtures' names."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            # "CTE name AS (...)" goes on after the fixtures' own.
            head, _, rest = sql.lstrip().partition(" ")
            body = f", {rest}" if head == "CTE" else f" {sql}"
            ORACLE[f.__name__] = f"WITH {X.SQL}{body}" if fixtures else sql
        return f

    return add


def located(spark, d) -> DataFrame:
    return cover.assign(X.points(spark, d))


def state(spark, d) -> DataFrame:
    return registry.latest(X.log(spark, d), ["lat_floor", "lng_floor"], ["ts", "ev_id"])


def pond_cells(spark, d) -> DataFrame:
    still = vector.still_water(X.ponds(spark, d))
    return vector.label_cells(vector.rasterize(vector.edges(still), S, S), F.col("pid") + 1)


def judged(spark, d) -> DataFrame:
    got = water.measure(X.dem(spark, d), pond_cells(spark, d), S, S, buffer=3, percentile=0.1, unit=U)
    return water.judge(got, 12, 10.0 * U, 2.5 * U)


def levelled(spark, d) -> tuple[DataFrame, DataFrame]:
    """The raster before and after correction; it and the label cells are computed once."""
    dem, cells = rasters.stored(X.dem(spark, d), "dem"), rasters.stored(pond_cells(spark, d), "cells")
    found = water.judge(water.measure(dem, cells, S, S, buffer=3, percentile=0.1, unit=U), 12, 10.0 * U, 2.5 * U)
    return dem, water.apply(dem, cells, found)


def flat(spark, d) -> DataFrame:
    dem = X.dem(spark, d)
    return focal.flat_mask(dem, R.zero_filled(F.col("value"), NONE).cast("long"), S, S, 5, 4 * U * U)


# -- tiles


@query(f"SELECT {TID} AS tile_id, lat_floor AS south, lng_floor AS west, count(*) AS n, CAST(sum(elev_dm) AS BIGINT) AS elev_dm FROM located GROUP BY 1, 2, 3")
def tile_assign_counts(spark, d):
    got = located(spark, d).groupBy("tile_id", F.col("lat_floor").alias("south"), F.col("lng_floor").alias("west"))
    return got.agg(F.count(F.lit(1)).alias("n"), F.sum("elev_dm").alias("elev_dm"))


@query(f"SELECT event_id, {TID} AS tile_id, CAST(lat_floor AS DOUBLE) AS south, CAST(lng_floor AS DOUBLE) AS west, CAST(lat_floor + 1 AS DOUBLE) AS north, CAST(lng_floor + 1 AS DOUBLE) AS east, CAST(lat_floor AS DOUBLE) + 0.5 AS mid_lat, CAST(lng_floor AS DOUBLE) + 0.5 AS mid_lng, true AS inside FROM located")
def tile_bounds_join(spark, d):
    p = located(spark, d)
    named = p.select("tile_id").distinct()
    lat, lng = T.parse(F.col("tile_id"))
    named = named.withColumn("b", T.bounds(lat, lng))
    b = F.col("b")
    return p.join(named, "tile_id").select("event_id", "tile_id", "b.*", T.centre(b)["lat"].alias("mid_lat"), T.centre(b)["lng"].alias("mid_lng"), T.contains(b, F.col("lat"), F.col("lng")).alias("inside"))


@query(f"""CTE t AS (SELECT DISTINCT lat_floor, lng_floor FROM located), b AS (SELECT pid, 30 + pid * 0.25 AS s, -120 + pid * 0.5 AS w, 32.5 + pid * 0.25 AS n, -118 + pid * 0.5 AS e FROM ponds)
SELECT pid, {TID} AS tile_id FROM b JOIN t ON lat_floor < n AND s < lat_floor + 1 AND lng_floor < e AND w < lng_floor + 1""")
def tile_bbox_intersects(spark, d):
    # Each box generates the few tiles it can touch; the theta join becomes an equi join.
    boxes = X.ponds(spark, d).select("pid", (30 + F.col("pid") * 0.25).alias("south"), (-120 + F.col("pid") * 0.5).alias("west"), (32.5 + F.col("pid") * 0.25).alias("north"), (-118 + F.col("pid") * 0.5).alias("east"))
    tiles = located(spark, d).select("lat_floor", "lng_floor", "tile_id").distinct()
    near = cover.bbox_tiles(boxes).drop("tile_id")
    hit = T.intersects(T.bounds(F.col("lat_floor"), F.col("lng_floor")), *(F.col(c) for c in ("south", "west", "north", "east")))
    return near.join(tiles, ["lat_floor", "lng_floor"]).filter(hit).select("pid", "tile_id")


@query(f"""CTE b AS (SELECT event_id, lat_c AS s, lng_c AS w, lat_c + 30 + event_id % 200 AS n, lng_c + 50 + user_id % 150 AS e FROM points), la AS (SELECT event_id, unnest(range(CAST(floor(s / 100) AS BIGINT), CAST(ceil(n / 100) AS BIGINT))) AS lat_floor FROM b),
lo AS (SELECT event_id, unnest(range(CAST(floor(w / 100) AS BIGINT), CAST(ceil(e / 100) AS BIGINT))) AS lng_floor FROM b)
SELECT event_id, {TID} AS tile_id FROM la JOIN lo USING (event_id)""")
def bbox_cover(spark, d):
    p = X.points(spark, d)
    north, east = F.col("lat_c") + 30 + F.col("event_id") % 200, F.col("lng_c") + 50 + F.col("user_id") % 150
    box = p.select("event_id", (F.col("lat_c") / 100).alias("south"), (F.col("lng_c") / 100).alias("west"), (north / 100).alias("north"), (east / 100).alias("east"))
    return cover.bbox_tiles(box).select("event_id", "tile_id")


@query(f"""CTE l AS (SELECT event_id, lat_c, lng_c FROM points UNION ALL SELECT event_id, lat_c + user_id % 90, lng_c - event_id % 120 FROM points),
p AS (SELECT event_id, min(lat_c) / 100 AS s, max(lat_c) / 100 AS n, min(lng_c) / 100 AS w, max(lng_c) / 100 AS e FROM l GROUP BY event_id),
g AS (SELECT event_id, s, n, w, e, 1000 / 111320.0::DOUBLE AS dy, 1000 / 111320.0::DOUBLE / greatest(cos(radians((s + n) / 2)), 1e-6) AS dx FROM p),
la AS (SELECT event_id, unnest(range(CAST(floor(s - dy) AS BIGINT), CAST(ceil(n + dy) AS BIGINT))) AS lat_floor FROM g),
lo AS (SELECT event_id, unnest(range(CAST(floor(w - dx) AS BIGINT), CAST(ceil(e + dx) AS BIGINT))) AS lng_floor FROM g)
SELECT event_id, count(*) AS n_tiles, min({TID}) AS first_id, max({TID}) AS last_id FROM la JOIN lo USING (event_id) GROUP BY event_id""")
def polyline_cover(spark, d):
    p = X.points(spark, d)
    ends = F.array(F.struct(F.col("lat_c").alias("a"), F.col("lng_c").alias("b")), F.struct((F.col("lat_c") + F.col("user_id") % 90).alias("a"), (F.col("lng_c") - F.col("event_id") % 120).alias("b")))
    line = p.select("event_id", F.explode(ends).alias("e")).select("event_id", (F.col("e.a").cast("double") / 100).alias("lat"), (F.col("e.b").cast("double") / 100).alias("lng"))
    got = cover.polyline_tiles(line, "event_id", 1000.0)
    return got.groupBy("event_id").agg(F.count(F.lit(1)).alias("n_tiles"), F.min("tile_id").alias("first_id"), F.max("tile_id").alias("last_id"))


@query(f"""CTE o AS (SELECT * FROM (VALUES ('N', 1, 0), ('S', -1, 0), ('E', 0, 1), ('W', 0, -1), ('NE', 1, 1), ('NW', 1, -1), ('SE', -1, 1), ('SW', -1, -1)) AS v(direction, a, b)),
t AS (SELECT lat_floor, lng_floor FROM state UNION ALL SELECT 89, 179)
SELECT lat_floor, lng_floor, direction, CASE WHEN lat_floor + a BETWEEN -90 AND 89 AND lng_floor + b BETWEEN -180 AND 179 THEN {ID.format("(lat_floor + a)", "(lng_floor + b)")} END AS neighbour FROM t CROSS JOIN o""")
def tile_neighbors(spark, d):
    t = state(spark, d).select("lat_floor", "lng_floor").unionAll(spark.sql("SELECT 89 AS lat_floor, 179 AS lng_floor"))
    return cover.neighbours(t)


@query("""CTE p AS (SELECT a.ev_id, a.lat_floor AS la, a.lng_floor * 3 % 180 AS lo, b.lat_floor AS lb, b.lng_floor AS lp FROM log a JOIN log b ON b.ev_id = a.ev_id + 1),
q AS (SELECT *, ((lp - lo + 180) % 360 + 360) % 360 - 180 AS arc FROM p), r AS (SELECT *, CASE WHEN arc >= 0 THEN lo ELSE lp END AS west, CASE WHEN arc >= 0 THEN lp ELSE lo END + 1 AS east FROM q)
SELECT ev_id, least(la, lb) AS south, west, greatest(la, lb) + 1 AS north, east, CAST((greatest(la, lb) + 1 - least(la, lb)) * (east - west) AS BIGINT) AS n_tiles, east <= west AS crosses FROM r""")
def corner_bounds(spark, d):
    a = X.log(spark, d).select("ev_id", F.col("lat_floor").alias("la"), (F.col("lng_floor") * 3 % 180).alias("lo"))
    b = X.log(spark, d).select((F.col("ev_id") - 1).alias("ev_id"), F.col("lat_floor").alias("lb"), F.col("lng_floor").alias("lp"))
    return a.join(b, "ev_id").select("ev_id", cover.corner_box(*(F.col(c) for c in ("la", "lo", "lb", "lp"))).alias("x")).select("ev_id", "x.*")


@query("""SELECT event_id, CASE WHEN lat_c BETWEEN 1700 AND 7200 AND lng_c BETWEEN -18000 AND -6000 THEN '3DEP_10' ELSE 'GLO30' END AS source,
 CASE WHEN lng_floor < 0 AND lat_floor BETWEEN 24 AND 72 THEN '10m,30m' ELSE '30m' END AS candidates,
 CASE WHEN lat_floor BETWEEN 24 AND 72 AND lng_floor >= -180 AND lng_floor + 1 <= -50 THEN 'nhd' ELSE 'osm' END AS water,
 CASE WHEN lat_c BETWEEN 1700 AND 7200 AND lng_c BETWEEN -18000 AND -6000 THEN 250.0::DOUBLE ELSE 80.0::DOUBLE END AS mb FROM located""")
def coverage_source_pick(spark, d):
    p = located(spark, d)
    source = R.auto_source(F.col("lat"), F.col("lng"))
    return p.select("event_id", source.alias("source"), F.array_join(R.candidates(F.col("lat_floor"), F.col("lng_floor"), F.lit("best")), ",").alias("candidates"),
                    R.water_source(F.col("lat_floor"), F.col("lng_floor"), F.col("lng_floor") + 1).alias("water"), R.estimated_mb(source).alias("mb"))


LAND = " OR ".join(f"(lat_c BETWEEN {a * 100} AND {b * 100} AND lng_c BETWEEN {w * 100} AND {e * 100})" for a, b, w, e in R.LAND_BOXES)


@query(f"SELECT event_id, lat_c, lng_c FROM points WHERE NOT ({LAND})")
def land_box_anti(spark, d):
    return X.points(spark, d).filter(~R.is_land(F.col("lat"), F.col("lng"))).select("event_id", "lat_c", "lng_c")


@query(f"SELECT event_id, CAST(CASE WHEN elev_dm = -99990 OR elev_dm NOT BETWEEN -5000 AND 90000 OR (NOT ({LAND}) AND elev_dm BETWEEN -100 AND 200) THEN 0 ELSE elev_dm END AS INT) AS elev_dm FROM points")
def suspect_elevation(spark, d):
    p = X.points(spark, d)
    bad = R.is_suspect(F.col("elev_dm"), ~R.is_land(F.col("lat"), F.col("lng")), NONE, U)
    return p.select("event_id", F.when(bad, 0).otherwise(F.col("elev_dm")).alias("elev_dm"))


@query("""SELECT event_id, CAST(floor((lat_floor * 100 + 100 - lat_c) * 120 / 100) AS INT) AS row, CAST(floor((lng_c - lng_floor * 100) * 120 / 100) AS INT) AS col, z AS value
FROM located JOIN dem ON r = least(CAST(floor((lat_floor * 100 + 100 - lat_c) * 120 / 100) AS INT), 119) AND c = CAST(floor((lng_c - lng_floor * 100) * 120 / 100) AS INT)""")
def point_sample(spark, d):
    p = located(spark, d)
    row = F.floor((F.col("lat_floor") * 100 + 100 - F.col("lat_c")) * S / 100).cast("int")
    col = F.floor((F.col("lng_c") - F.col("lng_floor") * 100) * S / 100).cast("int")
    at = p.select("event_id", row.alias("prow"), col.alias("col")).withColumn("row", F.least("prow", F.lit(S - 1)))
    return at.join(X.dem(spark, d), ["row", "col"]).select("event_id", F.col("prow").alias("row"), "col", "value")


@query(f"SELECT DISTINCT {TID} AS tile_id, 'tiles/' || {TID} AS dir, 'tiles/' || {TID} || '/' || {TID} || '_dem.tif' AS dem_file, CASE WHEN lat_floor < 0 THEN 'S' ELSE 'N' END || lpad(CAST(abs(lat_floor) AS VARCHAR), 2, '0') || '_00_' || CASE WHEN lng_floor < 0 THEN 'W' ELSE 'E' END || lpad(CAST(abs(lng_floor) AS VARCHAR), 3, '0') AS url_name FROM located")
def tile_paths(spark, d):
    t = located(spark, d).select("lat_floor", "lng_floor", "tile_id").distinct()
    return t.select("tile_id", T.tile_dir(F.col("tile_id")).alias("dir"), T.tile_file(F.col("tile_id"), "dem").alias("dem_file"), T.url_name(F.col("lat_floor"), F.col("lng_floor")).alias("url_name"))


@query("""SELECT DISTINCT lat_floor, lng_floor, round(111.32 * cos(radians(lat_floor + 0.5)), 6) AS width_km, round(111.32::DOUBLE, 6) AS height_km FROM located""")
def tile_area_km(spark, d):
    t = located(spark, d).select("lat_floor", "lng_floor").distinct()
    w, h = T.area_km(F.col("lat_floor"), F.col("lng_floor"), F.col("lat_floor") + 1, F.col("lng_floor") + 1)
    return t.select("lat_floor", "lng_floor", F.round(w, 6).alias("width_km"), F.round(h, 6).alias("height_km"))


# -- registry


@query(f"SELECT lat_floor, lng_floor, {TID} AS tile_id, ev_id, status, size_mb FROM state")
def registry_latest(spark, d):
    return state(spark, d).select("lat_floor", "lng_floor", T.tile_id(F.col("lat_floor"), F.col("lng_floor")).alias("tile_id"), "ev_id", "status", "size_mb")


@query("SELECT status, count(*) AS n, CAST(sum(size_mb) AS BIGINT) AS size_mb FROM state GROUP BY status")
def registry_status_counts(spark, d):
    return registry.status_counts(state(spark, d))


@query("SELECT count(*) AS tile_count, count(*) FILTER (status = 'ready') AS ready_count, CAST(sum(size_mb) AS BIGINT) AS total_size_mb FROM state")
def registry_totals(spark, d):
    return registry.totals(state(spark, d))


@query("""CTE t AS (SELECT DISTINCT lat_floor, lng_floor FROM located)
SELECT t.lat_floor, t.lng_floor, coalesce(status, 'absent') AS status FROM t LEFT JOIN state s ON t.lat_floor = s.lat_floor AND t.lng_floor = s.lng_floor""")
def registry_absent_lookup(spark, d):
    asked = located(spark, d).select("lat_floor", "lng_floor").distinct()
    return registry.status_of(asked, state(spark, d), ["lat_floor", "lng_floor"])


@query(f"SELECT {TID} AS tile_id FROM state WHERE status = 'ready'")
def registry_list_ready(spark, d):
    return state(spark, d).filter("status = 'ready'").select(T.tile_id(F.col("lat_floor"), F.col("lng_floor")).alias("tile_id")).orderBy("tile_id")


EVICT = """e AS (SELECT *, coalesce(sum(size_mb) OVER (ORDER BY ts, lat_floor, lng_floor ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS freed_before FROM state WHERE status = 'ready' AND ev_id % 7 <> 0)"""


def _evicted(spark, d) -> DataFrame:
    s = state(spark, d)
    return registry.evictions(s, 5000, ["lat_floor", "lng_floor"], s.filter("ev_id % 7 = 0"))


@query(f"CTE {EVICT} SELECT lat_floor, lng_floor, size_mb, CAST(freed_before AS BIGINT) AS freed_before FROM e WHERE freed_before < 5000")
def lru_evictions(spark, d):
    return _evicted(spark, d).select("lat_floor", "lng_floor", "size_mb", "freed_before")


@query("SELECT CAST(sum(size_mb) AS BIGINT) AS used, 50000 - CAST(sum(size_mb) AS BIGINT) AS headroom, sum(size_mb) + 250 <= 50000 AS allowed FROM state")
def capacity_hard(spark, d):
    return registry.capacity(state(spark, d), 250, 50000, "hard").select("used", F.col("headroom").cast("long").alias("headroom"), "allowed")


@query("SELECT true AS allowed, NOT sum(size_mb) + 250 <= 50000 AS warning FROM state")
def capacity_warn(spark, d):
    return registry.capacity(state(spark, d), 250, 50000, "warn").select("allowed", "warning")


@query(f"""CTE {EVICT}, f AS (SELECT coalesce(sum(size_mb), 0) AS freed FROM e WHERE freed_before < 5000), u AS (SELECT sum(size_mb) AS used FROM state)
SELECT CAST(freed AS BIGINT) AS freed, used + 250 <= 90000 OR used - freed + 250 <= 90000 AS allowed FROM f, u""")
def capacity_lru(spark, d):
    return registry.capacity(state(spark, d), 250, 90000, "lru", _evicted(spark, d)).select("freed", "allowed")


@query("SELECT lat_floor, lng_floor, status FROM state WHERE status <> 'failed'")
def prune_failed(spark, d):
    return registry.prune_failed(state(spark, d)).select("lat_floor", "lng_floor", "status")


@query(f"""CTE h AS (SELECT {TID} AS tile_id, CASE WHEN ev_id % 11 <> 0 THEN CASE WHEN ev_id % 5 = 0 THEN 541 ELSE 10800 END END AS w, 10800 AS h, ev_id % 7 = 0 AS moved FROM state)
SELECT tile_id, w IS NOT NULL AND w = 10800 AND NOT moved AS ok,
 nullif(CASE WHEN w IS NULL THEN 'file missing on disk' ELSE concat_ws('; ', CASE WHEN w <> 10800 THEN 'wrong size ' || w || 'x10800 (expected 10800x10800)' END, CASE WHEN moved THEN 'bounds differ' END) END, '') AS reason FROM h""")
def tile_validation(spark, d):
    s = state(spark, d)
    off = F.when(F.col("ev_id") % 7 == 0, 0.5).otherwise(0.0)
    lat, lng = F.col("lat_floor").cast("double"), F.col("lng_floor").cast("double")
    h = s.select(T.tile_id(F.col("lat_floor"), F.col("lng_floor")).alias("tile_id"), F.when(F.col("ev_id") % 11 != 0, F.when(F.col("ev_id") % 5 == 0, 541).otherwise(10800)).alias("width"), F.lit(10800).alias("height"),
                 (lng + off).alias("west"), lat.alias("south"), (lng + 1 + 1e-7).alias("east"), (lat + 1).alias("north"))
    return checks.validate_headers(h).select("tile_id", "ok", "reason")


@query("""SELECT ev_id, CASE WHEN ev_id % 13 = 0 THEN 'no valid pixels' WHEN ev_id % 101 < 1 THEN 'flat share below 1 %' WHEN ev_id % 101 > 99 AND ev_id % 5 < 2 AND ev_id % 2 = 1 THEN 'degenerate raster' END AS why,
 CASE WHEN ev_id % 9 > ev_id % 10 THEN 'more boundary than flat cells' END AS edge FROM log""")
def build_gates(spark, d):
    e = F.col("ev_id")
    why = checks.flat_gate((e % 101).cast("double"), F.when(e % 13 != 0, (e % 5).cast("double")), e % 2 == 0)
    return X.log(spark, d).select("ev_id", why.alias("why"), checks.boundary_gate(e % 9, e % 10).alias("edge"))


# -- rasters


@query("""SELECT count(*) FILTER (z <= -99980) AS n_nodata, count(*) FILTER (z = 0) AS n_zero, count(*) FILTER (z <= -99980 OR z = 0) AS n_gaps, count(*) AS n_pixels,
 min(r) FILTER (z <= -99980 OR z = 0) AS min_row, max(r) FILTER (z <= -99980 OR z = 0) AS max_row, min(c) FILTER (z <= -99980 OR z = 0) AS min_col, max(c) FILTER (z <= -99980 OR z = 0) AS max_col FROM dem""")
def gap_stats(spark, d):
    return resample.gap_stats(X.dem(spark, d), F.col("value"), NONE + 9)


@query("SELECT a.r AS row, a.c AS col, CASE WHEN a.z <= -99980 OR a.z = 0 THEN b.z ELSE a.z END AS value, CASE WHEN a.z <= -99980 OR a.z = 0 THEN 1 ELSE 0 END AS filled FROM dem a JOIN coarse b ON a.r = b.r AND a.c = b.c")
def gap_fill(spark, d):
    return resample.fill_gaps(X.dem(spark, d), X.coarse(spark), R.is_gap(F.col("value"), NONE + 9))


@query("""CTE a AS (SELECT * FROM dem WHERE r < 80) SELECT coalesce(a.r, b.r) AS row, coalesce(a.c, b.c) AS col, CASE WHEN a.z > -99980 THEN a.z WHEN b.z IS NOT NULL THEN b.z ELSE -99990 END AS value,
 CASE WHEN a.z > -99980 THEN 0 WHEN b.z IS NOT NULL THEN 1 ELSE -1 END AS source FROM a FULL JOIN (SELECT * FROM coarse WHERE c >= 40) b ON a.r = b.r AND a.c = b.c""")
def merge_first_valid(spark, d):
    got = resample.merge_first_valid([X.dem(spark, d).filter("row < 80"), X.coarse(spark).filter("col >= 40")], NONE + 9)
    return got.withColumn("value", F.when(F.col("source") < 0, NONE).otherwise(F.col("value")))


@query("SELECT r - 10 AS row, c - 20 AS col, z AS value FROM dem WHERE r >= 10 AND r < 60 AND c >= 20 AND c < 110")
def crop_window(spark, d):
    return resample.crop(X.dem(spark, d), 10, 60, 20, 110)


@query("SELECT CAST(r * 3 + i AS INT) AS row, CAST(c * 3 + j AS INT) AS col, z AS value FROM dem, range(3) AS a(i), range(3) AS b(j)")
def resample_nearest(spark, d):
    return resample.nearest(X.dem(spark, d), 3)


@query("SELECT CAST(floor(r / 4) AS INT) AS row, CAST(floor(c / 4) AS INT) AS col, CAST(coalesce(sum(z) FILTER (z > -99980), 0) AS BIGINT) AS total, count(*) FILTER (z > -99980) AS n FROM dem GROUP BY 1, 2")
def resample_average(spark, d):
    return resample.average(X.dem(spark, d), 4, F.when(R.has_elevation(F.col("value"), NONE + 9), F.col("value"))).select("row", "col", F.coalesce("total", F.lit(0)).alias("total"), "n")


@query("""CTE o AS (SELECT r AS row, c AS col, (r + 0.5) / 2 - 0.5 AS y, (c + 0.5) / 2 - 0.5 AS x FROM range(0, 240) AS a(r), range(0, 240) AS b(c)),
s AS (SELECT row, col, dem.z, CAST(16 * (1 - abs(y - dem.r)) * (1 - abs(x - dem.c)) AS BIGINT) AS w FROM o JOIN dem ON dem.r IN (CAST(floor(y) AS INT), CAST(floor(y) AS INT) + 1) AND dem.c IN (CAST(floor(x) AS INT), CAST(floor(x) AS INT) + 1) WHERE z > -99980)
SELECT CAST(row AS INT) AS row, CAST(col AS INT) AS col, CAST(sum(w * z) AS BIGINT) AS num, CAST(sum(w) AS BIGINT) AS den FROM s WHERE w > 0 GROUP BY row, col""")
def resample_bilinear(spark, d):
    return resample.bilinear(X.dem(spark, d), 2, S, S, F.when(F.col("value") > NONE + 10, F.col("value").cast("long")))


@query("SELECT CAST(floor(r / 5) AS INT) AS row, CAST(floor(c / 5) AS INT) AS col, z AS value FROM dem WHERE r % 5 = 2 AND c % 5 = 2")
def block_decimate(spark, d):
    return resample.decimate(X.dem(spark, d), 5)


ZERO = "CASE WHEN z < -99980 THEN 0 ELSE z END"
PAD = f"""p AS (SELECT r, c, CAST({ZERO} AS BIGINT) AS z FROM dem), pr AS (SELECT r, c, z FROM p UNION ALL SELECT -1 - r, c, z FROM p WHERE r < 2 UNION ALL SELECT 239 - r, c, z FROM p WHERE r > 117),
pc AS (SELECT r, c, z FROM pr UNION ALL SELECT r, -1 - c, z FROM pr WHERE c < 2 UNION ALL SELECT r, 239 - c, z FROM pr WHERE c > 117),
s1 AS (SELECT r, c, sum(z) OVER w AS s, sum(z * z) OVER w AS ss FROM pc WINDOW w AS (PARTITION BY r ORDER BY c RANGE BETWEEN 2 PRECEDING AND 2 FOLLOWING)),
s2 AS (SELECT r, c, CAST(sum(s) OVER w AS BIGINT) AS s, CAST(sum(ss) OVER w AS BIGINT) AS ss FROM s1 WINDOW w AS (PARTITION BY c ORDER BY r RANGE BETWEEN 2 PRECEDING AND 2 FOLLOWING)),
bx AS (SELECT * FROM s2 WHERE r BETWEEN 0 AND 119 AND c BETWEEN 0 AND 119),
fl AS (SELECT r, c, CASE WHEN 25 * ss - s * s < 400 * 625 THEN 1 ELSE 0 END AS flat FROM bx)"""


@query(f"CTE {PAD} SELECT r AS row, c AS col, s, ss, CAST(25 AS BIGINT) AS n FROM bx")
def box_variance(spark, d):
    return focal.box_sums(X.dem(spark, d), R.zero_filled(F.col("value"), NONE + 9).cast("long"), 5, S, S)


@query(f"CTE {PAD} SELECT r AS row, c AS col, flat FROM fl")
def flat_mask(spark, d):
    return flat(spark, d)


@query(f"CTE {PAD} SELECT CAST(sum(flat) AS BIGINT) AS flat_cells, count(*) AS total, min(z) FILTER (z >= -99980) AS elev_min, max(z) FILTER (z >= -99980) AS elev_max, round(100.0 * sum(flat) / count(*), 2)::DOUBLE AS flat_pct, max(z) FILTER (z >= -99980) - min(z) FILTER (z >= -99980) AS elev_range FROM fl JOIN dem USING (r, c)")
def flat_stats(spark, d):
    return stats.flat_stats(flat(spark, d), X.dem(spark, d), F.col("value"), R.has_elevation(F.col("value"), NONE + 9))


@query(f"CTE {PAD}, h AS (SELECT *, lag(flat, 1, 0) OVER (PARTITION BY r ORDER BY c) AS a, lead(flat, 1, 0) OVER (PARTITION BY r ORDER BY c) AS b, lag(flat, 1, 0) OVER (PARTITION BY c ORDER BY r) AS e, lead(flat, 1, 0) OVER (PARTITION BY c ORDER BY r) AS f FROM fl) SELECT r AS row, c AS col, flat, CASE WHEN flat = 1 AND least(a, b, e, f) = 0 THEN 1 ELSE 0 END AS boundary FROM h")
def boundary_mask(spark, d):
    return focal.boundary_mask(flat(spark, d))


@query(f"""CTE {PAD}, h AS (SELECT *, lag(flat, 1, 0) OVER (PARTITION BY r ORDER BY c) AS a, lead(flat, 1, 0) OVER (PARTITION BY r ORDER BY c) AS b, lag(flat, 1, 0) OVER (PARTITION BY c ORDER BY r) AS e, lead(flat, 1, 0) OVER (PARTITION BY c ORDER BY r) AS f FROM fl), k AS (SELECT sum(flat) AS f, count(*) FILTER (flat = 1 AND least(a, b, e, f) = 0) AS b, count(*) AS t FROM h)
SELECT CAST(f AS BIGINT) AS flat_cells, CAST(b AS BIGINT) AS boundary_cells, t AS total, round(100.0 * b / t, 2)::DOUBLE AS boundary_pct, round(100.0 * (1 - b / greatest(f, 1)::DOUBLE), 2)::DOUBLE AS reduction_pct FROM k""")
def boundary_stats(spark, d):
    return stats.boundary_stats(focal.boundary_mask(flat(spark, d)))


@query(f"CTE {PAD} SELECT CAST(i AS INT) AS row, CAST(j AS INT) AS col, coalesce(flat, 0) AS flat FROM range(0, 50) AS a(i) CROSS JOIN range(0, 60) AS b(j) LEFT JOIN fl ON r = i + 90 AND c = j - 15")
def mask_window_slice(spark, d):
    return resample.window_slice(flat(spark, d), 90, -15, 50, 60)


@query(f"CTE {PAD} SELECT r AS row, CAST(floor(c / 8) AS INT) AS byte_no, CAST(sum(flat * CAST(pow(2, 7 - c % 8) AS INT)) AS INT) AS byte FROM fl GROUP BY 1, 2")
def mask_pack_bits(spark, d):
    return masks.pack_bits(flat(spark, d))


@query(f"CTE {PAD} SELECT r AS row, c AS col, flat FROM fl")
def mask_pack_roundtrip(spark, d):
    return masks.unpack_rows(masks.pack_rows(flat(spark, d)))


@query("SELECT vec_id, CAST(floor((p - 1) / 8) AS INT) AS row, CAST((p - 1) % 8 AS INT) AS col, CAST(round(embedding[p] * 1000.0::DOUBLE) AS BIGINT) AS milli FROM embeddings, range(1, 65) AS a(p)")
def block_pixels(spark, d):
    e = spark.read.parquet(f"{d}/embeddings.parquet").select("vec_id", F.lit(0).alias("block_row"), F.lit(0).alias("block_col"), F.col("embedding").alias("values"))
    return masks.from_blocks(e, 8, ["vec_id"]).select("vec_id", "row", "col", F.round(F.col("value").cast("double") * 1000).cast("long").alias("milli"))


@query("SELECT r AS row, c AS col, z AS value FROM dem")
def block_roundtrip(spark, d):
    return masks.from_blocks(masks.to_blocks(X.dem(spark, d), 16), 16)


@query("SELECT round(100.0 * count(*) FILTER (z <= -99980 OR z = 0) / count(*), 2)::DOUBLE AS pct, count(*) FILTER (z <= -99980 OR z = 0) AS n FROM dem")
def void_share(spark, d):
    return stats.coverage_share(X.dem(spark, d), R.is_gap(F.col("value"), NONE + 9))


@query("SELECT avg(CASE WHEN z > -99980 AND z <> 0 THEN 1.0::DOUBLE ELSE 0 END) AS share, avg(CASE WHEN z > -99980 AND z <> 0 THEN 1.0::DOUBLE ELSE 0 END) >= 0.5 AS covered FROM dem WHERE r BETWEEN 28 AND 91 AND c BETWEEN 28 AND 91")
def coverage_probe(spark, d):
    return checks.coverage(X.dem(spark, d).filter("row BETWEEN 28 AND 91 AND col BETWEEN 28 AND 91"), ~R.is_gap(F.col("value"), NONE + 9))


# -- water


@query("SELECT pid FROM ponds WHERE cx + 0.0625 - hw <= 70 AND cx + 0.0625 + hw >= 30 AND cy - hh <= 80 AND cy + hh >= 40")
def polygon_bbox_filter(spark, d):
    return vector.overlapping(X.ponds(spark, d), 30, 40, 70, 80).select("pid")


@query("SELECT r AS row, c AS col, label FROM labels_")
def rasterize_labels(spark, d):
    return pond_cells(spark, d)


@query("SELECT CAST(l.r + i AS INT) AS row, CAST(l.c + j AS INT) AS col, max(label) AS label FROM labels_ l, range(-3, 4) AS a(i), range(-3, 4) AS b(j) WHERE l.r + i BETWEEN 0 AND 119 AND l.c + j BETWEEN 0 AND 119 GROUP BY 1, 2")
def dilate_square(spark, d):
    return focal.dilate_square(pond_cells(spark, d), 3, S, S)


@query("SELECT CAST(l.r + i AS INT) AS row, CAST(l.c + j AS INT) AS col, max(label) AS label FROM labels_ l, range(-2, 3) AS a(i), range(-2, 3) AS b(j) WHERE abs(i) + abs(j) <= 2 AND l.r + i BETWEEN 0 AND 119 AND l.c + j BETWEEN 0 AND 119 GROUP BY 1, 2")
def dilate_diamond(spark, d):
    return focal.dilate_diamond(pond_cells(spark, d), 2, S, S)


DIAG = """v AS (SELECT pid, count(*) AS pixel_count, min(z) FILTER (z > -99980 AND z < 90000)::DOUBLE AS least, max(z) FILTER (z > -99980 AND z < 90000)::DOUBLE AS most, stddev_pop(z) FILTER (z > -99980 AND z < 90000) AS sd FROM inside JOIN dem USING (r, c) WHERE ftype IN (390, 436, 493) GROUP BY pid)"""


@query(f"CTE {DIAG} SELECT pid, pixel_count, least, most, round(sd, 4) AS std, sd > 50 OR most - least > 200 AS flagged, CASE WHEN sd > 50 THEN 'std' WHEN most - least > 200 THEN 'range' END AS reason FROM v")
def water_diagnostics(spark, d):
    cells = vector.rasterize(vector.edges(vector.still_water(X.ponds(spark, d))), S, S)
    return water.diagnostics(X.dem(spark, d), cells, U, NONE + 9).select("pid", "pixel_count", "least", "most", F.round("std", 4).alias("std"), "flagged", "reason")


BODIES = """band AS (SELECT l.r + i AS r, l.c + j AS c, max(label) AS label FROM labels_ l, range(-3, 4) AS a(i), range(-3, 4) AS b(j) WHERE l.r + i BETWEEN 0 AND 119 AND l.c + j BETWEEN 0 AND 119 GROUP BY 1, 2),
ring AS (SELECT band.* FROM band ANTI JOIN labels_ USING (r, c)),
shore AS (SELECT label, quantile_cont(z::DOUBLE, 0.1) AS edge, stddev_pop(z) AS edge_std, count(*) AS n_shore FROM ring JOIN dem USING (r, c) WHERE z > -10000 AND z < 90000 GROUP BY label),
body AS (SELECT label, count(*) AS pixel_count, coalesce(avg(z) FILTER (z > -10000), 0) AS orig_mean, coalesce(stddev_pop(z) FILTER (z > -10000), 0) AS water_std, quantile_cont(z::DOUBLE, 0.1) FILTER (z > -10000) AS own FROM labels_ JOIN dem USING (r, c) GROUP BY label),
m AS (SELECT label, pixel_count, coalesce(edge, own) AS surface, orig_mean, water_std, coalesce(edge_std, water_std) AS shore_std, coalesce(n_shore, 0) AS n_shore FROM body LEFT JOIN shore USING (label)),
j AS (SELECT *, surface - orig_mean AS change, CASE WHEN pixel_count < 12 THEN 'too_small' WHEN surface IS NULL THEN 'no_samples' WHEN abs(surface - orig_mean) > 100 THEN 'flagged' ELSE 'corrected' END AS status FROM m)"""


@query(f"CTE {BODIES} SELECT label, pixel_count, round(surface, 3) AS surface, round(shore_std, 3) AS shore_std, n_shore FROM m")
def shoreline_percentile(spark, d):
    return judged(spark, d).select("label", "pixel_count", F.round("surface", 3).alias("surface"), F.round("shore_std", 3).alias("shore_std"), "n_shore")


@query(f"CTE {BODIES} SELECT label, status, round(change, 3) AS change, status = 'corrected' AND water_std > 25 AS low_confidence FROM j")
def water_correct(spark, d):
    return judged(spark, d).select("label", "status", F.round("change", 3).alias("change"), "low_confidence")


@query(f"CTE {BODIES} SELECT label, pixel_count, round(surface, 3) AS surface, round(change, 3) AS change, 'correction_too_large' AS reason FROM j WHERE status = 'flagged'")
def water_flagged(spark, d):
    return judged(spark, d).filter("status = 'flagged'").select("label", "pixel_count", F.round("surface", 3).alias("surface"), F.round("change", 3).alias("change"), F.lit("correction_too_large").alias("reason"))


@query(f"CTE {BODIES} SELECT dem.r AS row, dem.c AS col, round(coalesce(surface, z::DOUBLE), 3) AS value FROM dem LEFT JOIN labels_ l ON dem.r = l.r AND dem.c = l.c LEFT JOIN j ON l.label = j.label AND status = 'corrected'")
def water_corrected_dem(spark, d):
    return levelled(spark, d)[1].withColumn("value", F.round("value", 3))


@query(f"CTE {BODIES} SELECT dem.r AS row, dem.c AS col, round(surface - z, 3) AS change FROM dem JOIN labels_ l ON dem.r = l.r AND dem.c = l.c JOIN j ON l.label = j.label AND status = 'corrected' WHERE surface <> z")
def dem_diff(spark, d):
    dem, after = levelled(spark, d)
    return resample.difference(after, dem).withColumn("change", F.round("change", 3)).filter("change <> 0")


@query("""CTE m AS (SELECT label, count(*) AS n, sum(r) AS sr, sum(c) AS sc FROM labels_ GROUP BY label)
SELECT l.label, arg_min(r, (n * r - sr) * (n * r - sr) + (n * c - sc) * (n * c - sc) + (r * 120 + c) / 100000.0) AS row, arg_min(c, (n * r - sr) * (n * r - sr) + (n * c - sc) * (n * c - sc) + (r * 120 + c) / 100000.0) AS col FROM labels_ l JOIN m ON l.label = m.label GROUP BY l.label""")
def water_centroid(spark, d):
    return water.centroids(pond_cells(spark, d))


@query(f"CTE {BODIES} SELECT label, round(change, 3) AS change FROM j WHERE status = 'corrected' ORDER BY abs(change) DESC, label LIMIT 5")
def top_corrections(spark, d):
    return stats.top_changes(judged(spark, d).filter("status = 'corrected'"), 5).select("label", F.round("change", 3).alias("change"))


@query(f"""CTE {BODIES}, q AS (SELECT CAST(round(change * 1000) AS BIGINT) AS v FROM j WHERE status = 'corrected'), b AS (SELECT least(30, greatest(5, count(*) // 2)) AS bins, min(v) AS lo, max(v) AS hi FROM q)
SELECT CAST(CASE WHEN hi = lo THEN 0 ELSE least(floor((v - lo) * bins / (hi - lo)), bins - 1) END AS INT) AS bin, count(*) AS n, min(v) AS low, max(v) AS high FROM q, b GROUP BY 1""")
def change_histogram(spark, d):
    v = judged(spark, d).filter("status = 'corrected'").select(F.round(F.col("change") * 1000).cast("long").alias("v"))
    return stats.histogram(v, "v")


@query("""CTE q AS (SELECT pid, (cy - (SELECT min(cy) FROM ponds))::DOUBLE / greatest((SELECT max(cy) - min(cy) FROM ponds), 1e-9) * 65535 AS a, (cx - (SELECT min(cx) FROM ponds))::DOUBLE / greatest((SELECT max(cx) - min(cx) FROM ponds), 1e-9) * 65535 AS b FROM ponds),
t AS (SELECT pid, CAST(trunc(a) AS BIGINT) AS x, CAST(trunc(b) AS BIGINT) AS y FROM q)
SELECT pid, CAST(sum(((x >> CAST(i AS INT)) & 1) * (1::BIGINT << CAST(2 * i AS INT)) + ((y >> CAST(i AS INT)) & 1) * (1::BIGINT << CAST(2 * i + 1 AS INT))) AS BIGINT) AS code FROM t, range(16) AS k(i) GROUP BY pid""")
def morton_order(spark, d):
    c = X.ponds(spark, d).select("pid", F.col("cy").cast("double").alias("lat"), F.col("cx").cast("double").alias("lng"))
    return vector.morton_order(c).select("pid", "code").orderBy("code")


@query("""CTE f AS (SELECT pid, name, ftype, unnest(CASE WHEN pid % 3 = 0 THEN [0, 1] ELSE [0] END) AS part FROM ponds WHERE pid <> 13) SELECT pid, CAST(part AS INT) AS part, name, ftype FROM f WHERE ftype IN (390, 436, 493)""")
def nhd_feature_filter(spark, d):
    p = X.ponds(spark, d)
    ring = F.to_json("rings")
    geometry = F.when(F.col("pid") == 13, F.lit("null")).when(F.col("pid") % 3 == 0, F.concat(F.lit('{"type":"MultiPolygon","coordinates":['), ring, F.lit(","), ring, F.lit("]}"))).otherwise(F.concat(F.lit('{"type":"Polygon","coordinates":'), ring, F.lit("}")))
    number = F.when(F.col("pid") % 7 == 0, F.concat(F.lit('"'), F.col("ftype"), F.lit('"'))).otherwise(F.col("ftype").cast("string"))
    text = F.concat(F.lit('{"type":"Feature","geometry":'), geometry, F.lit(',"properties":{"GNIS_NAME":"'), F.col("name"), F.lit('","FTYPE":'), number, F.lit("}}"))
    raw = p.select("pid", text.alias("feature"))
    return vector.still_water(vector.parse_features(raw)).select("pid", "part", "name", "ftype")


@query("""CTE d AS (SELECT r, c, z, lag(z) OVER x AS a, lead(z) OVER x AS b, lag(z) OVER y AS e, lead(z) OVER y AS f FROM dem WINDOW x AS (PARTITION BY r ORDER BY c), y AS (PARTITION BY c ORDER BY r)),
g AS (SELECT r, c, 0.15::DOUBLE * CASE WHEN a IS NULL THEN b - z WHEN b IS NULL THEN z - a ELSE (b - a) / 2.0::DOUBLE END AS dx, 0.15::DOUBLE * CASE WHEN e IS NULL THEN f - z WHEN f IS NULL THEN z - e ELSE (f - e) / 2.0::DOUBLE END AS dy FROM d)
SELECT r AS row, c AS col, round(greatest(0.0::DOUBLE, least(1.0::DOUBLE, (cos(radians(45)) * (-dx * cos(radians(-225)) + dy * sin(radians(-225))) + sin(radians(45))) / sqrt(1 + dx * dx + dy * dy))), 5) AS shade FROM g""")
def hillshade(spark, d):
    return focal.hillshade(X.dem(spark, d), F.col("value"), pixel_m=float(U)).withColumn("shade", F.round("shade", 5))


@query(f"CTE {PAD}, h AS (SELECT *, lag(flat, 1, 0) OVER (PARTITION BY r ORDER BY c) AS a, lead(flat, 1, 0) OVER (PARTITION BY r ORDER BY c) AS b, lag(flat, 1, 0) OVER (PARTITION BY c ORDER BY r) AS e, lead(flat, 1, 0) OVER (PARTITION BY c ORDER BY r) AS f FROM fl) SELECT r AS row, c AS col, flat, CASE WHEN flat = 1 AND least(a, b, e, f) = 0 THEN 1 ELSE 0 END AS boundary FROM h")
def boundary_mask_blocks(spark, d):
    # The kernel for full-size rasters: blocks with a halo instead of pixel rows.
    got = blocks.flat_and_boundary(masks.to_blocks(X.dem(spark, d), 32).drop("w"), 32, S, S, 5, 4.0 * U * U, float(NONE))
    w = F.least(F.lit(32), S - F.col("block_col") * 32)
    pair = got.select("block_row", "block_col", w.alias("w"), F.arrays_zip("flat", "boundary").alias("values"))
    return masks.from_blocks(pair, 32).select("row", "col", F.col("value.flat").cast("int").alias("flat"), F.col("value.boundary").cast("int").alias("boundary"))


@query(f"""SELECT DISTINCT {TID} AS tile_id,
 CASE WHEN lng_floor < 0 AND lat_floor BETWEEN 24 AND 72 THEN 'https://prd-tnm.s3.amazonaws.com/StagedProducts/Elevation/13/TIFF/current/' || n || '/USGS_13_' || n || '.tif' END AS ten,
 'https://copernicus-dem-30m.s3.amazonaws.com/' || m || '/' || m || '.tif' AS thirty
FROM (SELECT *, 'n' || lpad(CAST(abs(lat_floor + 1) AS VARCHAR), 2, '0') || 'w' || lpad(CAST(abs(lng_floor) AS VARCHAR), 3, '0') AS n,
 'Copernicus_DSM_COG_10_' || CASE WHEN lat_floor < 0 THEN 'S' ELSE 'N' END || lpad(CAST(abs(lat_floor) AS VARCHAR), 2, '0') || '_00_' || CASE WHEN lng_floor < 0 THEN 'W' ELSE 'E' END || lpad(CAST(abs(lng_floor) AS VARCHAR), 3, '0') || '_00_DEM' AS m FROM located)""")
def source_urls(spark, d):
    t = located(spark, d).select("lat_floor", "lng_floor", "tile_id").distinct()
    return t.select("tile_id", urls.ten_metre(F.col("lat_floor"), F.col("lng_floor")).alias("ten"), urls.thirty_metre(F.col("lat_floor"), F.col("lng_floor")).alias("thirty"))


@query("""SELECT lat_floor, lng_floor, coalesce(arg_min(CASE ev_id % 3 WHEN 0 THEN '1m' WHEN 1 THEN '10m' ELSE '30m' END, (ev_id % 3) * 100 + ev_id % 7) FILTER (status = 'ready'), CASE WHEN lat_floor > 40 THEN 'ocean0m' ELSE 'none' END) AS label FROM log GROUP BY lat_floor, lng_floor""")
def source_cascade(spark, d):
    attempts = X.log(spark, d).withColumn("label", F.when(F.col("ev_id") % 3 == 0, "1m").when(F.col("ev_id") % 3 == 1, "10m").otherwise("30m")).withColumn("rank", F.col("ev_id") % 3)
    return fetch.first_available(attempts, ["lat_floor", "lng_floor"], "rank", F.col("status") == "ready", F.when(F.col("lat_floor") > 40, "ocean0m").otherwise("none"))


@query(f"SELECT lat_floor, lng_floor, bool_and(NOT ({LAND})) AS ocean FROM located GROUP BY lat_floor, lng_floor")
def ocean_tiles(spark, d):
    return fetch.all_ocean(located(spark, d), ["lat_floor", "lng_floor"], ~R.is_land(F.col("lat"), F.col("lng")))


@query("""CTE f AS (SELECT *, coalesce(sum(size_mb) OVER (ORDER BY ts, ev_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS freed FROM state WHERE NOT (lat_floor = 40 AND lng_floor = -100))
SELECT ev_id, size_mb, CAST(freed AS BIGINT) AS freed_before FROM f WHERE (SELECT sum(size_mb) FROM state) - freed > 60000""")
def cache_evictions(spark, d):
    keep = (F.col("lat_floor") == 40) & (F.col("lng_floor") == -100)
    return fetch.cache_evictions(state(spark, d), 60000, ["ev_id"], keep, "size_mb", "ts").select("ev_id", "size_mb", "freed_before")


@query("""CTE q AS (SELECT pid, (row_number() OVER (ORDER BY cy, cx, pid) - 1) // 16 AS batch FROM ponds) SELECT pid, CAST(batch AS INT) AS batch FROM q""")
def batch_numbers(spark, d):
    return vector.batches(X.ponds(spark, d), 16, ["cy", "cx", "pid"]).select("pid", "batch")


@query("SELECT CAST(r AS INT) AS row, CAST(c AS INT) AS col, CAST(0 AS FLOAT) AS value FROM grid")
def ocean_tile(spark, d):
    return fetch.constant_tile(spark, S)


# -- grids, files and pipelines


@query("SELECT event_id, abs((1.0::DOUBLE / 10800) * (1 + (event_id % 9 - 4) * 0.00003::DOUBLE) - 1.0::DOUBLE / 10800) <= 0.0001::DOUBLE / 10800 AND user_id % 5 <> 0 AS standard FROM points")
def standard_grid(spark, d):
    rx = F.lit(T.GRID) * (1 + (F.col("event_id") % 9 - 4) * 0.00003)
    ry = F.when(F.col("user_id") % 5 == 0, -T.GRID).otherwise(T.GRID)
    return X.points(spark, d).select("event_id", T.is_standard_grid(rx, ry).alias("standard"))


@query("SELECT 'area' AS name, 'best' AS resolution, 44 AS south, -113 AS west, 47 AS north, -108 AS east, CAST(15 AS BIGINT) AS n_tiles, round(5 * 111.32 * cos(radians(45.5)), 6) AS width_km, round(3 * 111.32::DOUBLE, 6) AS height_km", fixtures=False)
def study_area(spark, d):
    got = cover.study_area(spark, "area", "N46W113", "N44W109")
    return got.withColumn("width_km", F.round("width_km", 6)).withColumn("height_km", F.round("height_km", 6))


@query("SELECT event_id, CAST(trunc((4500 - lat_c) / 25.0::DOUBLE) AS INT) - 5 AS row, CAST(trunc((lng_c + 11000) / 25.0::DOUBLE) AS INT) - 5 AS col FROM points")
def pixel_boxes(spark, d):
    row, col = resample.pixel_corner(F.col("lat"), F.col("lng"), -110.0, 45.0, 0.25, 5)
    return X.points(spark, d).select("event_id", row.alias("row"), col.alias("col"))


@query("SELECT ev_id, CASE ev_id % 6 WHEN 0 THEN NULL WHEN 1 THEN NULL WHEN 2 THEN 'not a geographic reference system: EPSG:26912' WHEN 3 THEN 'not a geographic reference system: EPSG:5070' WHEN 4 THEN 'not a geographic reference system: EPSG:32612' ELSE 'unknown reference system' END AS why FROM log")
def crs_gate(spark, d):
    codes = F.array(*[F.lit(c) for c in ("EPSG:4326", "EPSG:4269", "EPSG:26912", "EPSG:5070", "EPSG:32612")])
    crs = F.when(F.col("ev_id") % 6 < 5, F.get(codes, (F.col("ev_id") % 6).cast("int")))
    return X.log(spark, d).select("ev_id", checks.crs_gate(crs).alias("why"))


@query("SELECT CAST(min(lat_floor) AS DOUBLE) AS south, CAST(min(lng_floor) AS DOUBLE) AS west, CAST(max(lat_floor) + 1 AS DOUBLE) AS north, CAST(max(lng_floor) + 1 AS DOUBLE) AS east FROM located")
def tile_box_union(spark, d):
    return checks.union_box(located(spark, d).select(T.bounds(F.col("lat_floor"), F.col("lng_floor")).alias("b")).select("b.*"))


@query("""CTE a AS (SELECT * FROM coarse WHERE c >= 40), b AS (SELECT * FROM dem WHERE z > -99980 AND r < 80), o AS (SELECT r, c, CAST(7 AS INT) AS z FROM grid WHERE r >= 100 AND c < 60)
SELECT CAST(g.r AS INT) AS row, CAST(g.c AS INT) AS col, coalesce(o.z, a.z, b.z) AS value FROM grid g LEFT JOIN o USING (r, c) LEFT JOIN a USING (r, c) LEFT JOIN b USING (r, c) WHERE coalesce(o.z, a.z, b.z) IS NOT NULL""")
def mosaic_priority(spark, d):
    source = lambda df, resolution, path: df.select("row", "col", "value", F.lit(resolution).alias("resolution"), F.lit(path).alias("path"))
    one = X.coarse(spark).filter("row >= 100 AND col < 60").withColumn("value", F.lit(7))
    parts = source(X.dem(spark, d).filter("row < 80"), "10m", "b.tif").unionByName(source(X.coarse(spark).filter("col >= 40"), "10m", "a.tif")).unionByName(source(one, "1m", "z.tif"))
    return resample.mosaic(parts, NONE + 9, ["path"])


@query("""CTE a AS (SELECT 45 AS la, -110 AS lo, r, c, z FROM dem UNION ALL SELECT 45, -109, r, c, z FROM coarse), p AS (SELECT r - 30 AS row, c + (lo + 110) * 120 - 60 AS col, z FROM a WHERE z > -99980)
SELECT CAST(row AS INT) AS row, CAST(col AS INT) AS col, z AS value FROM p WHERE row BETWEEN 0 AND 59 AND col BETWEEN 0 AND 119""")
def mosaic_area(spark, d):
    tile = lambda df, name: df.select(F.lit(name).alias("tile_id"), F.lit("10m").alias("resolution"), "row", "col", "value")
    tiles = tile(X.dem(spark, d), "N45W110").unionByName(tile(X.coarse(spark), "N45W109"))
    return pipelines.build_mosaic(tiles, 45.25, -109.5, 45.75, -108.5, rasters.workspace(spark, "mosaic"), S, buffer_deg=0.1, nodata=NONE + 9)


TARGET = resample.Grid(0.125, 119.875, 0.75, 0.75, 150, 150)
SOURCE = resample.Grid(0.0, 120.0, 1.0, 1.0, S, S)
PLACES = """o AS (SELECT CAST(r AS INT) AS row, CAST(c AS INT) AS col, (r + 0.5) * 0.75 + 0.125 AS y, (c + 0.5) * 0.75 + 0.125 AS x FROM range(0, {0}) AS a(r), range(0, {0}) AS b(c))"""
BILINEAR = """n AS (SELECT row, col, y, x, CAST(floor(y - 0.5) AS INT) + i AS r, CAST(floor(x - 0.5) AS INT) + j AS c FROM o, range(2) AS a(i), range(2) AS b(j)),
w AS (SELECT row, col, z, (1 - abs(y - 0.5 - n.r))::DOUBLE * (1 - abs(x - 0.5 - n.c))::DOUBLE AS w FROM n JOIN {0} USING (r, c) WHERE z > -99980)"""


@query(f"CTE {PLACES.format(150)}, {BILINEAR.format('dem')} SELECT row, col, sum(w * z) / sum(w) AS value FROM w WHERE w > 0 GROUP BY row, col")
def reproject_bilinear(spark, d):
    return resample.reproject_bilinear(X.dem(spark, d), SOURCE, TARGET, F.when(F.col("value") > NONE + 10, F.col("value")))


@query(f"CTE {PLACES.format(150)} SELECT row, col, z AS value FROM o JOIN dem ON r = CAST(floor(y) AS INT) AND c = CAST(floor(x) AS INT)")
def grid_snap(spark, d):
    return resample.reproject_nearest(X.dem(spark, d), SOURCE, TARGET)


@query(f"""CTE {PLACES.format(100).replace('+ 0.125 AS', '+ 0.125 + 10 AS')}, q AS (SELECT a.r, a.c, CASE WHEN a.z <= -99980 OR a.z = 0 THEN b.z ELSE a.z END AS z FROM dem a JOIN coarse b USING (r, c) WHERE r BETWEEN 10 AND 85 AND c BETWEEN 10 AND 85), {BILINEAR.format('q')},
v AS (SELECT row, col, sum(w * z) / sum(w) AS value FROM w WHERE w > 0 GROUP BY row, col) SELECT row, col, value, CASE WHEN z <= -99980 OR z = 0 THEN 1 ELSE 0 END AS gap FROM v JOIN o USING (row, col) JOIN dem ON r = CAST(floor(y) AS INT) AND c = CAST(floor(x) AS INT)""")
def canonical_fill(spark, d):
    dem, gaps = resample.canonical(X.dem(spark, d).withColumn("value", F.col("value").cast("double")), SOURCE, resample.Grid(10.125, 109.875, 0.75, 0.75, 100, 100), X.coarse(spark).withColumn("value", F.col("value").cast("double")), NONE + 9)
    return dem.join(gaps, ["row", "col"])


@query("SELECT label, count(*) AS pixel_count, min(r) AS min_row, max(r) AS max_row, min(c) AS min_col, max(c) AS max_col FROM labels_ GROUP BY label")
def label_boxes(spark, d):
    return water.boxes(pond_cells(spark, d))


@query("SELECT coalesce(quantile_cont(z::DOUBLE, 0.1) FILTER (z > -10000), 0) AS surface, count(*) FILTER (z > -10000) AS n FROM labels_ JOIN dem USING (r, c)")
def masked_percentile(spark, d):
    return water.masked_percentile(X.dem(spark, d), pond_cells(spark, d), 0.1, F.col("value") > -1000 * U)


@query("CTE band AS (SELECT DISTINCT l.r + i AS r, l.c + j AS c FROM labels_ l, range(-2, 3) AS a(i), range(-2, 3) AS b(j) WHERE abs(i) + abs(j) <= 2) SELECT coalesce(quantile_cont(z::DOUBLE, 0.1), 0) AS surface, count(*) AS n FROM (SELECT * FROM band ANTI JOIN labels_ USING (r, c)) JOIN dem USING (r, c) WHERE z > -10000 AND z < 90000")
def shoreline_sample(spark, d):
    return water.sample_shoreline(X.dem(spark, d), pond_cells(spark, d), S, S, 2, 0.1, U)


@query(f"CTE {DIAG} SELECT pid, sd > 50 OR most - least > 200 AS flagged, cx + 0.0625 + hw > 100 OR cy + hh > 100 AS cross_tile, CASE WHEN sd > 50 THEN 'std' WHEN most - least > 200 THEN printf('range %.1f above %.1f', (most - least) / 10, 20.0::DOUBLE) END AS said FROM v JOIN ponds USING (pid)")
def water_cross_tile(spark, d):
    still = vector.still_water(X.ponds(spark, d))
    got = water.diagnostics(X.dem(spark, d), vector.rasterize(vector.edges(still), S, S), U, NONE + 9, polygons=still, height=100, width=100)
    return got.select("pid", "flagged", "cross_tile", F.when(F.col("reason") == "std", "std").otherwise(F.col("text")).alias("said"))


TILED = f"""band AS (SELECT t, r + i AS r, c + j AS c, max(label) AS label FROM tlabels, range(-3, 4) AS a(i), range(-3, 4) AS b(j) WHERE r + i BETWEEN 0 AND {X.PART - 1} AND c + j BETWEEN 0 AND {X.PART - 1} GROUP BY 1, 2, 3),
shore AS (SELECT t, label, quantile_cont(z::DOUBLE, 0.1) AS edge FROM (SELECT * FROM band ANTI JOIN tlabels USING (t, r, c)) JOIN tdem USING (t, r, c) GROUP BY t, label),
body AS (SELECT t, label, count(*) AS n, avg(z) AS mean, quantile_cont(z::DOUBLE, 0.1) AS own FROM tlabels JOIN tdem USING (t, r, c) GROUP BY t, label),
j AS (SELECT t, label, n AS pixel_count, coalesce(edge, own) AS surface, CASE WHEN n < 12 THEN 'too_small' WHEN abs(coalesce(edge, own) - mean) > 100 THEN 'flagged' ELSE 'corrected' END AS status FROM body LEFT JOIN shore USING (t, label))"""


@query(f"CTE {TILED} SELECT d.t, d.r AS row, d.c AS col, round(CASE WHEN status = 'corrected' THEN surface ELSE z::DOUBLE END, 3) AS value FROM tdem d LEFT JOIN tlabels l ON d.t = l.t AND d.r = l.r AND d.c = l.c LEFT JOIN j ON l.t = j.t AND l.label = j.label")
def batch_corrected(spark, d):
    got, _ = pipelines.correct_keyed(X.tile_dem(spark, d), X.tile_ponds(spark, d), X.PART, X.PART, ("t",), U)
    return got.withColumn("value", F.round("value", 3))


@query(f"""CTE {TILED}, s AS (SELECT t, count(*) AS n, count(*) FILTER (status = 'too_small') AS too_small, count(*) FILTER (status = 'flagged') AS flagged, count(*) FILTER (status = 'corrected') AS corrected FROM j GROUP BY t)
SELECT CAST(t AS VARCHAR) AS tile_id, p.n AS polygons, p.n - coalesce(s.n, 0) AS no_pixels, coalesce(too_small, 0) AS too_small, coalesce(flagged, 0) AS flagged, coalesce(corrected, 0) AS corrected FROM (SELECT t, count(*) AS n FROM tponds GROUP BY t) p LEFT JOIN s USING (t)""")
def batch_summary(spark, d):
    named = lambda df: df.withColumn("tile_id", F.col("t").cast("string")).drop("t")
    dem, ponds = named(X.tile_dem(spark, d)), named(X.tile_ponds(spark, d))
    _, found = pipelines.correct_keyed(dem, ponds, X.PART, X.PART, unit=U)
    return pipelines.keyed_summary(dem.select("tile_id").distinct(), found, ponds).select("tile_id", "polygons", "no_pixels", "too_small", "flagged", "corrected")


@query("""CTE f AS (SELECT * FROM log QUALIFY row_number() OVER (PARTITION BY lat_floor, lng_floor ORDER BY ts DESC, ev_id DESC) = 1), k AS (SELECT lat_floor, lng_floor, arg_max(size_mb, (ts, ev_id)) FILTER (status = 'ready') AS size_mb FROM log GROUP BY 1, 2)
SELECT lat_floor, lng_floor, status, k.size_mb, CASE WHEN status = 'failed' THEN 'event ' || ev_id END AS failed_reason FROM f JOIN k USING (lat_floor, lng_floor)""")
def registry_marks(spark, d):
    log = X.log(spark, d)
    size, reason = F.when(F.col("status") == "ready", F.col("size_mb")), F.when(F.col("status") == "failed", F.concat(F.lit("event "), F.col("ev_id")))
    parts = [registry.mark(log.filter(F.col("status") == s).select("lat_floor", "lng_floor", "ev_id", F.col("ts").alias("at"), size.alias("mb"), reason.alias("why")), s, F.col("at"), size_mb=F.col("mb"), failed_reason=F.col("why")) for s in ("pending", "ready", "failed")]
    marks = parts[0].unionByName(parts[1]).unionByName(parts[2])
    got = registry.latest(marks.drop("at", "mb", "why"), ["lat_floor", "lng_floor"], ["ts", "ev_id"], ["size_mb"])
    return got.select("lat_floor", "lng_floor", "status", "size_mb", "failed_reason")


@query(f"SELECT {TID} AS tile_id, status, CAST(size_mb AS DOUBLE) AS size_mb FROM state WHERE status <> 'pending'")
def registry_file(spark, d):
    path = rasters.workspace(spark, "registry") + "/registry.json"
    rows = state(spark, d).select(T.tile_id(F.col("lat_floor"), F.col("lng_floor")).alias("tile_id"), "status", F.col("size_mb").cast("double").alias("size_mb"))
    rasters.replace_text(spark, path, rasters.registry_json(rows, "2026-01-01T00:00:00Z"))
    rasters.update_registry(spark, path, lambda s: s.filter("status <> 'pending'"), "2026-01-02T00:00:00Z")
    return rasters.read_registry(spark, path).select("tile_id", "status", "size_mb")


def written_tiffs(spark, d) -> str:
    folder = rasters.workspace(spark, "tiffs")
    rasters.write_tiffs(X.dem(spark, d).withColumn("tile_id", F.lit("N45W110")), folder, S, tile=32)
    return folder


@query("SELECT r AS row, c AS col, z AS value FROM dem")
def geotiff_roundtrip(spark, d):
    return rasters.read_tiffs(spark, written_tiffs(spark, d)).select("row", "col", F.col("value").cast("int").alias("value"))


@query("SELECT 120 AS width, 120 AS height, -110.0::DOUBLE AS west, 45.0::DOUBLE AS south, -109.0::DOUBLE AS east, 46.0::DOUBLE AS north, 'EPSG:4326' AS crs, -9999.0::DOUBLE AS nodata, true AS readable", fixtures=False)
def geotiff_headers(spark, d):
    got = rasters.read_headers(spark, written_tiffs(spark, d))
    return got.select("width", "height", *[F.round(c, 9).alias(c) for c in ("west", "south", "east", "north")], "crs", "nodata", "readable")


@query("SELECT r AS row, c AS col, z AS value FROM dem WHERE r BETWEEN 30 AND 59 AND c BETWEEN 50 AND 69")
def raster_window_scan(spark, d):
    path = rasters.workspace(spark, "pixels")
    rasters.write_pixels(X.dem(spark, d).withColumn("tile_id", F.lit("N45W110")), path)
    return rasters.read_pixels(spark, path, ["N45W110"], (30, 60, 50, 70)).select("row", "col", "value")


@query("SELECT CAST(pid AS BIGINT) AS id, name, CASE WHEN pid % 4 = 0 THEN NULL ELSE 'water' END AS natural, CASE WHEN is_rect = 1 THEN 5 ELSE 4 END AS points FROM ponds WHERE pid % 5 <> 2")
def osm_water(spark, d):
    p = X.ponds(spark, d)
    # Every fifth has two points only; rings of four corners are closed, those of three get their first again.
    ring = F.when(F.col("pid") % 5 == 2, F.slice(F.col("rings")[0], 1, 2)).when(F.col("is_rect") == 1, F.col("rings")[0]).otherwise(F.slice(F.col("rings")[0], 1, 3))
    tags = F.when(F.col("pid") % 4 == 0, F.create_map(F.lit("landuse"), F.lit("reservoir"), F.lit("name"), F.col("name"))).otherwise(F.create_map(F.lit("natural"), F.lit("water"), F.lit("name"), F.col("name")))
    element = F.struct(F.col("pid").cast("long").alias("id"), F.lit("way").alias("type"), tags.alias("tags"), F.transform(ring, lambda x: F.struct(x[1].alias("lat"), x[0].alias("lon"))).alias("geometry"))
    raw = p.select(F.to_json(F.struct(F.array(element).alias("elements"))).alias("value"))
    return rasters.overpass_water(raw).select("id", "name", "natural", F.size(F.col("rings")[0]).alias("points"))


@query("SELECT * FROM (VALUES (0, 'A', 390, 4), (1, 'B', NULL, 5)) AS v(i, name, ftype, points)", fixtures=False)
def water_file(spark, d):
    feature = lambda ring, name, kind: '{"type":"Feature","geometry":{"type":"Polygon","coordinates":[' + ring + ']},"properties":{"Name":"' + name + '"' + kind + "}}"
    text = '{"type":"FeatureCollection","features":[' + feature("[[0,0],[1,0],[1,1],[0,0]]", "A", ',"FType":"390"') + "," + feature("[[0,0],[2,0],[2,2],[0,2],[0,0]]", "B", "") + ',{"type":"Feature","geometry":null,"properties":{}}]}'
    path = rasters.workspace(spark, "features") + "/water.geojson"
    rasters.replace_text(spark, path, text)
    return vector.parse_features(rasters.read_features(spark, path)).select("i", "name", "ftype", F.size(F.col("rings")[0]).alias("points"))


@query("SELECT sha256('gridmill') AS sha256, CAST(1 AS BIGINT) AS files, 8 / 1048576.0::DOUBLE AS mb", fixtures=False)
def file_digests(spark, d):
    folder = rasters.workspace(spark, "file")
    rasters.replace_text(spark, f"{folder}/a.tif", "gridmill")
    return rasters.digests(spark, folder, "*.tif").select("sha256").crossJoin(rasters.directory_mb(rasters.list_files(spark, folder)))


@query("SELECT a.r AS row, a.c AS col, CASE WHEN a.z <= -99980 OR a.z = 0 THEN b.z ELSE a.z END AS value FROM dem a JOIN coarse b ON a.r = b.r AND a.c = b.c")
def repaired_dem(spark, d):
    path = rasters.workspace(spark, "repair")
    X.dem(spark, d).write.parquet(path)
    pipelines.repair_stored(spark, path, lambda: X.coarse(spark), S, S, nodata=NONE + 9)
    return spark.read.parquet(path)


@query("SELECT pid, name FROM ponds ORDER BY pid LIMIT 20")
def correction_preview(spark, d):
    return pipelines.preview(X.ponds(spark, d))[1].select("pid", "name")


@query("SELECT name, 'raw/' || name || '.tif' AS raw_path, CASE WHEN pid % 3 = 0 THEN 'out/' || name || '_corrected.tif' END AS corrected_path, pid % 3 = 0 AS corrected FROM (SELECT pid, replace(name, '#', '') AS name FROM ponds)")
def tile_index(spark, d):
    name = X.ponds(spark, d).select("pid", F.replace("name", F.lit("#"), F.lit("")).alias("name"))
    raw = name.select(F.concat(F.lit("raw/"), "name", F.lit(".tif")).alias("path"))
    done = name.filter("pid % 3 = 0").select(F.concat(F.lit("out/"), "name", F.lit("_corrected.tif")).alias("path"))
    return pipelines.tile_index(raw, done)


@query("CTE q AS (SELECT pid, row_number() OVER (ORDER BY cy, cx, pid) - 1 AS n, count(*) OVER () AS many FROM ponds) SELECT pid, CAST(n // greatest(1, CAST(ceil(many / 7.0) AS BIGINT)) AS INT) AS chunk FROM q")
def chunk_numbers(spark, d):
    return vector.chunks(X.ponds(spark, d), 7, ["cy", "cx", "pid"]).select("pid", "chunk")


@query(f"SELECT {TID} AS tile_id, '10m,30m' AS candidates, 'planned' AS status FROM range(44, 47) AS a(lat_floor), range(-113, -108) AS b(lng_floor)", fixtures=False)
def study_area_plan(spark, d):
    got = pipelines.download_study_area(spark, "area", "N44W113", "N46W109", "", dry_run=True)
    return got.select("tile_id", F.array_join("candidates", ",").alias("candidates"), "status")


@query(f"CTE {PAD}, h AS (SELECT *, lag(flat, 1, 0) OVER (PARTITION BY r ORDER BY c) AS a, lead(flat, 1, 0) OVER (PARTITION BY r ORDER BY c) AS b, lag(flat, 1, 0) OVER (PARTITION BY c ORDER BY r) AS e, lead(flat, 1, 0) OVER (PARTITION BY c ORDER BY r) AS f FROM fl), k AS (SELECT CAST(sum(flat) AS BIGINT) AS f, count(*) FILTER (flat = 1 AND least(a, b, e, f) = 0) AS b FROM h), v AS (SELECT count(*) FILTER (z <= -99980 OR z = 0) AS v FROM dem) SELECT panel, round(100.0 * n / 14400, 2)::DOUBLE AS pct, n FROM (SELECT 'void' AS panel, v AS n FROM v UNION ALL SELECT 'flat', f FROM k UNION ALL SELECT 'boundary', b FROM k)")
def report_panels(spark, d):
    dem = X.dem(spark, d)
    panels = pipelines.report(dem, focal.boundary_mask(flat(spark, d)), nodata=NONE + 9)
    one = lambda k: panels[k].select(F.lit(k).alias("panel"), "pct", "n")
    return one("void").unionByName(one("flat")).unionByName(one("boundary"))


@query("SELECT 'N45W110' AS tile_id, 'ready' AS status, true AS built, true AS skipped", fixtures=False)
def registered_build(spark, d):
    # A steep and a flat half, so that the gates hold; built once, then skipped.
    root, size = rasters.workspace(spark, "root"), 40
    steep = spark.range(size * size).select(F.floor(F.col("id") / size).cast("int").alias("row"), (F.col("id") % size).cast("int").alias("col"))
    steep = steep.withColumn("value", F.when(F.col("row") < 20, 500.0 + (F.col("row") * 37 + F.col("col") * 91) % 83).otherwise(500.0))
    run = lambda: pipelines.build_registered(spark, root, "N45W110", lambda out: pipelines.build_tile(spark, "N45W110", steep, out, size, size), "2026-01-01T00:00:00Z")
    first, second = run(), run()
    got = rasters.read_registry(spark, f"{root}/registry.json").filter("size_mb > 0")
    return got.select("tile_id", "status", F.lit(first.success).alias("built"), F.lit(second.steps[0].name == "skipped").alias("skipped"))
