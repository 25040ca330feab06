import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gridmill.functions import rules as R
from gridmill.operators import blocks, checks, focal, masks, registry, resample, vector, water
from gridmill.plans import pipelines
from gridmill.sources import rasters


def pixels(spark, z, kind="double"):
    cast = int if kind in ("int", "long") else float
    return spark.createDataFrame([(r, c, cast(v)) for r, line in enumerate(np.asarray(z).tolist()) for c, v in enumerate(line)], f"row int, col int, value {kind}")


def array(df, column, shape):
    out = np.zeros(shape)
    for r in df.collect():
        out[r.row, r.col] = r[column]
    return out


def brute_flat(z, thr):
    p = np.pad(z, 2, "symmetric")
    return np.array([[p[r : r + 5, c : c + 5].var() < thr for c in range(z.shape[1])] for r in range(z.shape[0])])


def brute_boundary(flat):
    p = np.pad(flat, 1)
    return flat & ~(p[:-2, 1:-1] & p[2:, 1:-1] & p[1:-1, :-2] & p[1:-1, 2:])


@pytest.mark.parametrize("seed", [1, 2])
def test_flat_and_boundary(spark, seed):
    rng = np.random.default_rng(seed)
    z = rng.integers(0, 9, (23, 31)) * rng.integers(0, 2, (23, 31))
    df = pixels(spark, z, "long")
    flat = focal.flat_mask(df, F.col("value"), 23, 31, 5, 4)
    both = focal.boundary_mask(flat)
    want = brute_flat(z.astype(float), 4)
    assert (array(both, "flat", z.shape) == want).all()
    edge = array(both, "boundary", z.shape)
    assert (edge == brute_boundary(want)).all() and (edge <= want).all()
    for size in (8, 16):
        got = blocks.flat_and_boundary(masks.to_blocks(df, size).drop("w"), size, 23, 31)
        flat_b = masks.from_blocks(got.select("block_row", "block_col", F.least(F.lit(size), 31 - F.col("block_col") * size).alias("w"), F.col("flat").alias("values")), size)
        edge_b = masks.from_blocks(got.select("block_row", "block_col", F.least(F.lit(size), 31 - F.col("block_col") * size).alias("w"), F.col("boundary").alias("values")), size)
        assert (array(flat_b, "value", z.shape) == want).all()
        assert (array(edge_b, "value", z.shape) == edge).all()


def test_even_window_is_refused(spark):
    with pytest.raises(ValueError, match="odd"):
        focal.box_sums(pixels(spark, [[1]]), F.col("value"), 4, 1, 1)


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 19), st.integers(0, 19)), min_size=1, max_size=12, unique=True), st.integers(1, 3))
def test_dilation(spark, cells, k):
    df = spark.createDataFrame([(r, c, i + 1) for i, (r, c) in enumerate(cells)], "row int, col int, label int")
    for op, near in ((focal.dilate_square, lambda a, b: max(abs(a), abs(b)) <= k), (focal.dilate_diamond, lambda a, b: abs(a) + abs(b) <= k)):
        got = {(r.row, r.col): r.label for r in op(df, k, 20, 20).collect()}
        want = {}
        for i, (r, c) in enumerate(cells):
            for y in range(20):
                for x in range(20):
                    if near(y - r, x - c):
                        want[(y, x)] = max(want.get((y, x), 0), i + 1)
        assert got == want and all(got[c] >= i + 1 for i, c in enumerate(cells))


def test_resampling(spark):
    z = np.arange(64.0).reshape(8, 8)
    df = pixels(spark, z)
    avg = array(resample.average(df, 4, F.col("value")), "value", (2, 2))
    assert np.allclose(avg, z.reshape(2, 4, 2, 4).mean((1, 3)))
    assert (array(resample.nearest(df, 2), "value", (16, 16)) == np.kron(z, np.ones((2, 2)))).all()
    b = resample.bilinear(df, 2, 8, 8, F.col("value")).withColumn("value", F.col("num") / F.col("den"))
    got = array(b, "value", (16, 16))
    assert np.isclose(got[1, 1], 0.25 * 9 * 0.25 + 0.75 * 0.25 * (1 + 8)) and np.isclose(got[0, 0], 0)
    assert (got.min(), got.max()) == (0, 63)
    assert array(resample.decimate(df, 4), "value", (2, 2)).tolist() == [[18, 22], [50, 54]]


def test_merge_fill_crop(spark):
    a, b = np.full((3, 3), -9999.0), np.full((3, 3), 7.0)
    a[1, 1] = 5
    got = resample.merge_first_valid([pixels(spark, a), pixels(spark, b)])
    assert array(got, "value", (3, 3)).sum() == 5 + 8 * 7
    filled = resample.fill_gaps(pixels(spark, a), pixels(spark, b), R.is_gap(F.col("value")))
    assert array(filled, "value", (3, 3))[1, 1] == 5 and filled.agg(F.sum("filled")).first()[0] == 8
    assert resample.crop(pixels(spark, b), 1, 3, 1, 2).count() == 2
    assert resample.pixel_window((44.25, -110.5, 44.75, -110.25), -111.0, 45.0, 0.25) == (1, 3, 2, 3)
    outside = resample.window_slice(pixels(spark, b).withColumnRenamed("value", "flat"), -1, 2, 3, 3)
    assert array(outside, "flat", (3, 3)).tolist() == [[0, 0, 0], [7, 0, 0], [7, 0, 0]]


def test_rasterize_with_hole(spark):
    ring = [[1.0, 1.0], [9.0, 1.0], [9.0, 9.0], [1.0, 9.0], [1.0, 1.0]]
    hole = [[3.0, 3.0], [6.0, 3.0], [6.0, 6.0], [3.0, 6.0]]
    df = spark.createDataFrame([(0, [ring, hole])], "pid int, rings array<array<array<double>>>")
    got = {(r.row, r.col) for r in vector.rasterize(vector.edges(df), 10, 10).collect()}
    assert got == {(r, c) for r in range(1, 9) for c in range(1, 9) if not (3 <= r < 6 and 3 <= c < 6)}


@pytest.mark.parametrize("seed", range(3))
def test_rasterize_random(spark, seed):
    rng = np.random.default_rng(seed)
    t = np.sort(rng.uniform(0, 2 * np.pi, 9))
    pts = np.stack([10 + rng.uniform(2, 9, 9) * np.cos(t), 10 + rng.uniform(2, 9, 9) * np.sin(t)], 1)
    df = spark.createDataFrame([(0, [pts.tolist()])], "pid int, rings array<array<array<double>>>")
    got = {(r.row, r.col) for r in vector.rasterize(vector.edges(df), 20, 20).collect()}

    def inside(x, y):
        n = 0
        for (x1, y1), (x2, y2) in zip(pts, np.roll(pts, -1, 0), strict=True):
            if (y1 <= y) != (y2 <= y) and x < x1 + (y - y1) * (x2 - x1) / (y2 - y1):
                n += 1
        return n % 2 == 1

    assert got == {(r, c) for r in range(20) for c in range(20) if inside(c + 0.5, r + 0.5)}


def test_flat_lake_changes_nothing_and_noisy_lake_is_levelled(spark):
    z = np.full((20, 20), 50.0)
    ring = [[[5.0, 5.0], [11.0, 5.0], [11.0, 11.0], [5.0, 11.0], [5.0, 5.0]]]
    df = spark.createDataFrame([(0, ring)], "pid int, rings array<array<array<double>>>")
    same, judged = pipelines.correct(pixels(spark, z), df, 20, 20)
    assert (array(same, "value", z.shape) == z).all() and judged.first().status == "corrected"
    z[5:11, 5:11] += np.arange(36).reshape(6, 6) % 7
    fixed, judged = pipelines.correct(pixels(spark, z), df, 20, 20)
    assert (array(fixed, "value", z.shape) == 50).all()
    z[5:11, 5:11] = 90
    kept, judged = pipelines.correct(pixels(spark, z), df, 20, 20)
    assert (array(kept, "value", z.shape) == z).all() and judged.first().status == "flagged"
    assert tuple(pipelines.correction_summary(judged, 3).first()) == (3, 2, 0, 0, 1, 0, 0)
    c = water.centroids(pipelines.polygon_cells(df, 20, 20)).first()
    assert (c.row, c.col) == (7, 7)


def test_pack_bits(spark):
    m = pixels(spark, [[1, 0, 1, 0, 0, 0, 0, 1, 1, 1]], "int").withColumnRenamed("value", "flat")
    got = masks.pack_rows(m).first()
    assert (bytes(got.bits), got.width) == (np.packbits([1, 0, 1, 0, 0, 0, 0, 1, 1, 1]).tobytes(), 10)


def test_registry_log_and_limits(spark):
    log = spark.createDataFrame(
        [("A", "pending", 1, 0, None), ("A", "ready", 2, 100, None), ("B", "ready", 1, 60, None), ("C", "ready", 3, 50, None), ("C", "failed", 4, None, "x"), ("D", "removed", 9, None, None)],
        "tile_id string, status string, ts int, size_mb long, failed_reason string",
    )
    s = registry.live(registry.latest(log, ["tile_id"], ["ts"], ["size_mb"]))
    assert {(r.tile_id, r.status, r.size_mb) for r in s.collect()} == {("A", "ready", 100), ("B", "ready", 60), ("C", "failed", 50)}
    t = registry.totals(s).first()
    assert (t.tile_count, t.ready_count, t.total_size_mb) == (3, 2, 210)
    gone = registry.evictions(s, 61, ["tile_id"])
    assert [r.tile_id for r in gone.orderBy("ts").collect()] == ["B", "A"]
    assert [r.tile_id for r in registry.evictions(s, 60, ["tile_id"]).collect()] == ["B"]
    assert [r.tile_id for r in registry.evictions(s, 60, ["tile_id"], s.filter("tile_id = 'B'")).collect()] == ["A"]
    assert not registry.capacity(s, 41, 250, "hard").first().allowed and registry.capacity(s, 40, 250, "hard").first().allowed
    assert registry.capacity(s, 41, 250, "warn").first().warning and registry.capacity(s, 41, 250, "lru", gone).first().allowed
    assert {r.tile_id for r in registry.prune_failed(s).collect()} == {"A", "B"}
    assert [r.status for r in registry.status_of(spark.createDataFrame([("Z",)], "tile_id string"), s, ["tile_id"]).collect()] == ["absent"]


@pytest.mark.parametrize(("pct", "span", "ocean", "ok"), [(0.0, 50.0, False, False), (100.0, None, True, False), (99.93, 60.0, False, True), (99.99, 0.5, False, False), (99.99, 0.5, True, True)])
def test_flat_gate(spark, pct, span, ocean, ok):
    df = spark.createDataFrame([(pct, span)], "p double, s double")
    assert (df.select(checks.flat_gate(F.col("p"), F.col("s"), F.lit(ocean)).alias("w")).first().w is None) == ok


def test_registry_file(spark, tmp_path):
    state = spark.createDataFrame([("N45W110", "ready", 12.5)], "tile_id string, status string, size_mb double")
    path = f"file://{tmp_path}/registry.json"
    assert rasters.read_registry(spark, path).count() == 0
    for _ in range(2):
        rasters.replace_text(spark, path, rasters.registry_json(state, "2026-01-01T00:00:00Z"))
    got = rasters.read_registry(spark, path).first()
    assert (got.tile_id, got.status, got.size_mb, got.dem_file) == ("N45W110", "ready", 12.5, None)
    assert {p.name for p in tmp_path.iterdir() if not p.name.endswith(".crc")} == {"registry.json"}
    for bad in ('{"version": 2, "tiles": {}}', '{"version": 1, "tiles": {"A": {"status": "lost"}}}', "{oops"):
        rasters.replace_text(spark, path, bad)
        with pytest.raises(Exception, match=r"version|status|MALFORMED"):
            rasters.read_registry(spark, path).collect()


def test_tiff_round_trip(spark, tmp_path):
    z = np.arange(12, dtype=np.float32).reshape(3, 4)
    (tmp_path / "a.tif").write_bytes(rasters.encode_tiff(z, -110.0, 46.0, 0.25))
    (tmp_path / "b.tif").write_bytes(b"junk")
    values, head = rasters.decode_tiff((tmp_path / "a.tif").read_bytes())
    assert (values == z).all() and head["crs"] == "EPSG:4326" and head["nodata"] == -9999 and (head["west"], head["south"], head["east"], head["north"]) == (-110.0, 45.25, -109.0, 46.0)
    heads = {r.path[-5:]: r.readable for r in rasters.read_headers(spark, str(tmp_path)).collect()}
    assert heads == {"a.tif": True, "b.tif": False}
    (tmp_path / "b.tif").unlink()
    assert (array(rasters.read_tiffs(spark, str(tmp_path)), "value", z.shape) == z).all()
    rasters.register(spark)
    assert (array(spark.read.format("geotiff").load(str(tmp_path)), "value", z.shape) == z).all()
    assert rasters.list_files(spark, str(tmp_path)).count() == 1


@pytest.mark.parametrize(("tile", "predictor", "big", "deflate"), [(0, 1, False, True), (16, 2, True, True), (32, 3, False, True), (16, 3, True, False), (0, 2, True, False)])
def test_tiff_layouts(tile, predictor, big, deflate):
    rng = np.random.default_rng(tile + predictor)
    z = rng.normal(500, 90, (300, 75)).astype(np.float32)
    z[3, 4] = -9999
    data = rasters.encode_tiff(z, -110.0, 46.0, 0.01, tile=tile, predictor=predictor, big=big, deflate=deflate, crs=26912 if big else 4269)
    values, head = rasters.decode_tiff(data)
    assert (values == z).all() and head["crs"] == ("EPSG:26912" if big else "EPSG:4269") and np.isclose(head["east"], -109.25)
    reads = []
    tiff = rasters.Tiff(lambda o, n: reads.append(n) or data[o : o + n])
    assert sum(reads) < 2000 + 16 * len(tiff.places) and tiff.header == head  # pixels aren't read for the header
    offset, size = tiff.places[-1]
    with pytest.raises((ValueError, rasters.zlib.error)):  # a block that can't be read
        list(rasters.Tiff(lambda o, n: data[o : o + n // 2] if o == offset and n == size else data[o : o + n]).blocks())


def test_write_tiffs(spark, tmp_path):
    rng = np.random.default_rng(1)
    z = {n: rng.integers(0, 900, (40, 40)).astype(float) for n in ("N45W110", "S03E007")}
    df = pixels(spark, z["N45W110"]).withColumn("tile_id", F.lit("N45W110")).unionByName(pixels(spark, z["S03E007"]).withColumn("tile_id", F.lit("S03E007")).filter("row < 39"))
    index = rasters.write_tiffs(df, f"file://{tmp_path}/t", 40, tile=16).collect()
    assert {r.tile_id for r in index} == set(z)
    heads = {r.path.rpartition("/")[2][:7]: r for r in rasters.read_headers(spark, str(tmp_path / "t")).collect()}
    assert (heads["S03E007"].south, heads["S03E007"].west, heads["S03E007"].readable) == (-3.0, 7.0, True)
    z["S03E007"][39] = -9999
    for name, want in z.items():
        assert (array(rasters.read_tiffs(spark, str(tmp_path / "t")).filter(F.col("path").contains(name)), "value", (40, 40)) == want).all()


def test_features(spark, tmp_path):
    text = '{"type":"FeatureCollection","features":[{"type":"Feature","geometry":{"type":"Polygon","coordinates":[[[0,0],[1,0],[1,1],[0,0]]]},"properties":{"Name":"A","FType":"390"}},{"type":"Feature","geometry":null,"properties":{}}]}'
    (tmp_path / "x.json").write_text(text)
    got = vector.parse_features(rasters.read_features(spark, str(tmp_path / "x.json"))).collect()
    assert [(r.i, r.name, r.ftype, len(r.rings[0])) for r in got] == [(0, "A", 390, 4)]
    osm = spark.createDataFrame([('{"elements":[{"id":1,"tags":{"natural":"water"},"geometry":[{"lat":0,"lon":0},{"lat":0,"lon":1},{"lat":1,"lon":1}]},{"id":2,"tags":{"natural":"water"},"geometry":[{"lat":0,"lon":0}]}]}',)], "value string")
    r = rasters.overpass_water(osm).collect()
    assert [x.id for x in r] == [1] and len(r[0].rings[0]) == 4


def test_build_tile(spark, tmp_path):
    rng = np.random.default_rng(3)
    z = np.full((40, 40), 500.0)
    z[:20, :20] = 1000 + rng.uniform(0, 90, (20, 20))
    z[25:28, 25:28] = -9999
    b = pipelines.build_tile(spark, "N45W110", pixels(spark, z), f"file://{tmp_path}/t", 40, 40, fallback=pixels(spark, np.full((40, 40), 500.0)))
    assert b.success and [s.name for s in b.steps] == ["crop_and_fill", "flat_mask", "boundary_mask"] and b.steps[0].detail["gaps"] == 0
    bad = pipelines.build_tile(spark, "N45W110", pixels(spark, np.full((40, 40), 500.0)), f"file://{tmp_path}/u", 40, 40)
    assert not bad.success and bad.steps[-1].error == "degenerate raster"


def test_mosaic_and_repair(spark, tmp_path):
    a = pixels(spark, np.full((4, 4), 1.0)).withColumn("tile_id", F.lit("N45W110")).withColumn("resolution", F.lit("30m"))
    b = pixels(spark, np.full((4, 4), 2.0)).withColumn("tile_id", F.lit("N45W109")).withColumn("resolution", F.lit("10m"))
    rasters.write_pixels(a.unionByName(b), str(tmp_path / "m"))
    got = pipelines.mosaic(rasters.read_pixels(spark, str(tmp_path / "m")), 45.0, -109.5, 46.0, -108.5, 4)
    assert array(got, "value", (4, 4)).tolist() == [[1, 1, 2, 2]] * 4
    z = np.full((4, 4), 3.0)
    assert pipelines.repair(pixels(spark, z), lambda: 1 / 0)[0] == "no_gaps"
    z[0, 0] = -9999
    status, fixed, n = pipelines.repair(pixels(spark, z), lambda: pixels(spark, np.full((4, 4), 9.0)))
    assert (status, n) == ("repaired", {"before": 1, "after": 0}) and array(fixed, "value", (4, 4))[0, 0] == 9


def test_mosaic_of_two_resolutions_and_ties(spark):
    ten, thirty = np.arange(16.0).reshape(4, 4), np.array([[40.0, 80.0], [40.0, 80.0]])
    a = pixels(spark, ten).filter("col < 2").withColumn("tile_id", F.lit("N45W110")).withColumn("resolution", F.lit("10m"))
    b = pixels(spark, thirty).withColumn("tile_id", F.lit("N45W110")).withColumn("resolution", F.lit("30m"))
    got = array(pipelines.mosaic(a.unionByName(b), 45.0, -110.0, 46.0, -109.0, {"10m": 4, "30m": 2}), "value", (4, 4))
    assert (got[:, :2] == ten[:, :2]).all() and got[:, 2:].tolist() == [[70.0, 80.0]] * 4
    two = [pixels(spark, np.full((2, 2), v)).withColumn("resolution", F.lit("10m")).withColumn("path", F.lit(p)) for v, p in ((900.0, "a.tif"), (100.0, "b.tif"))]
    assert (array(resample.mosaic(two[0].unionByName(two[1]), order=["path"]), "value", (2, 2)) == 900).all()


def test_reproject(spark):
    rng = np.random.default_rng(2)
    z = rng.uniform(0, 90, (7, 9))
    z[2, 3] = -9999
    source, target = resample.Grid(10.0, 50.0, 0.1, 0.1, 7, 9), resample.Grid(10.13, 49.87, 0.037, 0.041, 11, 16)
    got = array(resample.reproject_bilinear(pixels(spark, z), source, target, F.when(F.col("value") > -9998, F.col("value"))), "value", (11, 16))
    near = array(resample.reproject_nearest(pixels(spark, z), source, target), "value", (11, 16))
    for r in range(11):
        for c in range(16):
            y, x = (50.0 - (49.87 - (r + 0.5) * 0.041)) / 0.1, (10.13 + (c + 0.5) * 0.037 - 10.0) / 0.1
            assert near[r, c] == z[int(y), int(x)]
            num = den = 0.0
            for i in range(7):
                for j in range(9):
                    w = max(0, 1 - abs(y - 0.5 - i)) * max(0, 1 - abs(x - 0.5 - j))
                    if w and z[i, j] > -9998:
                        num, den = num + w * z[i, j], den + w
            assert np.isclose(got[r, c], num / den)


def test_canonical_grid(spark):
    z = np.full((6, 6), 5.0)
    z[1, 1] = -9999
    tile = resample.Grid.of_tile(45, -110, 4)
    around = resample.Grid(-110.25, 46.25, 0.25, 0.25, 6, 6)
    dem, gaps = resample.canonical(pixels(spark, z), around, tile, pixels(spark, np.full((6, 6), 7.0)))
    assert array(dem, "value", (4, 4))[0, 0] == 7 and array(gaps, "gap", (4, 4)).sum() == 1 and around.cropped(1, 5, 1, 5).same(tile)
    fine, gaps = resample.canonical(pixels(spark, z), around, resample.Grid.of_tile(45, -110, 8))
    assert np.isin(array(fine, "value", (8, 8)), (5, -9999)).all() and fine.filter("value < 0").count() == 1  # next to the gap alone
    assert array(gaps, "gap", (8, 8))[:2, :2].all() and gaps.agg(F.sum("gap")).first()[0] == 4 and fine.count() == 64


def test_numbering_and_chunks(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k"))
    got = {r.k: r.n for r in vector.numbered(df.repartition(5), ["k"]).collect()}
    assert got == {k: k for k in range(1000)}
    assert sorted((r.chunk, r["count"]) for r in vector.chunks(df, 3, ["k"]).groupBy("chunk").count().collect()) == [(0, 334), (1, 334), (2, 332)]


def test_registered_builds(spark, tmp_path):
    root, made = f"file://{tmp_path}/root", []

    def make(ok=True, mb=1):
        def run(out):
            made.append(out)
            spark.range(mb).write.mode("overwrite").parquet(f"{out}/dem")
            b = pipelines.Build("x")
            b.add("dem", None if ok else "no elevation")
            return b

        return run

    build = lambda tile, now, **kw: pipelines.build_registered(spark, root, tile, kw.pop("make", make()), now, **kw)
    state = lambda: {r.tile_id: r for r in rasters.read_registry(spark, f"{root}/registry.json").collect()}
    assert build("N45W110", "t1").success and state()["N45W110"].status == "ready" and state()["N45W110"].size_mb > 0
    assert build("N45W110", "t2").steps[0].name == "skipped" and len(made) == 1
    assert not build("N45W109", "t2", make=make(False)).success and state()["N45W109"].failed_reason == "no elevation"
    refused = build("N45W108", "t3", estimate_mb=10.0, cap_gb=5 / 1024)
    assert not refused.success and refused.steps[-1].name == "capacity" and state()["N45W108"].status == "failed" and len(made) == 2
    assert build("N45W107", "t4", estimate_mb=10.0, cap_gb=5 / 1024, policy="warn").steps[0].detail["warning"]
    small = state()["N45W110"].size_mb
    lru = build("N45W106", "t5", estimate_mb=1.0, cap_gb=(1.0 + small * 1.5) / 1024, policy="lru", protected=("N45W107",))
    assert lru.success and lru.steps[0].detail["evicted"] == ["N45W110"] and "N45W110" not in state() and not (tmp_path / "root/tiles/N45W110").exists()
    assert pipelines.prune_failed(spark, root, "t6") == ["N45W108", "N45W109"] and set(state()) == {"N45W106", "N45W107"}


def test_correct_all_resumes(spark, tmp_path):
    z = np.full((20, 20), 50.0)
    z[5:11, 5:11] += np.arange(36).reshape(6, 6) % 7
    ring = [[[5.0, 5.0], [11.0, 5.0], [11.0, 11.0], [5.0, 11.0], [5.0, 5.0]]]
    names = ["N45W110", "N45W109", "N46W110"]
    both = [pixels(spark, z + i).withColumn("tile_id", F.lit(n)) for i, n in enumerate(names)]
    rasters.write_pixels(both[0].unionByName(both[1]), str(tmp_path / "raw"))
    polygons = spark.createDataFrame([(n, 0, ring) for n in names[:1]] + [(names[2], 1, ring)], "tile_id string, pid int, rings array<array<array<double>>>")
    run = lambda: {r.tile_id: (r.polygons, r.corrected) for r in pipelines.correct_all(spark, str(tmp_path / "raw"), str(tmp_path / "out"), polygons, 20, 20).collect()}
    assert run() == {"N45W110": (1, 1), "N45W109": (0, 0)}
    rasters.write_pixels(both[0].unionByName(both[1]).unionByName(both[2]), str(tmp_path / "raw"))
    assert run() == {"N46W110": (1, 1)}
    got = spark.read.parquet(str(tmp_path / "out"))
    assert (array(got.filter("tile_id = 'N45W110'"), "value", (20, 20)) == 50).all() and (array(got.filter("tile_id = 'N45W109'"), "value", (20, 20)) == z + 1).all() and got.count() == 1200


def test_repair_in_place_keeps_a_backup(spark, tmp_path):
    z, path = np.full((20, 20), 50.0), f"file://{tmp_path}/dem"
    z[5:9, 5:9], z[0, 0] = 53, -9999
    ring = [[[5.0, 5.0], [9.0, 5.0], [9.0, 9.0], [5.0, 9.0], [5.0, 5.0]]]
    water_ = spark.createDataFrame([(0, ring)], "pid int, rings array<array<array<double>>>")
    pixels(spark, z).write.parquet(path)
    other = lambda: pixels(spark, np.full((20, 20), 50.0))
    assert pipelines.repair_stored(spark, path, other, 20, 20, dry_run=True)[0] == "dry_run"
    status, n = pipelines.repair_stored(spark, path, other, 20, 20, water_)
    assert status == "repaired" and n["after"] == 0 and n["water"]["corrected"] == 1
    assert (array(spark.read.parquet(path), "value", (20, 20)) == 50).all() and (array(spark.read.parquet(f"{path}.bak"), "value", (20, 20)) == z).all()


def test_study_area_download(spark, tmp_path):
    good = rasters.encode_tiff(np.random.default_rng(0).normal(size=(60, 60)), 0, 1, 1 / 60)

    def transport(url):
        return None if "n46w110" in url else good if "USGS" in url and "n46" in url else good[: len(good) // 2] if "W110" in url else good

    plan = pipelines.download_study_area(spark, "a", "N45W110", "N46W109", "", dry_run=True).collect()
    assert len(plan) == 4 and all(r.candidates == ["10m", "30m"] and r.status == "planned" for r in plan)
    got = {r.tile_id: r for r in pipelines.download_study_area(spark, "a", "N45W110", "N46W109", f"file://{tmp_path}/s", transport).collect()}
    assert (got["N45W109"].label, got["N45W110"].status, got["N46W109"].label) == ("10m", "missing", "30m" if got["N46W109"].label == "30m" else "10m")
    assert "manifest.json" in {p.name for p in (tmp_path / "s").iterdir()} and rasters.open_tiff(got["N45W109"].path).w == 60


def test_shoreline_sample_and_masked_percentile(spark):
    z = np.full((9, 9), 30.0)
    z[3:6, 3:6], z[2, 3:6] = 10, 20
    mask = pixels(spark, z).filter("value = 10").select("row", "col")
    got = water.sample_shoreline(pixels(spark, z), mask, 9, 9, 1, 0.0).first()
    assert (got.surface, got.n) == (20.0, 12)
    assert water.masked_percentile(pixels(spark, z), mask, 0.5).first().surface == 10 and water.masked_percentile(pixels(spark, z), mask.limit(0), 0.5).first().surface == 0.0


def test_reference_systems(spark):
    df = spark.createDataFrame([("EPSG:4326",), ("EPSG:4269",), ("EPSG:26912",), ("EPSG:5070",), ("EPSG:32612",), (None,)], "crs string")
    got = [r[0] for r in df.select(checks.crs_gate(F.col("crs"))).collect()]
    assert [g is None for g in got] == [True, True, False, False, False, False]


def test_access_stream(spark, tmp_path):
    from gridmill.streaming import access_log

    rows = [(f"2026-01-01 00:{m:02d}:00", 45.5, -109.5) for m in (1, 2, 7, 40)]
    spark.createDataFrame(rows, "ts string, lat double, lng double").write.parquet(str(tmp_path / "in"))
    events = spark.readStream.schema("ts string, lat double, lng double").parquet(str(tmp_path / "in"))
    q = access_log.append_to_log(access_log.tile_accesses(events), str(tmp_path / "out"), str(tmp_path / "cp"))
    q.awaitTermination(60)
    got = {str(r.start)[11:16]: r.n for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got.get("00:00") == 2 and got.get("00:05") == 1


def exploded_tiles(spark):
    """(dem, cells) of two tiles whose pixels come from generators: their estimated size is tiny."""
    dem = spark.range(2).selectExpr("id AS t", "explode(sequence(0, 19)) AS row").selectExpr("t", "row", "explode(sequence(0, 19)) AS col").withColumn("value", F.col("row") + F.col("t"))
    return dem, dem.filter("row BETWEEN 5 AND 9 AND col BETWEEN 5 AND 9").select("t", "row", "col", F.lit(1).alias("label"))


def test_measuring_broadcasts_no_pixels(spark):
    dem, cells = exploded_tiles(spark)
    got = water.measure(dem, cells, 20, 20, keys=("t",))
    assert "Broadcast" not in got._jdf.queryExecution().sparkPlan().toString()
    assert sorted((r.t, r.pixel_count, r.n_shore, r.orig_mean) for r in got.collect()) == [(t, 25, 96, 7.0 + t) for t in (0, 1)]


def test_levelling_broadcasts_no_pixels(spark):
    dem, cells = exploded_tiles(spark)
    judged = spark.createDataFrame([(0, 1, "corrected", 3.5), (1, 1, "flagged", 9.0)], "t long, label int, status string, surface double")
    got = water.apply(dem, cells, judged, ("t",))
    assert "Broadcast" not in got._jdf.queryExecution().sparkPlan().toString()
    assert got.count() == 800 and got.filter("value = 3.5").count() == 25
