"""Raster, header, feature and registry files as tables.

Parquet is the working format: pixel or block rows partitioned by tile.  Single-band GeoTIFF files (classic
and BigTIFF, strips and tiles, raw and deflated, predictors 2 and 3) are read and written with numpy alone;
readers fetch headers and blocks by byte range and hold one block at a time.
"""

from __future__ import annotations

import struct
import zlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

HEADER = "tile_id string, width int, height int, west double, south double, east double, north double, crs string, nodata double"
REGISTRY_FIELDS = ("status", "tile_dir", "dem_file", "flat_file", "boundary_file", "meta_file", "size_mb", "built_utc", "last_accessed_utc", "failed_reason")
ENTRY = "struct<tile_id:string," + ",".join(f"{f}:{'double' if f == 'size_mb' else 'string'}" for f in REGISTRY_FIELDS) + ">"
VERSION = 1
_OWN: dict[str, str] = {}


def workspace(spark: SparkSession, label: str) -> str:
    """A fresh URI in the shared folder that ``spark.checkpoint.dir`` names, removed when the application ends.

    Where that is unset and Spark runs on this machine alone, in a temporary folder.
    """
    import tempfile
    import uuid

    base, app = spark.conf.get("spark.checkpoint.dir", None), spark.sparkContext.applicationId
    if not base:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = _OWN.setdefault(app, tempfile.mkdtemp(prefix="gridmill-"))
    uri = f"{base if ':' in base else 'file://' + base}".rstrip("/") + f"/{app}/{label}-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return uri


def stored(df: DataFrame, label: str = "table") -> DataFrame:
    """``df`` written to the workspace and read again: computed once, and safe from lost executors."""
    uri = workspace(df.sparkSession, label)
    df.write.parquet(uri)
    return df.sparkSession.read.schema(df.schema).parquet(uri)


def delete(spark: SparkSession, uri: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def exists(spark: SparkSession, uri: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def rename(spark: SparkSession, old: str, new: str) -> None:
    a, b = (spark._jvm.org.apache.hadoop.fs.Path(x) for x in (old, new))
    if not a.getFileSystem(spark._jsc.hadoopConfiguration()).rename(a, b):
        raise OSError(f"can't rename {old} to {new}")


def write_pixels(df: DataFrame, path: str, keys: tuple[str, ...] = ("tile_id",)) -> None:
    """Pixel rows, one directory a tile, rows in raster order so that window filters skip row groups."""
    df.repartition(*keys).sortWithinPartitions(*keys, "row", "col").write.mode("overwrite").partitionBy(*keys).parquet(path)


def read_pixels(spark: SparkSession, path: str, tile_ids: list[str] | None = None, window: tuple[int, int, int, int] | None = None) -> DataFrame:
    """Whole rasters or a window (row0, row1, col0, col1): tiles prune partitions, windows reach the scan."""
    df = spark.read.parquet(path)
    if tile_ids is not None:
        df = df.filter(F.col("tile_id").isin(tile_ids))
    if window is not None:
        df = df.filter(F.col("row").between(window[0], window[1] - 1) & F.col("col").between(window[2], window[3] - 1))
    return df


def list_files(spark: SparkSession, path: str, pattern: str = "*.tif*") -> DataFrame:
    """(path, mb, modified) of files; contents are not read."""
    got = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    return got.select("path", (F.col("length") / 2**20).alias("mb"), F.col("modificationTime").alias("modified"))


def directory_mb(files: DataFrame) -> DataFrame:
    """files, mb: how many files of :func:`list_files` there are and their size in all."""
    return files.agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("mb"), F.lit(0.0)).alias("mb"))


def digests(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(path, sha256) of files."""
    got = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    return got.select("path", F.sha2("content", 256).alias("sha256"))


def is_tiff(content: Column) -> Column:
    return F.hex(F.substring(content, 1, 4)).isin("49492A00", "4D4D002A", "49492B00", "4D4D002B")


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """(i, feature): the features of a FeatureCollection, or a bare geometry as one feature; else an error."""
    text = spark.read.text(path, wholetext=True)
    kind = F.get_json_object("value", "$.type")
    many = F.from_json(F.get_json_object("value", "$.features"), "array<string>")
    one = F.array(F.concat(F.lit('{"type":"Feature","properties":{},"geometry":'), F.col("value"), F.lit("}")))
    bad = F.raise_error(F.lit("neither a FeatureCollection nor a polygon")).cast("array<string>")
    return text.select(F.posexplode(F.when(kind == "FeatureCollection", many).when(kind.isin("Polygon", "MultiPolygon"), one).otherwise(bad)).alias("i", "feature"))


def overpass_water(raw: DataFrame, column: str = "value") -> DataFrame:
    """(id, name, natural, ring) of map elements with a geometry of at least three points, rings closed."""
    schema = "elements array<struct<id:bigint,type:string,tags:map<string,string>,geometry:array<struct<lat:double,lon:double>>>>"
    e = raw.select(F.explode(F.from_json(column, schema)["elements"]).alias("e"))
    t = F.col("e.tags")
    water = t["natural"].isin("water", "bay") | (t["landuse"] == "reservoir")
    pts = F.transform("e.geometry", lambda p: F.array(p["lon"], p["lat"]))
    ring = F.when(F.element_at(pts, 1) == F.element_at(pts, -1), pts).otherwise(F.concat(pts, F.slice(pts, 1, 1)))
    return e.filter(water & (F.size("e.geometry") >= 3)).select("e.id", t["name"].alias("name"), t["natural"].alias("natural"), F.array(ring).alias("rings"))


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a registry file; no file gives none, a bad file, version or status raises; other keys go."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    fields = f"tile_id string, {', '.join(f'{f} double' if f == 'size_mb' else f'{f} string' for f in REGISTRY_FIELDS)}"
    if not jpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jpath):
        return spark.createDataFrame([], fields)
    text = spark.read.text(path, wholetext=True)
    got = text.select(F.from_json("value", f"version int, tiles map<string,{ENTRY}>", {"mode": "FAILFAST"}).alias("r"))
    good = F.when(F.col("r.version") == VERSION, F.col("r.tiles")).otherwise(F.raise_error(F.lit("unknown registry version")).cast(f"map<string,{ENTRY}>"))
    rows = got.select(F.explode(good).alias("tile_id", "e")).select("tile_id", *[F.col(f"e.{f}").alias(f) for f in REGISTRY_FIELDS])
    legal = F.when(F.col("status").isin("absent", "pending", "ready", "failed"), F.col("status")).otherwise(F.raise_error(F.concat(F.lit("bad status of "), F.col("tile_id"))).cast("string"))
    return rows.withColumn("status", legal)


def registry_json(state: DataFrame, updated_utc: str) -> str:
    """The registry as text, keys sorted, counts derived; at most one row for each tile of the globe."""
    import json

    rows = state.select("tile_id", *[c for c in REGISTRY_FIELDS if c in state.columns]).orderBy("tile_id").collect()
    tiles = {r.tile_id: r.asDict() for r in rows}
    size = sum(r.get("size_mb") or 0 for r in tiles.values())
    return json.dumps({"version": VERSION, "updated_utc": updated_utc, "tile_count": len(tiles), "total_size_mb": size, "tiles": tiles}, indent=2, sort_keys=True)


def update_registry(spark: SparkSession, path: str, change, updated_utc: str) -> DataFrame:
    """Read the file afresh, apply ``change`` (state -> state), replace the file; returns the new state.

    The driver is the only writer, so no lock is taken.
    """
    fields = f"tile_id string, {', '.join(f'{f} double' if f == 'size_mb' else f'{f} string' for f in REGISTRY_FIELDS)}"
    state = change(read_registry(spark, path)).select("tile_id", *REGISTRY_FIELDS)
    rows = state.collect()  # one a tile of the globe at most
    state = spark.createDataFrame(rows, fields)
    replace_text(spark, path, registry_json(state, updated_utc))
    return state


def with_entry(state: DataFrame, tile_id: str, status: str, now: str, **fields) -> DataFrame:
    """``state`` with one tile's status set.

    ``pending`` clears the reason and keeps the rest, ``failed`` sets the reason and keeps the rest,
    ``ready`` sets paths, size and both times; ``removed`` takes the row out.
    """
    rest = state.filter(F.col("tile_id") != tile_id)
    if status == "removed":
        return rest
    if status not in ("absent", "pending", "ready", "failed"):
        raise ValueError(f"no such status: {status}")
    held = state.filter(F.col("tile_id") == tile_id).first()
    row = held.asDict() if held else dict.fromkeys(state.columns)
    row |= {"tile_id": tile_id, "status": status}
    row |= {"ready": {"built_utc": now, "last_accessed_utc": now, "failed_reason": None}, "pending": {"failed_reason": None}}.get(status, {}) | fields
    return rest.unionByName(state.sparkSession.createDataFrame([tuple(row[c] for c in state.columns)], state.schema))


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a text file whole: to a new name first, then renamed over the old one."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    target, fresh = hadoop.Path(path), hadoop.Path(path + ".new")
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    out = fs.create(fresh, True)
    try:
        out.write(bytearray(text.encode()))
        out.hsync()
    finally:
        out.close()
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
    option = spark._jvm.java.lang.reflect.Array.newInstance(spark._jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename"), 1)
    option[0] = spark._jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE if hasattr(spark._jvm.org.apache.hadoop.fs, "Options") else None
    try:
        context.rename(fresh, target, option)
    except Exception:  # a file system without an atomic replacement
        fs.delete(target, False)
        if not fs.rename(fresh, target):
            raise


# -- GeoTIFF

KINDS = {1: "B", 2: "s", 3: "H", 4: "I", 11: "f", 12: "d", 16: "Q"}
SAMPLES = {(1, 8): "u1", (2, 16): "i2", (3, 32): "f4", (3, 64): "f8", (1, 16): "u2", (2, 32): "i4", (1, 32): "u4"}


def predicted(block, predictor: int):
    """Rows of a block as a predictor stores them: bytes."""
    import numpy as np

    if predictor == 2:
        x = block.view(f"<u{block.itemsize}")
        return np.diff(x, axis=1, prepend=x.dtype.type(0)).astype(x.dtype).tobytes()
    if predictor == 3:
        h, w = block.shape
        planes = block.astype(block.dtype.newbyteorder(">")).view("u1").reshape(h, w, block.itemsize).transpose(0, 2, 1).reshape(h, -1)
        return np.diff(planes, axis=1, prepend=np.uint8(0)).astype("u1").tobytes()
    return block.tobytes()


def unpredicted(data: bytes, kind, h: int, w: int, predictor: int):
    """The block that :func:`predicted` made ``data`` of, in the byte order of ``kind``."""
    import numpy as np

    if predictor == 2:
        x = np.frombuffer(data, np.dtype(f"u{kind.itemsize}").newbyteorder(kind.byteorder)).reshape(h, w)
        return np.cumsum(x, axis=1, dtype=f"u{kind.itemsize}").view(kind.newbyteorder("="))
    if predictor == 3:
        x = np.cumsum(np.frombuffer(data, "u1").reshape(h, w * kind.itemsize), axis=1, dtype="u1")
        return np.ascontiguousarray(x.reshape(h, kind.itemsize, w).transpose(0, 2, 1)).view(kind.newbyteorder(">")).reshape(h, w)
    return np.frombuffer(data, kind).reshape(h, w)


def encode_tiff(values, west: float, north: float, px: float, nodata: float = -9999.0, tile: int = 0, predictor: int = 1, big: bool = False, deflate: bool = True, crs: int = 4326) -> bytes:
    """A float32 band as a little-endian GeoTIFF: strips of 256 rows, or square tiles (a multiple of 16)."""
    import numpy as np

    z = np.ascontiguousarray(values, "<f4")
    h, w = z.shape
    bh, bw = (tile, tile) if tile else (min(256, h), w)
    blocks = []
    for r in range(0, h, bh):
        for c in range(0, w, bw):
            part = z[r : r + bh, c : c + bw]
            if tile:  # tiles are whole, the last strip isn't
                part = np.pad(part, ((0, bh - part.shape[0]), (0, bw - part.shape[1])), constant_values=np.float32(nodata))
            data = predicted(np.ascontiguousarray(part), predictor)
            blocks.append(zlib.compress(data) if deflate else data)
    return assemble_tiff(blocks, h, w, (bh, bw) if tile else (bh, 0), west, north, px, nodata, predictor, big, deflate, crs)


def assemble_tiff(blocks: list[bytes], h: int, w: int, shape: tuple[int, int], west: float, north: float, px: float, nodata: float, predictor: int, big: bool, deflate: bool, crs: int) -> bytes:
    """Header, blocks in raster order, and the directory at the end."""
    body, offsets, at = [], [], 16 if big else 8
    for b in blocks:
        offsets.append(at)
        body.append(b + b"\0" * (len(b) % 2))
        at += len(body[-1])
    none, kind = f"{nodata:g}".encode() + b"\0", (16, "Q") if big else (4, "I")
    keys = (1, 1, 0, 3, 1024, 0, 1, 2 if crs < 5000 else 1, 1025, 0, 1, 1, 2048 if crs < 5000 else 3072, 0, 1, crs)
    short = lambda code, v: (code, 3, 1, struct.pack("<H", v))
    many = lambda code, v: (code, kind[0], len(v), struct.pack(f"<{len(v)}{kind[1]}", *v))
    items = [
        (256, 4, 1, struct.pack("<I", w)), (257, 4, 1, struct.pack("<I", h)), short(258, 32), short(259, 8 if deflate else 1), short(262, 1), short(277, 1), short(317, predictor), short(339, 3),
        (33550, 12, 3, struct.pack("<3d", px, px, 0)), (33922, 12, 6, struct.pack("<6d", 0, 0, 0, west, north, 0)), (34735, 3, 16, struct.pack("<16H", *keys)), (42113, 2, len(none), none),
    ]
    sizes = [len(b) for b in blocks]
    items += [(322, 4, 1, struct.pack("<I", shape[1])), (323, 4, 1, struct.pack("<I", shape[0])), many(324, offsets), many(325, sizes)] if shape[1] else [many(273, offsets), (278, 4, 1, struct.pack("<I", shape[0])), many(279, sizes)]
    room, extra, tags = 8 if big else 4, b"", []
    for code, k, count, payload in sorted(items):
        if len(payload) > room:
            where = struct.pack("<Q" if big else "<I", at + len(extra))
            extra += payload + b"\0" * (-len(payload) % 8)
        else:
            where = payload.ljust(room, b"\0")
        tags.append(struct.pack("<HHQ" if big else "<HHI", code, k, count) + where)
    start = at + len(extra)
    if big:
        return b"II+\0" + struct.pack("<HHQ", 8, 0, start) + b"".join(body) + extra + struct.pack("<Q", len(tags)) + b"".join(tags) + struct.pack("<Q", 0)
    return b"II*\0" + struct.pack("<I", start) + b"".join(body) + extra + struct.pack("<H", len(tags)) + b"".join(tags) + struct.pack("<I", 0)


class Tiff:
    """A single-band GeoTIFF behind ``read(offset, size)``: its header, and its blocks one at a time."""

    def __init__(self, read):
        import numpy as np

        self.read = read
        start = read(0, 16)
        order = {b"II": "<", b"MM": ">"}.get(start[:2])
        magic = struct.unpack_from(f"{order}H", start, 2)[0] if order and len(start) > 7 else 0
        if magic not in (42, 43):
            raise ValueError("not a TIFF file")
        big = magic == 43
        (at,) = struct.unpack_from(f"{order}Q", start, 8) if big else struct.unpack_from(f"{order}I", start, 4)
        wide, entry, form = (8, 20, f"{order}HHQ") if big else (2, 12, f"{order}HHI")
        (n,) = struct.unpack(f"{order}{'Q' if big else 'H'}", read(at, wide))
        table, tags, room = read(at + wide, entry * n), {}, entry - struct.calcsize(form)
        for i in range(n):
            code, kind, count = struct.unpack_from(form, table, entry * i)
            if kind not in KINDS:
                continue
            size, where = struct.calcsize(f"{order}{count}{KINDS[kind]}"), entry * i + entry - room
            payload = table[where : where + size] if size <= room else read(struct.unpack_from(f"{order}{'Q' if big else 'I'}", table, where)[0], size)
            tags[code] = struct.unpack(f"{order}{count}{KINDS[kind]}", payload)
        self.h, self.w = h, w = tags[257][0], tags[256][0]
        px, py = tags.get(33550, (1.0, 1.0))[:2]
        west, north = tags.get(33922, (0, 0, 0, 0.0, 0.0))[3:5]
        keys = tags.get(34735, ())
        found = {keys[i]: keys[i + 3] for i in range(4, len(keys) - 3, 4)}
        crs = next((f"EPSG:{found[k]}" for k in (3072, 2048) if k in found), None)
        self.header = {"width": w, "height": h, "west": west, "north": north, "east": west + w * px, "south": north - h * py, "crs": crs, "nodata": float(tags[42113][0].split(b"\0")[0]) if 42113 in tags else None}
        self.kind = np.dtype(SAMPLES[(tags.get(339, (1,))[0], tags[258][0])]).newbyteorder(order) if tags.get(277, (1,))[0] == 1 else None
        self.packing, self.predictor = tags.get(259, (1,))[0], tags.get(317, (1,))[0]
        self.tiled = 322 in tags
        self.shape = (tags[323][0], tags[322][0]) if self.tiled else (min(tags.get(278, (h,))[0], h), w)
        self.places = list(zip(tags[324 if self.tiled else 273], tags[325 if self.tiled else 279], strict=True))

    def blocks(self):
        """(row, col, values) of every block, cut to the raster; an error if one can't be decoded."""
        if self.kind is None or self.packing not in (1, 8, 32946) or self.predictor not in (1, 2, 3):
            raise ValueError("only single bands, raw or deflated, with predictors 1 to 3 are read")
        (bh, bw), across = self.shape, -(-self.w // self.shape[1])
        if len(self.places) != across * -(-self.h // bh):
            raise ValueError("blocks are missing")
        for k, (offset, size) in enumerate(self.places):
            r, c = k // across * bh, k % across * bw
            data = self.read(offset, size)
            if len(data) != size:
                raise ValueError("the file is cut short")
            tall = bh if self.tiled else min(bh, self.h - r)
            block = unpredicted(zlib.decompress(data) if self.packing != 1 else data, self.kind, tall, bw, self.predictor)
            yield r, c, block[: self.h - r, : self.w - c]


def decode_tiff(data: bytes, header_only: bool = False):
    """(values or None, header) of a whole file."""
    import numpy as np

    tiff = Tiff(lambda offset, size: data[offset : offset + size])
    if header_only:
        return None, tiff.header
    out = None
    for r, c, block in tiff.blocks():
        if out is None:
            out = np.empty((tiff.h, tiff.w), block.dtype.newbyteorder("="))
        out[r : r + block.shape[0], c : c + block.shape[1]] = block
    return out, tiff.header


def open_tiff(uri: str) -> Tiff:
    """The file at a URI, read by byte range."""
    from pyarrow import fs as pafs

    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri[5:]
    system, path = pafs.FileSystem.from_uri(uri if ":" in uri else "file://" + uri)
    file = system.open_input_file(path)
    return Tiff(lambda offset, size: file.read_at(size, offset))


def _pixels(name: str, tiff: Tiff):
    """A record batch of pixel rows a block."""
    import numpy as np
    import pyarrow as pa

    for r, c, block in tiff.blocks():
        h, w = block.shape
        row, col = np.repeat(np.arange(r, r + h, dtype=np.int32), w), np.tile(np.arange(c, c + w, dtype=np.int32), h)
        yield pa.record_batch([pa.array([name] * (h * w)), pa.array(row), pa.array(col), pa.array(np.ascontiguousarray(block).astype(np.float32).ravel())], names=["path", "row", "col", "value"])


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.tif*").load(path).select("path")


def read_tiffs(spark: SparkSession, path: str) -> DataFrame:
    """(path, row, col, value) of all GeoTIFF files of a folder; a file is one task's work, block by block."""

    def run(batches):
        for batch in batches:
            for name in batch.column(0).to_pylist():
                yield from _pixels(name, open_tiff(name))

    return _files(spark, path).mapInArrow(run, "path string, row int, col int, value float")


def read_headers(spark: SparkSession, path: str, decode: bool = True) -> DataFrame:
    """(path, header, readable) of files, by byte range; ``readable`` decodes every block, one at a time.

    Without ``decode`` a file with a sound header counts as readable.
    """
    names = ("width", "height", "west", "south", "east", "north", "crs", "nodata")

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            out = []
            for name in batch.column(0).to_pylist():
                try:
                    tiff = open_tiff(name)
                except Exception:
                    out.append((name, *[None] * 8, False))
                    continue
                try:
                    ok = not decode or all(True for _ in tiff.blocks())
                except Exception:
                    ok = False
                out.append((name, *[tiff.header[k] for k in names], ok))
            kinds = [pa.string(), pa.int32(), pa.int32(), *[pa.float64()] * 4, pa.string(), pa.float64(), pa.bool_()]
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out, strict=True) if out else [()] * 10, kinds, strict=True)], names=["path", *names, "readable"])

    return _files(spark, path).mapInArrow(run, "path string, width int, height int, west double, south double, east double, north double, crs string, nodata double, readable boolean")


def write_tiffs(pixels: DataFrame, folder: str, size: int, tile: int = 512, predictor: int = 3, big: bool = True, nodata: float = -9999.0) -> DataFrame:
    """Write (tile_id, row, col, value) as one deflated GeoTIFF a tile; returns (tile_id, path, bytes).

    Pixels that have no row get nodata.  A task holds one band of ``tile`` rows and a tile's compressed
    blocks.  Names are fresh for each attempt; the index names those that count.
    """

    def run(batches):
        import uuid

        import numpy as np
        import pyarrow as pa
        from pyarrow import fs as pafs

        state: dict = {"tile": None}

        def flush_band():
            for c in range(0, size, tile):
                part = state["band"][:, c : c + tile]
                part = np.pad(part, ((0, 0), (0, tile - part.shape[1])), constant_values=np.float32(nodata))
                state["blocks"].append(zlib.compress(predicted(np.ascontiguousarray(part, "<f4"), predictor)))
            state["row"] += tile
            state["band"] = np.full((tile, size), np.float32(nodata))

        def close():
            name = state["tile"]
            if name is None:
                return
            while state["row"] < size:
                flush_band()
            south = (1 if name[0] == "N" else -1) * int(name[1:3])
            west = (1 if name[3] == "E" else -1) * int(name[4:7])
            data = assemble_tiff(state["blocks"], size, size, (tile, tile), west, south + 1, 1 / size, nodata, predictor, big, True, 4326)
            uri = f"{folder}/{name}-{uuid.uuid4().hex}.tif"
            system, path = pafs.FileSystem.from_uri(uri if not uri.startswith("file:/") or uri.startswith("file://") else "file://" + uri[5:])
            system.create_dir(path.rpartition("/")[0], recursive=True)
            with system.open_output_stream(path) as f:
                f.write(data)
            yield pa.record_batch([pa.array([name]), pa.array([uri]), pa.array([len(data)], pa.int64())], names=["tile_id", "path", "bytes"])

        for batch in batches:
            names = np.array(batch.column(0).to_pylist(), object)
            row, col, value = (batch.column(k).to_numpy(zero_copy_only=False) for k in (1, 2, 3))
            cuts = np.flatnonzero(np.append(True, (names[1:] != names[:-1]) | (row[1:] // tile != row[:-1] // tile))) if len(names) else []
            for a, b in zip(cuts, [*cuts[1:], len(names)], strict=True):
                if names[a] != state["tile"]:
                    yield from close()
                    state.update(tile=names[a], row=0, blocks=[], band=np.full((tile, size), np.float32(nodata)))
                while state["row"] + tile <= row[a]:
                    flush_band()
                state["band"][row[a:b] - state["row"], col[a:b]] = value[a:b]
        yield from close()

    rows = pixels.select("tile_id", "row", "col", F.col("value").cast("float").alias("value"))
    return stored(rows.repartition("tile_id").sortWithinPartitions("tile_id", "row", "col").mapInArrow(run, "tile_id string, path string, bytes long"), "tiff-index")


class _Part(InputPartition):
    def __init__(self, path: str):
        self.path = path


class GeoTiffSource(DataSource):
    """``spark.read.format("geotiff").load(path)``: pixel rows of local files, one partition a file."""

    @classmethod
    def name(cls) -> str:
        return "geotiff"

    def schema(self):
        return T.StructType([T.StructField("path", T.StringType()), T.StructField("row", T.IntegerType()), T.StructField("col", T.IntegerType()), T.StructField("value", T.FloatType())])

    def reader(self, schema):
        return _Reader(self.options["path"])


class _Reader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self):
        from pathlib import Path

        p = Path(self.path)
        return [_Part(str(f)) for f in (sorted([*p.glob("*.tif"), *p.glob("*.tiff")]) if p.is_dir() else [p])]

    def read(self, partition):
        yield from _pixels(partition.path, open_tiff(partition.path))


def register(spark: SparkSession) -> None:
    from pyspark import cloudpickle
    import sys

    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(GeoTiffSource)
