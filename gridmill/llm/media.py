"""Media columns: content-addressed payloads in tar shards.

A row keeps (digest, shard, offset, length); the payload lies in a tar shard of the shared folder, once
in each shard however many rows have it, and the index points every row of a digest to one place.  A
payload is stored as one Zstandard frame, whose header and the tar header before it are all that the
metadata columns need: they are filled by a range read of 530 bytes a payload.
"""

from __future__ import annotations

import hashlib
import tarfile
import uuid
import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import new_path, open_fs, stash

HEADER = 512
# Longest header of a Zstandard frame: magic number, descriptor, window, dictionary id, content size.
FRAME = 18
UNIT = 64


def padded(data: bytes, unit: int = UNIT) -> bytes:
    """Zero bytes up to a positive multiple of ``unit``."""
    return data + b"\0" * (max(1, -(-len(data) // unit)) * unit - len(data))


def tar_header(digest: str, size: int) -> bytes:
    """A member's header; it depends on the payload alone, so equal payloads have equal members."""
    info = tarfile.TarInfo(digest)
    info.size, info.mode = size, 0o444
    return info.tobuf(tarfile.USTAR_FORMAT)


def store(docs: DataFrame, shard_bytes: int = 64 << 20, level: int = 3) -> DataFrame:
    """Write every text's padded UTF-8 bytes to tar shards; returns the stored index.

    Null text counts as empty; its payload is 64 zero bytes.  Repeated rows and equal texts share a
    payload.  Rows keep their ``doc_id``, null included; other columns are ignored.  Each task writes
    shards under names of its own, so a repeated attempt can't damage another's.  Index: doc_id,
    n_bytes, digest (of the padded payload), shard, offset (of the header), length (of the member's data).
    """
    folder = new_path(docs.sparkSession, "media")

    def write(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import zstandard

        press = zstandard.ZstdCompressor(level=level, write_content_size=True, threads=0)
        sink, uri, at, seen = None, "", 0, {}
        for batch in batches:
            out = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                raw = (text or "").encode()
                payload = padded(raw)
                digest = hashlib.sha256(payload).hexdigest()
                if digest not in seen:
                    if sink is None:
                        uri, at = f"{folder}/{uuid.uuid4().hex}.tar", 0
                        fs, path = open_fs(uri)
                        fs.create_dir(path.rpartition("/")[0], recursive=True)
                        sink = fs.open_output_stream(path)
                    frame = press.compress(payload)
                    seen[digest] = (uri, at, len(frame))
                    member = tar_header(digest, len(frame)) + frame + b"\0" * (-len(frame) % HEADER)
                    sink.write(member)
                    at += len(member)
                    out.append((doc, len(raw), digest, *seen[digest]))
                    if at >= shard_bytes:
                        sink.write(b"\0" * 2 * HEADER)
                        sink.close()
                        sink, seen = None, {}
                else:
                    out.append((doc, len(raw), digest, *seen[digest]))
            if out:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64()), strict=True)], names=["doc_id", "n_bytes", "digest", "shard", "offset", "length"])
        if sink is not None:
            sink.write(b"\0" * 2 * HEADER)
            sink.close()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return stash(rows.mapInArrow(write, "doc_id long, n_bytes long, digest string, shard string, offset long, length long"), "media-index")


def places(index: DataFrame) -> DataFrame:
    """One place for each digest, the least (shard, offset); the sums are made before the shuffle."""
    best = index.groupBy("digest").agg(F.min(F.struct("shard", "offset", "length")).alias("p"))
    return best.select("digest", "p.shard", "p.offset", "p.length")


def _by_shard(at: DataFrame) -> DataFrame:
    return at.repartition(F.col("shard")).sortWithinPartitions("shard", "offset")


def _reader():
    """A function (uri) -> open file that keeps the last one open."""
    held = {}

    def get(uri: str):
        if uri not in held:
            for f in held.values():
                f.close()
            held.clear()
            fs, path = open_fs(uri)
            held[uri] = fs.open_input_file(path)
        return held[uri]

    return get


def read_metadata(at: DataFrame) -> DataFrame:
    """Header-only range reads: digest, media_name, media_bytes, payload_bytes, feature."""

    def read(batches: Iterator) -> Iterator:
        import pyarrow as pa

        get = _reader()
        for batch in batches:
            out = [(d, *header_columns(get(s).read_at(HEADER + FRAME, o))) for d, s, o in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True)]
            if out:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string()), strict=True)], names=["digest", "media_name", "media_bytes", "payload_bytes", "feature"])

    return _by_shard(at).mapInArrow(read, "digest string, media_name string, media_bytes long, payload_bytes long, feature string")


def header_columns(head: bytes) -> tuple[str, int, int, str]:
    """What a member's first 530 bytes tell: its name, stored size, payload size and a feature text."""
    import zstandard

    info = tarfile.TarInfo.frombuf(head[:HEADER], "utf-8", "strict")
    size = zstandard.frame_content_size(head[HEADER:])
    return info.name, info.size, size, f"zstd {size // UNIT}x{UNIT} ratio {100 * info.size // size}% {info.name[:8]}"


def read_media(at: DataFrame) -> DataFrame:
    """Read the stored bytes of each digest back: its place, size and sums of the payload, sum of the stored form."""
    kinds = "digest string, shard string, offset long, length long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_sha256 string"

    def read(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import zstandard

        get, open_up = _reader(), zstandard.ZstdDecompressor()
        for batch in batches:
            out = []
            for digest, shard, offset, length in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                data = get(shard).read_at(HEADER + length, offset)
                frame = data[HEADER : HEADER + header_columns(data[: HEADER + FRAME])[1]]
                payload = open_up.decompress(frame)
                out.append((len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-UNIT:]), hashlib.sha256(frame).hexdigest()))
            sums = [pa.array(c, t) for c, t in zip(zip(*out, strict=True) if out else [()] * 4, (pa.int64(), pa.string(), pa.int64(), pa.string()), strict=True)]
            yield pa.record_batch([*batch.columns, *sums], names=["digest", "shard", "offset", "length", "payload_bytes", "payload_sha256", "tail_crc32", "media_sha256"])

    return _by_shard(at).mapInArrow(read, kinds)


def media_columns(docs: DataFrame) -> DataFrame:
    """Store all texts and fill every row's columns: metadata from headers, sums from the bytes read back.

    Every row carries the digest, shard, offset and length of its payload; equal texts have one place.
    """
    index = store(docs)
    at = stash(places(index), "media-places")
    heads = read_metadata(at).select("digest", "media_bytes", "feature")
    got = stash(read_media(at).join(heads, "digest"), "media-read")
    return index.select("doc_id", "n_bytes", "digest").join(got, "digest").select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "digest", "shard", "offset", "length")
