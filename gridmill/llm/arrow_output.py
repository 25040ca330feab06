"""Token-ID output as Arrow stream files of fixed-size-list batches.

Each file holds the ids of consecutive documents, cut into sequences of equal length.  A record batch has
``rows`` sequences: ``ids`` is a fixed-size list of unsigned 16-bit (32-bit for vocabularies over 65,536)
integers and ``mask`` the same positions as packed bits, 1 where an id is real.  All batches of a file are
equally large, so sequence ``i`` is row ``i % rows`` of batch ``i // rows``, and a memory-mapped reader
returns views of it without copying.  Only the last batch of a file is padded.

Writing range-partitions the documents by ``doc_id``; each task writes files of about ``most_ids`` ids under
names of their own (task attempts never share one) and returns an index row for each document.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .chunks import LibraryEncoder, worker_state
from .shared import new_path, open_fs, stash


class SequenceWriter:
    """Appends ids to one Arrow stream file; full batches go out at once, so memory is one batch."""

    def __init__(self, sink, dtype: str, length: int, rows: int):
        import pyarrow as pa

        self.pa, self.dtype, self.length, self.rows = pa, dtype, length, rows
        kind = pa.uint16() if dtype == "<u2" else pa.uint32()
        self.schema = pa.schema([("ids", pa.list_(kind, length)), ("mask", pa.list_(pa.uint8(), length // 8))])
        self.out = pa.ipc.new_stream(sink, self.schema)
        self.held, self.n, self.total = [], 0, 0
        self.full = length * rows

    def add(self, ids) -> int:
        """Append an array of ids; returns the position of its first in this file."""
        import numpy as np

        at = self.total
        self.held.append(ids)
        self.n += len(ids)
        self.total += len(ids)
        if self.n >= self.full:
            flat = np.concatenate(self.held)
            whole = self.n // self.full * self.full
            for i in range(0, whole, self.full):
                self._batch(flat[i : i + self.full], self.full)
            self.held, self.n = [flat[whole:]], self.n - whole
        return at

    def _batch(self, flat, real: int) -> None:
        import numpy as np

        pa, mask = self.pa, np.zeros(self.full, np.uint8)
        mask[:real] = 1
        ids = pa.FixedSizeListArray.from_arrays(pa.array(flat), self.length)
        bits = pa.FixedSizeListArray.from_arrays(pa.array(np.packbits(mask)), self.length // 8)
        self.out.write_batch(pa.record_batch([ids, bits], schema=self.schema))

    def close(self) -> None:
        import numpy as np

        if self.n:
            flat = np.zeros(self.full, self.dtype)
            flat[: self.n] = np.concatenate(self.held)
            self._batch(flat, self.n)
        self.out.close()


class SequenceReader:
    """Access to the ids of one file by position.

    Where the file system is local the file is memory-mapped and everything is a view of it.  Elsewhere one
    batch is held at a time: reading on goes forward through the stream, going back opens it again.
    """

    def __init__(self, uri: str):
        import pyarrow as pa
        from pyarrow import fs as pafs

        self.pa, (self.fs, self.path) = pa, open_fs(uri)
        self.batches = list(pa.ipc.open_stream(pa.memory_map(self.path))) if isinstance(self.fs, pafs.LocalFileSystem) else None
        self.stream, self.next, self.held = None, 0, None
        first = self.batch(0) if self.batches is None or self.batches else None
        self.length = first.column(0).type.list_size if first else 1
        self.rows = first.num_rows if first else 1

    def batch(self, k: int):
        if self.batches is not None:
            return self.batches[k]
        if self.stream is None or k < self.next - 1:
            self.stream, self.next = self.pa.ipc.open_stream(self.fs.open_input_stream(self.path)), 0
        while self.next <= k:
            self.held = self.stream.read_next_batch()
            self.next += 1
        return self.held

    def sequence(self, i: int):
        """(ids, packed mask) of sequence ``i`` as views of its batch."""
        at, batch = i % self.rows, self.batch(i // self.rows)
        flat, mask = (batch.column(c).values.to_numpy(zero_copy_only=True) for c in (0, 1))
        return flat[at * self.length : (at + 1) * self.length], mask[at * self.length // 8 : (at + 1) * self.length // 8]

    def ids(self, start: int, n: int):
        import numpy as np

        full = self.length * self.rows
        parts, end = [], start + n
        while start < end:
            k, at = divmod(start, full)
            take = min(end - start, full - at)
            parts.append(self.batch(k).column(0).values.to_numpy(zero_copy_only=True)[at : at + take])
            start += take
        return parts[0] if len(parts) == 1 else np.concatenate(parts) if parts else np.zeros(0, np.uint16)


def write_tokens(docs: DataFrame, tokenizer: str, end_id: int = 2, length: int = 2048, rows: int = 64, most_ids: int = 1 << 26) -> DataFrame:
    """Encode ``docs`` (doc_id, text) and write Arrow stream files in ascending ``doc_id`` order.

    Null text counts as empty and yields the end id alone.  A null ``doc_id`` sorts first; rows with equal
    ids are ordered by text.  Other columns are ignored.  An empty table writes no file.  Returns the
    index, already stored: doc_id, part and file (their order), uri, at (position in the file), n_tokens.
    A file ends with the first document that brings it to ``most_ids`` ids.
    """
    spark = docs.sparkSession
    folder = new_path(spark, "tokens")

    def write(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        codec, writer, sink, uri, file = worker_state("library", lambda: LibraryEncoder(tokenizer), tokenizer), None, None, "", -1
        part = TaskContext.get().partitionId()
        end = np.array([end_id], codec.dtype).tobytes()

        def close():
            if writer is not None:
                writer.close()
                sink.close()

        for batch in batches:
            for lo in range(0, batch.num_rows, 5000):
                piece = batch.slice(lo, 5000)
                files, uris, at, size = [], [], [], []
                for x in codec.encode(piece.column(1)):
                    if writer is None or writer.total >= most_ids:
                        close()
                        file, uri = file + 1, f"{folder}/part-{part:06d}-{file + 1:04d}-{uuid.uuid4().hex}.arrows"
                        fs, path = open_fs(uri)
                        fs.create_dir(path.rpartition("/")[0], recursive=True)
                        sink = fs.open_output_stream(path)
                        writer = SequenceWriter(sink, codec.dtype, length, rows)
                    ids = np.frombuffer(x + end, codec.dtype)
                    at.append(writer.add(ids))
                    size.append(len(ids))
                    files.append(file)
                    uris.append(uri)
                yield pa.record_batch(
                    [piece.column(0), pa.array([part] * len(at), pa.int32()), pa.array(files, pa.int32()), pa.array(uris, pa.string()), pa.array(at, pa.int64()), pa.array(size, pa.int64())],
                    names=["doc_id", "part", "file", "uri", "at", "n_tokens"],
                )
        close()

    rows_in = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ordered = rows_in.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return stash(ordered.mapInArrow(write, "doc_id long, part int, file int, uri string, at long, n_tokens long"), "token-index")


def read_tokens(index: DataFrame) -> DataFrame:
    """Read every document's ids back from the files: doc_id, start, n_tokens, ids_crc32.

    ``start`` counts the ids of all documents before it.  One row a file goes to the driver for the
    running total and back to all tasks: two numbers for each ``most_ids`` ids written.
    """
    spark: SparkSession = index.sparkSession
    sums = sorted((r.part, r.file, r.n) for r in index.groupBy("part", "file").agg(F.sum("n_tokens").alias("n")).collect())
    base, total = [], 0
    for part, file, n in sums:
        base.append((part, file, total))
        total += n
    bases = spark.createDataFrame(base, "part int, file int, base long")

    def read(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        uri, reader = None, None
        for batch in batches:
            crc = []
            for u, at, n in zip(*(batch.column(k).to_pylist() for k in (3, 4, 5)), strict=True):
                if u != uri:
                    uri, reader = u, SequenceReader(u)
                crc.append(zlib.crc32(reader.ids(at, n).astype(np.uint32).astype("<u4").tobytes()))
            yield pa.record_batch([*(batch.column(k) for k in (0, 1, 2, 4, 5)), pa.array(crc, pa.int64())], names=["doc_id", "part", "file", "at", "n_tokens", "ids_crc32"])

    got = (
        index.repartition(F.col("uri")).sortWithinPartitions("uri", "at")
        .mapInArrow(read, "doc_id long, part int, file int, at long, n_tokens long, ids_crc32 long")
    )
    return got.join(F.broadcast(bases), ["part", "file"]).select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")
