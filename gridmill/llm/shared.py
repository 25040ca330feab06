"""The folder that driver and executors share, and tables written there to cut lineage.

``spark.checkpoint.dir`` names the folder.  Only where it is unset and Spark runs on this machine alone
(tests) a fresh temporary folder is used.  Tables written here survive the loss of any executor.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_FALLBACK: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """URI of this application's own part of the shared folder."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    app = spark.sparkContext.applicationId
    if not base:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        if app not in _FALLBACK:
            _FALLBACK[app] = "file://" + tempfile.mkdtemp(prefix="gridmill-")
        base = _FALLBACK[app]
    if "://" not in base and not base.startswith("file:"):
        base = "file://" + base
    return f"{base.rstrip('/')}/gridmill-{app}"


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh URI in the shared folder, removed when the application ends."""
    uri = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return uri


def stash(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and return a reader of that table."""
    spark = df.sparkSession
    uri = new_path(spark, label)
    df.write.parquet(uri)
    return spark.read.schema(df.schema).parquet(uri)


def put_file(spark: SparkSession, data: bytes, label: str) -> str:
    """Write bytes to the shared folder and hand the file to every executor; returns its name there."""
    name = f"{label}-{uuid.uuid4().hex}.bin"
    uri = new_path(spark, "file") + f"/{name}"
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    out = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path)
    try:
        for at in range(0, len(data), 1 << 22):
            out.write(bytearray(data[at : at + (1 << 22)]))
    finally:
        out.close()
    spark.sparkContext.addFile(uri)
    return name


def open_fs(uri: str):
    """(pyarrow file system, path) of a URI; ``file:/x`` and ``file:///x`` are both understood."""
    from pyarrow import fs

    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri[5:]
    return fs.FileSystem.from_uri(uri)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that no column of ``df`` has, whatever its case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def most_frequent(counts: DataFrame, n: str, most: int, key: str) -> DataFrame:
    """About the ``most`` rows of ``counts`` (key, n) of greatest ``n``, without a sort.

    Rows are counted by eighths of powers of two of ``n``.  The highest classes stay whole; of the one that
    would go beyond ``most`` a share by the hash of ``key`` stays, so ties of any number leave some.
    """
    from pyspark.sql import functions as F

    parts = 1 << 20
    kind = F.floor(F.log2(F.col(n).cast("double")) * 8).cast("int")
    room, bound, share = most, None, 0
    for r in sorted(counts.filter(F.col(n) > 0).groupBy(kind.alias("v")).agg(F.count(F.lit(1)).alias("rows")).collect(), reverse=True):
        bound, share = r.v, parts if r.rows <= room else parts * room // r.rows
        if share < parts:
            break
        room -= r.rows
    if bound is None:
        return counts.filter(F.lit(False))
    return counts.filter((F.col(n) > 0) & ((kind > bound) | ((kind == bound) & (F.pmod(F.xxhash64(key), F.lit(parts)) < share))))
