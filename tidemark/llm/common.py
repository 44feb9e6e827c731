"""Helpers shared by the training-data operators."""

from __future__ import annotations

import atexit
import ctypes
import gc
import os
import shutil
import tempfile
import zipfile

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.context import scratch_path


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package's code to the executors, once an application (as ``--py-files`` would)."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    root = os.path.dirname(package)
    folder = tempfile.mkdtemp(prefix="tidemark-code-")  # the driver serves the file from here until it ends
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    path = os.path.join(folder, "tidemark_package.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for at, _, names in os.walk(package):
            for n in names:
                if n.endswith(".py"):
                    z.write(os.path.join(at, n), os.path.relpath(os.path.join(at, n), root))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


def scratch(spark: SparkSession, kind: str) -> str:
    """A fresh location in the shared folder, removed when the application ends."""
    return scratch_path(spark, "llm", kind)


def materialize(df: DataFrame, kind: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage: a lost executor never makes the work above run again,
    and values that depend on a task (partition numbers, ranks) stay fixed.
    """
    path = scratch(df.sparkSession, kind)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fold(doc_id: Column | str, buckets: int) -> Column:
    """crc32 of the id as text, modulo ``buckets`` (a NULL id is in fold 0)."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(c.cast("string")) % F.lit(buckets), F.lit(0)).cast("int")


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def row_key(id_col: str = "doc_id", text_col: str = "text") -> list[Column]:
    """Two non-NULL columns that name a document row: ``_id`` and ``_th``.

    Repeated rows (same id, same text) share a key and count as one document;
    rows that share an id but not the text stay apart.
    """
    return [F.coalesce(F.col(id_col).cast("long"), F.lit(-(2**63))).alias("_id"),
            F.xxhash64(F.col(text_col)).alias("_th")]


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of finished jobs.

    It does so once the driver's garbage collection has found that nothing refers to them; a driver with room may go long without.
    """
    gc.collect()  # Python's references to plans first
    spark.sparkContext._jvm.System.gc()


def discard(spark: SparkSession, path: str) -> None:
    """Remove a table of :func:`scratch` that nothing reads any more."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def new_name(name: str, df: DataFrame) -> str:
    """``name``, lengthened until no column of ``df`` is called that."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def give_back_memory() -> None:
    """Return what this process has freed to the machine, where its allocators can."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)
