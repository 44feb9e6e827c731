"""Rows of a vector table as integer matrices inside tasks, and fixed-length binary columns that hold them between jobs.

A row is usable if its vector is there, holds at least one component, and no component is NULL or non-finite. All usable rows
must have one length: the one that most of them have (of equally frequent ones the smaller); rows of another length are dropped like the unusable.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(embeddings: DataFrame, *columns: Column | str, vector: str = "embedding") -> tuple[DataFrame, int]:
    """(the ``columns`` and the vector of the usable rows, the vectors' length); the length is 0 if no row is usable."""
    def bad(c):
        x = c.cast("double")
        return x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))

    v = F.col(vector)
    kept = embeddings.select(*columns, v).where(v.isNotNull() & (F.size(v) > 0) & ~F.coalesce(F.exists(v, bad), F.lit(False)))
    most = (kept.groupBy(F.size(v).alias("size")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "size").first())
    length = most["size"] if most else 0
    return kept.where(F.size(v) == length), length


def floors(column: pa.Array, length: int, scale: float, limit: int) -> np.ndarray:
    """floor(scale * component) of a list column without NULLs, as a matrix of longs; larger ones are held at ``limit``."""
    x = np.asarray(column.flatten(), dtype=np.float64).reshape(len(column), length)
    with np.errstate(over="ignore"):
        return np.clip(np.floor(x * scale), -limit, limit).astype(np.int64)


def to_binary(a: np.ndarray) -> pa.Array:
    """A binary column with the bytes of each row of ``a``."""
    a = np.ascontiguousarray(a)
    width = a.itemsize * int(np.prod(a.shape[1:]))
    if len(a) * width >= 2 ** 31:
        raise ValueError("a binary column holds less than 2 GB")
    offsets = np.arange(len(a) + 1, dtype=np.int32) * np.int32(width)
    return pa.Array.from_buffers(pa.binary(), len(a), [None, pa.py_buffer(offsets), pa.py_buffer(a)])


def from_binary(column: pa.Array, dtype, *shape: int) -> np.ndarray:
    """The rows of a binary column without NULLs, all of one length, as one array."""
    n = len(column)
    if not n:
        return np.empty((0, *shape), dtype=dtype)
    start = np.frombuffer(column.buffers()[1], dtype=np.int32, count=1, offset=4 * column.offset)[0]
    return np.frombuffer(column.buffers()[2], dtype=dtype, count=n * int(np.prod(shape)), offset=int(start)).reshape(n, *shape)
