"""A hashed bitmap of fixed size: a prefilter that may be sent to every task.

The bitmap of a key set has ``2 ** bits`` bits however many keys there are, so
what is collected and broadcast has a proven bound (2 MB at the default).
It has no false negatives. A full bitmap only prunes less; results never
depend on it because an exact join follows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 24


def build(keys: DataFrame, key: str, bits: int = BITS) -> np.ndarray:
    """Bitmap (uint64 words) of the low ``bits`` bits of the 64-bit hash column ``key``."""
    slot = F.col(key).bitwiseAND(F.lit((1 << bits) - 1))
    words = (keys.select(F.shiftright(slot, 6).cast("int").alias("w"),
                         slot.bitwiseAND(F.lit(63)).cast("int").alias("b"))
             .groupBy("w").agg(F.bit_or(F.expr("shiftleft(1L, b)")).alias("m")))
    out = np.zeros(1 << (bits - 6), dtype=np.int64)
    for row in words.toLocalIterator():  # at most 2 ** (bits - 6) rows
        out[row["w"]] = row["m"]
    return out.view(np.uint64)


def contains(bitmap: np.ndarray, hashes: np.ndarray, bits: int = BITS) -> np.ndarray:
    slot = hashes.astype(np.uint64) & np.uint64((1 << bits) - 1)
    return (bitmap[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1) != 0
