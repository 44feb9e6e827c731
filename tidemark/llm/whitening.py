"""Operator 13: whitening of embeddings with an exact covariance from bit-sliced scatter.

Components become integers, ``floor(scale * x)``. The covariance is taken over the distinct vectors. Each dimension, less its smallest
value, is cut into bit planes; a plane of many rows is packed into 64-bit words. The sum of products of two dimensions is
then the sum over pairs of their planes of ``2**(a + b)`` times the number of bits set in both (AND, population count), exact at any number of rows. A plane of ones gives
the sums and the number of rows. ``n * sum(x y) - sum(x) sum(y)`` is centred as an integer (it is n**2 times the covariance, and the shifts cancel), divided once, and goes to ``eigh``.

On Spark: the distinct vectors are one aggregate over their packed integers (a vector of any frequency is one row of a map task), written as a table. Each
task keeps one triangle of sums, sums of all tasks are added as decimals by dimension pair, and the driver gets (length + 1)**2 / 2 numbers and does one eigendecomposition; it
needs room for length x length numbers, whatever the number of rows. The identity error is measured by a further pass over the whitened fit list.

Edge cases: a vector that is NULL, empty, of another length than most (see :mod:`tidemark.llm.vectors`) or holds a NULL or non-finite component
drops its row; repeated rows, and rows of equal vectors, count once in the fit and are returned each; integers are held at
+-2**40. A component without variance (eigenvalue not above 1e-12 of the largest one) is whitened to 0, explains 0 and is left out of the identity error; a
deviation that does not fit 64 bits is NULL. Vectors shorter than the number of components have as many as their length. No usable row: no result row. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialize, ship
from tidemark.llm.vectors import floors, from_binary, to_binary, usable

SCALE = 256.0
COMPONENTS = 4
LIMIT = 1 << 40
WIDTHS = (np.int8, np.int16, np.int32, np.int64)
SLICE = 1 << 21  # components handled at a time in a task


def _slices(batch: pa.RecordBatch, length: int) -> Iterator[pa.RecordBatch]:
    step = max(64, SLICE // max(length, 1))
    for at in range(0, batch.num_rows, step):
        yield batch.slice(at, step)


def packed(x: np.ndarray) -> list[bytes]:
    """Each row's integers in the narrowest type that holds them all, so that equal vectors have equal bytes."""
    most = np.maximum(x.max(axis=1), -1 - x.min(axis=1))
    out: list[bytes] = [b""] * len(x)
    done = np.zeros(len(x), bool)
    for t in WIDTHS:
        rows = np.flatnonzero(~done & (most <= np.iinfo(t).max))
        for i, row in zip(rows.tolist(), np.ascontiguousarray(x[rows].astype(t))):
            out[i] = row.tobytes()
        done[rows] = True
    return out


def unpacked(column: pa.Array, length: int) -> np.ndarray:
    sizes = np.diff(np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, 4 * column.offset)) if len(column) else np.empty(0, np.int32)
    out = np.empty((len(column), length), np.int64)
    for t in WIDTHS:
        rows = np.flatnonzero(sizes == length * np.dtype(t).itemsize)
        if len(rows):
            out[rows] = from_binary(column if len(rows) == len(column) else column.take(pa.array(rows)), t, length)
    return out


def distinct_vectors(kept: DataFrame, length: int, scale: float) -> DataFrame:
    """(x) of the distinct integer vectors, packed."""
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _slices(whole, length):
                yield pa.RecordBatch.from_arrays([pa.array(packed(floors(batch.column(0), length, scale, LIMIT)), pa.binary())], names=["x"])

    return kept.select("embedding").mapInArrow(of, "x binary").distinct()


def extremes(fit: DataFrame, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest value of each dimension."""
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, high = np.full(length, np.iinfo(np.int64).max), np.full(length, np.iinfo(np.int64).min)
        for batch in batches:
            for part in _slices(batch, length):
                x = unpacked(part.column(0), length)
                low, high = np.minimum(low, x.min(axis=0)), np.maximum(high, x.max(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array([low.tolist()], pa.list_(pa.int64())), pa.array([high.tolist()], pa.list_(pa.int64()))], names=["low", "high"])

    ends = (fit.mapInArrow(of, "low array<bigint>, high array<bigint>").select(F.posexplode(F.arrays_zip("low", "high")).alias("at", "e"))
            .groupBy("at").agg(F.min("e.low"), F.max("e.high")).orderBy("at").collect())  # a row a dimension
    return np.array([r[1] for r in ends], np.int64), np.array([r[2] for r in ends], np.int64)


def bit_planes(x: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """The planes of each column of ``x`` (not negative), ``bits`` of them, low ones first, packed across the rows into words."""
    words = -(-len(x) // 64)
    planes = np.zeros((int(bits.sum()), words * 8), np.uint8)
    at = 0
    for column, width in zip(x.T, bits.tolist()):
        for k in range(width):
            row = np.packbits(column >> k & 1, bitorder="little")
            planes[at, :len(row)] = row
            at += 1
    return planes.view(np.uint64)


def add_products(total: np.ndarray, x: np.ndarray, bits: np.ndarray) -> None:
    """Add the sums of products of the columns of ``x`` to the upper triangle of ``total``, by population counts of planes."""
    planes = bit_planes(x, bits)
    starts = np.concatenate([[0], np.cumsum(bits)[:-1]])
    weight = np.array([1 << k for width in bits.tolist() for k in range(width)], dtype=object if total.dtype == object else np.int64)
    for i, width in enumerate(bits.tolist()):
        later = planes[starts[i]:]
        for a in range(width):
            both = np.bitwise_count(later & planes[starts[i] + a]).sum(axis=1, dtype=np.int64)
            weighted = weight[starts[i]:] * both
            total[i, i:] += np.add.reduceat(weighted, starts[i:] - starts[i]) * (1 << a)


def scatter(fit: DataFrame, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Sums of products of the shifted dimensions and a column of ones, over all rows; exact (an object array), the upper triangle."""
    length = len(low)
    # A dimension without variance keeps one (empty) plane; the last column is the ones.
    bits = np.array([max(1, int(h - l).bit_length()) for l, h in zip(low.tolist(), high.tolist())] + [1])
    triangle = np.triu_indices(length + 1)
    # A task's sums stay within 64 bits up to 2**32 rows, or are Python's integers.
    exact = np.int64 if 2 * int(bits.max()) + 32 <= 62 else object

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((length + 1, length + 1), exact)
        for batch in batches:
            for part in _slices(batch, length):
                x = unpacked(part.column(0), length) - low
                add_products(total, np.hstack([x, np.ones((len(x), 1), np.int64)]), bits)
        yield pa.RecordBatch.from_arrays([pa.array([[str(v) for v in total[triangle].tolist()]], pa.list_(pa.string()))], names=["sums"])

    sums = (fit.mapInArrow(of, "sums array<string>").select(F.posexplode("sums").alias("at", "v"))
            .groupBy("at").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v")).collect())  # (length + 1)**2 / 2 rows
    out = np.zeros((length + 1, length + 1), object)
    out[triangle] = [int(r["v"]) for r in sorted(sums, key=lambda r: r["at"])]
    return out


@dataclass
class Whitening:
    """n distinct vectors with sums S; directions (length, components) that whiten x - S / n; the share of the variance of each."""

    n: int
    sums: list[int]
    low: np.ndarray
    high: np.ndarray
    directions: np.ndarray
    explained: np.ndarray
    eigenvalues: np.ndarray

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return (x - np.array([s / self.n for s in self.sums])) @ self.directions

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n x - S)**2, exact; None where it does not fit 64 bits."""
        reach = max((max(abs(self.n * int(v) - s) for v in ends) for *ends, s in zip(self.low, self.high, self.sums)), default=0)
        if len(self.sums) * reach ** 2 < 2 ** 63:
            d = self.n * x - np.array(self.sums, np.int64)
            return (d * d).sum(axis=1).tolist()
        d = self.n * x.astype(object) - np.array(self.sums, object)
        return [v if v < 2 ** 63 else None for v in (d * d).sum(axis=1).tolist()]


def solve(products: np.ndarray, low: np.ndarray, high: np.ndarray, components: int) -> Whitening:
    """The leading components of the covariance given by the exact scatter."""
    length = len(low)
    n, shifted = products[length, length], products[:length, length]
    full = np.triu(products[:length, :length]) + np.triu(products[:length, :length], 1).T
    centred = n * full - np.outer(shifted, shifted)  # n**2 times the covariance
    v = np.array([[c / (n * n) for c in row] for row in centred.tolist()])
    e, vectors = np.linalg.eigh(v)
    e, vectors = e[::-1][:components], vectors[:, ::-1][:, :components]
    vectors = vectors * np.where(np.take_along_axis(vectors, np.abs(vectors).argmax(axis=0)[None], 0) < 0, -1, 1)
    there = e > 1e-12 * max(float(e[0]), 0) if e[0] > 0 else np.zeros(len(e), bool)
    trace = sum(int(centred[i, i]) for i in range(length)) / (n * n)
    sums = [int(s) + n * int(l) for s, l in zip(shifted, low)]
    directions = np.where(there, vectors / np.sqrt(np.where(there, e, 1)), 0.0)
    return Whitening(n, sums, low, high, directions, np.where(there, e / (trace or 1), 0.0), np.where(there, e, 0.0))


def fit_whitening(fit: DataFrame, length: int, components: int = COMPONENTS) -> Whitening:
    """The whitening of the distinct vectors ``fit`` (at least one, packed in column x)."""
    low, high = extremes(fit, length)
    return solve(scatter(fit, low, high), low, high, min(components, length))


def identity_error(fit: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of (covariance of the whitened fit list - identity), measured, over the components that have variance."""
    length, k = model.directions.shape
    shared = fit.sparkSession.sparkContext.broadcast(model)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k + 1))
        for batch in batches:
            for part in _slices(batch, length):
                w = shared.value.whiten(unpacked(part.column(0), length))
                w = np.hstack([w, np.ones((len(w), 1))])
                total += w.T @ w
        yield pa.RecordBatch.from_arrays([pa.array([total.ravel().tolist()], pa.list_(pa.float64()))], names=["sums"])

    rows = (fit.mapInArrow(of, "sums array<double>").select(F.posexplode("sums").alias("at", "v")).groupBy("at").agg(F.sum("v").alias("v")).collect())
    total = np.array([v for _, v in sorted(rows)]).reshape(k + 1, k + 1) / model.n
    covariance = total[:k, :k] - np.outer(total[:k, k], total[:k, k])
    there = model.eigenvalues > 0
    return float(np.abs(covariance - np.eye(k))[np.ix_(there, there)].max(initial=0.0))


def whitened(embeddings: DataFrame, *, components: int = COMPONENTS, scale: float = SCALE) -> DataFrame:
    """(vec_id, n, deviation, whitened array, explained array, identity_error) of every usable row."""
    ship(embeddings.sparkSession)
    schema = "vec_id long, n long, deviation long, whitened array<double>, explained array<double>, identity_error double"
    kept, length = usable(embeddings, F.col("vec_id").cast("long").alias("vec_id"))
    if not length:
        return kept.sparkSession.createDataFrame([], schema)
    fit = materialize(distinct_vectors(kept, length, scale), "distinct-vectors")
    model = fit_whitening(fit, length, components)
    error = identity_error(fit, model)
    shared = kept.sparkSession.sparkContext.broadcast(model)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, doubles = shared.value, pa.list_(pa.float64())
        for whole in batches:
            for batch in _slices(whole, length):
                x, n = floors(batch.column(1), length, scale, LIMIT), batch.num_rows
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array([model.n] * n, pa.int64()), pa.array(model.deviations(x), pa.int64()),
                     pa.array(model.whiten(x).tolist(), doubles), pa.array([model.explained.tolist()] * n, doubles), pa.array([error] * n, pa.float64())],
                    names=["vec_id", "n", "deviation", "whitened", "explained", "identity_error"])

    return kept.select("vec_id", "embedding").mapInArrow(of, schema)


def by_component(rows: DataFrame) -> DataFrame:
    """One row for each row and component: (vec_id, component, n, deviation, whitened, explained, identity_error)."""
    both = F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "c")
    return rows.select("vec_id", "n", "deviation", "identity_error", both).select(
        "vec_id", (F.col("at") + 1).alias("component"), "n", "deviation", F.col("c.whitened").alias("whitened"), F.col("c.explained").alias("explained"), "identity_error")
