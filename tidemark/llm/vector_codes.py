"""Operator 11: vector code compression -- a product quantiser whose rounds skip exact scans by norm-of-sum bounds.

Components become integers, ``floor(scale * x)``, and a vector is cut into ``PARTS`` equal consecutive parts. Each part position has a codebook; a
code is the index of the nearest entry at each position. The codebooks are refined by rounds of assigning every part to
its nearest entry (ties to the lower index) and moving every entry to its parts' mean (floored).

A part keeps an upper bound of the distance to its own entry and a lower bound of the distance to every other, each stamped with the round in which
it was exact. All earlier codebooks are retained, so a bound of round ``s`` is moved to round ``t`` by how far the entry is from
where it stood in round ``s``: one net displacement, the norm of the sum of its moves. Adding up the single moves (the sum of the norms)
is never smaller and keeps growing when an entry wanders around one place. Only entries whose lower bound does not exceed the upper one are compared exactly, and only
these bounds get a new stamp. Bounds are rounded outwards and distances are integers, so the codes are those of a full scan.

On Spark: one row per vector with its integers, code, bounds and stamps in fixed-length binary columns, written anew by each round; the older table is removed.
Each task adds one row with how much the sums and counts of the entries change by the parts that left or came (whole sums in the first round), so a round is one pass.
Only the codebooks (parts x entries x length of a part) and their sums reach the driver.

Edge cases: a vector that is NULL, empty, of another length than most (see :mod:`tidemark.llm.vectors`) or holds a NULL or non-finite component
drops its row; repeated rows are coded each and count each; the start entries are the vectors of the smallest distinct ids (of rows that share an id, the
least one), a NULL id comes last; with fewer ids there are fewer entries. A length that the parts do not divide is
filled up with zeros, which belong to no codebook. Integers are held at +-sqrt(2**60 / length) so that every squared distance fits 64 bits (+-2**27 for
64 components: |x| of 32768 at a scale of 4096). No usable row: no result row. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from tidemark.llm.common import discard, scratch, ship
from tidemark.llm.vectors import floors, from_binary, to_binary, usable

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096.0
SLICE = 1 << 20  # components handled at a time in a task
STATE = "x binary, code binary, upper binary, upper_at binary, lower binary, lower_at binary, changes array<bigint>"


@dataclass
class Bounds:
    """For n vectors: code, upper bound and its stamp (n, parts); lower bounds and their stamps (n, parts, entries)."""

    code: np.ndarray
    upper: np.ndarray
    upper_at: np.ndarray
    lower: np.ndarray
    lower_at: np.ndarray

    def columns(self) -> list[pa.Array]:
        return [to_binary(a) for a in (self.code, self.upper, self.upper_at, self.lower, self.lower_at)]

    @classmethod
    def of(cls, columns: list[pa.Array], parts: int, entries: int) -> "Bounds":
        types = ((np.uint8, (parts,)), (np.float32, (parts,)), (np.uint8, (parts,)), (np.float32, (parts, entries)), (np.uint8, (parts, entries)))
        return cls(*(from_binary(c, t, *s).copy() for c, (t, s) in zip(columns, types)))


def _up(squares: np.ndarray) -> np.ndarray:
    """Roots as 32-bit floats, none too small."""
    return np.nextafter(np.sqrt(squares.astype(np.float64)).astype(np.float32), np.float32(np.inf))


def _down(squares: np.ndarray) -> np.ndarray:
    """Roots as 32-bit floats, none too large."""
    return np.nextafter(np.sqrt(squares.astype(np.float64)).astype(np.float32), np.float32(-np.inf))


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances along the last axis, exact."""
    d = a - b
    return np.einsum("...i,...i->...", d, d)


def net_displacements(history: list[np.ndarray]) -> np.ndarray:
    """(round, part, entry): how far each entry of the last codebooks is from where it stood in each round, rounded up."""
    now = history[-1]
    return np.stack([np.sqrt(squared(now, then).astype(np.float64)) for then in history]) * (1 + 1e-12)


def first_scan(x: np.ndarray, books: np.ndarray) -> Bounds:
    """Every part against every entry, in round 0."""
    n, parts, _ = x.shape
    entries = books.shape[1]
    code, upper = np.empty((n, parts), np.uint8), np.empty((n, parts), np.float32)
    lower = np.empty((n, parts, entries), np.float32)
    for p in range(parts):
        d = np.stack([squared(x[:, p], books[p, j]) for j in range(entries)], axis=1)
        code[:, p] = d.argmin(axis=1)
        upper[:, p], lower[:, p] = _up(d.min(axis=1)), _down(d)
    return Bounds(code, upper, np.zeros_like(code), lower, np.zeros(lower.shape, np.uint8))


def rescan(x: np.ndarray, bounds: Bounds, history: list[np.ndarray], moved: np.ndarray) -> int:
    """Bring ``bounds`` to the last codebooks of ``history`` and return how many distances that took."""
    n, parts, _ = x.shape
    books, now, scanned = history[-1], len(history) - 1, 0
    every = np.arange(books.shape[1])
    for p in range(parts):
        own = bounds.code[:, p].astype(np.int64)
        upper = bounds.upper[:, p] + moved[bounds.upper_at[:, p], p, own]
        lower = bounds.lower[:, p] - moved[bounds.lower_at[:, p], p, every[None, :]]
        open_ = lower <= upper[:, None]
        open_[np.arange(n), own] = False
        rows = np.flatnonzero(open_.any(axis=1))
        if not len(rows):
            continue
        # The upper bound first: made exact, it settles many parts.
        own, lower, open_ = own[rows], lower[rows], open_[rows]
        to_own = squared(x[rows, p], books[p, own])
        tight = _up(to_own)
        open_ &= lower <= tight[:, None]
        at, j = np.nonzero(open_)
        exact = squared(x[rows[at], p], books[p, j])
        scanned += len(rows) + len(at)
        bounds.lower[rows[at], p, j], bounds.lower_at[rows[at], p, j] = _down(exact), now
        distance = np.full(lower.shape, np.iinfo(np.int64).max)
        distance[np.arange(len(rows)), own] = to_own
        distance[at, j] = exact
        best = distance.argmin(axis=1)  # the first, so the lower index, of equal ones
        left = np.flatnonzero(best != own)
        bounds.lower[rows[left], p, own[left]], bounds.lower_at[rows[left], p, own[left]] = _down(to_own[left]), now
        bounds.code[rows, p], bounds.upper_at[rows, p] = best, now
        bounds.upper[rows, p] = _up(distance[np.arange(len(rows)), best])
    return scanned


def add_changes(sums: np.ndarray, x: np.ndarray, old: np.ndarray | None, new: np.ndarray) -> None:
    """Add to (part, entry, components and count) what parts take to their new entry and from their old one."""
    for p in range(x.shape[1]):
        if old is None:
            rows = np.arange(len(x))
        else:
            rows = np.flatnonzero(old[:, p] != new[:, p])
            np.subtract.at(sums[p, :, :-1], old[rows, p], x[rows, p])
            sums[p, :, -1] -= np.bincount(old[rows, p], minlength=sums.shape[1])
        np.add.at(sums[p, :, :-1], new[rows, p], x[rows, p])
        sums[p, :, -1] += np.bincount(new[rows, p], minlength=sums.shape[1])


def _slices(batch: pa.RecordBatch, width: int) -> Iterator[pa.RecordBatch]:
    step = max(1, SLICE // width)
    for at in range(0, batch.num_rows, step):
        yield batch.slice(at, step)


def integer_parts(embeddings: DataFrame, scale: float, parts: int) -> tuple[DataFrame, int]:
    """(vec_id, label, x) of the usable rows, x being the parts' integers (parts x components, filled up with zeros), and the vectors' length."""
    kept, length = usable(embeddings, F.col("vec_id").cast("long").alias("vec_id"), "label")
    limit, width = math.isqrt(2 ** 60 // max(length, 1)), parts * math.ceil(length / parts)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _slices(whole, width):
                x = np.zeros((batch.num_rows, width), np.int32)
                x[:, :length] = floors(batch.column(2), length, scale, limit)
                yield pa.RecordBatch.from_arrays([*batch.columns[:2], to_binary(x)], names=["vec_id", "label", "x"])

    schema = StructType([StructField("vec_id", LongType()), kept.schema["label"], StructField("x", BinaryType())])
    return kept.mapInArrow(of, schema), length


def start_entries(rows: DataFrame, entries: int, parts: int, width: int) -> np.ndarray:
    """The parts of the vectors of the smallest distinct ids: (part, entry, component)."""
    def least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int | None, bytes] = {}
        for batch in batches:
            for i, x in zip(batch.column(0).to_pylist(), batch.column(1)):
                if i in best or len(best) < entries or i is not None and (None in best or i < max(best)):
                    x = x.as_py()
                    best[i] = min(best.get(i, x), x)
                    if len(best) > entries:
                        del best[None if None in best else max(best)]
        yield pa.RecordBatch.from_arrays([pa.array(list(best), pa.int64()), pa.array(list(best.values()), pa.binary())], names=["vec_id", "x"])

    # At most ``entries`` rows from each task, and from all.
    chosen = (rows.select("vec_id", "x").mapInArrow(least, "vec_id long, x binary").groupBy("vec_id").agg(F.min("x").alias("x"))
              .orderBy(F.asc_nulls_last("vec_id")).limit(entries).collect())
    return np.stack([np.frombuffer(r["x"], np.int32).reshape(parts, width) for r in chosen], axis=1).astype(np.int64)


def assign(rows: DataFrame, history: list[np.ndarray]) -> DataFrame:
    """``rows`` with their codes and bounds brought to the last codebooks, and a row with ``changes`` from each task.

    ``changes``: sums and counts that entries gain, then how many distances were computed and how many a full scan takes.
    """
    parts, entries, width = history[-1].shape
    shared, first = rows.sparkSession.sparkContext.broadcast((history, net_displacements(history))), len(history) == 1
    schema = StructType([*rows.schema.fields[:2], *StructType.fromDDL(STATE).fields])

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books, moved = shared.value
        sums, scanned, seen = np.zeros((parts, entries, width + 1), np.int64), 0, 0
        for whole in batches:
            for batch in _slices(whole, parts * width):
                x = from_binary(batch.column(2), np.int32, parts, width).astype(np.int64)
                if first:
                    old, bounds = None, first_scan(x, books[0])
                    scanned += len(x) * parts * entries
                else:
                    bounds = Bounds.of(batch.columns[3:8], parts, entries)
                    old = bounds.code.copy()
                    scanned += rescan(x, bounds, books, moved)
                add_changes(sums, x, old, bounds.code)
                seen += len(x) * parts * entries
                none = pa.nulls(len(x), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([*batch.columns[:3], *bounds.columns(), none], names=schema.names)
        changes = pa.array([[*sums.ravel().tolist(), scanned, seen]], pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([*(pa.nulls(1, to_arrow_type(f.dataType)) for f in schema.fields[:-1]), changes], names=schema.names)

    return rows.mapInArrow(of, schema)


@dataclass
class Compressed:
    """``rows``: (vec_id, label, code, error); ``codebooks``: (part, entry, component); ``scans``: (distances computed, of how many) in each round."""

    rows: DataFrame
    codebooks: np.ndarray
    length: int
    scans: list[tuple[int, int]]

    def digest(self) -> str:
        """SHA-256 of all entries' components in decimal, comma-joined, by part, entry and place in the part."""
        parts, _, width = self.codebooks.shape
        real = [self.codebooks[p, :, :max(0, min(width, self.length - p * width))] for p in range(parts)]
        return hashlib.sha256(",".join(str(c) for book in real for c in book.ravel().tolist()).encode()).hexdigest()


def compress(embeddings: DataFrame, *, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: float = SCALE) -> Compressed:
    """Codebooks learned from all usable rows, and the code (a byte per part) and squared error of each."""
    spark = embeddings.sparkSession
    ship(spark)
    if not 0 < entries <= 256:
        raise ValueError("an index has to fit a byte")

    def store(df: DataFrame, kind: str) -> tuple[DataFrame, str]:
        path = scratch(spark, kind)
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path), path

    table, length = integer_parts(embeddings, scale, parts)
    width = math.ceil(length / parts)
    if not length:
        return Compressed(table.selectExpr("vec_id", "label", "x as code", "0L as error"), np.empty((parts, 0, 0), np.int64), 0, [])
    table, path = store(table, "vector-parts")
    history = [start_entries(table, entries, parts, width)]
    shape, sums, scans = (*history[0].shape[:2], width + 1), 0, []
    for r in range(rounds + 1):
        state, newer = store(assign(table, history), "vector-codes")
        discard(spark, path)
        table, path = state.where("x IS NOT NULL"), newer
        # As many rows as a codebook has numbers, however many tasks there were.
        changes = (state.where("changes IS NOT NULL").select(F.posexplode("changes").alias("at", "n")).groupBy("at").agg(F.sum("n").alias("n")).collect())
        change = np.array([n for _, n in sorted(changes)], np.int64)
        scans.append(tuple(change[-2:].tolist()))
        sums = sums + change[:-2].reshape(shape)
        if r < rounds:
            count = sums[:, :, -1:]
            history.append(np.where(count > 0, sums[:, :, :-1] // np.maximum(count, 1), history[-1]))

    books = spark.sparkContext.broadcast(history[-1])

    def errors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _slices(whole, parts * width):
                x = from_binary(batch.column(2), np.int32, parts, width).astype(np.int64)
                code = from_binary(batch.column(3), np.uint8, parts)
                error = sum(squared(x[:, p], books.value[p, code[:, p]]) for p in range(parts))
                yield pa.RecordBatch.from_arrays([*batch.columns[:2], batch.column(3), pa.array(error, pa.int64())], names=["vec_id", "label", "code", "error"])

    schema = StructType([*table.schema.fields[:2], StructField("code", BinaryType()), StructField("error", LongType())])
    coded, _ = store(table.select("vec_id", "label", "x", "code").mapInArrow(errors, schema), "coded-vectors")
    discard(spark, path)
    return Compressed(coded, history[-1], length, scans)


def with_label_errors(compressed: Compressed) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of every coded row; ``code`` in hexadecimal, two digits a part."""
    rows = compressed.rows
    # Summed before it is joined: a label of any size is one row of a task there, and its rows can be split here.
    per_label = rows.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    return rows.join(per_label, F.col("label").eqNullSafe(F.col("_label"))).select(
        "vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(compressed.digest()).alias("codebooks_sha256"))
