"""Operator 3: best-fit-decreasing packing of documents into fixed-length sequences.

``token_pieces`` encodes each document, appends the end id and cuts only what is longer than a sequence.
``best_fit_pack`` then packs rows of any table by their ``length``.

Best-fit decreasing takes pieces from the longest to the shortest and puts each into the open sequence with the
least room that still fits; which piece of a given length goes first makes no difference. So the packing depends
on nothing but the number of pieces of each length: at most ``capacity`` counts, however large the corpus. The driver
packs these counts exactly -- a segment tree over remaining capacities finds the tightest open sequences in
logarithmic time, and all pieces of one length that go into sequences of one kind are placed in one step -- and
returns a table of placements "pieces number a..b of length L go, m to a sequence, from sequence s on". Executors number the pieces
of each length by prefix sums over partitions and look their placement up. No piece passes through the driver,
and no task holds all pieces of a length.

Edge cases: a NULL or empty text is one piece with the end id alone; repeated rows are packed once each; an empty
table packs into nothing; other columns are not carried. A length below 1 or above the capacity is an error.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import materialize, ship, text_or_empty
from tidemark.llm.encode import encoder, slices

CAPACITY = 4096


class RoomTree:
    """Segment tree over remaining capacities 0..capacity: is a sequence with this room open?"""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.open = [0] * (2 * self.size)

    def add(self, room: int, by: int) -> None:
        i = room + self.size
        while i:
            self.open[i] += by
            i >>= 1

    def tightest(self, need: int) -> int | None:
        """The smallest room >= need that is open."""
        i = need + self.size
        if self.open[i]:
            return need
        while i > 1:  # climb until a right neighbour holds something, then go down to its leftmost leaf
            if not i & 1 and self.open[i + 1]:
                i += 1
                while i < self.size:
                    i = 2 * i if self.open[2 * i] else 2 * i + 1
                return i - self.size
            i >>= 1
        return None


def plan_packing(counts: dict[int, int], capacity: int) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Best-fit decreasing over counts of lengths.

    Returns placements (length, first rank, first sequence, pieces per sequence, offset) ordered by length and
    rank, and the number of sequences. Ranks of a length run from 0.
    """
    placements: list[tuple[int, int, int, int, int]] = []
    rooms: dict[int, list[tuple[int, int]]] = defaultdict(list)  # room -> runs of sequences [first, end)
    tree, sequences = RoomTree(capacity), 0

    def put(room: int, first: int, end: int) -> None:
        if first < end and room:
            rooms[room].append((first, end))
            tree.add(room, 1)

    for length in sorted(counts, reverse=True):
        if not 1 <= length <= capacity:
            raise ValueError(f"length {length} is outside 1..{capacity}")
        rank, left = 0, counts[length]
        while left:
            room = tree.tightest(length)
            if room is None:
                room = capacity
                first, end = sequences, sequences - (-left // (capacity // length))
                sequences = end
            else:
                first, end = rooms[room].pop()
                tree.add(room, -1)
            each = room // length  # a sequence stays the tightest until no further piece fits
            full = min(end - first, left // each)
            rest = left - full * each if full < end - first else 0  # the last pieces go into one more, not filled up
            placements.append((length, rank, first, each, capacity - room))
            put(room - each * length, first, first + full)
            used = first + full
            if rest:
                put(room - rest * length, used, used + 1)
                used += 1
            put(room, used, end)
            rank += full * each + rest
            left -= full * each + rest
    return sorted(placements), sequences


def token_pieces(docs: DataFrame, tokenizer: str, *, capacity: int = CAPACITY, end_id: int = 1, units: str = "whole",
                 keep_ids: bool = False) -> DataFrame:
    """Pieces (doc_id, piece, start, length, ids_crc32[, ids]) of every whole text, in no order.

    ``ids`` (little-endian unsigned 32-bit) is carried on request only. ``_part`` and ``_rank`` number
    the pieces of each length within the task that made them; they are fixed once the rows are written.
    """
    ship(docs.sparkSession)
    end = np.asarray([end_id], dtype="<u4").tobytes()
    step = 4 * capacity
    fields = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
              ("ids_crc32", pa.int64()), ("_part", pa.int32()), ("_rank", pa.int64())] + [("ids", pa.binary())] * keep_ids
    schema = pa.schema(fields)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen, enc = TaskContext.get().partitionId(), defaultdict(int), encoder(tokenizer, units)
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in slices(texts):
                rows = []
                for doc_id, coded in zip(ids[a:b], enc.encode(texts[a:b])):
                    coded += end
                    for k, at in enumerate(range(0, len(coded), step)):
                        piece = coded[at:at + step]
                        n = len(piece) // 4
                        rows.append((doc_id, k, at // 4, n, zlib.crc32(piece), part, seen[n]) + (piece,) * keep_ids)
                        seen[n] += 1
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    names = {"int64": "long", "int32": "int", "binary": "binary"}
    return (docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text"))
            .mapInArrow(cut, ", ".join(f"{f.name} {names[str(f.type)]}" for f in schema)))


def best_fit_pack(pieces: DataFrame, *, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to written rows with ``length``, ``_part`` and ``_rank`` (see token_pieces)."""
    spark = pieces.sparkSession
    ship(spark)
    counts = pieces.groupBy("length", "_part").agg(F.count("*").alias("_n"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("_n").alias("n")).collect()}  # <= capacity rows
    placements, _ = plan_packing(histogram, capacity)
    table = np.asarray(placements or np.empty((0, 5)), dtype=np.int64).reshape(-1, 5)
    shift = np.int64(1 << 44)  # ranks of a length stay below
    place = spark.sparkContext.broadcast((table[:, 0] * shift + table[:, 1], table))

    def look_up(batches):
        key, t = place.value
        for pdf in batches:
            if len(pdf):
                rank = pdf["_base"].to_numpy() + pdf["_rank"].to_numpy()
                length = pdf["length"].to_numpy()
                p = t[np.searchsorted(key, length * shift + rank, side="right") - 1]
                k = rank - p[:, 1]
                pdf["sequence_id"], pdf["offset"] = p[:, 2] + k // p[:, 3], p[:, 4] + k % p[:, 3] * length
            else:
                pdf["sequence_id"] = pdf["offset"] = np.empty(0, np.int64)
            yield pdf[names]

    # A row per task and length; the window over one length holds a row per task.
    before = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("length", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    keep = [f for f in pieces.schema.fields if f.name not in ("_part", "_rank")]
    names = [f.name for f in keep] + ["sequence_id", "offset"]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in keep) + ", sequence_id long, offset long"
    return pieces.join(bases, ["length", "_part"]).mapInPandas(look_up, schema)


def pack_documents(docs: DataFrame, tokenizer: str, *, capacity: int = CAPACITY, end_id: int = 1, units: str = "whole",
                   keep_ids: bool = False) -> DataFrame:
    """Tokenize and pack: (doc_id, piece, start, length, ids_crc32[, ids], sequence_id, offset)."""
    pieces = materialize(token_pieces(docs, tokenizer, capacity=capacity, end_id=end_id, units=units, keep_ids=keep_ids), "pieces")
    return best_fit_pack(pieces, capacity=capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences (sequence_id, n_tokens, ids) of pieces packed with ``keep_ids``; a group holds one sequence."""
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(
        F.sum("length").alias("n_tokens"),
        F.aggregate(F.transform(ordered, lambda p: p["ids"]), F.lit(b""), lambda a, b: F.concat(a, b)).alias("ids"))
