"""Operator 12: SimHash near-duplicates by a byte-position inverted index with count filtering.

A text's fingerprint has a bit set if more than half of its three-word shingles' XXH64 values (seed 42) have it set. Two texts are linked
if their fingerprints differ in at most ``MAX_BITS`` = 3 bits.

Three differing bits lie in at most three of the eight bytes, so linked fingerprints share at least ``MIN_SHARED`` = 5 bytes at
their positions. The index's lists are keyed by positions and the bytes there. A single position has only 256 lists, so
a list is keyed by three positions at once: any five of eight positions hold three of the first four or three of the last four, which makes
eight keys for a fingerprint. Within a list the shared positional bytes of each pair are tallied; pairs with the guaranteed minimum are verified by their differing bits.

A list of more than ``LONGEST`` fingerprints is replaced by longer keys, exactly: of the five positions that are left a linked pair shares two, so one of any four of
them; each member moves to the four lists with one of these added, and if such a list is still too long, to the four lists with one of the last four
positions. A list of five positions leaves 24 bits open. One that is too long even then is a bitmap of 2**24 bits (2 MB at most, built by fixed-size partial aggregates), in which
neighbours are found by flipping one to three bits: work in proportion to its members, not to their pairs.

Pairs are never rows: a list returns the smallest member of each cluster for its members, the components follow from these. Equal fingerprints are one row throughout.
Words are the runs of characters other than space and \\t \\n \\v \\f \\r, in lower case (A-Z only); shingles are joined by single spaces and
count as often as they occur; a text of one or two words is one shingle.

Edge cases: NULL, empty and blank texts have no shingle and the fingerprint zero, and are linked like any other; repeated rows give a row
each; a component's id is the smallest of its ids, NULL only if all are; an empty table gives no row. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialize, ship
from tidemark.llm.components import components

SHINGLE = 3
SEED = 42
MAX_BITS = 3
MIN_SHARED = 8 - MAX_BITS
LONGEST = 512
BLOCK = 1 << 16  # shingles hashed at a time
TRIPLES = [t for half in ((0, 1, 2, 3), (4, 5, 6, 7)) for t in combinations(half, 3)]


def fingerprint(text: bytes | None) -> int:
    """SimHash of a text in UTF-8, unsigned."""
    words = text.lower().split() if text else []  # of bytes: A-Z only, and ASCII white space only
    shingles = max(len(words) - SHINGLE + 1, 1 if words else 0)
    size, set_bits = min(SHINGLE, len(words)), np.zeros(64, np.int64)
    for at in range(0, shingles, BLOCK):
        some = words[at:at + BLOCK + size - 1]
        joined = map(b" ".join, zip(*(some[k:] for k in range(size))))
        hashes = np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in joined), np.uint64)
        set_bits += np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * set_bits > shingles, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp) of every row of ``docs``, the fingerprint as a signed 64-bit integer."""
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t.as_py()) for t in batch.column(1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps, pa.int64())], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")).mapInArrow(of, "doc_id long, fp long")


def _byte(position: int) -> int:
    """The bits of a byte position, as a signed 64-bit integer."""
    return int(np.uint64(0xFF << (8 * position)).astype(np.int64))


def _mask(positions) -> int:
    out = 0
    for p in positions:
        out |= _byte(p)
    return out


def index(fps: DataFrame) -> DataFrame:
    """(positions, bytes, fp): the lists of three positions that each fingerprint is in; ``positions`` is the mask of their bits."""
    masks = F.array(*(F.lit(_mask(t)).cast("long") for t in TRIPLES))
    return fps.select("fp", F.explode(masks).alias("positions")).select("positions", F.col("fp").bitwiseAND(F.col("positions")).alias("bytes"), "fp")


def longer_keys(lists: DataFrame) -> DataFrame:
    """The same lists with one more position each: one of four of the positions that are not in the key."""
    free: Column = F.filter(F.array(*(F.lit(_byte(p)).cast("long") for p in range(8))), lambda b: F.col("positions").bitwiseAND(b) == 0)
    return (lists.select("fp", "positions", F.explode(F.slice(free, 1, 4)).alias("more"))
            .select(F.col("positions").bitwiseOR(F.col("more")).alias("positions"), "fp")
            .select("positions", F.col("fp").bitwiseAND(F.col("positions")).alias("bytes"), "fp").distinct())


def linked_pairs(fps: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, j) of the linked pairs within lists that stand one after the other; ``owner`` numbers the lists."""
    octets = fps.view(np.uint8).reshape(-1, 8)
    left, right = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    at, lag = np.arange(len(fps)), 0
    while True:
        lag += 1
        at = at[at < len(fps) - lag]
        at = at[owner[at] == owner[at + lag]]
        if not len(at):
            return np.concatenate(left), np.concatenate(right)
        shared = (octets[at] == octets[at + lag]).sum(axis=1)  # the tally of a pair
        likely = at[shared >= MIN_SHARED]
        near = likely[np.bitwise_count(fps[likely] ^ fps[likely + lag]) <= MAX_BITS]
        left.append(near)
        right.append(near + lag)


def least_linked(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """For each of n places the first place of its cluster."""
    root = np.arange(n)
    while True:
        before = root.copy()
        np.minimum.at(root, left, root[right])
        np.minimum.at(root, right, root[left])
        root = root[root]
        if (root == before).all():
            return root


def _stars(fps: np.ndarray, root: np.ndarray) -> pa.RecordBatch:
    moved = root != np.arange(len(root))
    return pa.RecordBatch.from_arrays([pa.array(fps[moved].view(np.int64)), pa.array(fps[root[moved]].view(np.int64))], names=["u", "v"])


def links_of_lists(lists: DataFrame) -> DataFrame:
    """(u, v) that connect the linked fingerprints of each list of at most ``LONGEST``."""
    grouped = lists.groupBy("positions", "bytes").agg(F.collect_list("fp").alias("fps"))

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(0)
            owner = np.repeat(np.arange(len(column)), np.asarray(column.value_lengths()))
            fps = np.asarray(column.flatten()).view(np.uint64)
            yield _stars(fps, least_linked(len(fps), *linked_pairs(fps, owner)))

    return grouped.select("fps").mapInArrow(of, "u long, v long")


def flipped() -> np.ndarray:
    """The 24-bit numbers with one to ``MAX_BITS`` bits set."""
    return np.array([sum(1 << b for b in bits) for k in range(1, MAX_BITS + 1) for bits in combinations(range(24), k)], np.int64)


def clusters_of_bitmap(present: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(members, first member of the cluster of each) of a set of 24-bit numbers given as 2**24 flags."""
    members = np.flatnonzero(present)
    place = np.full(1 << 24, -1, np.int32)
    place[members] = np.arange(len(members), dtype=np.int32)
    root, masks = np.arange(len(members)), flipped()
    while True:
        before = root.copy()
        for m in masks.tolist():
            other = place[members ^ m]
            there = np.flatnonzero(other >= 0)
            root[there] = np.minimum(root[there], root[other[there]])
        root = root[root]
        if (root == before).all():
            return members, root


def links_of_bitmaps(lists: DataFrame) -> DataFrame:
    """(u, v) that connect the linked fingerprints of lists of five positions, of any number of members."""
    free = F.expr("filter(array(0, 1, 2, 3, 4, 5, 6, 7), p -> (shiftleft(255L, 8 * p) & positions) = 0)")
    keyed = lists.withColumn("free", free)
    octet = (F.expr(f"shiftleft(shiftrightunsigned(fp, 8 * free[{k}]) & 255L, {8 * k})") for k in range(3))
    rest = next(octet) + next(octet) + next(octet) + 1  # Spark numbers the bits of its bitmaps from 1
    parts = (keyed.select("positions", "bytes", rest.alias("rest"))
             .groupBy("positions", "bytes", F.bitmap_bucket_number("rest").alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("rest")).alias("bits")))
    # 2**24 bits are 512 parts of 4 KB.
    whole = parts.groupBy("positions", "bytes").agg(F.collect_list(F.struct("part", "bits")).alias("parts"))

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                positions, octets = np.uint64(batch.column(0)[at].as_py() & (2 ** 64 - 1)), np.uint64(batch.column(1)[at].as_py() & (2 ** 64 - 1))
                flags = np.zeros(1 << 24, bool)
                for part in batch.column(2)[at]:
                    start = (part["part"].as_py() - 1) << 15
                    flags[start:start + (1 << 15)] = np.unpackbits(np.frombuffer(part["bits"].as_buffer(), np.uint8), bitorder="little").view(bool)
                members, root = clusters_of_bitmap(flags)
                fps = np.full(len(members), octets, np.uint64)
                for k, p in enumerate(p for p in range(8) if not int(positions) >> (8 * p) & 255):
                    fps |= (members.astype(np.uint64) >> np.uint64(8 * k) & np.uint64(255)) << np.uint64(8 * p)
                yield _stars(fps, root)

    return whole.mapInArrow(of, "u long, v long")


def links(fps: DataFrame, *, longest: int = LONGEST) -> DataFrame:
    """(u, v) that connect all linked pairs of the distinct fingerprints ``fps`` (column fp)."""
    found, lists = [], index(fps)
    for length in (3, 4, 5):
        sizes = materialize(lists.groupBy("positions", "bytes").agg(F.count("*").alias("size")).where("size > 1"), "list-sizes")
        short = lists.join(sizes.where(F.col("size") <= longest).drop("size"), ["positions", "bytes"], "left_semi")
        found.append(materialize(links_of_lists(short).distinct(), "fingerprint-links"))
        long = lists.join(sizes.where(F.col("size") > longest).drop("size"), ["positions", "bytes"], "left_semi")
        if sizes.where(F.col("size") > longest).isEmpty():
            break
        if length == 5:
            found.append(materialize(links_of_bitmaps(long).distinct(), "fingerprint-links"))
        else:
            lists = materialize(longer_keys(long), "longer-lists")
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out


def near_duplicates(docs: DataFrame, *, longest: int = LONGEST) -> DataFrame:
    """(doc_id, fp, component_id) of every row of ``docs``."""
    ship(docs.sparkSession)
    rows = materialize(fingerprints(docs), "fingerprints")
    # Copies meet here, in partial aggregates.
    classes = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "fingerprint-classes")
    cluster = materialize(components(links(classes.select("fp"), longest=longest)), "fingerprint-components")
    member = classes.join(cluster.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least_id", F.coalesce("component", "fp").alias("component"))
    least = member.groupBy("component").agg(F.min("least_id").alias("component_id"))
    # Written, so that the last join is a plain one between two tables and the copies of a hot text can be split.
    named = materialize(member.join(least, "component").select("fp", "component_id"), "fingerprint-names")
    return rows.join(named, "fp").select("doc_id", "fp", "component_id")


def hexadecimal(fp: Column | str) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
