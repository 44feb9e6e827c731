"""Operator 8: document fingerprints by one-permutation MinHash, in DataFrame functions only.

The five-word shingles of the lower-cased text (words between white space; fewer than five words are one shingle) are hashed
once. The top bits of a hash pick one of ``BINS`` bins, and each bin keeps its smallest hash. An empty bin is filled by optimal
densification: it takes the value of the non-empty bin that comes first in the bin's own pseudo-random order (a universal hash
(a t + b) mod p with a and b drawn per bin), so texts with the same empty and full bins borrow alike. Of each bin the ``BITS``
low-order bits are stored, packed, as lowercase hex. Two bins of unlike texts agree by chance with probability C = 2**-BITS, so the
likeness of two fingerprints is (share of equal bins - C) / (1 - C), not below 0.

Everything is computed on a row's own arrays; nothing is exploded, and a text of any length stays one row.

Edge cases: a NULL text is empty; a text without a word has the empty fingerprint, likeness 1 to another empty
one and 0 to any other; equal texts have equal fingerprints; repeated rows (same id and text) are one place in the
order and return the same result each; documents that share
an id are ordered by the hash of their text; a NULL id comes last; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import materialize, row_key

SHINGLE = 5
BINS = 128
BITS = 8
PROBES = 8
_PRIME = 131  # the least prime above the number of bins
_WHITE = " \t\n\x0b\f\r"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body (or a lambda in it) uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    """The words between white space of the lower-cased text."""
    text = F.lower(text)
    for c in _WHITE[1:]:
        text = F.replace(text, F.lit(c), F.lit(" "))
    return F.array_remove(F.split(text, " "), "")


def shingle_hashes(text: Column) -> Column:
    """Hashes of the shingles of a text, in order; an empty array without words."""
    def of(w: Column) -> Column:
        n = F.size(w)
        runs = F.transform(F.sequence(F.lit(0), n - SHINGLE), lambda i: F.xxhash64(*(F.get(w, i + k) for k in range(SHINGLE))))
        return F.when(n >= SHINGLE, runs).when(n > 0, F.array(F.xxhash64(w))).otherwise(F.array().cast("array<bigint>"))

    return let(F.transform(words(text), lambda w: F.xxhash64(w)), of)


def bin_of(h: Column) -> Column:
    """0..BINS-1 from the top bits; ordered as the hashes are."""
    return (F.shiftright(h, 64 - (BINS - 1).bit_length()) + BINS // 2).cast("int")


def _orders() -> Column:
    """For each bin the start of its order of bins t = a k + b modulo _PRIME (k = 0, 1, ...), b and the inverse of a: constants."""
    state, drawn = 1, []
    for _ in range(2 * BINS):
        state = (state * 6364136223846793005 + 1442695040888963407) % 2**64
        drawn.append(state >> 33)
    a, b = [x % (_PRIME - 1) + 1 for x in drawn[::2]], [x % _PRIME for x in drawn[1::2]]
    starts = [[(x * k + y) % _PRIME for k in range(PROBES)] for x, y in zip(a, b)]
    return F.arrays_zip(F.lit(starts).alias("start"), F.lit(b).alias("b"), F.lit([pow(x, -1, _PRIME) for x in a]).alias("inverse"))


def densified(full: Column, values: Column) -> Column:
    """All BINS values from the full bins (ascending) and their values: empty bins borrow from the first full bin in their order.

    The first PROBES bins of an order are looked up; where they are all empty, the full bins are compared by their place in it.
    """
    dense = F.transform(F.sequence(F.lit(0), F.lit(BINS - 1)), lambda j: F.get(values, F.array_position(full, j).cast("int") - 1))

    def borrowed(dense: Column, order: Column) -> Column:
        probe = F.get(F.array_compact(F.transform(order["start"], lambda t: F.get(dense, t))), 0)
        place = F.array_min(F.transform(full, lambda t, i: order["inverse"] * (t - order["b"] + _PRIME) % _PRIME * BINS + i))
        return F.coalesce(probe, F.get(values, place % BINS))

    return let(dense, lambda d: F.transform(_orders(), lambda order, j: F.coalesce(F.get(d, j), borrowed(d, order))))


def bins(text: Column) -> Column:
    """The BITS low-order bits of each bin's value (an array of BINS small integers; empty without words)."""
    def of_minima(minima: Column) -> Column:
        full = F.transform(minima, bin_of)
        values = F.transform(minima, lambda h: h.bitwiseAND(F.lit((1 << BITS) - 1)).cast("int"))
        return let(F.struct(full.alias("f"), values.alias("v")), lambda s: densified(s["f"], s["v"]))

    def of_sorted(h: Column) -> Column:
        first = F.filter(h, lambda x, i: (i == 0) | (bin_of(x) != bin_of(F.get(h, i - 1))))
        return F.when(F.size(h) == 0, F.array().cast("array<int>")).otherwise(let(first, of_minima))

    return let(F.sort_array(shingle_hashes(text)), of_sorted)


def packed(values: Column) -> Column:
    """Bins as lowercase hex, two digits each."""
    return F.lower(F.array_join(F.transform(values, lambda v: F.lpad(F.hex(v), 2, "0")), ""))


def likeness(a: Column, b: Column) -> Column:
    """Bias-corrected share of equal bins."""
    chance = 2.0 ** -BITS
    equal = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda e: e))
    estimate = F.greatest((equal / F.lit(BINS) - chance) / (1 - chance), F.lit(0.0))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), (F.size(a) == F.size(b)).cast("double")).otherwise(estimate)


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint) of every row of ``docs``."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), packed(bins(F.coalesce("text", F.lit("")))).alias("fingerprint"))


def neighbours(docs: DataFrame) -> DataFrame:
    """(_id, _th, before): for each document the one before it by descending key, as a struct (_id, _th, n).

    The document before the largest key is the smallest one. Keys are sorted across partitions; a partition's
    last key looks at the first of the next partition, of which there is a row per partition.
    """
    keys = docs.select(*row_key(), F.length("text").alias("n")).distinct()
    # Written, so that the partition numbers below are those of one run.
    placed = materialize(keys.repartitionByRange("_id", "_th").withColumn("part", F.spark_partition_id()), "document-order")
    key = F.struct("_id", "_th", "n")
    firsts = placed.groupBy("part").agg(F.min(key).alias("first"))
    ends = firsts.select("part", F.lead("first").over(Window.orderBy("part")).alias("following"),
                         F.min("first").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, 0)).alias("least"))
    inside = placed.withColumn("larger", F.lead(key).over(Window.partitionBy("part").orderBy("_id", "_th")))
    return inside.join(ends, "part").select("_id", "_th", F.coalesce("larger", "following", "least").alias("before"))


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text and of its edit, whose last half is the beginning of the next document by descending id.

    (doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next). A text crosses the network
    once to meet its place in the order; then its first half goes to its own key and what the document before
    needs of it goes there.
    """
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    placed = texts.select("doc_id", *row_key(), "text").join(neighbours(texts), ["_id", "_th"])
    # The fingerprint is taken once and travels with both parts.
    own = placed.withColumn("bins", bins(F.col("text")).cast("array<smallint>"))
    n = F.length("text")
    half = F.floor(F.length("text") / 2).cast("int")
    head = F.struct(F.col("_id").alias("to_id"), F.col("_th").alias("to_th"), F.lit(True).alias("is_head"), F.col("doc_id").cast("long").alias("doc_id"),
                    n.alias("n"), F.substring("text", F.lit(1), n - half).alias("part"), F.col("bins"))
    tail = F.struct(F.col("before._id").alias("to_id"), F.col("before._th").alias("to_th"), F.lit(False).alias("is_head"), F.lit(None).cast("long").alias("doc_id"),
                    F.lit(None).cast("int").alias("n"), F.substring("text", F.lit(1), F.floor(F.col("before.n") / 2).cast("int")).alias("part"), F.col("bins"))
    parts = own.select(F.inline(F.array(head, tail)))
    is_head = F.col("is_head")
    met = parts.groupBy("to_id", "to_th").agg(
        F.max("doc_id").alias("doc_id"), F.max("n").alias("n"), F.count(F.when(is_head, True)).cast("int").alias("rows"),
        F.max(F.when(is_head, F.col("part"))).alias("head"), F.max(F.when(~is_head, F.col("part"))).alias("tail"),
        F.max(F.when(is_head, F.col("bins"))).alias("a"), F.max(F.when(~is_head, F.col("bins"))).alias("next"))
    edited = met.withColumn("edited", F.concat("head", "tail"))
    done = edited.withColumn("b", bins(F.col("edited")).cast("array<smallint>"))
    result = done.select("rows", "doc_id", F.col("n").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
                       packed(F.col("a")).alias("fingerprint"), packed(F.col("b")).alias("edited_fingerprint"),
                       likeness(F.col("a"), F.col("b")).alias("near_edited"), likeness(F.col("a"), F.col("next")).alias("near_next"))
    # Repeated rows are one place in the order and have the same result, each.
    return result.withColumn("row", F.explode(F.sequence(F.lit(1), "rows"))).drop("rows", "row")
