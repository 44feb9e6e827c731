"""Operator 2: benchmark decontamination by winnowing.

Words are runs of digits, a-z (A-Z lower-cased) and characters beyond ASCII. Every run of ``K`` words is hashed, and of
each window of ``W`` neighbouring hashes the smallest is kept (the rightmost among equals). A shared span of
``K + W - 1 = 13`` words is one such window on both sides, so both sides keep the same hash at the same place in it: no span of 13
words or more can be missed. Kept hashes of documents and benchmark items are joined, and each hit is extended to both
sides, word by word, over the 12 words that any 13-word window around it can take up; what reaches 13 words is a shared span. Items
of fewer than 13 words are one window as a whole and are looked up by the hash of all their words.

Before the join the documents' hashes pass a bitmap of the benchmark's hashes, whose size is fixed (2 MB); only
hashes that may be shared are shuffled. A passage that very many documents share is a hot key on one side of an
equi-join, which Spark's skew join splits.

Edge cases: a NULL or empty text has no words, is never hit and not contaminated; an item without words has no window; items
that repeat an id count once, an item with a NULL id hits words but is not counted among the items; repeated document
rows get a row each; an empty benchmark hits nothing. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import bitmap
from tidemark.llm.common import give_back_memory, materialize, new_name, row_key, ship
from tidemark.llm.words import forget_words, gram_hashes, mix, word_hashes

SPAN = 13
K = W = 7
SIDE = SPAN - K

_TO_WORDS = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_TO_WORDS).split()


def winnow(hashes: np.ndarray) -> np.ndarray:
    """Places of the hashes that are the smallest (rightmost) of some window of W neighbours."""
    windows = len(hashes) - W + 1
    if windows <= 0:
        return np.empty(0, dtype=np.int64)
    best, place = hashes[:windows], np.zeros(windows, dtype=np.int64)
    for k in range(1, W):
        here = hashes[k:k + windows]
        place = np.where(here <= best, k, place)
        best = np.minimum(best, here)
    return np.unique(place + np.arange(windows))


def whole_hash(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of runs of ``n`` < SPAN words, apart from those of other lengths and from the kept K-gram hashes."""
    return mix(gram_hashes(hashes, n) + np.uint64(n))


def fingerprints(words: list[bytes], short: list[int], keep) -> Iterator[tuple[int, int, int, str]]:
    """(hash, first word of the context, anchor's place in it, context) of each kept place; ``short``: other lengths to look up."""
    hashes = word_hashes(words)
    grams = gram_hashes(hashes, K)
    kept = winnow(grams)
    for at in kept[keep(grams[kept])].tolist():
        first = max(at - SIDE, 0)
        yield int(grams[at].view(np.int64)), first, at - first, b" ".join(words[first:at + SPAN]).decode()
    for n in short:
        runs = whole_hash(hashes, n)
        for at in np.flatnonzero(keep(runs)).tolist():
            yield int(runs[at].view(np.int64)), at, -1, b" ".join(words[at:at + n]).decode()


_HIT = pa.list_(pa.struct([("h", pa.int64()), ("first", pa.int32()), ("anchor", pa.int32()), ("context", pa.string())]))
_HIT_SQL = "array<struct<h:bigint,first:int,anchor:int,context:string>>"


def _hit_lists(rows: list[list[tuple[int, int, int, str]]]) -> pa.Array:
    return pa.array([[dict(zip(("h", "first", "anchor", "context"), r)) for r in row] for row in rows], _HIT)


def item_fingerprints(benchmark: DataFrame) -> DataFrame:
    """(item_id, n_words, h, anchor, context) of the benchmark."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        everything = lambda h: np.ones(len(h), dtype=bool)
        for batch in batches:
            words = [words_of(t) for t in batch.column(1).to_pylist()]
            hits = [list(fingerprints(w, [], everything)) if len(w) >= SPAN else list(fingerprints(w, [len(w)] if w else [], everything))[-1:]
                    for w in words]
            yield pa.RecordBatch.from_pydict({"item_id": batch.column(0), "n_words": pa.array(map(len, words), pa.int32()), "hits": _hit_lists(hits)})

    return (benchmark.select(F.col("item_id").cast("string"), "text").mapInArrow(of, f"item_id string, n_words int, hits {_HIT_SQL}")
            .select("item_id", "n_words", F.inline("hits")).drop("first").distinct())


def shared_span(context: str, anchor: int, item_context: str, item_anchor: int) -> tuple[int, int] | None:
    """The span of the context's words that extends the hit on both sides and has SPAN words or more."""
    if anchor < 0 or item_anchor < 0:  # a whole short item
        return (0, context.count(" ") + 1) if anchor == item_anchor and context == item_context else None
    a, b = context.split(" "), item_context.split(" ")
    if a[anchor:anchor + K] != b[item_anchor:item_anchor + K]:
        return None
    left, right = 0, K
    while left < min(anchor, item_anchor) and a[anchor - left - 1] == b[item_anchor - left - 1]:
        left += 1
    while anchor + right < len(a) and item_anchor + right < len(b) and a[anchor + right] == b[item_anchor + right]:
        right += 1
    return (anchor - left, anchor + right) if left + right >= SPAN else None


def document_hits(docs: DataFrame, benchmark: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Documents (_row, doc_id, _id, _th, n_words) and shared spans (_row, item_id, start, end)."""
    spark = docs.sparkSession
    ship(spark)
    items = materialize(item_fingerprints(benchmark), "benchmark-fingerprints")
    short = sorted(r["n_words"] for r in items.where(f"n_words < {SPAN}").select("n_words").distinct().collect())  # at most 12 rows
    shared = spark.sparkContext.broadcast(bitmap.build(items, "h"))

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def keep(hashes):
            return bitmap.contains(shared.value, hashes)

        for batch in batches:
            counts, hits = [], []
            for text in batch.column(3).to_pylist():
                words = words_of(text)
                counts.append(len(words))
                hits.append(list(fingerprints(words, short, keep)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(counts, pa.int64()), _hit_lists(hits)],
                                             names=["doc_id", "_id", "_th", "n_words", "hits"])
        forget_words()
        give_back_memory()

    found = docs.select("doc_id", *row_key(), "text").mapInArrow(
        of, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, _id long, _th long, n_words long, hits {_HIT_SQL}")
    found = materialize(found.withColumn("_row", F.monotonically_increasing_id()), "document-hits")

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in zip(*(c.to_pylist() for c in batch.columns)):
                row, first, anchor, context, item_id, item_anchor, item_context = r
                if span := shared_span(context, anchor, item_context, item_anchor):
                    rows.append((row, item_id, first + span[0], first + span[1]))
            row, item_id, start, end = zip(*rows) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_pydict({"_row": pa.array(row, pa.int64()), "item_id": pa.array(item_id, pa.string()),
                                              "start": pa.array(start, pa.int64()), "end": pa.array(end, pa.int64())})

    hits = found.select("_row", F.inline("hits"))
    item = items.select("item_id", "h", F.col("anchor").alias("item_anchor"), F.col("context").alias("item_context"))
    spans = (hits.join(item, "h").select("_row", "first", "anchor", "context", "item_id", "item_anchor", "item_context")
             .mapInArrow(extend, "_row long, item_id string, start long, end long"))
    return found.drop("hits"), spans


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per document row: doc_id, n_words, n_hit, n_items, items_sha256, contaminated (and the row's key _id, _th)."""
    found, spans = document_hits(docs, benchmark)
    # Per document: its spans and the items they come from, bounded by its own length and the items it shares words with.
    grouped = spans.groupBy("_row").agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("spans"),
                                        F.array_sort(F.collect_set("item_id")).alias("items"))
    covered = F.aggregate(
        "spans", F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("upto")),
        lambda a, s: F.struct((a["n"] + F.greatest(s["end"] - F.greatest(s["start"], a["upto"]), F.lit(0))).alias("n"),
                              F.greatest(a["upto"], s["end"]).alias("upto")), lambda a: a["n"])
    grouped = grouped.select("_row", covered.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                             F.array_join("items", ",").alias("items"))
    n_hit = F.coalesce("n_hit", F.lit(0))
    return found.join(grouped, "_row", "left").select(
        "doc_id", "n_words", n_hit.cast("long").alias("n_hit"), F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce("items", F.lit("")), 256).alias("items_sha256"),
        ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"), "_id", "_th")


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with the same columns."""
    key = [new_name("_tm_id", docs), new_name("_tm_th", docs)]
    bad = contamination(docs, benchmark).where("contaminated").select("_id", "_th").distinct().toDF(*key)
    keyed = docs.withColumns(dict(zip(key, row_key())))
    return keyed.join(bad, key, "left_anti").select(*docs.columns)
