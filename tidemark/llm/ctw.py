"""Operator 4: scoring texts with a context-tree weighting language model over bytes.

The modelled sequence of a text is its words (A-Z lower-cased, white space collapsed to one space) and an end byte. Each byte
is coded as eight binary decisions; a decision's node (the bits before it) has a tree of its own over the preceding bytes. In
every context of 0..DEPTH bytes a Krichevsky-Trofimov estimator counts the decisions seen there, and context-tree weighting
mixes all depths: P_w(s) = (P_e(s) + product of the children's P_w) / 2. Scoring takes the learned tree as it is: a decision's
probability is the mixture along its context path, each depth with its posterior weight P_e / (2 P_w), up to the deepest context that
training saw. These are proper probabilities: bits per byte are a code length.

All training documents are counted; nothing is sampled or pruned. A tree is fixed by the counts of its (DEPTH + 1)-byte
grams -- shorter contexts are sums -- so the work is on distinct grams:

1. Documents are dealt into chunks of about CHUNK_BYTES by hash. A chunk counts its distinct grams and words.
2. Grams are gathered by the three bytes before (never more than the contexts of three bytes have) into buckets, which build the tree from depth DEPTH up to 3.
   Of the depths 0..2 there are at most 2**16 contexts; their sums are added up by Spark and finished on the driver.
3. Buckets walk down again and send every chunk the log-probabilities of its own grams (and word counts for the
   base score, gathered by word). Chunks then add up their texts.

No task holds more than a chunk or a bucket, and neither grows with the corpus but in number.

Edge cases: a NULL or empty text is the end token alone; with nothing to learn from, every decision has probability 1/2 and every
token the base probability 1; repeated rows are learned from and scored each; an empty table gives no row; other
columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from math import log, log10

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialize, ship, text_or_empty

DEPTH = 6
TOP = 3  # contexts shorter than this are finished centrally
CHUNK_BYTES = 16 << 20
BUCKET_CHUNKS = 4  # chunks per bucket
END = b"\n"
_BYTE = np.uint64(8)


def words_of(text: str) -> list[bytes]:
    """Words between white space (bytes 9-13 and 32), A-Z lower-cased."""
    return text.encode().lower().split()


def grams(sequences: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The gram of every byte, and how many each sequence has.

    A gram is a number: the byte before in the top place, then the one before that, ..., and the byte itself in the lowest place; so a
    context of d bytes is a gram's top d places. Sequences begin after end bytes.
    """
    lengths = np.fromiter(map(len, sequences), dtype=np.int64, count=len(sequences))
    data = np.frombuffer((END * DEPTH).join([b"", *sequences]), dtype=np.uint8).astype(np.uint64)
    out = data[DEPTH:].copy()
    for k in range(1, DEPTH + 1):
        out |= data[DEPTH - k:len(data) - k] << np.uint64(8 * (DEPTH + 1 - k))
    starts = np.cumsum(lengths + DEPTH) - lengths - DEPTH
    real = np.ones(len(out), dtype=bool)
    for k in range(DEPTH):  # the end bytes between sequences are not coded
        at = starts[1:] - k - 1
        real[at] = False
    return out[real], lengths


def context(gram: np.ndarray, depth: int) -> np.ndarray:
    return gram >> np.uint64(8 * (DEPTH + 1 - depth))


def decisions(gram: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(context and node, bit) of the eight decisions of each gram's byte, as arrays 8 x grams."""
    byte = gram & np.uint64(255)
    j = np.arange(8, dtype=np.uint64)[:, None]
    node = (np.uint64(1) << j) | (byte >> (np.uint64(8) - j))
    return (context(gram, depth) << _BYTE) | node, (byte >> (np.uint64(7) - j)) & np.uint64(1)


_STEPS = np.concatenate(([0.0], np.cumsum(np.log(np.arange(1 << 16) + 0.5))))
_FACTORIALS = np.concatenate(([0.0], np.cumsum(np.log(np.arange(1, 1 << 16)))))


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series; exact to double precision for the large values it is used for."""
    return (x - 0.5) * np.log(x) - x + 0.5 * log(2 * np.pi) + 1 / (12 * x) - 1 / (360 * x ** 3)


def _by_table(n: np.ndarray, table: np.ndarray, shift: float, constant: float) -> np.ndarray:
    small = n < len(table) - 1
    return np.where(small, table[np.where(small, n, 0)], _log_gamma(np.where(small, 1e5, n) + shift) - constant)


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of a sequence with so many zeros and ones."""
    half = 0.5 * log(np.pi)
    return _by_table(zeros, _STEPS, 0.5, half) + _by_table(ones, _STEPS, 0.5, half) - _by_table(zeros + ones, _FACTORIALS, 1.0, 0.0)


class Level:
    """The nodes of one depth: sorted (context, node) keys, counts, log P_w and the weight of the node's own estimate."""

    def __init__(self, key: np.ndarray, zeros: np.ndarray, ones: np.ndarray, below: np.ndarray | None):
        self.key, self.zeros, self.ones = key, zeros, ones
        own = log_kt(zeros, ones)
        self.log_weighted = own if below is None else log(0.5) + np.logaddexp(own, below)
        self.weight = np.ones(len(key)) if below is None else np.exp(log(0.5) + own - self.log_weighted)

    @classmethod
    def deepest(cls, gram: np.ndarray, count: np.ndarray) -> Level:
        """From sorted distinct grams: the decisions of one place in the byte come in the order of their keys."""
        rows = []
        for key, bit in zip(*decisions(gram, DEPTH)):
            first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.empty(0, np.int64)
            total, ones = (np.add.reduceat(c, first) if len(key) else c for c in (count, count * bit.astype(np.int64)))
            rows.append((key[first], total - ones, ones))
        key, zeros, ones = (np.concatenate(c) for c in zip(*rows))
        order = np.argsort(key)
        key = key[order]
        return cls(key, zeros[order], ones[order], None)

    def above(self) -> Level:
        """The level one byte of context shorter."""
        keys, at = np.unique(self.parents(), return_inverse=True)
        zeros, ones = (np.bincount(at, c, len(keys)).astype(np.int64) for c in (self.zeros, self.ones))
        return Level(keys, zeros, ones, self.sums(keys))

    def parents(self) -> np.ndarray:
        """Keys of the nodes one byte of context shorter (the byte farthest back goes)."""
        return (self.key >> np.uint64(16) << _BYTE) | (self.key & np.uint64(255))

    def sums(self, parent_keys: np.ndarray) -> np.ndarray:
        """For each parent the log of the product of its children's P_w."""
        return np.bincount(np.searchsorted(parent_keys, self.parents()), self.log_weighted, len(parent_keys)).astype(np.float64)

    def mixed(self, key: np.ndarray, bit: np.ndarray, deeper: np.ndarray) -> np.ndarray:
        """Probability of each decision from this depth on, NaN where it was never seen; ``deeper``: the same one byte deeper."""
        if not len(self.key):
            return deeper
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        seen = self.key[at] == key
        zeros, ones = self.zeros[at], self.ones[at]
        own = (np.where(bit == 1, ones, zeros) + 0.5) / (zeros + ones + 1)
        w = self.weight[at]
        return np.where(seen, np.where(np.isnan(deeper), own, w * own + (1 - w) * deeper), np.nan)


def build(gram: np.ndarray, count: np.ndarray, to: int = 0) -> dict[int, Level]:
    """Levels of the depths DEPTH .. ``to`` from sorted distinct grams."""
    levels = {DEPTH: Level.deepest(gram, count)}
    for d in range(DEPTH - 1, to - 1, -1):
        levels[d] = levels[d + 1].above()
    return levels


def merge(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and their summed counts."""
    if not parts:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    key, count = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(key)
    key, count = key[order], count[order].astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.empty(0, np.int64)
    return key[first], np.add.reduceat(count, first) if len(key) else count


def log10_probabilities(gram: np.ndarray, levels: dict[int, Level]) -> np.ndarray:
    """log10 of the model's probability of each gram's byte in its context; ``levels``: all depths."""
    p = np.full((8, len(gram)), np.nan)
    for d in range(DEPTH, -1, -1):
        key, bit = decisions(gram, d)
        p = levels[d].mixed(key.ravel(), bit.ravel(), p.ravel()).reshape(8, -1)
    return np.log10(np.where(np.isnan(p), 0.5, p)).sum(axis=0)


# Sorted numbers travel as differences, and everything is deflated.
def pack_sorted(a: np.ndarray) -> bytes:
    return zlib.compress(np.diff(a, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes(), 1)


def unpack_sorted(b: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(b), dtype=np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u8").ravel(), dtype=np.uint64)


def pack(a: np.ndarray, dtype: str) -> bytes:
    return zlib.compress(a.astype(dtype).tobytes(), 1)


def unpack(b: bytes, dtype: str) -> np.ndarray:
    return np.frombuffer(zlib.decompress(b), dtype=dtype)


def gram_bucket(gram: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of the subtree below the TOP bytes before."""
    h = context(gram, TOP) * np.uint64(0x9E3779B97F4A7C15)
    return ((h >> np.uint64(33)) % np.uint64(buckets)).astype(np.int64)


def word_bucket(word: bytes, buckets: int) -> int:
    return zlib.crc32(word) % buckets


def batches(table: pa.Table, size: int = 2_000_000):
    """(rows, words of each, sequences) for about ``size`` bytes of text at a time."""
    texts, start, total = table.column("text"), 0, 0
    lengths = pc.binary_length(texts).to_numpy()
    for i, n in enumerate(lengths.tolist()):
        total += n
        if total >= size or i + 1 == len(lengths):
            words = [words_of(t) for t in texts.slice(start, i + 1 - start).to_pylist()]
            yield slice(start, i + 1), words, [b" ".join(w) + END for w in words]
            start, total = i + 1, 0


class Chunk:
    """Distinct grams and words of a chunk's documents, each with their count in the documents to learn from."""

    def __init__(self, buckets: int):
        self.buckets = buckets

    def distinct(self, table: pa.Table) -> tuple[np.ndarray, np.ndarray, dict[bytes, int]]:
        learn = table.column("learn").to_numpy(zero_copy_only=False)
        parts, words = [], Counter()
        for rows, texts, sequences in batches(table):
            key, lengths = grams(sequences)
            learned = np.repeat(learn[rows], lengths)
            parts.append(np.unique(key[learned], return_counts=True))
            other = np.unique(key[~learned])
            parts.append((other, np.zeros(len(other), np.int64)))
            for w, yes in zip(texts, learn[rows]):
                words.update(w) if yes else words.update(dict.fromkeys(w, 0))
            if len(parts) > 8:
                parts = [merge(parts)]
        return *merge(parts), words

    def gram_parts(self, gram: np.ndarray) -> list[np.ndarray]:
        """Places of the grams of each bucket."""
        bucket = gram_bucket(gram, self.buckets)
        order = np.argsort(bucket, kind="stable")
        return np.split(order, np.searchsorted(bucket[order], np.arange(1, self.buckets)))

    def word_parts(self, words) -> list[list[bytes]]:
        parts: list[list[bytes]] = [[] for _ in range(self.buckets)]
        for w in words:
            parts[word_bucket(w, self.buckets)].append(w)
        return [sorted(p) for p in parts]


def _chunk_counts(buckets: int):
    def of(table: pa.Table) -> pa.Table:
        chunk = Chunk(buckets)
        gram, count, words = chunk.distinct(table)
        rows = [("g", b, pack_sorted(gram[at]), pack(count[at], "<u4")) for b, at in enumerate(chunk.gram_parts(gram)) if len(at)]
        rows += [("w", b, zlib.compress(b"\n".join(part), 1), pack(np.array([words[w] for w in part]), "<u4"))
                 for b, part in enumerate(chunk.word_parts(words)) if part]
        kind, bucket, keys, counts = zip(*rows)
        return pa.table({"chunk": pa.array([table.column("chunk")[0].as_py()] * len(rows), pa.int32()), "kind": list(kind),
                         "bucket": pa.array(bucket, pa.int32()), "keys": pa.array(keys, pa.binary()), "counts": pa.array(counts, pa.binary())})
    return of


def _total(table: pa.Table) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Grams that training saw with their counts, over all chunks of a bucket; and the grams of each chunk."""
    keys = [unpack_sorted(k) for k in table.column("keys").to_pylist()]
    gram, count = merge([(k, unpack(c, "<u4")) for k, c in zip(keys, table.column("counts").to_pylist())])
    return gram[count > 0], count[count > 0], keys


def _top_sums(table: pa.Table) -> pa.Table:
    """The bucket's share in the nodes of depth TOP - 1: counts, and the log-product of the P_w below."""
    gram, count, _ = _total(table)
    levels = build(gram, count, TOP)
    below = levels[TOP]
    keys, at = np.unique(below.parents(), return_inverse=True)
    zeros, ones = (np.bincount(at, c, len(keys)).astype(np.int64) for c in (below.zeros, below.ones))
    return pa.table({"node": keys.astype(np.int64), "zeros": zeros, "ones": ones, "below": below.sums(keys)})


def finish_top(node: np.ndarray, zeros: np.ndarray, ones: np.ndarray, below: np.ndarray) -> dict[int, Level]:
    """Levels TOP - 1 .. 0 from the summed nodes of depth TOP - 1."""
    order = np.argsort(node.astype(np.uint64))
    levels = {TOP - 1: Level(node.astype(np.uint64)[order], zeros[order], ones[order], below[order])}
    for d in range(TOP - 2, -1, -1):
        levels[d] = levels[d + 1].above()
    return levels


def _gram_answers(top):
    def of(table: pa.Table) -> pa.Table:
        gram, count, asked = _total(table)
        levels = build(gram, count, TOP) | top.value
        wanted = np.unique(np.concatenate(asked))
        logs = np.concatenate([log10_probabilities(wanted[a:a + 50_000], levels) for a in range(0, len(wanted), 50_000)])
        answers = [pack(logs[np.searchsorted(wanted, k)], "<f4") for k in asked]
        return pa.table({"chunk": table.column("chunk"), "kind": ["g"] * len(answers), "keys": table.column("keys"),
                         "answer": pa.array(answers, pa.binary())})
    return of


def _word_counts(table: pa.Table) -> tuple[list[list[bytes]], Counter]:
    total, asked = Counter(), []
    for keys, counts in zip(table.column("keys").to_pylist(), table.column("counts").to_pylist()):
        asked.append(zlib.decompress(keys).split(b"\n"))
        for w, c in zip(asked[-1], unpack(counts, "<u4").tolist()):
            total[w] += c
    return asked, total


def _word_answers(table: pa.Table) -> pa.Table:
    """Each chunk's words with their total counts; the row of chunk -1 has the bucket's (tokens, distinct words)."""
    asked, total = _word_counts(table)
    answers = [pack(np.array([total[w] for w in part]), "<i8") for part in asked]
    sums = np.array([sum(total.values()), sum(c > 0 for c in total.values())])
    return pa.table({"chunk": pa.array([*table.column("chunk").to_pylist(), -1], pa.int32()), "kind": ["w"] * len(answers) + ["sum"],
                     "keys": pa.array([*table.column("keys").to_pylist(), b""], pa.binary()),
                     "answer": pa.array([*answers, pack(sums, "<i8")], pa.binary())})


def text_sums(gram: np.ndarray, log_of: np.ndarray, key: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """For each text the sum of the values of its grams; ``gram`` (sorted) has them all.

    Up to 256 texts at a time are told apart in the byte that a gram leaves free, so that one sort
    brings equal grams of a text together and the look-ups into order.
    """
    out, ends = np.zeros(len(lengths)), np.cumsum(lengths)
    for a in range(0, len(lengths), 256):
        b = min(a + 256, len(lengths))
        text = np.repeat(np.arange(b - a, dtype=np.uint64), lengths[a:b])
        both = np.sort((key[ends[a] - lengths[a]:ends[b - 1]] << _BYTE) | text)
        first = np.flatnonzero(np.concatenate(([True], both[1:] != both[:-1])))
        times = np.diff(np.append(first, len(both)))
        both = both[first]
        value = log_of[np.searchsorted(gram, both >> _BYTE)]
        out[a:b] = np.bincount((both & np.uint64(255)).astype(np.int64), value * times, b - a)
    return out


def _scorer(tokens: int, distinct: int, ends: int):
    base = log10(tokens + 0.1 * (distinct + 1))

    def of(docs: pa.Table, answers: pa.Table) -> pa.Table:
        grams_of, logs_of, count_of = [], [], {}
        for kind, keys, answer in zip(*(answers.column(c).to_pylist() for c in ("kind", "keys", "answer"))):
            if kind == "g":
                grams_of.append(unpack_sorted(keys))
                logs_of.append(unpack(answer, "<f4"))
            else:
                count_of.update(zip(zlib.decompress(keys).split(b"\n"), unpack(answer, "<i8").tolist()))
        gram, logs = np.concatenate(grams_of), np.concatenate(logs_of).astype(np.float64)
        order = np.argsort(gram)
        gram, logs = gram[order], logs[order]
        scores, bases, known, n_tokens = [], [], [], []
        for _, texts, sequences in batches(docs):
            scores.append(text_sums(gram, logs, *grams(sequences)))
            for w in texts:
                c = np.fromiter(map(count_of.__getitem__, w), dtype=np.float64, count=len(w))
                n_tokens.append(len(w) + 1)
                known.append(int((c > 0).sum()) + (ends > 0))
                bases.append(float(np.log10(c + 0.1).sum()) + log10(ends + 0.1) - (len(w) + 1) * base)
        return pa.table({"doc_id": docs.column("doc_id"), "learn": docs.column("learn"), "n_tokens": pa.array(n_tokens, pa.int64()),
                         "n_known": pa.array(known, pa.int64()), "train_tokens": pa.array([tokens] * len(known), pa.int64()),
                         "base_score": pa.array(bases, pa.float64()), "score": pa.array(np.concatenate(scores), pa.float64())})
    return of


def score(docs: DataFrame, learn: Column, *, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(doc_id, learn, n_tokens, n_known, train_tokens, base_score, score) of every row; ``learn``: the rows to learn from."""
    spark = docs.sparkSession
    ship(spark)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(learn, F.lit(False)).alias("learn"), text_or_empty().alias("text"))
    size, rows = texts.agg(F.sum(F.octet_length("text")), F.count(F.when(F.col("learn"), 1))).first()
    chunks = max(-(-(size or 0) // chunk_bytes), 1)
    buckets = max(-(-chunks // BUCKET_CHUNKS), 6)
    dealt = texts.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)).cast("int"))

    counts = materialize(dealt.groupBy("chunk").applyInArrow(
        _chunk_counts(buckets), "chunk int, kind string, bucket int, keys binary, counts binary"), "chunk-counts")
    of_grams, of_words = counts.where("kind = 'g'"), counts.where("kind = 'w'")

    # At most 2**16 contexts of two bytes, with 255 nodes each.
    sums = (of_grams.groupBy("bucket").applyInArrow(_top_sums, "node long, zeros long, ones long, below double")
            .groupBy("node").agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum("below").alias("below"))).toPandas()
    top = spark.sparkContext.broadcast(finish_top(*(sums[c].to_numpy() for c in ("node", "zeros", "ones", "below"))))

    answer = "chunk int, kind string, keys binary, answer binary"
    word_answers = materialize(of_words.groupBy("bucket").applyInArrow(_word_answers, answer), "word-answers")
    totals = [unpack(bytes(r["answer"]), "<i8") for r in word_answers.where("kind = 'sum'").toLocalIterator()]
    tokens, distinct = (int(sum(t[i] for t in totals)) for i in (0, 1))
    answers = of_grams.groupBy("bucket").applyInArrow(_gram_answers(top), answer).union(word_answers.where("kind = 'w'"))
    # The end of a text is a token too, seen once in every document learned from.
    return dealt.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
        _scorer(tokens + rows, distinct + (rows > 0), rows),
        "doc_id long, learn boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
