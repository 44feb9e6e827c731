"""Operator 1: toxicity with a counterfactually regularised classifier.

A logistic model over hashed features of the distinct words of a text (the word and its prefixes, so that inflected
forms share weight), scaled by the square root of their number so that long texts do not drift.
Training minimises the logistic loss plus an L2 penalty plus a counterfactual penalty: in each labelled text that names a
group of people, the terms are swapped for other terms of the same kind and for a neutral word, and the squared change
of the score is penalised. Labelled texts need not name a group for that: a mention of each term is also *inserted* into every labelled text, and its swaps
for the neutral word and for nothing are penalised in the same way (such a change depends on the text by its scale alone, so the mean over
all texts and terms is exact and costs one entry a term). A mention of a group then moves the score no more than a mention of any other, or of none.

Training reads a bounded sample: the ``max_rows`` labelled rows with the smallest hash of their id, of texts of at most ``max_chars``
characters, and of those as many, in the order of the hash, as have ``max_sample_chars`` characters in total. A feature is used if at least ``min_toxic`` toxic texts of the sample have it; others would tell
texts apart by chance and keep the weight 0. Scoring reads every whole text and nothing but the text.

Edge cases: a NULL or empty text has no evidence and gets the base score; labels that are NULL, or whose document is missing,
are not learned from; a document with several labels counts as toxic if one of them says so; repeated rows are scored each;
without any label, or with labels of one kind only, the score is the smoothed share of toxic labels; other
columns, also those named like results, are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tidemark.llm.common import give_back_memory, materialize, new_name, ship

BITS = 18
SCALE = 10.0
PREFIXES = (4, 5, 6)
CACHED_WORDS = 150_000  # words whose evidence a task keeps
WORDS = re.compile(r"[^\W\d_]+")

# Terms that name groups of people, by kind, with a neutral word of the kind's language first.
IDENTITY_TERMS = (
    ("person", "woman", "man", "girl", "boy", "mother", "father", "grandmother", "grandfather"),
    ("people", "women", "men", "girls", "boys", "mothers", "fathers", "immigrants", "refugees", "foreigners"),
    ("person", "christian", "muslim", "jew", "hindu", "buddhist", "sikh", "atheist", "catholic", "protestant"),
    ("people", "christians", "muslims", "jews", "hindus", "buddhists", "sikhs", "atheists", "catholics", "protestants"),
    ("ordinary", "christian", "muslim", "jewish", "hindu", "buddhist", "sikh", "atheist", "catholic"),
    ("ordinary", "black", "white", "asian", "african", "european", "american", "latino", "hispanic", "arab", "indigenous"),
    ("ordinary", "gay", "lesbian", "straight", "bisexual", "transgender", "queer", "heterosexual", "homosexual"),
    ("ordinary", "deaf", "blind", "disabled", "autistic", "paralyzed", "old", "young", "elderly"),
    ("menschen", "frauen", "männer", "christen", "muslime", "juden", "hindus", "buddhisten", "ausländer", "flüchtlinge"),
    ("personnes", "femmes", "hommes", "chrétiens", "musulmans", "juifs", "hindous", "bouddhistes", "étrangers", "réfugiés"),
    ("personas", "mujeres", "hombres", "cristianos", "musulmanes", "judíos", "hindúes", "budistas", "extranjeros", "refugiados"),
)


def words_of(text: str | None) -> set[str]:
    return set(WORDS.findall(text.lower())) if text else set()


def word_features(word: str) -> list[int]:
    names = [f"w:{word}", *(f"p:{word[:k]}" for k in PREFIXES if len(word) > k)]
    return [zlib.crc32(n.encode()) & ((1 << BITS) - 1) for n in names]


def features_of(words: Iterable[str]) -> np.ndarray:
    return np.fromiter(chain.from_iterable(map(word_features, words)), dtype="<i4")


def counterfactuals(words: set[str], terms: tuple[tuple[str, ...], ...] = IDENTITY_TERMS) -> Iterator[tuple[list[str], list[str]]]:
    """Swaps (words that leave, words that come): every term of a kind in the text for each other word of its kind."""
    for kind in terms:
        named = [w for w in kind[1:] if w in words]
        if named:
            for other in kind:
                come = [other] if other not in words else []
                if other not in named:
                    yield named, come


def inserted_mentions(terms: tuple[tuple[str, ...], ...] = IDENTITY_TERMS) -> Iterator[tuple[list[str], list[str]]]:
    """Swaps of an inserted mention: the neutral word, or nothing, for each term of its kind."""
    for neutral, *names in terms:
        for name in names:
            yield [neutral], [name]
            yield [], [name]


class Classifier:
    """logit = bias + SCALE / sqrt(distinct words) * evidence of the distinct words; a word's evidence is the sum over its features."""

    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias = weights, bias
        self.words: dict[str, float] = {}

    def evidence(self, word: str) -> float:
        return sum(self.weights.item(f) for f in word_features(word))

    def scores(self, texts: Iterable[str | None]) -> np.ndarray:
        out, known = [], self.words
        for text in texts:
            words = words_of(text)
            for w in words:
                if w not in known:
                    known[w] = self.evidence(w)
            out.append(sum(map(known.__getitem__, words)) * scale_of(len(words)))
            if len(known) > CACHED_WORDS:
                known.clear()
        return 1 / (1 + np.exp(-np.clip(np.array(out, dtype=float) + self.bias, -40, 40)))


def dot(a: np.ndarray, b: np.ndarray) -> float:
    """Sum of products on one thread: these vectors are short, and a BLAS would start a thread per core."""
    return float((a * b).sum())


def scale_of(words: int) -> float:
    return SCALE / max(words, 1) ** 0.5


CHUNK = 1024  # texts handled at a time while the loss is computed


def fit(features: list[np.ndarray], scales: np.ndarray, toxic: np.ndarray,
        swaps: list[tuple[np.ndarray, np.ndarray, float]], *, mentions: list[tuple[np.ndarray, np.ndarray]] = (),
        l2: float = 1e-4, counterfactual: float = 1.0, min_toxic: int = 2, steps: int = 80) -> Classifier:
    """Limited-memory BFGS on the regularised logistic loss.

    ``features``: hashed features of each text, ``scales``: its scale; ``swaps``: for each counterfactual the
    features that leave, those that come, and the scale of its text; ``mentions``: the same of a mention inserted into every text, at the texts' mean square scale.
    Memory: 8 bytes for each used feature of each text, and arrays of one chunk of texts.
    """
    size, n = 1 << BITS, len(features)
    y = np.asarray(toxic, dtype=float)
    if n == 0 or y.min() == y.max():
        p = (y.sum() + 0.5) / (n + 1)
        return Classifier(np.zeros(size), float(np.log(p / (1 - p))))
    support = np.zeros(size, np.int32)
    for f in (f for f, t in zip(features, y) if t == 1):
        support[np.unique(f)] += 1
    used = np.flatnonzero(support >= min_toxic)
    place = np.full(size, -1, np.int32)
    place[used] = np.arange(len(used), dtype=np.int32)
    scales, d = np.asarray(scales, float), len(used)
    chunks = []
    for at in range(0, n, CHUNK):
        some = features[at:at + CHUNK]
        feature = place[np.concatenate(some)]
        row = np.repeat(np.arange(len(some), dtype=np.int16), [len(f) for f in some])
        chunks.append((slice(at, at + len(some)), row[feature >= 0], feature[feature >= 0]))

    s_mention = float(np.sqrt((scales ** 2).mean()))
    changes = [*swaps, *((a, b, s_mention) for a, b in mentions)]
    c_row = np.repeat(np.arange(len(changes)), [len(a) + len(b) for a, b, _ in changes])
    c_feature = place[np.concatenate([np.concatenate([a, b]) for a, b, _ in changes] or [np.empty(0)]).astype(np.int32)]
    c_sign = np.concatenate([np.r_[-np.ones(len(a)), np.ones(len(b))] * s for a, b, s in changes] or [np.empty(0)])
    c_row, c_feature, c_sign = (x[c_feature >= 0] for x in (c_row, c_feature, c_sign))
    # The mean over the swaps in texts plus the mean over the inserted mentions.
    pull = counterfactual * np.r_[np.full(len(swaps), 1 / max(len(swaps), 1)), np.full(len(mentions), 1 / max(len(mentions), 1))]

    def loss_and_slope(p: np.ndarray) -> tuple[float, np.ndarray]:
        w, g, loss = p[:d], np.zeros(d + 1), 0.0
        for rows, row, feature in chunks:
            t, scale = y[rows], scales[rows]
            z = np.bincount(row, w[feature], len(t)) * scale + p[d]
            loss += np.logaddexp(0, np.where(t == 1, -z, z)).sum() / n
            r = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - t) / n
            g[:d] += np.bincount(feature, (r * scale)[row], d)
            g[d] += r.sum()
        moved = np.bincount(c_row, c_sign * w[c_feature], len(changes))
        loss += l2 / 2 * dot(w, w) + dot(pull, moved * moved) / 2
        g[:d] += l2 * w
        if len(c_row):
            g[:d] += np.bincount(c_feature, c_sign * (pull * moved)[c_row], d)
        return loss, g

    p = np.zeros(d + 1)
    p[d] = np.log(y.mean() / (1 - y.mean()))
    loss, g = loss_and_slope(p)
    past: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        q, shares = g.copy(), []
        for s, t in reversed(past):
            shares.append(dot(s, q) / dot(t, s))
            q -= shares[-1] * t
        q *= dot(*past[-1]) / dot(past[-1][1], past[-1][1]) if past else 1 / max(1.0, np.abs(q).sum())
        for (s, t), share in zip(past, reversed(shares)):
            q += s * (share - dot(t, q) / dot(t, s))
        step = 1.0
        while (new := loss_and_slope(p - step * q))[0] > loss - 1e-4 * step * dot(g, q) and step > 1e-6:
            step /= 2
        s, t = -step * q, new[1] - g
        if dot(s, t) > 1e-16:
            past = [*past[-7:], (s, t)]
        settled = abs(loss - new[0]) < 1e-5 * loss
        p, (loss, g) = p + s, new
        if settled:
            break
    weights = np.zeros(size)
    weights[used] = p[:d]
    return Classifier(weights, float(p[d]))


def training_rows(docs: DataFrame, labels: DataFrame, learn: Column, *, max_rows: int, max_chars: int, max_sample_chars: int,
                  terms: tuple[tuple[str, ...], ...]) -> DataFrame:
    """(features, scale, toxic, leave, come) of the bounded sample; ``learn`` is a condition on ``doc_id``."""
    chosen = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
              .where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & learn)
              .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where(F.length("text") <= max_chars)
    # At most max_rows pairs of numbers are broadcast.
    joined = texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "toxic")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chars, found, scales, leave, come = [], [], [], [], []
            for text in batch.column(1):
                words = words_of(text := text.as_py())
                swaps = list(counterfactuals(words, terms))
                chars.append(len(text))
                found.append(features_of(sorted(words)).tobytes())
                scales.append(scale_of(len(words)))
                leave.append([features_of(a).tobytes() for a, _ in swaps])
                come.append([features_of(b).tobytes() for _, b in swaps])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(chars, pa.int32()), pa.array(found, pa.binary()), pa.array(scales, pa.float64()), batch.column(2),
                 pa.array(leave, pa.list_(pa.binary())), pa.array(come, pa.list_(pa.binary()))],
                names=["doc_id", "chars", "features", "scale", "toxic", "leave", "come"])

    sample = materialize(joined.withColumn("toxic", (F.col("toxic") > 0).cast("int")).mapInArrow(
        features, "doc_id long, chars int, features binary, scale double, toxic int, leave array<binary>, come array<binary>"), "toxicity-sample")
    # One row for each of the sample's at most max_rows ids (repeated ones are few numbers too): a window over them is bounded.
    order = Window.orderBy(F.xxhash64("doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sizes = sample.groupBy("doc_id").agg(F.sum("chars").alias("chars"))
    within = sizes.select("doc_id", F.sum("chars").over(order).alias("so_far")).where(F.col("so_far") <= max_sample_chars).select("doc_id")
    return sample.join(F.broadcast(within), "doc_id").select("features", "scale", "toxic", "leave", "come")


def _fit_sample(rows: pa.Table, mentions: list[tuple[np.ndarray, np.ndarray]], options: dict) -> Classifier:
    def arrays(name: str) -> list[np.ndarray]:  # views of the column's buffers
        return [np.frombuffer(value.as_buffer(), "<i4") for chunk in rows.column(name).chunks for value in chunk]

    features, toxic, scales = arrays("features"), rows.column("toxic").to_pylist(), rows.column("scale").to_pylist()
    # The order is fixed so that the same rows give the same model.
    order = sorted(range(len(features)), key=lambda i: (bytes(features[i]), toxic[i]))
    swaps = [(*(np.frombuffer(b, "<i4") for b in pair), scales[i]) for i in order
             for pair in zip(rows.column("leave")[i].as_py(), rows.column("come")[i].as_py())]
    return fit([features[i] for i in order], np.array([scales[i] for i in order]), np.array([toxic[i] for i in order]), swaps, mentions=mentions, **options)


def train(docs: DataFrame, labels: DataFrame, learn: Column, *, max_rows: int = 12_000, max_chars: int = 100_000, max_sample_chars: int = 64_000_000,
          terms: tuple[tuple[str, ...], ...] = IDENTITY_TERMS, **options) -> Classifier:
    """The model of the bounded sample. One task fits it, so that the driver holds the weights only."""
    mentions = [(features_of(a), features_of(b)) for a, b in inserted_mentions(terms)]

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not (some := list(batches)):
            return
        model = _fit_sample(pa.Table.from_batches(some), mentions, options)
        del some
        give_back_memory()  # the worker is used again, next to tasks that need the room
        at = np.flatnonzero(model.weights)
        yield pa.RecordBatch.from_arrays([pa.array([at.astype("<i4").tobytes()]), pa.array([model.weights[at].tobytes()]), pa.array([model.bias])],
                                         names=["at", "weight", "bias"])

    rows = training_rows(docs, labels, learn, max_rows=max_rows, max_chars=max_chars, max_sample_chars=max_sample_chars, terms=terms)
    found = rows.coalesce(1).mapInArrow(fitted, "at binary, weight binary, bias double").collect()  # one row, of at most 2 ** BITS weights
    if not found:
        return fit([], np.empty(0), np.empty(0), [])
    weights = np.zeros(1 << BITS)
    weights[np.frombuffer(found[0]["at"], "<i4")] = np.frombuffer(found[0]["weight"])
    return Classifier(weights, found[0]["bias"])


def score(docs: DataFrame, model: Classifier, *, column: str = "score") -> DataFrame:
    """``docs`` with the score of each text added as its last column (which must be new)."""
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classifier = Classifier(*shared.value)
        for batch in batches:
            scores = classifier.scores(t.as_py() for t in batch.column(text_at))  # one text at a time
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], names=[*batch.schema.names, column])
        del classifier
        give_back_memory()

    text_at = docs.columns.index("text")
    return docs.mapInArrow(add, StructType([*docs.schema.fields, StructField(column, DoubleType())]))


def classify(docs: DataFrame, labels: DataFrame, learn: Column, **bounds) -> DataFrame:
    """(doc_id, score, predicted) of every row of ``docs``, with a model learned from ``labels``."""
    ship(docs.sparkSession)
    model = train(docs, labels, learn, **bounds)
    scored = score(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), model)
    return scored.select("doc_id", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def reject_toxic(docs: DataFrame, labels: DataFrame, learn: Column, **bounds) -> DataFrame:
    """The rows of ``docs`` whose text is not predicted toxic, with the same columns."""
    ship(docs.sparkSession)
    model = train(docs, labels, learn, **bounds)
    column = new_name("_toxicity", docs)
    return score(docs, model, column=column).where(F.col(column) < 0.5).select(*docs.columns)
