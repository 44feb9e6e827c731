"""Operator 9: language identification with interpolated Kneser-Ney character models.

One model a language over the characters of normalised text (lower case; every run of non-letters is one space): order
``ORDER`` n-grams, interpolated Kneser-Ney smoothing -- raw counts at the highest order, the number of distinct
characters seen before at the lower ones, one absolute discount an order estimated from the counts of counts. The
n-grams of all languages are kept in sorted arrays of 64-bit hashes, one pair of arrays an order: probabilities of
n-grams and back-off weights of contexts, with a column a language. A text gets the language with the lowest cross-entropy per character.

Training reads a bounded sample of the labelled rows: the ``max_docs`` rows of each language with the smallest hash
of id and text among those of at most ``max_chars`` characters, so the model has a size bound (languages x max_docs x max_chars n-grams an order) whatever the corpus.
Prediction reads every whole text.

Rejection is calibrated: a text is ``rejected`` if its cross-entropy lies above the ``reject_quantile`` of the
cross-entropies that the language's own calibration texts (a fifth of the sample, kept out of the counts) reach; the
spread of all languages' texts counts as ``PRIOR`` = 20 further ones, so that a language with few texts has a bound as well. The score
is the posterior of the language given the per-character margins, with a temperature fitted on the same texts.

Edge cases: a NULL text, or one without a letter, is ``und`` with score 0 and rejected; rows with NULL lang
are not learned from; repeated rows count in training once each; with no labelled row at all every text is ``und``;
ties go to the first language in alphabetical order; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ship

ORDER = 5
UNDETERMINED = "und"
_MUL = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


@cache
def letters() -> np.ndarray:
    """Is this code point a letter?"""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


def normalise(text: str | None) -> np.ndarray:
    """Code points of the lower-cased text with each run of non-letters as one space, led and ended by a space."""
    code = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
    code = np.where(letters()[code], code, 32).astype(np.uint64)
    code = np.concatenate(([32], code, [32])).astype(np.uint64)
    return code[np.concatenate(([True], (code[1:] != 32) | (code[:-1] != 32)))]


@dataclass
class Model:
    languages: list[str]
    gram: list[np.ndarray]        # order 1..ORDER: sorted hashes
    alpha: list[np.ndarray]       # discounted probability, a column a language
    context: list[np.ndarray]     # order 1..ORDER: sorted hashes of the n-1 characters before
    back: list[np.ndarray]        # weight of the next lower order
    floor: np.ndarray             # probability of a character never seen
    reject: np.ndarray            # cross-entropy above which a text is rejected
    temperature: float

    def log_probabilities(self, code: np.ndarray) -> np.ndarray:
        """log2 p(character | the ORDER-1 before it) at each place, a column a language."""
        padded = np.concatenate((np.full(ORDER, 32, np.uint64), code))
        # Equal n-grams have equal probabilities: work once for each distinct one.
        _, first, inverse = np.unique(_hash_at(padded, np.arange(ORDER + 1, len(padded)), ORDER), return_index=True, return_inverse=True)
        place = first + 1
        p = np.tile(self.floor, (len(place), 1))
        for n in range(1, ORDER + 1):
            g, c = _hash_at(padded, place + ORDER, n), _hash_at(padded, place + ORDER - 1, n - 1)
            back, seen = _find(self.context[n - 1], c), _find(self.gram[n - 1], g)
            weight = np.where((back >= 0)[:, None], self.back[n - 1][back], 1.0)
            weight[weight == 0] = 1.0  # a context this language never had
            p *= weight
            p += np.where((seen >= 0)[:, None], self.alpha[n - 1][seen], 0.0)
        return np.log2(p)[inverse]

    def cross_entropies(self, texts: list[str | None]) -> np.ndarray:
        """Bits per character, a row a text and a column a language; NaN where a text has no letter."""
        codes = [normalise(t) for t in texts]
        out = np.full((len(texts), len(self.languages)), np.nan)
        used = [i for i, c in enumerate(codes) if len(c) > 2 and len(self.languages)]
        if used:
            lengths = np.array([len(codes[i]) - 1 for i in used])
            # One padded array a batch: each text begins after ORDER spaces, as it does alone.
            pad = np.full(ORDER, 32, np.uint64)
            joined = np.concatenate([np.concatenate((pad, codes[i])) for i in used])
            starts = np.cumsum([0, *(lengths + 1 + ORDER)])[:-1]
            logs = self.log_probabilities(joined)
            keep = np.concatenate([np.arange(s + ORDER, s + ORDER + n) for s, n in zip(starts, lengths)])
            ends = np.cumsum([0, *lengths])[:-1]
            out[used] = -np.add.reduceat(logs[keep], ends, axis=0) / lengths[:, None]
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score and rejection of each text."""
        h = self.cross_entropies(texts)
        known = ~np.isnan(h).any(axis=1) if len(self.languages) else np.zeros(len(texts), bool)
        best = np.zeros(len(texts), int)
        if known.any():
            best[known] = h[known].argmin(axis=1)
        lang = [self.languages[b] if k else UNDETERMINED for b, k in zip(best, known)]
        score, rejected = np.zeros(len(texts)), np.ones(len(texts), bool)
        if known.any():
            lowest = h[known].min(axis=1)
            score[known] = 1 / np.exp((lowest[:, None] - h[known]) / self.temperature).sum(axis=1)
            rejected[known] = lowest > self.reject[best[known]]
        return lang, score, rejected


def _hash_at(padded: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """Hash of the ``n`` characters that end at each given place."""
    out = np.zeros(len(at), np.uint64)
    for k in range(n - 1, -1, -1):
        out = out * _MUL + padded[at - k] if k < n - 1 else padded[at - k].copy()
    if n:
        out = (out ^ (out >> np.uint64(29))) * _MIX
        out = out ^ (out >> np.uint64(32))
    return out


def _find(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Place of each key in a sorted array, -1 where it is missing."""
    if not len(table):
        return np.full(len(keys), -1)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return np.where(table[at] == keys, at, -1)


def _counts(texts: list[str]) -> list[dict[str, np.ndarray]]:
    """Per order: distinct n-grams with their contexts, shorter n-grams and (continuation) counts."""
    codes = [c for c in map(normalise, texts) if len(c) > 2]
    pad = np.full(ORDER, 32, np.uint64)
    joined = np.concatenate([np.concatenate((pad, c)) for c in codes]) if codes else np.empty(0, np.uint64)
    at = np.concatenate([np.arange(ORDER + 1, ORDER + len(c)) for c in codes]) if codes else np.empty(0, int)
    starts = np.cumsum([0, *(len(c) + ORDER for c in codes)])[:-1]
    at = at + np.repeat(starts, [len(c) - 1 for c in codes]) if codes else at
    out: list[dict[str, np.ndarray]] = []
    for n in range(ORDER, 0, -1):
        g, first, count = np.unique(_hash_at(joined, at, n), return_index=True, return_counts=True)
        if n < ORDER:  # the number of distinct (n+1)-grams that end with this n-gram
            ends = _find(g, out[-1]["shorter"])
            count = np.bincount(ends, minlength=len(g))
        place = at[first]
        out.append({"gram": g, "count": count.astype(float), "context": _hash_at(joined, place - 1, n - 1),
                    "shorter": _hash_at(joined, place, n - 1)})
    return out[::-1]


def fit(samples: dict[str, list[str]], *, reject_quantile: float = 0.99) -> Model:
    """A model of each language from its sample texts."""
    languages = sorted(samples)
    held = {k: [t for i, t in enumerate(v) if i % 5 == 4] for k, v in samples.items()}
    counts = {k: _counts([t for i, t in enumerate(v) if i % 5 != 4]) for k, v in samples.items()}
    m = Model(languages, [], [], [], [], np.zeros(len(languages)), np.full(len(languages), np.inf), 0.05)
    for n in range(1, ORDER + 1):
        gram = np.unique(np.concatenate([counts[k][n - 1]["gram"] for k in languages] or [np.empty(0, np.uint64)]))
        context = np.unique(np.concatenate([counts[k][n - 1]["context"] for k in languages] or [np.empty(0, np.uint64)]))
        alpha, back = np.zeros((len(gram), len(languages))), np.zeros((len(context), len(languages)))
        for j, k in enumerate(languages):
            t = counts[k][n - 1]
            if not len(t["gram"]):
                continue
            once, twice = (t["count"] == 1).sum(), (t["count"] == 2).sum()
            discount = min(max(once / (once + 2 * twice), 0.1), 0.9) if once else 0.5
            c = np.searchsorted(context, t["context"])
            total = np.bincount(c, t["count"], len(context))
            alpha[np.searchsorted(gram, t["gram"]), j] = (t["count"] - discount) / total[c]
            kinds = np.bincount(c, minlength=len(context))
            back[:, j] = np.divide(discount * kinds, total, out=np.zeros(len(context)), where=total > 0)
        m.gram.append(gram)
        m.alpha.append(alpha)
        m.context.append(context)
        m.back.append(back)
    m.floor[:] = 1 / 0x110000  # below the lowest order: any code point
    _calibrate(m, held, reject_quantile)
    return m


PRIOR = 20.0


def rejection_bounds(values: list[np.ndarray], quantile: float) -> list[float]:
    """For each language the quantile of its held-out cross-entropies, with those of all languages as ``PRIOR`` further texts.

    The others' deviations from their own medians are added to the language's median (the median of all if it has no text), with a total
    weight of ``PRIOR`` texts: the same rule at every size, and a language with few texts gets the spread of all of them. Without
    any held-out text there is nothing to calibrate from, and no bound.
    """
    every = np.concatenate([np.empty(0), *values])
    if not len(every):
        return [np.inf] * len(values)
    centres = [np.median(v) if len(v) else np.median(every) for v in values]
    spread = np.concatenate([v - c for v, c in zip(values, centres)])
    out = []
    for v, c in zip(values, centres):
        x, weight = np.concatenate([v, c + spread]), np.concatenate([np.ones(len(v)), np.full(len(spread), PRIOR / len(spread))])
        order = np.argsort(x, kind="stable")
        reached = np.cumsum(weight[order]) >= quantile * weight.sum() * (1 - 1e-12)
        out.append(float(x[order][np.argmax(reached)]))
    return out


def _calibrate(m: Model, held: dict[str, list[str]], reject_quantile: float) -> None:
    texts = [(j, t) for j, k in enumerate(m.languages) for t in held[k]]
    if not texts:
        return
    h, truth = m.cross_entropies([t for _, t in texts]), np.array([j for j, _ in texts])
    known = ~np.isnan(h).any(axis=1)
    h, truth = h[known], truth[known]
    m.reject[:] = rejection_bounds([h[truth == j, j] for j in range(len(m.languages))], reject_quantile)
    if len(h):
        def loss(t: float) -> float:
            z = -h / t
            return float((np.logaddexp.reduce(z, axis=1) - z[np.arange(len(h)), truth]).mean())
        m.temperature = min((0.02, 0.05, 0.1, 0.2, 0.4, 0.8), key=loss)


def training_sample(docs: DataFrame, learn: Column, *, max_docs: int, max_chars: int) -> dict[str, list[str]]:
    """At most ``max_docs`` whole texts of each language: those with the smallest hash of id and text."""
    rows = docs.where(learn & F.col("lang").isNotNull() & F.col("text").isNotNull() & (F.length("text") <= max_chars))
    rows = rows.select("lang", F.xxhash64("doc_id", "text").alias("_h"), "text")
    # The bound of each language comes from its count; a hash is uniform, so a share of the hash range is a share of the rows.
    n = {r["lang"]: r["n"] for r in rows.select("lang", "_h").distinct().groupBy("lang").agg(F.count("*").alias("n")).collect()}
    below = F.lit(False)
    for lang, count in n.items():
        share = min(1.0, max_docs / count)
        edge = int(-(2**63) + share * (2**64)) - 1
        below |= (F.col("lang") == lang) & (F.col("_h") <= F.lit(min(edge, 2**63 - 1)))
    out: dict[str, list[tuple[int, str]]] = {}
    # Repeated rows are one before they are fetched.
    for r in rows.where(below).dropDuplicates(["lang", "_h"]).toLocalIterator():
        out.setdefault(r["lang"], []).append((r["_h"], r["text"]))
    return {k: [t for _, t in sorted(v)[:max_docs]] for k, v in out.items()}


def identify(docs: DataFrame, learn: Column, *, max_docs: int = 1000, max_chars: int = 20_000,
             reject_quantile: float = 0.99) -> DataFrame:
    """Rows (doc_id, lang_pred, score, rejected) for every row of ``docs``; ``learn`` says which rows may be learned from."""
    spark = docs.sparkSession
    ship(spark)
    model = spark.sparkContext.broadcast(
        fit(training_sample(docs, learn, max_docs=max_docs, max_chars=max_chars), reject_quantile=reject_quantile))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, at = batch.column(1).to_pylist(), 0
            while at < len(texts):  # about a million characters at a time
                end, size = at, 0
                while end < len(texts) and (end == at or size < 1_000_000):
                    size += len(texts[end] or "")
                    end += 1
                lang, score, rejected = model.value.predict(texts[at:end])
                yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0).slice(at, end - at), "lang_pred": pa.array(lang, pa.string()),
                                                  "score": pa.array(score, pa.float64()), "rejected": pa.array(rejected, pa.bool_())})
                at = end

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        predict, "doc_id long, lang_pred string, score double, rejected boolean")
