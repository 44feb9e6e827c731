"""Language identification: Kneser-Ney probabilities, held-out accuracy, rejection, odd rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import langid as L
from tidemark.llm.common import fold

from helpers import DOCS, documents, odd_documents

SYLLABLES = {"xa": ["ka", "to", "mi", "ru", "sen"], "xb": ["sch", "ein", "ver", "ung", "äu"], "xc": ["que", "oi", "eau", "é", "tion"]}


def text(lang, seed, words=30):
    r = random.Random(f"{lang}{seed}")
    return " ".join("".join(r.choice(SYLLABLES[lang]) for _ in range(r.randint(1, 4))) for _ in range(words))


def samples(n):
    return {k: [text(k, i) for i in range(n)] for k in SYLLABLES}


def test_probabilities_sum_to_one():
    """Over all code points: those ever seen by their estimates, the others by an equal share of the floor."""
    model = L.fit(samples(40))
    alphabet = sorted({int(c) for k in SYLLABLES for t in samples(40)[k] for c in L.normalise(t)})
    for context in ("kato", "ver", "qx"):
        p = []
        for c in alphabet:
            code = np.concatenate((L.normalise(context)[:-1], [c])).astype(np.uint64)
            p.append(2.0 ** model.log_probabilities(code)[-1])
        unseen = 2.0 ** model.log_probabilities(np.concatenate((L.normalise(context)[:-1], [0x10FFFF])).astype(np.uint64))[-1]
        assert np.sum(p, axis=0) + unseen * (0x110000 - len(alphabet)) == pytest.approx(1.0, abs=1e-6)


def test_batches_do_not_matter():
    model = L.fit(samples(30))
    texts = [text("xa", 91, 3), None, text("xb", 92, 50), "123 !", text("xc", 93, 1)]
    together = model.cross_entropies(texts)
    alone = np.concatenate([model.cross_entropies([t]) for t in texts])
    assert np.allclose(together, alone, equal_nan=True)


def test_held_out_accuracy_and_rejection(spark):
    rows = [(i, text(k, i, 20), k, "s", 0) for i in range(600) for k in [sorted(SYLLABLES)[i % 3]]]
    rows += [(1000, "zzzz yyy xxqq wwzz zyzyz", None, "s", 0), (1001, "12 34 !", "xa", "s", 0), (1002, None, "xb", "s", 0)]
    docs = spark.createDataFrame(rows, DOCS)
    got = {r["doc_id"]: r for r in L.identify(docs, fold("doc_id", 3) != 1).collect()}
    assert len(got) == len(rows)
    held = [(i, lang) for i, _, lang, _, _ in rows if i < 1000 and i in {r["doc_id"] for r in docs.where(fold("doc_id", 3) == 1).collect()}]
    assert np.mean([got[i]["lang_pred"] == lang for i, lang in held]) > 0.99
    assert np.mean([got[i]["rejected"] for i, _ in held]) < 0.1
    assert got[1000]["rejected"] and got[1000]["lang_pred"] in SYLLABLES
    assert all(got[i]["lang_pred"] == "und" and got[i]["score"] == 0 and got[i]["rejected"] for i in (1001, 1002))
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_odd_rows_and_nothing_to_learn(spark):
    odd = odd_documents(spark)
    rows = L.identify(odd, F.lit(True)).collect()
    assert len(rows) == odd.count()
    assert all((r["lang_pred"] == "und") == (r["doc_id"] in (0, 1, 2, None)) for r in rows)
    assert {r["lang_pred"] for r in L.identify(odd, F.lit(False)).collect()} == {"und"}
    assert L.identify(documents(spark, []), F.lit(True)).count() == 0


def test_training_sample_is_bounded(spark):
    docs = documents(spark, [text("xa", i) for i in range(200)] + ["x" * 500])
    sample = L.training_sample(docs, F.lit(True), max_docs=20, max_chars=400)
    assert 5 <= len(sample["en"]) <= 20 and "x" * 500 not in sample["en"]


def test_rejection_bounds_at_every_size():
    r = np.random.default_rng(0)
    large, other = r.normal(2.0, 0.1, 5000), r.normal(3.0, 0.1, 4000)
    few = np.array([5.0, 5.1])
    a, b, c, d = L.rejection_bounds([large, other, few, np.empty(0)], 0.99)
    assert abs(a - np.quantile(large, 0.99)) < 0.01 and abs(b - np.quantile(other, 0.99)) < 0.01
    assert 5.1 < c < 5.5 and np.isfinite(d)  # the spread of the others
    assert L.rejection_bounds([np.empty(0)] * 2, 0.99) == [np.inf, np.inf]
    sizes = [L.rejection_bounds([large[:n], other], 0.99)[0] for n in (1, 18, 19, 20, 21, 100)]
    assert np.abs(np.diff(sizes)).max() < 0.3
