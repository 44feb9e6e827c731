"""Toxicity: held-out accuracy, the counterfactual penalty, and edge cases."""

import random
from itertools import chain

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import toxicity as T
from tidemark.llm.common import fold

from helpers import SMALL, documents, letters, odd_documents

SLURS = ["vermalk", "vermalkisch", "vermalken", "grobbo", "grobbolo"]


def features(words):
    return np.fromiter(chain.from_iterable(map(T.word_features, words)), dtype="<i4")


def corpus(n, seed=0):
    r = random.Random(seed)
    texts, toxic = [], []
    for i in range(n):
        words = letters(seed * 100_000 + i, r.randint(20, 120)).split()
        bad = r.random() < 0.3
        for _ in range(r.randint(1, 3) if bad else 0):
            words.insert(r.randrange(len(words)), r.choice(SLURS))
        texts.append(" ".join(words))
        toxic.append(int(bad))
    return texts, toxic


def fitted(texts, toxic, **options):
    words = [T.words_of(t) for t in texts]
    swaps = [(features(a), features(b), T.scale_of(len(w))) for w in words for a, b in T.counterfactuals(w)]
    return T.fit([features(w) for w in words], np.array([T.scale_of(len(w)) for w in words]), np.array(toxic), swaps, **options)


def test_held_out_accuracy_and_inflected_forms():
    model = fitted(*corpus(400))
    texts, toxic = corpus(200, seed=7)
    predicted = model.scores(texts) >= 0.5
    assert (predicted == np.array(toxic)).mean() > 0.97
    clean = letters(5, 60)
    assert model.scores([clean + " vermalkung"])[0] > model.scores([clean])[0]  # an unseen form of a learned stem


def test_counterfactual_penalty_frees_neutral_mentions():
    """A group that is named in toxic texts only would be taken for toxic itself; the penalty takes that away."""
    texts, toxic = corpus(300)
    texts = [t + " muslims" if bad else t for t, bad in zip(texts, toxic)]
    plain, regular = fitted(texts, toxic, counterfactual=0.0), fitted(texts, toxic, counterfactual=100.0)
    neutral = [letters(10_000 + i, 40) + " muslims" for i in range(50)]
    without = [letters(10_000 + i, 40) for i in range(50)]
    shift = lambda m: np.abs(m.scores(neutral) - m.scores(without)).mean()
    assert shift(regular) < 0.2 * shift(plain)
    assert (regular.scores(neutral) >= 0.5).sum() <= (plain.scores(neutral) >= 0.5).sum()
    assert (regular.scores([letters(5, 40) + " vermalk grobbo"]) >= 0.5).all()


def mentions():
    return [(features(a), features(b)) for a, b in T.inserted_mentions()]


def test_inserted_mentions_act_where_no_text_names_a_group():
    """The stem of a slur is also the beginning of a group's name: without the penalty a neutral mention counts as toxic."""
    texts, toxic = corpus(300)
    texts = [t.replace("vermalk", "musli") for t in texts]
    assert not any({"muslim", "muslims", "muslime"} & T.words_of(t) for t in texts)
    plain, regular = fitted(texts, toxic, counterfactual=0.0), fitted(texts, toxic, mentions=mentions(), counterfactual=10.0)
    neutral, without = ([letters(10_000 + i, 40) + m for i in range(50)] for m in (" muslims", ""))
    shift = lambda m: np.abs(m.scores(neutral) - m.scores(without)).mean()
    assert shift(regular) < 0.3 * shift(plain)
    assert (regular.scores(neutral) >= 0.5).sum() < (plain.scores(neutral) >= 0.5).sum()
    assert (fitted(texts, toxic, mentions=mentions()).scores(texts) >= 0.5).tolist() == [bool(t) for t in toxic]


def plain_fit(texts, toxic, *, counterfactual, l2=1e-4, min_toxic=2, steps=6000, rate=0.05):
    """Full-gradient descent with dense vectors on the same loss, term by term."""
    words = [sorted(T.words_of(t)) for t in texts]
    support = {}
    for w, t in zip(words, toxic):
        for f in {f for x in w for f in T.word_features(x)} if t else ():
            support[f] = support.get(f, 0) + 1
    place = {f: k for k, f in enumerate(sorted(f for f, n in support.items() if n >= min_toxic))}

    def vector(ws):
        v = np.zeros(len(place))
        for x in ws:
            for f in T.word_features(x):
                if f in place:
                    v[place[f]] += 1
        return v

    scale = np.array([T.scale_of(len(w)) for w in words])
    x, y = np.stack([vector(w) * s for w, s in zip(words, scale)]), np.array(toxic, float)
    # Every mention in every text, as the definition says.
    moves = np.stack([(vector(b) - vector(a)) * s for a, b in T.inserted_mentions() for s in scale])
    w, bias = np.zeros(len(place)), 0.0
    for _ in range(steps):
        r = 1 / (1 + np.exp(-(x @ w + bias))) - y
        w -= rate * (x.T @ r / len(y) + l2 * w + counterfactual * moves.T @ (moves @ w) / len(moves))
        bias -= rate * r.mean()
    return lambda text: 1 / (1 + np.exp(-(vector(T.words_of(text)) @ w * T.scale_of(len(T.words_of(text))) + bias)))


def test_fit_is_the_plain_one_on_a_small_table():
    texts, toxic = corpus(40, seed=2)
    texts = [t.replace("vermalk", "musli") for t in texts]
    options = {"counterfactual": 3.0, "l2": 0.05}
    model, plain = fitted(texts, toxic, mentions=mentions(), steps=300, **options), plain_fit(texts, toxic, **options)
    for text in [*texts, "musli", "muslims", ""]:
        assert abs(model.scores([text])[0] - plain(text)) < 0.02


def test_query_trains_with_mentions_and_clears_neutral_ones(spark):
    docs, labels = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    on, off = (T.train(docs, labels, fold("doc_id", 5) != 0, counterfactual=c) for c in (1.0, 0.0))
    texts = [r["text"] for r in docs.where("text IS NOT NULL").orderBy("doc_id").limit(60).collect()]
    terms = [w for kind in T.IDENTITY_TERMS for w in kind[1:]]
    named = [f"{t} {terms[k % len(terms)]}" for k, t in enumerate(texts)]
    shift = [np.abs(m.scores(named) - m.scores(texts)).max() for m in (on, off)]
    assert shift[0] <= shift[1] + 1e-6 and ((on.scores(named) >= 0.5) <= (on.scores(texts) >= 0.5)).all()
    assert len(list(T.inserted_mentions())) > 150


def test_sample_is_bounded_in_characters(spark):
    texts, toxic = corpus(200, seed=9)
    docs, labels = documents(spark, texts), spark.createDataFrame([(i, t) for i, t in enumerate(toxic)], "doc_id long, toxic int")
    bounds = {"max_rows": 150, "max_chars": 400, "terms": T.IDENTITY_TERMS}
    few = T.training_rows(docs, labels, F.lit(True), max_sample_chars=5000, **bounds).collect()
    more = T.training_rows(docs, labels, F.lit(True), max_sample_chars=10 ** 6, **bounds).collect()
    sizes = {np.sort(features(sorted(T.words_of(t)))).tobytes(): len(t) for t in texts}
    chars = [sum(sizes[np.sort(np.frombuffer(r["features"], "<i4")).tobytes()] for r in rows) for rows in (few, more)]
    assert 5000 - 400 < chars[0] <= 5000 < chars[1] and len(few) < len(more) <= 150


def test_support_is_a_parameter():
    texts, toxic = corpus(60, seed=4)
    texts = [t + (" zzyzx" if k == toxic.index(1) else "") for k, t in enumerate(texts)]
    assert fitted(texts, toxic).evidence("zzyzx") == 0 < fitted(texts, toxic, min_toxic=1).evidence("zzyzx")


def test_counterfactuals_swap_each_term_of_a_kind():
    swaps = list(T.counterfactuals({"women", "house"}))
    kind = next(k for k in T.IDENTITY_TERMS if "women" in k)
    assert [s for s in swaps] == [(["women"], [w]) for w in kind if w != "women"]
    assert list(T.counterfactuals({"people", "house"})) == []  # the neutral word alone names nobody


def test_one_kind_of_label_or_none():
    assert T.fit([], np.empty(0), np.empty(0), []).scores(["a", None]).tolist() == [0.5, 0.5]
    model = T.fit([features(["a"])] * 3, np.ones(3), np.zeros(3), [])
    assert model.scores(["vermalk", ""]).max() < 0.5


def test_query_and_filter_with_odd_rows(spark):
    texts, toxic = corpus(300, seed=3)
    docs = documents(spark, [*texts, None, ""], [*range(300), 300, None])
    labels = spark.createDataFrame([*((i, 1, t) for i, t in enumerate(toxic)), (0, 1, None), (None, 1, 1), (999, 1, 1), (5, 0, toxic[5])],
                                   "doc_id long, quality int, toxic int")
    learn = fold("doc_id", 5) != 0
    rows = {r["doc_id"]: r for r in T.classify(docs, labels, learn).collect()}
    assert len(rows) == 302 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows.values())
    assert rows[300]["score"] == rows[None]["score"]
    held = [r["doc_id"] for r in docs.where(~learn & (F.col("doc_id") < 300)).collect()]
    assert np.mean([rows[i]["predicted"] == toxic[i] for i in held]) > 0.9
    kept = T.reject_toxic(docs, labels, learn)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.where("doc_id IS NOT NULL").collect()) == sorted(i for i, r in rows.items() if i is not None and not r["predicted"])
    odd = odd_documents(spark)
    assert T.reject_toxic(odd, labels, learn).schema == odd.schema
    assert T.classify(documents(spark, []), labels.limit(0), learn).count() == 0
    assert T.classify(odd, labels.limit(0), learn).count() == odd.count()
