"""Fingerprints: the hashing rule against plain Python, bias, the edited text, odd rows."""

import hashlib

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import fingerprints as P

from helpers import ODD_IDS, ODD_TEXTS, documents, letters, odd_documents


def shingles(text):
    w = text.lower().split()
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def test_edited_text_and_unbiased_likeness(spark):
    texts = [letters(i, 30 + i * 5) for i in range(120)]
    for i in range(0, 120, 3):  # the next by descending id is a near copy
        texts[i] = texts[i + 1].replace(" ", " x ", 1)
    rows = {r["doc_id"]: r for r in P.edited_fingerprints(documents(spark, texts).repartition(6)).collect()}
    assert len(rows) == 120
    errors, next_errors = [], []
    for i, text in enumerate(texts):
        following = texts[i - 1]  # index -1 after the last
        edited = text[:len(text) - len(text) // 2] + following[:len(text) // 2]
        r = rows[i]
        assert r["n_chars"] == len(text) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert len(r["fingerprint"]) == len(r["edited_fingerprint"]) == P.BINS * P.BITS // 4
        errors.append(r["near_edited"] - jaccard(text, edited))
        next_errors.append(r["near_next"] - jaccard(text, following))
    assert abs(np.mean(errors)) < 0.02 and np.abs(errors).max() < 0.25
    assert abs(np.mean(next_errors)) < 0.02 and np.abs(next_errors).max() < 0.25


def test_densified_values_follow_the_rule(spark):
    """Each empty bin takes the value of the first full bin of its order, also where the probes all miss."""
    state, drawn = 1, []
    for _ in range(2 * P.BINS):
        state = (state * 6364136223846793005 + 1442695040888963407) % 2**64
        drawn.append(state >> 33)
    orders = [[(a * k + b) % P._PRIME for k in range(P._PRIME)] for a, b in
              zip((x % (P._PRIME - 1) + 1 for x in drawn[::2]), (x % P._PRIME for x in drawn[1::2]))]
    for full in ([0], [5, 77], list(range(0, P.BINS, 11)), list(range(0, P.BINS, 2)), list(range(P.BINS))):
        df = spark.createDataFrame([(full, [b * 7 % 256 for b in full])], "f array<int>, v array<int>")
        got = df.select(P.densified(F.col("f"), F.col("v")).alias("d")).first()["d"]
        assert got == [(b if b in full else next(t for t in orders[b] if t in full)) * 7 % 256 for b in range(P.BINS)]


def test_equal_texts_and_odd_rows(spark):
    odd = odd_documents(spark)
    rows = P.edited_fingerprints(odd).collect()
    assert len(rows) == len(ODD_TEXTS)  # the repeated row is one place in the order, and returned twice
    order = sorted(set(zip(ODD_IDS, ODD_TEXTS)), key=lambda x: (x[0] is None, -(x[0] or 0)))  # a NULL id comes last
    texts = [t or "" for _, t in order]
    by_id = {r["doc_id"]: r for r in rows}
    for k, (i, _) in enumerate(order):
        text, following = texts[k], texts[(k + 1) % len(texts)]
        edited = text[:len(text) - len(text) // 2] + following[:len(text) // 2]
        assert by_id[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
    assert by_id[0]["fingerprint"] == by_id[1]["fingerprint"] == by_id[2]["fingerprint"] == ""
    assert by_id[2]["near_next"] == 1.0
    same = {r["doc_id"]: r["fingerprint"] for r in P.fingerprints(documents(spark, ["a b c d e f", "A b  c\nd e f ", "a b c", "a b c d"])).collect()}
    assert same[0] == same[1] and len({same[0], same[2], same[3]}) == 3
    assert P.edited_fingerprints(documents(spark, [])).count() == 0
    one = P.edited_fingerprints(documents(spark, ["only one text here"])).first()
    assert one["near_next"] == 1.0


def test_no_python_in_the_plan(spark):
    plan = P.edited_fingerprints(documents(spark, ["a", "b"]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
