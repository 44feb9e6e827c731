"""Context-tree weighting against a naive tree, and the base score against plain counting."""

import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import ctw

from helpers import documents, letters, odd_documents


def decided(byte):
    return [((1 << j) | (byte >> (8 - j)), (byte >> (7 - j)) & 1) for j in range(8)]


def sequence(text):
    return b" ".join(ctw.words_of(text or "")) + b"\n"


def naive(train, texts):
    node = defaultdict(lambda: [0, 0])
    for t in train:
        s = b"\n" * ctw.DEPTH + sequence(t)
        for k in range(ctw.DEPTH, len(s)):
            for n, bit in decided(s[k]):
                for d in range(ctw.DEPTH + 1):
                    node[s[k - d:k], n][bit] += 1
    children = defaultdict(list)
    for c, n in node:
        if c:
            children[c[1:], n].append((c, n))
    lg = math.lgamma
    weighted, weight = {}, {}
    for d in range(ctw.DEPTH, -1, -1):
        for key in [k for k in node if len(k[0]) == d]:
            a, b = node[key]
            own = lg(a + 0.5) + lg(b + 0.5) - 2 * lg(0.5) - lg(a + b + 1)
            if d < ctw.DEPTH:
                below = sum(weighted[k] for k in children[key])
                weighted[key] = math.log(0.5) + np.logaddexp(own, below)
                weight[key] = math.exp(math.log(0.5) + own - weighted[key])
            else:
                weighted[key], weight[key] = own, 1.0
    out = []
    for t in texts:
        s, total = b"\n" * ctw.DEPTH + sequence(t), 0.0
        for k in range(ctw.DEPTH, len(s)):
            for n, bit in decided(s[k]):
                p = None
                for d in range(ctw.DEPTH, -1, -1):
                    if (key := (s[k - d:k], n)) in node:
                        own = (node[key][bit] + 0.5) / (sum(node[key]) + 1)
                        p = own if p is None else weight[key] * own + (1 - weight[key]) * p
                total += math.log10(0.5 if p is None else p)
        out.append(total)
    return out


def base_of(train, texts):
    count = Counter(w for t in train for w in [*ctw.words_of(t or ""), b"\n"])
    n, v = sum(count.values()), len(count)
    tokens = [[*ctw.words_of(t or ""), b"\n"] for t in texts]
    return [(len(w), sum(count[x] > 0 for x in w), n, sum(math.log10((count[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w)) for w in tokens]


def check(docs, learn, chunk_bytes=ctw.CHUNK_BYTES):
    rows = docs.select("doc_id", "text", F.coalesce(learn, F.lit(False)).alias("l")).collect()
    train, texts = [r["text"] for r in rows if r["l"]], [r["text"] for r in rows]
    want = sorted(zip([str(r["doc_id"]) for r in rows], base_of(train, texts), naive(train, texts)))
    got = sorted((str(r["doc_id"]), (r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]), r["score"])
                 for r in ctw.score(docs, learn, chunk_bytes=chunk_bytes).collect())
    assert len(got) == len(want)
    for (i, b, s), (j, c, t) in zip(got, want):
        assert i == j and b[:3] == c[:3]
        assert b[3] == pytest.approx(c[3], rel=1e-12, abs=1e-9) and s == pytest.approx(t, rel=1e-6)


@pytest.mark.parametrize("chunk_bytes", [ctw.CHUNK_BYTES, 700])
def test_equals_the_naive_tree(spark, chunk_bytes):
    texts = [letters(i % 17, 4 + i % 9) + (" É.\nOne TWO" if i % 3 else "") for i in range(40)]
    check(documents(spark, texts), F.col("doc_id") % 4 != 0, chunk_bytes)


def test_odd_rows_no_training_and_empty(spark):
    odd = odd_documents(spark).where("length(coalesce(text, '')) < 1000")
    check(odd, F.col("doc_id") % 2 == 0)
    nothing = ctw.score(odd, F.lit(False)).collect()
    assert all(r["base_score"] == 0 and r["train_tokens"] == r["n_known"] == 0 for r in nothing)
    assert all(r["score"] == pytest.approx(8 * math.log10(0.5)) for r in nothing if r["n_tokens"] == 1)
    assert ctw.score(documents(spark, []), F.lit(True)).count() == 0


def test_probabilities_sum_to_one():
    gram, count = np.unique(ctw.grams([sequence(letters(i, 30)) for i in range(20)])[0], return_counts=True)
    levels = ctw.build(gram, count)
    for text in (b"the st", b"zzzzzz", b"abcdef"):
        context = sum(c << (8 * (k + 1)) for k, c in enumerate(text))
        p = 10 ** ctw.log10_probabilities(np.arange(256, dtype=np.uint64) + np.uint64(context), levels)
        assert p.sum() == pytest.approx(1.0)


def test_large_counts_of_kt():
    for a, b in ((3, 4), (0, 10), (65_536, 7), (200_000, 70_000)):
        want = math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - 2 * math.lgamma(0.5) - math.lgamma(a + b + 1)
        assert ctw.log_kt(np.array([a]), np.array([b]))[0] == pytest.approx(want, rel=1e-10)


def test_packing_of_numbers():
    a = np.unique(np.random.default_rng(0).integers(0, 2**56, 1000, dtype=np.uint64))
    assert (ctw.unpack_sorted(ctw.pack_sorted(a)) == a).all()
