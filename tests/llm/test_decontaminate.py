"""Decontamination against brute force over all 13-word windows."""

import hashlib
import random
import re

import numpy as np
import pytest

from tidemark.llm import decontaminate as D
from tidemark.llm.words import gram_hashes, word_hashes

from helpers import DOCS, documents, odd_documents

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(text, items):
    w, hit, found = words(text), set(), set()
    for item_id, item in items:
        v = words(item)
        k = min(13, len(v))
        windows = {tuple(v[i:i + k]) for i in range(len(v) - k + 1)} if v else set()
        for i in range(len(w) - k + 1):
            if tuple(w[i:i + k]) in windows:
                hit.update(range(i, i + k))
                if item_id is not None:
                    found.add(str(item_id))
    return (len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(),
            len(hit) > 0 and 20 * len(hit) >= len(w))


def bench(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def result(docs, benchmark):
    rows = D.contamination(docs, benchmark).collect()
    return sorted(((r["doc_id"], (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"])) for r in rows), key=str)


def test_words_are_those_of_the_contract():
    text = "Ab-C9 é_Ü\x80x`y{z ß 中文。\nQ@1"
    assert [w.decode() for w in D.words_of(text)] == words(text)


def test_every_window_keeps_a_hash():
    h = gram_hashes(word_hashes([str(random.Random(1).randrange(9)) for _ in range(500)]), D.K)
    kept = set(D.winnow(h).tolist())
    for at in range(len(h) - D.W + 1):
        window = h[at:at + D.W]
        assert at + max(np.flatnonzero(window == window.min())) in kept


@pytest.mark.parametrize("seed", range(3))
def test_equals_brute_force(spark, seed):
    r = random.Random(seed)
    small = [f"t{i}" for i in range(40)]
    line = lambda n: " ".join(r.choice(small) for _ in range(n))
    items = [(i, line(r.choice([0, 1, 3, 6, 7, 9, 12, 13, 14, 20, 40]))) for i in range(25)] + [(None, line(15)), (3, line(20)), (7, None)]
    texts = []
    for i in range(60):
        parts = [line(r.randint(0, 30))]
        for _ in range(r.randint(0, 4)):
            v = words(r.choice(items)[1])
            a = r.randint(0, max(len(v) - 1, 0))
            parts += [" ".join(v[a:a + r.choice([5, 12, 13, 14, 30])]).upper(), line(r.randint(0, 6))]
        texts.append(", ".join(parts))
    got = result(documents(spark, texts), bench(spark, items))
    assert got == sorted(((i, brute(t, items)) for i, t in enumerate(texts)), key=str)


def test_odd_rows_and_filter(spark):
    r = random.Random(5)
    passage = " ".join(f"p{r.randrange(1000)}" for _ in range(60))
    items = [(1, passage), (2, "one two three four"), (3, "repeated row repeated"), (4, "")]
    odd = odd_documents(spark)
    want = sorted(((x["doc_id"], brute(x["text"], items)) for x in odd.collect()), key=str)
    assert result(odd, bench(spark, items)) == want
    kept = D.decontaminate(odd, bench(spark, items))
    assert kept.schema == odd.schema
    assert sorted(map(str, (x["doc_id"] for x in kept.collect()))) == sorted(str(i) for i, w in want if not w[4])
    assert D.contamination(documents(spark, []), bench(spark, items)).count() == 0
    assert [w[1] for _, w in result(odd, bench(spark, []))] == [0] * odd.count()


def test_clean_and_contaminated_copies(spark):
    r = random.Random(6)
    passage = " ".join(f"p{r.randrange(1000)}" for _ in range(60))
    own = lambda n: " ".join(f"d{r.randrange(9999)}" for _ in range(n))
    rows = [(1, own(500) + " " + passage), (2, own(2000) + " " + passage), (3, own(50)), (4, passage), (1, own(500))]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], DOCS)
    kept = D.decontaminate(docs, bench(spark, [(9, passage)])).collect()
    assert sorted((x["doc_id"], x["text"]) for x in kept) == sorted(rows[i] for i in (1, 2, 4))  # 60 words of 2060 are under a twentieth
