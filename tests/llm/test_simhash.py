"""SimHash near-duplicates against brute force: fingerprints, lists of every length, bitmaps, components."""

import random
import re

import numpy as np
import pytest
import xxhash

from tidemark.llm import simhash as S

from helpers import ODD_IDS, ODD_TEXTS, documents, odd_documents, prose


def plain_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps):
    root = list(range(len(fps)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a in range(len(fps)):
        for b in range(a):
            if bin(fps[a] ^ fps[b]).count("1") <= 3:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return [find(a) for a in range(len(fps))]


def brute(rows):
    fps = [plain_fingerprint(t) for _, t in rows]
    comp = plain_components(fps)
    least = {}
    for (i, _), c in zip(rows, comp):
        if i is not None:
            least[c] = min(least.get(c, i), i)
    return sorted((str(i), f"{f:016x}", str(least.get(c))) for (i, _), f, c in zip(rows, fps, comp))


def got(df, **options):
    out = S.near_duplicates(df, **options).select("doc_id", S.hexadecimal("fp").alias("f"), "component_id").collect()
    return sorted((str(r[0]), r[1], str(r[2])) for r in out)


def corpus():
    r, out = random.Random(3), []
    for i in range(25):
        words = prose(i, 150).split()
        out.append(" ".join(words))
        for _ in range(r.randrange(5)):
            w = list(words)
            for _ in range(r.randrange(1, 4)):
                w[r.randrange(len(w))] = f"e{r.randrange(10 ** 6)}"
            out.append(" ".join(w))
    return out + [out[0]] * 5 + ["", None, " \t", "a B", "A b", "ÄÖ Straße ä", " x y z", "x\x1cy z w", "x\x0by\x0cz w"]


@pytest.mark.parametrize("text", corpus() + ODD_TEXTS)
def test_fingerprint_is_the_plain_one(text):
    assert S.fingerprint(None if text is None else text.encode()) == plain_fingerprint(text)


def test_fingerprint_of_a_text_of_several_blocks(monkeypatch):
    monkeypatch.setattr(S, "BLOCK", 7)
    text = prose(1, 100)
    assert S.fingerprint(text.encode()) == plain_fingerprint(text)


@pytest.mark.parametrize("longest", [512, 2])
def test_equals_brute_force(spark, longest):
    rows = list(enumerate(corpus()))
    assert got(documents(spark, [t for _, t in rows]).repartition(4), longest=longest) == brute(rows)


def fingerprint_sets():
    r = random.Random(11)
    near = [r.getrandbits(64) for _ in range(12)]
    out = set(near)
    for f in near:
        for _ in range(12):
            g = f
            for b in r.sample(range(64), r.randrange(1, 5)):
                g ^= 1 << b
            out.add(g)
    dense = r.getrandbits(64)
    # Fingerprints that share five bytes: too long a list until it is a bitmap.
    out |= {dense & ~0xFFFFFF00 | v << 8 for v in r.sample(range(1 << 24), 150)} | {dense ^ (1 << b) for b in range(64)}
    return sorted(out)


@pytest.mark.parametrize("longest", [512, 20, 3])
def test_every_link_is_found_whatever_the_length_of_a_list(spark, longest):
    fps = fingerprint_sets()
    df = spark.createDataFrame([(int(np.uint64(f).astype(np.int64)),) for f in fps], "fp long")
    at = {int(np.uint64(f).astype(np.int64)): i for i, f in enumerate(fps)}
    pairs = [(at[r["u"]], at[r["v"]]) for r in S.links(df, longest=longest).collect()]
    a, b = (np.array(x, np.int64) for x in zip(*pairs))
    assert S.least_linked(len(fps), a, b).tolist() == S.least_linked(len(fps), *np.nonzero(
        np.bitwise_count(np.array(fps, np.uint64)[:, None] ^ np.array(fps, np.uint64)[None, :]) <= 3)).tolist()
    assert [plain_components(fps)[i] for i in range(len(fps))] == S.least_linked(len(fps), a, b).tolist()


def test_three_flips_leave_a_triple_of_the_index():
    r = random.Random(2)
    for _ in range(300):
        bad = {r.randrange(8) for _ in range(3)}
        assert any(not bad & set(t) for t in S.TRIPLES)


def test_a_bitmap_with_many_members():
    present = np.zeros(1 << 24, bool)
    present[np.random.default_rng(0).integers(0, 1 << 24, 3000)] = True
    present[:64] = True
    members, root = S.clusters_of_bitmap(present)
    few = np.flatnonzero(np.bitwise_count((members[:, None] ^ members[None, :]).astype(np.uint64)).ravel() <= 3)
    assert (root == S.least_linked(len(members), few // len(members), few % len(members))).all()
    assert (root[:64] == 0).all()


def test_odd_documents(spark):
    assert got(odd_documents(spark)) == brute(list(zip(ODD_IDS, ODD_TEXTS)))


def test_ids_that_are_null(spark):
    assert got(documents(spark, ["a b c", "a b c", "z y x"], [None, None, None])) == brute([(None, "a b c"), (None, "a b c"), (None, "z y x")])


def test_empty_table(spark):
    assert got(documents(spark, [])) == []


def test_query_on_documents(spark):
    from tidemark.llm import queries as Q

    small = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    out = Q.op12_simhash(spark, small)
    assert out.columns == ["doc_id", "fingerprint", "component_id"]
    assert sorted((str(r[0]), r[1], str(r[2])) for r in out.collect()) == brute(rows)
