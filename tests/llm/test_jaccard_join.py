"""Jaccard join against brute force, blocks, components, keeping one of each group."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from tidemark.llm import bitmap, jaccard_join as J
from tidemark.llm.components import components
from tidemark.llm.words import shingles

from helpers import SMALL, documents, odd_documents, prose


def brute(rows):
    sets = [frozenset(shingles(t).tolist()) for _, t in rows]
    parent, links = list(range(len(rows))), Counter()

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.8:
                links[a] += 1
                links[b] += 1
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    groups = defaultdict(list)
    for a, (i, _) in enumerate(rows):
        groups[find(a)].append(i)
    least = {g: min((i for i in ids if i is not None), default=None) for g, ids in groups.items()}
    return sorted((str(i), str(least[find(a)]), links[a]) for a, (i, _) in enumerate(rows))


def edited(text, n, seed):
    r, w = random.Random(seed), text.split()
    for _ in range(n):
        w[r.randrange(len(w))] = f"e{r.randrange(10**6)}"
    return " ".join(w)


def corpus():
    texts = [prose(i, 60) for i in range(40)]
    for i in range(12):
        texts += [edited(prose(i, 200), k % 6, 100 * i + k) for k in range(i)]  # groups of near copies, some beyond the threshold
    texts += [prose(1, 60)] * 30 + ["one two three", "one  TWO three", "one two"]
    return texts


@pytest.mark.parametrize("block", [256, 4])
def test_equals_brute_force(spark, block):
    rows = list(enumerate(corpus()))
    got = J.link_documents(documents(spark, [t for _, t in rows]).repartition(5), block=block).collect()
    assert sorted((str(r["doc_id"]), str(r["class_id"]), r["n_links"]) for r in got) == brute(rows)


def test_keep_one_of_each_group(spark):
    texts = corpus()
    docs = documents(spark, [*texts, "", "", None, texts[3]], [*range(len(texts)), 900, 901, 902, 3])  # a repeated row, too
    kept = J.keep_one(docs)
    assert kept.columns == docs.columns
    ids = sorted(r["doc_id"] for r in kept.collect())
    classes = {c for _, c, _ in brute(list(enumerate(texts)))}
    assert ids == sorted([*map(int, classes), 900, 901, 902])


def test_unlinked_groups_keep_a_row_each(spark):
    x, y, z, v = (prose(70 + k, 60) for k in range(4))
    docs = documents(spark, [x, x + " more", y, y + " more", z, z + " more", v, v + " more"], [1, 2, 1, 3, None, None, None, None])
    kept = [r["text"] for r in J.keep_one(docs).collect()]
    assert sorted(t.removesuffix(" more") for t in kept) == sorted([x, y, z, v])


def test_odd_and_empty_tables(spark):
    odd = odd_documents(spark)
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    got = J.link_documents(odd).collect()
    assert sorted((str(r["doc_id"]), str(r["class_id"]), r["n_links"]) for r in got) == brute(rows)
    assert J.keep_one(odd).schema == odd.schema and J.keep_one(odd).count() == len(rows) - 1
    assert J.link_documents(documents(spark, [])).count() == J.keep_one(documents(spark, [])).count() == 0


def pair_of(rng, common, own):
    """Two sets of that many common and own members each."""
    s = rng.integers(0, 2**63, common + 2 * own, dtype=np.uint64)
    return np.unique(s[:common + own]), np.unique(np.concatenate([s[:common], s[common + own:]]))


def test_prefixes_reach_the_recall():
    lengths = J.prefix_lengths()
    assert lengths[0] == J.LONGEST and lengths == sorted(lengths, reverse=True)
    assert J.found_by(0.8, lengths[-1]) >= 0.9999 > J.found_by(0.8, lengths[-1] + 1)
    assert J.prefix_lengths(0.8, 0.5) == [J.LONGEST]  # a low target never shortens
    functions, rng = J.hash_functions(), np.random.default_rng(0)
    met = []
    for _ in range(400):  # pairs of similarity 0.8
        a, b = (J.signature(x, lengths, functions) for x in pair_of(rng, 80, 10))
        met.append((a == b).any(axis=1))
        assert not ((a == b)[:-1] & ~(a == b)[1:]).any()  # who shares a prefix shares all shorter ones
    share = np.mean(met, axis=0)
    assert share[-1] >= 0.998
    for measured, d in zip(share, lengths):
        assert abs(measured - J.found_by(0.8, d)) < 0.03


def test_estimate_of_what_was_not_found():
    # 1000 links, of which each was found with probability 0.9: about 111 more.
    assert J.estimated_recall(1000, 1000 * (1 / 0.9 - 1), 0.8, 3) == pytest.approx(0.9, abs=1e-3)
    assert J.estimated_recall(0, 0.0, 0.8, 6) == pytest.approx(J.found_by(0.8, 6))  # no link is no proof
    assert J.estimated_recall(10**6, 0.0, 0.8, 6) > 0.9999


def lengths_used(monkeypatch, spark, texts, **options):
    used, groups = [], J.candidate_groups
    monkeypatch.setattr(J, "candidate_groups", lambda c, t, length, *rest: used.append(length) or groups(c, t, length, *rest))
    J.link_documents(documents(spark, texts), **options)
    return used


def test_shortens_until_the_links_found_prove_the_recall(spark, monkeypatch):
    alike = [prose(5, 1500) + f" end{k}" for k in range(16)]  # 120 links of similarity above 0.99
    assert lengths_used(monkeypatch, spark, alike) == [6]
    monkeypatch.undo()
    assert lengths_used(monkeypatch, spark, [prose(5, 1500), prose(6, 1500)]) == J.prefix_lengths()


def test_planted_pairs_near_the_threshold_in_documents(spark):
    texts = [r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").where("text IS NOT NULL").orderBy("doc_id").limit(400).collect()]
    long = [t for t in texts if len(t.split()) >= 80]
    rows = list(enumerate([*texts, *(edited(t, max(len(t.split()) // 50, 1), k) for k, t in enumerate(long))]))  # similarity about 0.82
    got = J.link_documents(documents(spark, [t for _, t in rows])).collect()
    assert len(long) > 50
    assert sorted((str(r["doc_id"]), str(r["class_id"]), r["n_links"]) for r in got) == brute(rows)


def test_hot_node_in_blocks(spark):
    text = prose(9, 120)
    rows = list(enumerate([edited(text, k % 3, k) for k in range(500)] + [prose(k, 50) for k in range(20)]))
    got = J.link_documents(documents(spark, [t for _, t in rows]).repartition(4), block=32).collect()
    exact, links = brute(rows), {str(r["doc_id"]): (str(r["class_id"]), r["n_links"]) for r in got}
    assert {i: c for i, (c, _) in links.items()} == {i: c for i, c, _ in exact}
    assert all(links[i][1] <= n for i, _, n in exact)
    # Some 80 000 links between texts of similarity 0.8 to 0.9: the target recall is kept.
    assert sum(n for _, n in links.values()) >= J.RECALL * sum(n for _, _, n in exact) > 100_000 * J.RECALL


def test_common_shingles_in_pieces():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 30_000, n).astype(np.uint64)) for n in (9000, 8000, 50, 1, 7000)]
    got = J.common_shingles(sets, np.array([0, 1]), np.array([2, 3, 4]))
    assert got.tolist() == [[len(np.intersect1d(sets[a], sets[b])) for b in (2, 3, 4)] for a in (0, 1)]


def test_components_of_chains_stars_and_loops(spark):
    r = random.Random(1)
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(500, 500 + i) for i in range(1, 40)]
    edges = [*chain, *star, (7, 7), (9, 8), (8, 9), (9, 8)]
    r.shuffle(edges)
    got = {x["node"]: x["component"] for x in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, **{i: 500 for i in range(500, 540)}, 8: 8, 9: 8}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_bitmap_has_no_false_negative(spark):
    keys = np.random.default_rng(2).integers(-2**63, 2**63, 500)
    found = bitmap.build(spark.createDataFrame([(int(k),) for k in keys], "h long"), "h", bits=12)
    assert bitmap.contains(found, keys.view(np.uint64), bits=12).all()
    assert not bitmap.contains(bitmap.build(spark.createDataFrame([], "h long"), "h"), keys.view(np.uint64)).any()


def test_hot_node_joins_each_class_once(spark, monkeypatch):
    text, joined, groups = prose(9, 120), [], J.candidate_groups

    def counted(classes, tries, *rest):
        found = groups(classes, tries, *rest)
        joined.append((tries.count(), found.count()))
        return found

    monkeypatch.setattr(J, "candidate_groups", counted)
    J.link_documents(documents(spark, [edited(text, k % 3, k) for k in range(200)]).repartition(4), block=8)
    assert all(rows < paths for paths, rows in joined)  # a row a block, not a row a class, in each of its 25 pairs of blocks
    assert len(joined) > 0
