"""Whitening against a plain covariance in exact integers; planes, deviations, odd tables."""

import math
from fractions import Fraction

import numpy as np
import pytest

from tidemark.llm import whitening as W

SCHEMA = "vec_id long, embedding array<float>, label int"


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def vectors(seed, n, length=10, repeat=20):
    r = np.random.default_rng(seed)
    mixing = r.normal(0, 1, (length, length))
    rows = [(i, (r.normal(0, 1, length) @ mixing).astype(np.float32).tolist(), 0) for i in range(n)]
    return rows + [(n + k, rows[3][1], 0) for k in range(repeat)]


def plain(rows):
    """{vec_id: x}, n, sums, covariance as fractions, over the distinct vectors."""
    xs = [(i, tuple(math.floor(256 * float(c)) for c in v)) for i, v, _ in rows]
    fit = sorted({x for _, x in xs})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    cov = [[Fraction(sum(x[a] * x[b] for x in fit) * n - sums[a] * sums[b], n * n) for b in range(len(sums))] for a in range(len(sums))]
    return xs, n, sums, np.array([[float(c) for c in row] for row in cov])


def check(df, rows):
    xs, n, sums, cov = plain(rows)
    e, vectors_ = np.linalg.eigh(cov)
    e, vectors_ = e[::-1], vectors_[:, ::-1]
    out = W.by_component(W.whitened(df)).collect()
    k = min(4, len(sums))
    assert len(out) == k * len(rows)
    got = {}
    for r in out:
        got.setdefault((r["vec_id"], r["component"]), []).append(r)
    signs = {}
    for i, x in xs:
        deviation = sum((n * v - s) ** 2 for v, s in zip(x, sums))
        for c in range(1, k + 1):
            for r in got[i, c]:
                assert r["n"] == n and r["deviation"] == (deviation if deviation < 2 ** 63 else None)
                assert math.isclose(r["explained"], e[c - 1] / np.trace(cov), rel_tol=1e-9) and r["identity_error"] < 1e-9
                want = float((np.array(x) - np.array(sums) / n) @ vectors_[:, c - 1] / math.sqrt(e[c - 1]))
                if abs(want) > 1e-3:
                    signs.setdefault(c, np.sign(want * r["whitened"]))
                assert math.isclose(r["whitened"] * signs.get(c, 1), want, abs_tol=1e-7)


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_the_plain_covariance(spark, seed):
    rows = vectors(seed, 150)
    check(table(spark, rows).repartition(4), rows)


def test_products_by_population_counts():
    r = np.random.default_rng(3)
    for high, kind in ((5, np.int64), (30_000, np.int64), (1 << 40, object)):
        x = r.integers(0, high, (131, 6))
        x[:, 2] = 0
        bits = np.array([max(1, int(v).bit_length()) for v in x.max(axis=0)])
        total = np.zeros((6, 6), kind)
        for part in (x[:64], x[64:100], x[100:]):
            W.add_products(total, part, bits)
        wide = x.astype(object)
        assert (np.triu(total) == np.triu(wide.T @ wide)).all()


def test_wide_values_stay_exact(spark):
    r = np.random.default_rng(4)
    rows = [(i, (r.integers(-100, 100, 3) * 2.0 ** k).tolist(), 0) for i, k in enumerate(list(range(12)) * 5)]
    check(table(spark, rows), rows)


def test_deviation_beyond_64_bits_is_null(spark):
    rows = [(i, [float(10 ** 8 * i), 1.0], 0) for i in range(20)]
    out = {r["vec_id"]: r["deviation"] for r in W.whitened(table(spark, rows)).collect()}
    xs, n, sums, _ = plain(rows)
    want = {i: sum((n * v - s) ** 2 for v, s in zip(x, sums)) for i, x in xs}
    assert out == {i: d if d < 2 ** 63 else None for i, d in want.items()} and None in out.values()


def test_packing_is_the_vectors_own(spark):
    import pyarrow as pa

    x = np.array([[1, -128], [127, 0], [128, 0], [-129, 5], [1 << 20, 1], [-(1 << 40), 2]])
    p = W.packed(x)
    assert [len(b) for b in p] == [2, 2, 4, 4, 8, 16]
    column = pa.array(p, pa.binary())
    assert (W.unpacked(column, 2) == x).all() and (W.unpacked(column.slice(2, 3), 2) == x[2:5]).all()


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = vectors(5, 40)
    odd = [(900, None, 1), (901, [], 1), (902, [0.1] * 9 + [nan], 1), (903, [0.1] * 9 + [None], 1), (904, [-inf] * 10, 1), (905, [0.1] * 3, 1)]
    same = good[:2]  # repeated rows are returned each
    df = table(spark, good + odd + same).selectExpr("*", "vec_id as n", "label as whitened", "'x' as x", "0 as component", "label as deviation")
    check(df, good + same)


@pytest.mark.parametrize("rows", [[(i, [1.0, 2.0, 3.0, 4.0, 5.0], 0) for i in range(4)], [(None, [0.5], 0)]])
def test_no_variance(spark, rows):
    out = W.by_component(W.whitened(table(spark, rows))).collect()
    assert len(out) == len(rows) * min(4, len(rows[0][1]))
    assert all(r["n"] == 1 and r["deviation"] == 0 and r["whitened"] == r["explained"] == r["identity_error"] == 0 for r in out)


def test_components_beyond_the_rank(spark):
    rows = [(i, [i / 256, 2 * i / 256, 0.0, 0.0, 1.0], 0) for i in range(9)]
    out = W.whitened(table(spark, rows)).collect()
    for r in out:
        assert abs(r["whitened"][0]) < 2 and r["whitened"][1:] == [0.0, 0.0, 0.0]
        assert math.isclose(r["explained"][0], 1) and r["explained"][1:] == [0.0, 0.0, 0.0] and r["identity_error"] < 1e-9


@pytest.mark.parametrize("rows", [[], [(1, None, 1), (2, [], None)]])
def test_no_usable_row(spark, rows):
    df = W.by_component(W.whitened(table(spark, rows)))
    assert df.collect() == [] and df.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_query_on_embeddings(spark):
    small = "/root/testdata/sf0.001"
    df = spark.read.parquet(f"{small}/embeddings.parquet")
    check(df, [(r["vec_id"], r["embedding"], 0) for r in df.collect()])
