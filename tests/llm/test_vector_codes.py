"""Vector codes against a plain full scan, the bounds' work, odd tables."""

import hashlib
import math

import numpy as np
import pytest

from tidemark.llm import vector_codes as V

SCHEMA = "vec_id long, embedding array<float>, label int"


def table(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def clustered(seed, n, length=16, spread=0.02):
    r = np.random.default_rng(seed)
    centres = r.normal(0, 0.3, (25, length))
    return [(i, (centres[r.integers(25)] + r.normal(0, spread, length)).astype(np.float32).tolist(), int(r.integers(3)) if i % 7 else None) for i in range(n)]


def plain(rows, rounds=6, parts=8, entries=16):
    """The contract, one distance after the other."""
    kept = [(i, v, lab) for i, v, lab in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    width = len(kept[0][1]) // parts
    xs = [[[math.floor(4096 * c) for c in v[p * width:(p + 1) * width]] for p in range(parts)] for _, v, _ in kept]
    first = sorted(range(len(kept)), key=lambda r: kept[r][0])[:entries]
    books = [[xs[r][p] for r in first] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), j) for j, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for x in xs:
                groups.setdefault(nearest(x[p], books[p])[1], []).append(x[p])
            books[p] = [[sum(c) // len(groups[j]) for c in zip(*groups[j])] if j in groups else e for j, e in enumerate(books[p])]
    codes = [[nearest(x[p], books[p]) for p in range(parts)] for x in xs]
    errors = [sum(d for d, _ in c) for c in codes]
    by_label = {}
    for (_, _, lab), e in zip(kept, errors):
        by_label[lab] = by_label.get(lab, 0) + e
    sha = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return sorted((i, "".join(f"{j:02x}" for _, j in c), e, by_label[lab], sha) for (i, _, lab), c, e in zip(kept, codes, errors))


def got(df):
    return sorted(tuple(r) for r in V.with_label_errors(V.compress(df)).collect())


@pytest.mark.parametrize("seed,n", [(1, 300), (2, 40), (3, 9)])
def test_equals_a_full_scan(spark, seed, n):
    rows = clustered(seed, n)
    assert got(table(spark, rows).repartition(4)) == plain(rows)


def test_equal_distances_go_to_the_lower_index(spark):
    # On a coarse grid most distances tie, entries coincide and some stay unused.
    r = np.random.default_rng(5)
    rows = [(i, (r.integers(-2, 3, 16) / 4096).tolist(), 0) for i in range(200)]
    assert got(table(spark, rows).repartition(3)) == plain(rows)


def test_bounds_skip_most_distances_and_hold_in_every_round():
    r = np.random.default_rng(0)
    centres = r.integers(-900, 900, (16, 8, 4))
    x = centres[r.integers(16, size=2000)] + r.integers(-40, 41, (2000, 8, 4))
    history = [x[:16].transpose(1, 0, 2).copy()]
    bounds, scans = V.first_scan(x, history[0]), []
    for _ in range(8):
        sums = np.zeros((8, 16, 5), np.int64)
        V.add_changes(sums, x, None, bounds.code)
        history.append(np.where(sums[:, :, -1:] > 0, sums[:, :, :-1] // np.maximum(sums[:, :, -1:], 1), history[-1]))
        moved = V.net_displacements(history)
        scans.append(V.rescan(x, bounds, history, moved))
        every = np.stack([[V.squared(x[:, p], history[-1][p, j]) for j in range(16)] for p in range(8)]).transpose(2, 0, 1)
        assert (bounds.code == every.argmin(axis=2)).all()
        rows, parts = np.indices(bounds.code.shape)
        assert (bounds.upper + moved[bounds.upper_at, parts, bounds.code] >= np.sqrt(every.min(axis=2))).all()
        lower = bounds.lower - moved[bounds.lower_at, parts[..., None], np.arange(16)]
        assert (lower <= np.sqrt(every)).all()
        # One net displacement is never longer than the way the entry took.
        steps = [np.sqrt(V.squared(a, b).astype(float)) for a, b in zip(history[1:], history)]
        for s in range(len(history)):
            assert (moved[s] <= sum(steps[s:], np.zeros((8, 16))) + 1e-6).all()
    assert scans[-1] < 0.2 * x.shape[0] * 8 * 16


def test_changes_add_up_to_whole_sums():
    r = np.random.default_rng(1)
    x, old, new = r.integers(-9, 9, (50, 8, 3)), r.integers(0, 16, (50, 8)).astype(np.uint8), r.integers(0, 16, (50, 8)).astype(np.uint8)
    a, b = np.zeros((8, 16, 4), np.int64), np.zeros((8, 16, 4), np.int64)
    V.add_changes(a, x, None, old)
    V.add_changes(a, x, old, new)
    V.add_changes(b, x, None, new)
    assert (a == b).all()


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = clustered(4, 30)
    odd = [(100, None, 1), (101, [], 1), (102, [0.1] * 15 + [nan], 1), (103, [0.1] * 15 + [None], 1), (104, [inf] * 16, 1), (105, [0.1] * 8, 1)]
    df = table(spark, good + odd + good[20:22]).selectExpr("*", "vec_id as code", "label as error", "'x' as x", "0 as changes", "label as _label")
    assert got(df) == plain(good + good[20:22])


def test_null_ids_come_last_and_repeated_start_ids_count_once(spark):
    good = clustered(6, 12)
    out = V.compress(table(spark, good + good[:5] + [(None, good[0][1], None)]).repartition(5), rounds=0)
    assert out.codebooks.shape == (8, 13, 2) and out.rows.count() == 18
    first = [[math.floor(4096 * np.float32(c)) for c in v] for _, v, _ in [*good, good[0]]]
    assert out.codebooks.transpose(1, 0, 2).reshape(13, 16).tolist() == first


def test_lengths_that_parts_do_not_divide_and_huge_components(spark):
    rows = [(i, [float(i * k % 5) for k in range(11)], i % 2) for i in range(40)] + [(40, [3e38, -3e38] + [0.0] * 9, 0)]
    out = V.compress(table(spark, rows))
    assert out.length == 11 and out.codebooks.shape[2] == 2 and out.rows.count() == 41
    worst = out.rows.where("vec_id = 40").first()["error"]
    assert 0 <= worst < 2 ** 63


@pytest.mark.parametrize("rows", [[], [(1, None, 1), (2, [], None)]])
def test_no_usable_row(spark, rows):
    assert got(table(spark, rows)) == []


def test_digest_columns(spark):
    df = V.with_label_errors(V.compress(table(spark, clustered(1, 20))))
    assert dict(df.dtypes) == {"vec_id": "bigint", "code": "string", "error": "bigint", "label_error": "bigint", "codebooks_sha256": "string"}
