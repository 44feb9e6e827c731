"""Late and repeated deliveries, writers that die, and the store's log."""

import datetime as dt
from itertools import permutations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidemark.context import scratch_path
from tidemark.operators import history as H

from test_history_property import SCHEMA, STAMPS, batches, python_fold, to_row


def frame(spark, rows, stamp):
    return spark.createDataFrame([to_row(k, v, stamp) for k, v in rows.items()], SCHEMA)


def values(plan, seats=1, end=None):
    return {"plan_tier": plan, "seats": seats, "churn_flag": False, "end_date": end}


def rows_of(df):
    return sorted(map(str, ((r.subscription_id, r.valid_from, r.valid_to, r.plan_tier, r.seats, r.churn_flag, r.end_date) for r in df.collect())))


def want(seq):
    return sorted(map(str, python_fold(seq)))


def store_of(spark):
    return H.HistoryStore(spark, scratch_path(spark, "late-history"))


# A@1, B@2, A@3: only the delivered rows of the third batch tell that A comes back; C's first row is older than its first version.
THREE = [{"S-1": values("Basic"), "S-2": values("Pro"), "S-3": values("Basic")},
         {"S-1": values("Pro"), "S-2": values("Pro", end=dt.date(2001, 3, 1)), "S-4": values("Basic")},
         {"S-1": values("Basic", end=dt.date(2001, 3, 1)), "S-3": values(None), "S-4": values("Basic", end=dt.date(2001, 3, 1))}]


@pytest.mark.parametrize("order", list(permutations(range(3))))
def test_all_orders_of_three_batches_give_one_history(spark, order):
    store = store_of(spark)
    for k in order:
        store.apply(frame(spark, THREE[k], STAMPS[k]), STAMPS[k])
    assert rows_of(store.read()) == want(THREE)
    versions = store.read().select("subscription_id", "valid_from", "version_id").collect()
    assert len({r.version_id for r in versions}) == len(versions)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(seq=batches, data=st.data())
def test_any_order_equals_the_fold_in_order(spark, seq, data):
    order = data.draw(st.permutations(range(len(seq))))
    store = store_of(spark)
    for k in order:
        store.apply(frame(spark, seq[k], STAMPS[k]), STAMPS[k])
    assert rows_of(store.read()) == want(seq)
    delivered = None
    for k in order:
        rows = frame(spark, seq[k], STAMPS[k]).selectExpr("*", f"timestamp'{STAMPS[k]}' as batch_ts", f"{k} as seq")
        delivered = rows if delivered is None else delivered.union(rows)
    assert rows_of(H.rebuild(delivered)) == want(seq)


def test_a_late_batch_rewrites_only_the_keys_it_changes(spark):
    store = store_of(spark)
    for k in (0, 2):
        store.apply(frame(spark, THREE[k], STAMPS[k]), STAMPS[k])
    store.apply(frame(spark, {"S-1": values("Basic"), "S-3": values("Pro")}, STAMPS[1]), STAMPS[1])
    last = store.entries()[-1]
    assert last.late and [r[0] for r in store._part("replaced", [last.merge]).select("subscription_id").collect()] == ["S-3"]
    assert rows_of(store.read()) == want([THREE[0], {"S-3": values("Pro")}, THREE[2]])


def test_two_late_batches_rebuild_one_key_twice(spark):
    seq = [{"S-1": values(p)} for p in ("Basic", "Pro", "Basic", "Pro", None)]
    store = store_of(spark)
    for k in (0, 4, 2, 1, 3):
        store.apply(frame(spark, seq[k], STAMPS[k]), STAMPS[k])
    assert rows_of(store.read()) == want(seq)
    # and a batch in time afterwards
    store.apply(frame(spark, {"S-1": values("Basic")}, STAMPS[5]), STAMPS[5])
    assert rows_of(store.read()) == want([*seq, {"S-1": values("Basic")}])


def test_a_repeated_delivery_changes_nothing_and_the_first_one_counts(spark):
    store = store_of(spark)
    for k in (0, 1, 2):
        store.apply(frame(spark, THREE[k], STAMPS[k]), STAMPS[k])
    for k in (1, 2):
        store.apply(frame(spark, THREE[k], STAMPS[k]), STAMPS[k])
    assert rows_of(store.read()) == want(THREE)
    store.apply(frame(spark, {"S-1": values("Enterprise"), "S-2": values("Basic")}, STAMPS[1]), STAMPS[1])
    assert rows_of(store.read()) == want(THREE)


def test_a_writer_that_dies_locks_nothing(spark, monkeypatch):
    store = store_of(spark)
    store.apply(frame(spark, THREE[0], STAMPS[0]), STAMPS[0])

    def die(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m, pytest.raises(RuntimeError, match="lost"):
        m.setattr(store, "_claim", die)
        store.apply(frame(spark, THREE[1], STAMPS[1]), STAMPS[1])
    assert rows_of(store.read()) == want(THREE[:1])
    fs, empty = store._file(f"{store._log()}/000000002")
    fs.create(empty, False).close()  # what a writer of the older kind could leave
    for k in (1, 2):
        store.apply(frame(spark, THREE[k], STAMPS[k]), STAMPS[k])
    assert rows_of(store.read()) == want(THREE) and [e.seq for e in store.entries()] == [1, 3, 4]
    removed = store.remove_orphans()
    assert sorted(p.split("/")[0] for p in removed) == ["data", "delivered"]
    assert rows_of(store.read()) == want(THREE) and store.remove_orphans() == []


def test_of_two_writers_one_fails(spark):
    store = store_of(spark)
    store.apply(frame(spark, THREE[0], STAMPS[0]), STAMPS[0])
    with pytest.raises(Exception, match="exist"):
        store._claim(1, "another", "2001-01-01 00:00:00")
    assert [e.seq for e in store.entries()] == [1]


def test_empty_late_batch(spark):
    store = store_of(spark)
    store.apply(frame(spark, THREE[2], STAMPS[2]), STAMPS[2])
    store.apply(frame(spark, {}, STAMPS[0]), STAMPS[0])
    assert rows_of(store.read()) == rows_of(H.open_versions(frame(spark, THREE[2], STAMPS[2]), STAMPS[2]))


def test_a_batch_is_never_one_tasks_share(spark, monkeypatch):
    """The log's numbers are broadcast: shuffled by merge, all rows of a batch would be sorted in one task."""
    store, plans = store_of(spark), []
    for k in (0, 2):
        store.apply(frame(spark, THREE[k], STAMPS[k]), STAMPS[k])
    append = store._append
    monkeypatch.setattr(store, "_append", lambda df, *a: (plans.append(df), append(df, *a)))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        store.apply(frame(spark, THREE[1], STAMPS[1]), STAMPS[1])
        texts = [df._jdf.queryExecution().executedPlan().toString() for df in [*plans, store.read()]]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert any("BroadcastHashJoin" in t for t in texts)
    assert not any("hashpartitioning(merge" in t for t in texts)
    assert rows_of(store.read()) == want(THREE)
