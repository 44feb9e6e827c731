"""Subscription history: versioning rules and properties."""

import datetime as dt

from pyspark.sql import functions as F

from tidemark.context import scratch_path
from tidemark.operators import history as H
from tidemark.plans import catalog

from conftest import SMALL

SCHEMA = ("subscription_id string, account_id string, start_date date, end_date date, plan_tier string, "
          "seats int, mrr_amount bigint, arr_amount bigint, is_trial boolean, upgrade_flag boolean, "
          "downgrade_flag boolean, churn_flag boolean, billing_frequency string, auto_renew_flag boolean, "
          "ingestion_ts timestamp")
D = dt.date
T1, T2, T3 = "2001-10-01 00:00:00", "2001-11-01 00:00:00", "2001-12-01 00:00:00"


def row(sid, tier="Pro", seats=5, end=None, churn=False, trial=False, stamp=T1):
    return (sid, "A-1", D(2000, 1, 1), end, tier, seats, 100, 1200, trial, False, False, churn, "monthly", True,
            dt.datetime.fromisoformat(stamp))


def versions(df):
    return {(r.subscription_id, str(r.valid_from), str(r.valid_to) if r.valid_to else None): r
            for r in df.collect()}


def test_check_columns_open_versions_unchecked_do_not(spark):
    b1 = spark.createDataFrame([row("S-1"), row("S-2"), row("S-3"), row("S-4", churn=None)], SCHEMA)
    b2 = spark.createDataFrame([
        row("S-1", tier="Enterprise", stamp=T2),        # checked column -> new version
        row("S-2", end=D(2001, 10, 15), trial=True, stamp=T2),  # unchecked only -> nothing
        # S-3 missing: stays open
        row("S-4", churn=None, stamp=T2),               # NULL = NULL -> unchanged
        row("S-5", stamp=T2),                           # new key
    ], SCHEMA)
    hist = H.merge_batch(H.open_versions(b1, T1), b2, T2)
    v = versions(hist)
    assert set(v) == {
        ("S-1", "2001-10-01 00:00:00", "2001-11-01 00:00:00"),
        ("S-1", "2001-11-01 00:00:00", None),
        ("S-2", "2001-10-01 00:00:00", None),
        ("S-3", "2001-10-01 00:00:00", None),
        ("S-4", "2001-10-01 00:00:00", None),
        ("S-5", "2001-11-01 00:00:00", None),
    }
    s2 = v[("S-2", "2001-10-01 00:00:00", None)]
    assert s2.end_date is None and s2.is_trial is False  # values of the opening row are kept


def test_null_safe_change_opens_version(spark):
    b1 = spark.createDataFrame([row("S-1", churn=False)], SCHEMA)
    b2 = spark.createDataFrame([row("S-1", churn=None, stamp=T2)], SCHEMA)
    hist = H.merge_batch(H.open_versions(b1, T1), b2, T2)
    assert hist.count() == 2
    assert hist.filter(F.col("valid_to").isNull()).first().churn_flag is None


def test_reapplying_a_batch_changes_nothing(spark):
    b1 = spark.createDataFrame([row("S-1"), row("S-2")], SCHEMA)
    b2 = spark.createDataFrame([row("S-1", seats=9, stamp=T2), row("S-2", stamp=T2)], SCHEMA)
    once = H.merge_batch(H.open_versions(b1, T1), b2, T2)
    twice = H.merge_batch(once, b2, T3)
    cols = H.HISTORY_COLUMNS
    assert once.select(cols).exceptAll(twice.select(cols)).count() == 0
    assert twice.select(cols).exceptAll(once.select(cols)).count() == 0


def test_fixture_history_properties(spark):
    hist = catalog.subscription_history(spark, SMALL)
    # one open version per key
    assert hist.filter(F.col("valid_to").isNull()).groupBy("subscription_id").count() \
        .filter("count > 1").count() == 0
    # contiguous: each closed version ends where the next one starts
    from pyspark.sql import Window as W
    w = W.partitionBy("subscription_id").orderBy("valid_from")
    gaps = hist.withColumn("next_from", F.lead("valid_from").over(w)).filter(
        ~F.col("valid_to").eqNullSafe(F.col("next_from")))
    assert gaps.count() == 0
    # version ids are unique
    assert hist.select("version_id").distinct().count() == hist.count()


def test_as_of(spark):
    b1 = spark.createDataFrame([row("S-1")], SCHEMA)
    b2 = spark.createDataFrame([row("S-1", tier="Basic", stamp=T2)], SCHEMA)
    hist = H.merge_batch(H.open_versions(b1, T1), b2, T2)
    assert H.as_of(hist, "2001-10-15 00:00:00").first().plan_tier == "Pro"
    assert H.as_of(hist, "2001-11-01 00:00:00").first().plan_tier == "Basic"
    assert H.as_of(hist, "2001-09-01 00:00:00").count() == 0


def test_history_store_appends_closed_versions_and_keeps_states(spark):
    store = H.HistoryStore(spark, scratch_path(spark, "test-history"))
    assert store.read() is None
    store.apply(spark.createDataFrame([row("S-1"), row("S-2")], SCHEMA), T1)
    seq1, dirs1 = store.state()
    assert seq1 == 1 and len(dirs1) == 1
    data = lambda: spark.read.parquet(store._data())
    second = store.apply(spark.createDataFrame([row("S-1", seats=7, stamp=T2), row("S-2", stamp=T2)], SCHEMA), T2)
    seq2, dirs2 = store.state()
    assert seq2 == 2 and dirs2[:1] == dirs1 and len(dirs2) == 2
    assert second.count() == 3
    closed_by_second = data().filter((F.col("merge") == dirs2[1]) & ~F.col("_open"))
    assert closed_by_second.count() == 1                          # only the version this batch closed
    assert data().filter(F.col("merge") == dirs1[0]).count() == 2  # the first merge is never rewritten
    # a batch without changes closes nothing and keeps the same rows
    third = store.apply(spark.createDataFrame([row("S-1", seats=7, stamp=T3), row("S-2", stamp=T3)], SCHEMA), T3)
    seq3, dirs3 = store.state()
    assert seq3 == 3 and data().filter((F.col("merge") == dirs3[2]) & ~F.col("_open")).count() == 0
    cols = H.HISTORY_COLUMNS
    assert third.select(cols).exceptAll(second.select(cols)).count() == 0
    assert second.select(cols).exceptAll(third.select(cols)).count() == 0
    # the same history as the in-memory fold
    b = [spark.createDataFrame([row("S-1"), row("S-2")], SCHEMA),
         spark.createDataFrame([row("S-1", seats=7, stamp=T2), row("S-2", stamp=T2)], SCHEMA)]
    folded = H.merge_batch(H.open_versions(b[0], T1), b[1], T2)
    assert folded.select(cols).exceptAll(second.select(cols)).count() == 0
