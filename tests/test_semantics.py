"""Skew-proof formulations equal the straightforward ones (brute force on small frames)."""

import datetime as dt

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.context import RunContext
from tidemark.functions.core import latest_per_key
from tidemark.operators import intermediate as mid

D = dt.date
CTX = RunContext.pinned()

ACCOUNTS = ("account_id string, account_name string, industry string, country string, signup_date date, "
            "referral_source string, plan_tier string, seats int, is_trial boolean, churn_flag boolean, "
            "ingestion_ts timestamp")
SUBS = ("subscription_id string, account_id string, start_date date, end_date date, plan_tier string, "
        "seats int, mrr_amount bigint, arr_amount bigint, is_trial boolean, upgrade_flag boolean, "
        "downgrade_flag boolean, churn_flag boolean, billing_frequency string, auto_renew_flag boolean, "
        "ingestion_ts timestamp")
CHURN = ("churn_event_id string, account_id string, churn_date date, reason_code string, "
         "refund_amount_usd double, preceding_upgrade_flag boolean, preceding_downgrade_flag boolean, "
         "is_reactivation boolean, feedback_text string, ingestion_ts timestamp")
USAGE = ("subscription_id string, usage_date date, feature_name string, total_usage_count bigint, "
         "total_usage_duration_secs bigint, total_error_count bigint, is_beta_feature boolean")


def acct(i, tier="Pro", signup=D(2000, 1, 1)):
    return (i, f"name-{i}", "ind", "c", signup, "ads", tier, 3, False, False, None)


def sub(sid, aid, start, end=None, tier="Pro", mrr=100, up=False, down=False):
    return (sid, aid, start, end, tier, 1, mrr, 12 * mrr, False, up, down, False, "monthly", True, None)


def same(a, b):
    cols = a.columns
    return a.select(cols).exceptAll(b.select(cols)).count() == 0 and \
        b.select(cols).exceptAll(a.select(cols)).count() == 0


def test_latest_per_key_ties_and_nulls(spark):
    df = spark.createDataFrame([
        ("a", D(2001, 1, 1), "S-1", 1), ("a", D(2001, 1, 1), "S-2", 2), ("a", None, "S-9", 3),
        ("b", None, "S-3", 4), ("b", None, "S-4", 5),
    ], "k string, d date, id string, v int")
    got = {r.k: r.v for r in latest_per_key(df, "k", ["d", "id"], ["v"]).collect()}
    assert got == {"a": 2, "b": 5}  # latest date wins, NULL dates last, ties -> larger id


def test_subscription_summary_equals_join_then_aggregate(spark):
    # A-1 appears twice in accounts: the left join fans its subscriptions out.
    accounts = spark.createDataFrame([acct("A-1"), acct("A-1"), acct("A-2")], ACCOUNTS)
    subs = spark.createDataFrame([
        sub("S-1", "A-1", D(2000, 1, 1), None, "Pro", 10, up=True),
        sub("S-2", "A-1", D(2000, 6, 1), D(2000, 9, 1), "Enterprise", 30),
        sub("S-3", "A-2", D(2000, 6, 1), D(2000, 9, 1), "Basic", 5, down=True),
        sub("S-4", "A-orphan", D(2000, 2, 1), None, "Basic", 7),
    ], SUBS)
    fast = mid.subscription_summary(subs, accounts)
    joined = mid.int_account_subscriptions(subs, accounts, CTX)
    a = F.col("is_active")
    slow = joined.groupBy("account_id").agg(
        F.count("subscription_id").alias("total_subscriptions"), F.sum("mrr_amount").alias("total_mrr"),
        F.sum("arr_amount").alias("total_arr"), F.max("mrr_amount").alias("peak_mrr"),
        F.count(F.when(a, 1)).alias("active_subscriptions"),
        F.max(F.when(a, F.col("plan_tier"))).alias("current_plan_tier"),
        F.max(F.when(a, F.col("mrr_amount"))).alias("current_mrr"),
        F.bool_or("upgrade_flag").alias("ever_upgraded"), F.bool_or("downgrade_flag").alias("ever_downgraded"),
        F.max("start_date").alias("latest_subscription_start"))
    assert same(fast, slow)
    assert fast.filter("account_id = 'A-1'").first().total_subscriptions == 4


def test_latest_churn_equals_ranked_enriched_churn(spark):
    accounts = spark.createDataFrame([acct("A-1"), acct("A-2", "Basic")], ACCOUNTS)
    subs = spark.createDataFrame([
        sub("S-1", "A-1", D(2000, 1, 1), tier="Pro", mrr=10),
        sub("S-2", "A-1", D(2000, 1, 1), tier="Enterprise", mrr=20),  # tie on start -> larger id
    ], SUBS)
    churn = spark.createDataFrame([
        ("C-1", "A-1", D(2001, 1, 1), "pricing", 1.0, False, True, False, None, None),
        ("C-2", "A-1", D(2001, 1, 1), "budget", None, True, True, False, "x", None),
        ("C-3", "A-2", D(2000, 5, 1), "unknown", 2.0, True, False, False, None, None),
        ("C-4", "A-3", D(2000, 5, 1), "unknown", 2.0, False, False, False, None, None),
    ], CHURN)
    enriched = mid.int_account_churn(churn, accounts, subs)
    w = W.partitionBy("account_id").orderBy(F.col("churn_date").desc_nulls_last(), F.col("churn_event_id").desc())
    slow = enriched.withColumn("rn", F.row_number().over(w)).filter("rn = 1").drop("rn")
    fast = mid.latest_churn(churn, accounts, subs)
    assert same(fast, slow)
    got = {r.account_id: (r.churn_event_id, r.plan_tier_at_churn, r.mrr_at_churn, r.churn_path)
           for r in fast.collect()}
    assert got == {"A-1": ("C-2", "Enterprise", 20, "downgrade_to_churn"),
                   "A-2": ("C-3", "Basic", None, "upgrade_to_churn"),
                   "A-3": ("C-4", None, None, "direct_churn")}


def test_feature_usage_rollup_equals_distinct_aggregate(spark):
    subs = spark.createDataFrame([sub("S-1", "A-1", D(2000, 1, 1)), sub("S-2", "A-1", D(2000, 1, 1)),
                                  sub("S-3", "A-2", D(2000, 1, 1))], SUBS)
    usage = spark.createDataFrame([
        ("S-1", D(2001, 1, 1), "f1", 5, 3600, 1, False),
        ("S-1", D(2001, 1, 2), "f2", 9, 60, 0, True),
        ("S-2", D(2001, 1, 2), "f2", 9, 60, 2, None),
        ("S-2", D(2001, 1, 3), "f3", 9, 60, 0, None),  # tie on the count -> larger name
        ("S-2", None, None, None, None, None, True),   # NULL date / feature / measures
        ("S-3", D(2001, 2, 1), "f1", 0, 0, 0, False),  # zero usage -> NULL error rate
        ("S-9", D(2001, 2, 1), "f1", 1, 1, 1, False),  # unknown subscription: dropped
    ], USAGE)
    fast = mid.int_account_feature_usage(usage, subs)
    u = mid.usage_with_account(usage, subs)
    cnt = F.col("total_usage_count")
    slow = u.groupBy("account_id").agg(
        F.countDistinct("feature_name").alias("distinct_features_used"),
        F.sum(cnt).alias("total_usage_count"),
        F.round(F.sum("total_usage_duration_secs") / 3600.0, 2).alias("total_usage_hours"),
        F.sum("total_error_count").alias("total_error_count"),
        F.round(F.sum("total_error_count") * 100.0 / F.nullif(F.sum(cnt), F.lit(0)), 2).alias("error_rate_pct"),
        F.countDistinct(F.when(F.col("is_beta_feature"), F.col("feature_name"))).alias("beta_features_used"),
        F.max_by("feature_name", F.when(cnt.isNotNull(), F.struct(cnt, F.col("feature_name")))).alias("top_feature"),
        F.max("usage_date").alias("last_usage_date"), F.min("usage_date").alias("first_usage_date"),
        F.countDistinct("usage_date").alias("active_days"))
    assert same(fast, slow)
    a1 = fast.filter("account_id = 'A-1'").first()
    assert (a1.distinct_features_used, a1.beta_features_used, a1.top_feature, a1.active_days) == (3, 1, "f3", 3)
    assert fast.filter("account_id = 'A-2'").first().error_rate_pct is None


def test_feature_adoption_monthly_preaggregation_equals_daily_averages(spark):
    from tidemark.operators import gold
    subs = spark.createDataFrame([sub("S-1", "A-1", D(2000, 1, 1), tier="Pro"),
                                  sub("S-2", "A-2", D(2000, 1, 1), tier="Pro")], SUBS)
    usage = spark.createDataFrame([
        ("S-1", D(2001, 1, 1), "f1", 5, 100, 1, False),
        ("S-1", D(2001, 1, 9), "f1", 8, None, 0, False),      # NULL duration: left out of its average
        ("S-2", D(2001, 1, 3), "f1", 3, 50, 2, False),
        ("S-2", D(2001, 2, 3), "f1", None, None, None, False),  # all-NULL month -> NULL averages
    ], USAGE)
    got = {(r.usage_month.month, r.active_accounts, r.total_usage_count, r.avg_usage_per_account,
            r.avg_session_minutes, r.total_errors)
           for r in gold.gold_feature_adoption(usage, subs, CTX).collect()}
    assert got == {(1, 2, 16, 5.33, 1.25, 3), (2, 1, None, None, None, None)}


def test_movements_repeat_with_the_account_rows(spark):
    """Summing per account and multiplying equals joining every subscription with every account row."""
    from tidemark.operators import gold
    accounts = spark.createDataFrame([acct("A-1"), acct("A-1"), acct("A-1"), acct("A-2")], ACCOUNTS)
    subs = spark.createDataFrame([
        sub("S-1", "A-1", D(2000, 1, 1)), sub("S-2", "A-2", D(2000, 2, 1)), sub("S-3", "A-orphan", D(2000, 3, 1)),
        sub("S-4", "A-1", D(2000, 2, 1)), sub("S-5", None, D(2000, 2, 1)),
    ], SUBS)
    joined = gold.mrr_movements(mid.int_account_subscriptions(subs, accounts, CTX))
    want = joined.groupBy("month_start", "plan_tier", "mrr_type").agg(
        F.sum("mrr_amount").alias("mrr_movement"), F.count(F.lit(1)).alias("subscription_count"))
    assert same(gold.mrr_movement_agg(subs, accounts), want)
    assert joined.count() == 9


def test_null_tier_is_one_row_a_month_in_the_dense_trend(spark):
    from tidemark.operators import gold
    accounts = spark.createDataFrame([acct("A-1")], ACCOUNTS)
    subs = spark.createDataFrame([sub("S-1", "A-1", D(2001, 10, 1), tier=None), sub("S-2", "A-1", D(2001, 11, 1), tier="Pro")], SUBS)
    trends = gold.gold_mrr_trends(gold.mrr_movement_agg(subs, accounts), CTX)
    rows = gold.mrr_trends_dense(subs, trends, CTX).collect()
    grain = [(r["month_start"], r["plan_tier"]) for r in rows]
    assert len(grain) == len(set(grain)) == 6
    assert sum(r["new_subscriptions"] for r in rows) == 2
