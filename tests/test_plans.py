"""Plan-shape guards: what must never appear in a registered query's physical plan,
and a hot key really being split by AQE at run time."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.plans import catalog
from tidemark.context import RunContext
from tidemark.operators import intermediate as mid

from conftest import SMALL

FORBIDDEN = {
    "CartesianProduct": "cross join",
    "BroadcastNestedLoopJoin": "non-equi / cross join",
    "BatchEvalPython": "row-at-a-time Python UDF",
    "ArrowEvalPython": "Python UDF in the hot path",
    "Window ": "window over a whole partition group (a hot key would land in one task)",
}


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_no_forbidden_operators(spark, name):
    plan = catalog.queries()[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    for op, why in FORBIDDEN.items():
        assert op not in plan, f"{name}: {op} ({why})"


def test_scans_read_only_needed_columns(spark):
    plan = catalog.queries()["gold_support_performance"](spark, SMALL)._jdf.queryExecution() \
        .executedPlan().toString()
    # the ticket KPIs need 5 of the 6 event columns; the JSON payload column is never read
    assert "props" not in plan


ACCOUNTS = ("account_id string, account_name string, industry string, country string, signup_date date, "
            "referral_source string, plan_tier string, seats int, is_trial boolean, churn_flag boolean, "
            "ingestion_ts timestamp")


def test_hot_account_is_split_by_adaptive_skew_join(spark):
    """One account holds over a third of the subscriptions; AQE splits it and the result stays exact."""
    n = 30000
    subs = spark.range(n).select(
        F.concat(F.lit("S-"), F.col("id").cast("string")).alias("subscription_id"),
        F.when(F.col("id") % 3 == 0, F.lit("A-hot"))
        .otherwise(F.concat(F.lit("A-"), (F.col("id") % 500).cast("string"))).alias("account_id"),
        F.lit(dt.date(2000, 1, 1)).alias("start_date"), F.lit(None).cast("date").alias("end_date"),
        F.lit("Pro").alias("plan_tier"), F.lit(1).alias("seats"), F.col("id").alias("mrr_amount"),
        (F.col("id") * 12).alias("arr_amount"), F.lit(False).alias("is_trial"), F.lit(False).alias("upgrade_flag"),
        F.lit(False).alias("downgrade_flag"), F.lit(False).alias("churn_flag"), F.lit("monthly").alias("billing_frequency"),
        F.lit(True).alias("auto_renew_flag"), F.lit(None).cast("timestamp").alias("ingestion_ts"),
    ).repartition(8)
    accounts = spark.range(500).select(
        F.concat(F.lit("A-"), F.col("id").cast("string")).alias("account_id"),
        *[F.lit(None).cast(t).alias(c) for c, t in [("account_name", "string"), ("industry", "string"),
                                                     ("country", "string"), ("signup_date", "date"),
                                                     ("referral_source", "string"), ("plan_tier", "string"),
                                                     ("seats", "int"), ("is_trial", "boolean"),
                                                     ("churn_flag", "boolean"), ("ingestion_ts", "timestamp")]],
    ).unionByName(spark.createDataFrame([("A-hot", "hot", None, None, None, None, None, None, None, None, None)],
                                        ACCOUNTS))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        df = mid.int_account_subscriptions(subs, accounts, RunContext.pinned())
        rows = df.groupBy("account_id").agg(F.count(F.lit(1)).alias("n"), F.sum("mrr_amount").alias("m"))
        got = {r.account_id: (r.n, r.m) for r in rows.collect()}
        out = df.select("subscription_id", "account_name")
        assert len(out.collect()) == n
        final = out._jdf.queryExecution().executedPlan().toString()  # the adaptive plan, now final
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert got["A-hot"] == (n // 3, sum(range(0, n, 3)))
    assert sum(v[0] for v in got.values()) == n
    assert "skew=true" in final.replace(" ", "") or "isSkewJoin=true" in final.replace(" ", ""), final[:2000]


CHURN = ("churn_event_id string, account_id string, churn_date date, reason_code string, "
         "refund_amount_usd double, preceding_upgrade_flag boolean, preceding_downgrade_flag boolean, "
         "is_reactivation boolean, feedback_text string, ingestion_ts timestamp")


def test_hot_account_in_churn_facts_is_split(spark):
    """Churn facts meet both per-account dimensions in one join, so a hot account can be split."""
    n = 30000
    churn = spark.range(n).select(
        F.concat(F.lit("C-"), F.col("id").cast("string")).alias("churn_event_id"),
        F.when(F.col("id") % 3 == 0, F.lit("A-hot"))
        .otherwise(F.concat(F.lit("A-"), (F.col("id") % 500).cast("string"))).alias("account_id"),
        F.lit(dt.date(2001, 1, 1)).alias("churn_date"), F.lit("pricing").alias("reason_code"),
        F.lit(1.0).alias("refund_amount_usd"), F.lit(False).alias("preceding_upgrade_flag"),
        F.lit(False).alias("preceding_downgrade_flag"), F.lit(False).alias("is_reactivation"),
        F.lit(None).cast("string").alias("feedback_text"), F.lit(None).cast("timestamp").alias("ingestion_ts"),
    ).repartition(8)
    accounts = spark.createDataFrame(
        [(f"A-{i}", "n", None, None, dt.date(2000, 1, 1), None, "Pro", 1, False, False, None) for i in range(500)]
        + [("A-hot", "hot", None, None, dt.date(2000, 1, 1), None, "Pro", 1, False, False, None)], ACCOUNTS)
    subs = spark.createDataFrame(
        [("S-1", "A-hot", dt.date(2000, 1, 1), None, "Enterprise", 1, 50, 600, False, False, False, False,
          "annual", True, None)],
        "subscription_id string, account_id string, start_date date, end_date date, plan_tier string, seats int, "
        "mrr_amount bigint, arr_amount bigint, is_trial boolean, upgrade_flag boolean, downgrade_flag boolean, "
        "churn_flag boolean, billing_frequency string, auto_renew_flag boolean, ingestion_ts timestamp")
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        df = mid.int_account_churn(churn, accounts, subs).select("churn_event_id", "account_id", "mrr_at_churn")
        rows = df.collect()
        final = df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert len(rows) == n
    assert sum(1 for r in rows if r.account_id == "A-hot" and r.mrr_at_churn == 50) == n // 3
    assert "skew=true" in final.replace(" ", ""), final[:2000]


@pytest.mark.parametrize("name", ["int_account_feature_usage", "int_account_360"])
def test_usage_is_scanned_once(spark, name):
    """Features and days are counted in one pass over the usage."""
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = catalog.queries()[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert plan.count("lineitem.parquet") == 1
    assert plan.count("Exchange hashpartitioning") <= {"int_account_feature_usage": 7, "int_account_360": 16}[name]
