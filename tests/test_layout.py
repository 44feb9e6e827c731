"""Bucketed usage, stored lookups, views of a run."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.context import RunContext
from tidemark.operators import quality as Q
from tidemark.plans import catalog, layout
from tidemark.plans.pipeline import Pipeline

from conftest import SMALL


@pytest.mark.parametrize("name", ["bucketed_feature_usage", "bucketed_feature_adoption"])
def test_no_exchange_below_the_join(spark, name):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = catalog.queries()[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    below = plan[plan.index("SortMergeJoin"):]
    assert "Exchange" not in below and "Bucketed: true" in below and "Exchange" in plan


def test_hot_subscription_is_combined_before_it_is_bucketed(spark, tmp_path):
    """A subscription with a third of all raw rows has one row for each of its days and features in its bucket."""
    n = 30_000
    raw = spark.range(n).select(
        F.col("id").cast("string").alias("usage_id"),
        F.when(F.col("id") % 3 == 0, "S-hot").otherwise(F.concat(F.lit("S-"), (F.col("id") % 500).cast("string"))).alias("subscription_id"),
        F.date_add(F.lit(dt.date(2001, 1, 1)), (F.col("id") % 7).cast("int")).alias("usage_date"),
        F.concat(F.lit("feature_"), (F.col("id") % 5).cast("string")).alias("feature_name"),
        F.lit(1).cast("long").alias("usage_count"), F.lit(60).cast("long").alias("usage_duration_secs"),
        F.lit(0).alias("error_count"), F.lit(False).alias("is_beta_feature"))
    p = Pipeline.from_driver_tables(spark, SMALL, RunContext.pinned())
    p.bronze._frames["feature_usage"] = raw
    subscriptions = p.stg_subscriptions.limit(1).withColumn("subscription_id", F.lit("S-hot"))
    p.__dict__["stg_subscriptions"] = subscriptions
    stored = layout.store_usage_layout(p, str(tmp_path), buckets=4)
    assert stored.stg_feature_usage.filter("subscription_id = 'S-hot'").count() == 35
    row = stored.int_account_feature_usage.first()
    assert (row["total_usage_count"], row["distinct_features_used"], row["active_days"]) == (n // 3, 5, 7)


def test_buckets_grow_with_the_input(spark, tmp_path, monkeypatch):
    """A task's share of the join stays the same: a fixed number of buckets would make it grow with the input."""
    p = Pipeline.from_driver_tables(spark, SMALL, RunContext.pinned())
    assert layout.buckets_for(p.bronze.feature_usage) == layout.MIN_BUCKETS
    monkeypatch.setattr(layout, "BUCKET_BYTES", 1 << 12)
    many = layout.buckets_for(p.bronze.feature_usage)
    assert many > 2 * layout.MIN_BUCKETS
    usage = catalog.queries()["bucketed_feature_usage"](spark, SMALL)
    assert f"SelectedBucketsCount: {many} out of {many}" in usage._jdf.queryExecution().executedPlan().toString()


def test_bucketed_tables_are_sorted_and_complete(spark, tmp_path):
    p = Pipeline.from_driver_tables(spark, SMALL, RunContext.pinned())
    stored = layout.store_usage_layout(p, str(tmp_path), buckets=4, prefix="layout_test_")
    assert stored.stg_feature_usage.exceptAll(p.stg_feature_usage).count() == 0
    assert stored.stg_feature_usage.count() == p.stg_feature_usage.count()
    detail = {r["col_name"]: r["data_type"] for r in spark.sql("DESCRIBE EXTENDED layout_test_usage_daily").collect()}
    assert detail["Num Buckets"] == "4" and "subscription_id" in detail["Bucket Columns"] and "subscription_id" in detail["Sort Columns"]


def rows_scanned(df):
    """Rows that the scan has put out, from the executed plan's metrics."""
    qe = df._jdf.queryExecution()
    qe.executedPlan().executeCollect()
    plan, todo = None, [qe.executedPlan()]
    while todo:
        node = todo.pop()
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            todo.append(node.executedPlan())
        elif node.nodeName().startswith("Scan"):
            plan = node
        elif node.nodeName().startswith(("ShuffleQueryStage", "ResultQueryStage")) or "QueryStage" in node.nodeName():
            todo.append(node.plan())
        else:
            children = node.children()
            todo += [children.apply(i) for i in range(children.size())]
    return plan.metrics().apply("numOutputRows").value()


def test_lookups_skip_row_groups(spark, tmp_path):
    n = 40_000
    df = spark.range(n).select(F.concat(F.lit("U-"), F.sha1(F.col("id").cast("string"))).alias("usage_id"),
                               F.concat(F.lit("S-"), (F.col("id") % 5000).cast("string")).alias("subscription_id"),
                               F.lit(dt.date(2001, 1, 1)).alias("usage_date"), F.lit("feature_1").alias("feature_name"))
    path = str(tmp_path / "lookup")
    layout.store_for_lookup(df, path, catalog.USAGE_GRAIN, ["usage_id"], partitions=16)
    table = layout.lookup_table(spark, path)
    wanted = df.first()["usage_id"]
    by_id = Q.lookup(table, usage_id=wanted)
    assert by_id.count() == 1 and rows_scanned(Q.lookup(table, usage_id=wanted)) < n / 4
    by_grain = Q.lookup(table, subscription_id="S-42", feature_name="feature_1")
    assert by_grain.count() == n / 5000 and rows_scanned(Q.lookup(table, subscription_id="S-42", feature_name="feature_1")) < n / 4


def test_views_of_a_run(spark, tmp_path):
    p = Pipeline.from_driver_tables(spark, SMALL, RunContext.pinned())
    p.run(str(tmp_path), ["gold_customer_segments"], views="v_")
    assert spark.sql("SELECT count(*) AS n FROM v_stg_accounts").first()["n"] == p.stg_accounts.count()
    joined = spark.sql("SELECT count(*) AS n FROM v_int_account_360 a JOIN v_int_account_support s USING (account_id)").first()["n"]
    assert joined == p.int_account_support.count()
    assert str(tmp_path) in spark.table("v_int_account_360").inputFiles()[0]  # the stored spine
