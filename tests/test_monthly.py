"""Monthly tables: only touched months are rewritten, and the result is a full run's."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tidemark.plans import catalog
from tidemark.plans.monthly import MONTH, MonthlyTables

from conftest import SMALL


def files(root):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(root) for f in fs if f.endswith(".parquet")}


def rows(df):
    return sorted(map(str, df.drop("updated_at").collect()))


@pytest.fixture(scope="module")
def refreshed(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("monthly"))
    first, second = catalog.two_loads(spark, SMALL)
    MonthlyTables(first, root).write_all()
    before = files(root)
    tables = MonthlyTables(second, root)
    return root, before, tables, tables.refresh(catalog.FIRST_LOAD)


@pytest.mark.parametrize("table", sorted(MONTH))
def test_result_is_a_full_runs(spark, refreshed, table):
    _, _, tables, _ = refreshed
    assert rows(tables.read(table)) == rows(tables.p.model(table))


@pytest.mark.parametrize("table", sorted(MONTH))
def test_only_touched_months_are_rewritten(refreshed, table):
    root, before, _, touched = refreshed
    mine = {f for f in before if f"/{table}/" in f}
    after = files(root)
    kept = {f for f in mine if after.get(f) == before[f]}
    gone = {f.split(f"{MONTH[table]}=")[1].split("/")[0][:10] for f in mine - kept}
    new = {f.split(f"{MONTH[table]}=")[1].split("/")[0][:10] for f in after if f"/{table}/" in f and f not in mine}
    months = {str(m)[:10] if m else "__HIVE_DEF" for m in touched[table]}
    assert kept and new and gone <= months and new <= months


def test_nothing_new_touches_nothing(refreshed):
    root, _, tables, _ = refreshed
    before = files(root)
    assert all(m == [] for m in tables.refresh(dt.datetime(2002, 1, 1)).values())
    assert files(root) == before


def test_a_new_account_row_touches_the_months_of_its_subscriptions(spark, tmp_path):
    _, p = catalog.two_loads(spark, SMALL)
    account = p.stg_subscriptions.filter("NOT is_trial").first()["account_id"]
    again = p.bronze.accounts.filter(F.col("account_id") == account).withColumn("ingestion_ts", F.lit(dt.datetime(2001, 12, 5)))
    assert again.count() >= 1
    MonthlyTables(p, str(tmp_path)).write_all()
    _, q = catalog.two_loads(spark, SMALL)
    q.bronze._frames["accounts"] = q.bronze.accounts.unionByName(again)
    tables = MonthlyTables(q, str(tmp_path))
    touched = tables.refresh(dt.datetime(2001, 12, 2))
    assert touched["gold_mrr_trends"] and not touched["gold_support_performance"]
    assert rows(tables.read("gold_mrr_trends")) == rows(q.gold_mrr_trends)


def test_rows_without_a_month(spark, tmp_path):
    _, p = catalog.two_loads(spark, SMALL)
    MonthlyTables(p, str(tmp_path)).write_all()
    _, q = catalog.two_loads(spark, SMALL)
    lost = q.bronze.support_tickets.limit(3).withColumns({"submitted_at": F.lit(None).cast("timestamp"), "ingestion_ts": F.lit(dt.datetime(2001, 12, 5)),
                                                          "account_id": F.lit("A-1")})
    q.bronze._frames["support_tickets"] = q.bronze.support_tickets.unionByName(lost)
    tables = MonthlyTables(q, str(tmp_path))
    assert tables.refresh(dt.datetime(2001, 12, 2))["gold_support_performance"] == [None]
    assert rows(tables.read("gold_support_performance")) == rows(q.gold_support_performance)


def test_usage_is_read_once_to_find_its_months(spark, tmp_path, monkeypatch):
    """New usage and usage of new subscriptions are found by one reading; before, the inputs of the usage were joined for each."""
    _, q = catalog.two_loads(spark, SMALL)
    monkeypatch.setattr(MonthlyTables, "_at_once", lambda self, jobs: [plans.append(job.__self__) or [] for job in jobs])
    plans = []
    MonthlyTables(q, str(tmp_path)).touched(catalog.FIRST_LOAD)
    text = plans[1]._jdf.queryExecution().optimizedPlan().toString()
    assert len(plans) == 3 and text.count("l_orderkey#") and text.count("Relation [l_orderkey") == 1


def test_adoption_shuffles_the_usage_once_for_its_join(spark):
    """Daily rows go to the join as they are: one exchange by subscription, none for sums by month before it."""
    _, q = catalog.two_loads(spark, SMALL)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = q.gold_feature_adoption._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    below = plan[plan.index("SortMergeJoin"):]
    assert below.count("Exchange hashpartitioning(subscription_id") == 3  # rollup, both sides of the join
