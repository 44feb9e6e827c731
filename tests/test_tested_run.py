"""The report of a run that measures while it writes equals the suite's own, also when tests fail."""

import pytest
from pyspark.sql import functions as F

from tidemark.context import RunContext
from tidemark.operators import quality as Q
from tidemark.plans import catalog
from tidemark.plans import tested_run as T
from tidemark.plans.pipeline import GOLD_MODELS, INTERMEDIATE_MODELS, SILVER_MODELS, Pipeline

from conftest import SMALL


def report(df):
    return sorted(tuple(r[c] for c in Q.REPORT_COLUMNS) for r in df.select(*Q.REPORT_COLUMNS).collect())


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("tested"))
    return root, T.tested_run(Pipeline.from_driver_tables(spark, SMALL, RunContext.pinned()), root)


def test_report_equals_the_suite(spark, run):
    own = Pipeline.from_driver_tables(spark, SMALL, RunContext.pinned())
    got = report(run[1])
    assert len(got) == 48 and got == report(Q.run_suite(own.model))


def test_every_tested_model_has_its_wave():
    assert sorted(m for w in T.WAVES for m in w) == sorted(SILVER_MODELS + INTERMEDIATE_MODELS + GOLD_MODELS)
    assert {c.model for c in Q.SUITE} <= {m for w in T.WAVES for m in w}


def test_gold_tables_are_whole_and_checks_read_stored_columns(spark, run):
    root, df = run
    own = Pipeline.from_driver_tables(spark, SMALL, RunContext.pinned())
    for m in GOLD_MODELS:
        assert spark.read.parquet(f"{root}/{m}").columns == own.model(m).columns
    plan = df._jdf.queryExecution().executedPlan().toString()
    sources = {"/region.parquet", "/orders.parquet", "/lineitem.parquet", "/events.parquet", "/customer.parquet"}
    assert not any(s in plan for s in sources)
    keys = sum(1 if c.test != "relationships" else 2 for c in Q.SUITE if c.test in ("unique", "unique_combination", "relationships"))
    assert plan.count("FileScan") <= keys


def test_failing_tests_are_counted_alike(spark, tmp_path):
    checks = [Q.Check("stg_accounts", "industry", "not_null"), Q.Check("stg_accounts", "industry", "accepted_values", {"values": ["x"]}),
              Q.Check("stg_accounts", "plan_tier", "accepted_values", {"values": ["Basic", "Pro", "Enterprise"]}),
              Q.Check("stg_subscriptions", "account_id", "unique"), Q.Check("stg_subscriptions", "end_date", "not_null"),
              Q.Check("stg_subscriptions", "account_id", "relationships", {"to": "gold_customer_segments", "field": "account_id"}),
              Q.Check("gold_mrr_trends", "month_start", "unique")]
    got = report(T.tested_run(Pipeline.from_driver_tables(spark, SMALL, RunContext.pinned()), str(tmp_path), checks))
    assert got == report(Q.run_suite(Pipeline.from_driver_tables(spark, SMALL, RunContext.pinned()).model, checks))
    assert sum(r[3] > 0 for r in got) >= 3


def test_empty_inputs(spark, tmp_path):
    p = Pipeline.from_driver_tables(spark, SMALL, RunContext.pinned())
    for name in ("accounts", "subscriptions", "churn_events", "feature_usage", "support_tickets"):
        p.bronze._frames[name] = p.bronze.table(name).filter(F.lit(False))
    got = report(T.tested_run(p, str(tmp_path)))
    assert len(got) == 48 and all(r[3] == 0 and r[4] == "pass" for r in got)


def test_the_stored_usage_is_not_shuffled_again(spark, run):
    """Its combinations are grouped inside the buckets in which it is stored."""
    df = run[1].filter("test = 'unique_combination'")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan and "hashpartitioning(subscription_id" not in plan


def test_a_suite_computes_the_usage_once(spark):
    """What several tested models read is stored, so the report's plan holds no scan of the raw usage."""
    for kind in ("not_null", "unique"):
        plan = catalog.queries()[f"dq_{kind}"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "/lineitem.parquet" not in plan
