"""End-to-end runs: CSV landing -> catalog bronze -> gold tables, and path-based gold output."""

from tidemark.context import RunContext, scratch_path
from tidemark.plans import catalog
from tidemark.plans.pipeline import GOLD_MODELS, Pipeline
from tidemark.sources import bronze as B

from conftest import SMALL


def test_catalog_run_matches_lazy_models(spark):
    ctx = RunContext.pinned()
    landing = catalog._land_csv(spark, SMALL, ["accounts", "subscriptions", "churn_events",
                                                "feature_usage", "support_tickets"])
    B.ingest_all_to_catalog(spark, landing, "tm_test", ctx)
    names = {r.table_name for r in B.catalog_tables(spark, "tm_test").collect()}
    assert {"bronze_accounts", "bronze_subscriptions", "bronze_feature_usage"} <= names

    p = Pipeline.from_catalog(spark, "tm_test", ctx)
    written = p.run("tm_gold", as_tables=True)
    assert set(written) == {*GOLD_MODELS, "int_account_360"}
    lazy = Pipeline.from_driver_tables(spark, SMALL, ctx)
    for model in (*GOLD_MODELS, "int_account_360"):
        got, want = spark.table(f"tm_gold.{model}"), lazy.model(model)
        cols = want.columns
        assert got.select(cols).exceptAll(want.select(cols)).count() == 0, model
        assert want.select(cols).exceptAll(got.select(cols)).count() == 0, model


def test_path_run_stores_the_spine_as_a_table(spark):
    p = Pipeline.from_driver_tables(spark, SMALL)
    out = p.run(scratch_path(spark, "test-gold"))
    assert spark.read.parquet(out["int_account_360"]).count() == p.stg_accounts.count()
    health = spark.read.parquet(out["gold_account_health_summary"])
    assert health.count() == p.stg_accounts.count()


def test_scratch_output_lives_under_the_sessions_checkpoint_dir(spark):
    from tidemark.context import shared_dir

    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert shared_dir(spark) == configured
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a.startswith(configured.rstrip("/")) and a != b  # fresh location per call
