"""Registered queries: name -> (Spark builder, oracle SQL or None).

Every builder takes ``(spark, sf_dir)``, derives the bronze inputs from the
driver tables under ``sf_dir`` with the pinned run context, and returns a
lazy DataFrame over the whole tables.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.context import RunContext
from tidemark.operators import gold
from tidemark.plans import oracle as O
from tidemark.plans.pipeline import Pipeline

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    build: Builder
    sql: str | None


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None):
    def deco(fn: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        REGISTRY[name] = Query(name, fn, O.with_ctes(sql) if sql else None)
        return fn
    return deco


def pipeline(spark: SparkSession, sf_dir: str) -> Pipeline:
    return Pipeline.from_driver_tables(spark, sf_dir, RunContext.pinned())


def _model_query(key: str, model: str, sql: str) -> None:
    register(key, sql)(lambda spark, sf_dir: pipeline(spark, sf_dir).model(model))


# ---- silver
_model_query("stg_accounts", "stg_accounts", "SELECT * FROM s_accounts")
_model_query("stg_subscriptions", "stg_subscriptions", "SELECT * FROM s_subscriptions")
_model_query("stg_churn_events", "stg_churn_events", "SELECT * FROM s_churn")
_model_query("stg_support_tickets", "stg_support_tickets", "SELECT * FROM s_tickets")
_model_query("stg_feature_usage", "stg_feature_usage", "SELECT * FROM s_usage")

# ---- intermediate
_model_query("int_account_subscriptions", "int_account_subscriptions", "SELECT * FROM i_subs")
_model_query("latest_subscription", "latest_subscription", "SELECT * FROM i_latest_sub")
_model_query("int_account_churn", "int_account_churn", "SELECT * FROM i_churn")
_model_query("latest_churn", "latest_churn", "SELECT * FROM i_latest_churn")
_model_query("int_account_support", "int_account_support", "SELECT * FROM i_support")
_model_query("int_account_feature_usage", "int_account_feature_usage", "SELECT * FROM i_usage")
_model_query("subscription_summary", "subscription_summary", "SELECT * FROM i_sub_summary")
_model_query("int_account_360", "int_account_360", "SELECT * FROM i_360")

# ---- gold
_model_query("gold_account_health_summary", "gold_account_health_summary", "SELECT * FROM g_health")
_model_query("gold_customer_segments", "gold_customer_segments", "SELECT * FROM g_segments")
_model_query("gold_churn_analysis", "gold_churn_analysis", "SELECT * FROM g_churn")
_model_query("mrr_movements", "mrr_movements", "SELECT month_start, plan_tier, mrr_amount, mrr_type FROM g_moves")
_model_query("mrr_movement_agg", "mrr_movement_agg", "SELECT * FROM g_move_agg")
_model_query("gold_mrr_trends", "gold_mrr_trends", "SELECT * FROM g_mrr")
_model_query("month_spine", "month_spine", "SELECT month_start FROM g_spine")
_model_query("mrr_trends_dense", "mrr_trends_dense", "SELECT * FROM g_mrr_dense")
_model_query("gold_feature_adoption", "gold_feature_adoption", "SELECT * FROM g_features")
_model_query("gold_support_performance", "gold_support_performance", "SELECT * FROM g_support")

AT_RISK_K = 50


@register("at_risk_topk", f"SELECT * FROM g_segments ORDER BY health_score, account_id LIMIT {AT_RISK_K}")
def at_risk_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.at_risk_accounts(pipeline(spark, sf_dir).gold_customer_segments, AT_RISK_K)


def queries() -> dict[str, Builder]:
    return {n: q.build for n, q in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {n: q.sql for n, q in REGISTRY.items() if q.sql}


# ---------------------------------------------------------------- subscription history
from tidemark.operators import history as H  # noqa: E402
from tidemark.sources.fixtures import subscription_batches  # noqa: E402

AS_OF_PROBE = "2001-11-15 00:00:00"


def subscription_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History after the three batches, merged in order from an empty history."""
    batches = subscription_batches(pipeline(spark, sf_dir).stg_subscriptions)
    stamp, first = batches[0]
    hist = H.open_versions(first, stamp)
    for stamp, batch in batches[1:]:
        hist = H.merge_batch(hist, batch, stamp)
    return hist


register("snap_subscriptions_scd2", "SELECT * FROM h_history")(subscription_history)


@register("snap_subscriptions_stored", "SELECT * FROM h_history")
def subscription_history_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same three batches applied through the persistent store (one write per batch)."""
    from tidemark.context import scratch_path  # noqa: PLC0415

    store = H.HistoryStore(spark, scratch_path(spark, "history"))
    for stamp, batch in subscription_batches(pipeline(spark, sf_dir).stg_subscriptions):
        store.apply(batch, stamp)
    return store.read()


@register("snap_late_batch", "SELECT * FROM h_history")
def subscription_history_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three batches, the second one delivered last: the same history."""
    from tidemark.context import scratch_path  # noqa: PLC0415

    store = H.HistoryStore(spark, scratch_path(spark, "history"))
    first, second, third = subscription_batches(pipeline(spark, sf_dir).stg_subscriptions)
    for stamp, batch in (first, third, second):
        store.apply(batch, stamp)
    return store.read()


@register("snap_as_of", f"SELECT * FROM h_history WHERE valid_from <= TIMESTAMP '{AS_OF_PROBE}' "
                        f"AND (valid_to IS NULL OR valid_to > TIMESTAMP '{AS_OF_PROBE}')")
def snap_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return H.as_of(subscription_history(spark, sf_dir), AS_OF_PROBE)


# ---------------------------------------------------------------- stored support percentiles
from tidemark.operators.support_sketches import SupportSketches  # noqa: E402


@register("support_percentiles_merged",
          "SELECT ticket_month, priority, total_tickets, avg_resolution_time_hours, median_resolution_time_hours, p95_resolution_time_hours, "
          "avg_first_response_minutes, median_first_response_minutes FROM g_support")
def support_percentiles_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantile sketches of three deliveries of the tickets, stored by month and merged on read."""
    from tidemark.context import scratch_path  # noqa: PLC0415

    tickets = pipeline(spark, sf_dir).stg_support_tickets
    store = SupportSketches(spark, scratch_path(spark, "support-sketches"))
    for k in range(3):
        store.add(tickets.filter(F.crc32("ticket_id") % 3 == k), f"d{k}")
    return store.report()


# ---------------------------------------------------------------- data quality
from tidemark.operators import quality as Q  # noqa: E402


def _suite(kinds):
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        # The account spine carries 11 of the checks: it is stored once, when the first of them asks for it.
        # The usage is stored for what reads it more than once: its rollup per account, the spine and the adoption report.
        p = Pipeline.from_driver_tables(spark, sf_dir, RunContext.pinned(), materialize_spine=True)
        tested = {c.model for c in Q.SUITE if c.test in kinds}
        if {"stg_feature_usage", "gold_feature_adoption"} <= tested:
            buckets = L.buckets_for(p.bronze.feature_usage)
            p.__dict__["stg_feature_usage"] = L.store_usage(p.stg_feature_usage.repartition(buckets, "subscription_id"), scratch_path(spark, "usage"), buckets)
        if {"int_account_feature_usage", "int_account_360"} <= tested:
            p.store("int_account_feature_usage")
        return Q.run_suite(p.model, kinds=kinds)
    return build


for _kind in Q.TEST_KINDS:
    register(f"dq_{_kind}", O.dq_report_sql([c for c in Q.SUITE if c.test == _kind]))(_suite([_kind]))


@register("dq_report", O.dq_report_sql(Q.SUITE))
def dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All declared tests, measured by a run while it writes the models."""
    from tidemark.context import scratch_path  # noqa: PLC0415
    from tidemark.plans.tested_run import tested_run  # noqa: PLC0415

    return tested_run(pipeline(spark, sf_dir), scratch_path(spark, "tested-run"))


@register("dq_duplicates_bronze", "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, {k} AS key_value, count(*) AS n_records FROM b_{t} "
    f"WHERE {k} IS NOT NULL GROUP BY {k} HAVING count(*) > 1" for t, k in Q.BRONZE_KEYS.items()))
def dq_duplicates_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.bronze_duplicates(pipeline(spark, sf_dir).bronze.as_dict())


@register("dq_duplicates_usage_grain",
          "SELECT subscription_id, usage_date, feature_name, count(*) AS n_records FROM b_feature_usage "
          "GROUP BY subscription_id, usage_date, feature_name HAVING count(*) > 1")
def dq_duplicates_usage_grain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.usage_grain_duplicates(pipeline(spark, sf_dir).bronze.feature_usage)


@register("dq_multi_subscription_accounts",
          "SELECT account_id, count(*) AS n_subscriptions FROM s_subscriptions "
          "GROUP BY account_id HAVING count(*) > 1")
def dq_multi_subscription_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.multi_subscription_accounts(pipeline(spark, sf_dir).stg_subscriptions)


@register("dq_open_subscriptions",
          "SELECT count(*) FILTER (WHERE end_date IS NULL) AS open_subscriptions FROM s_subscriptions")
def dq_open_subscriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.open_subscriptions(pipeline(spark, sf_dir).stg_subscriptions)


@register("dq_row_lookup",
          "SELECT * FROM b_feature_usage WHERE usage_id IN "
          "(SELECT usage_id FROM b_feature_usage GROUP BY usage_id HAVING count(*) > 1)")
def dq_row_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.duplicate_rows(pipeline(spark, sf_dir).bronze.feature_usage, "usage_id")


# ---------------------------------------------------------------- bronze sources and sinks
from tidemark.context import scratch_path  # noqa: E402
from tidemark.sources import bronze as B  # noqa: E402
from tidemark.sources import fixtures as FX  # noqa: E402
from tidemark.sources.schemas import BRONZE_SCHEMAS, SOURCE_FILES, STAMP  # noqa: E402


def _source_frames(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The five inputs as they arrive (CSV rows, before the stamp)."""
    return {n: df.drop(STAMP) for n, df in FX.load_bronze(spark, sf_dir).as_dict().items()}


def _land_csv(spark: SparkSession, sf_dir: str, tables: list[str]) -> str:
    """Write the source frames as CSV files under a fresh shared location."""
    root = scratch_path(spark, "landing")
    frames = _source_frames(spark, sf_dir)
    for t in tables:
        B.write_csv(frames[t], f"{root}/{t}.csv")
    return root


@register("bronze_csv_roundtrip", "SELECT * EXCLUDE (ingestion_ts) FROM b_subscriptions")
def bronze_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _land_csv(spark, sf_dir, ["subscriptions"])
    return B.read_csv(spark, f"{root}/subscriptions.csv", "subscriptions")


@register("bronze_csv_reordered", "SELECT * EXCLUDE (ingestion_ts) FROM b_subscriptions")
def bronze_csv_reordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A delivery with its columns in another order and one more column: read by name."""
    path = f"{scratch_path(spark, 'landing')}/subscriptions.csv"
    df = _source_frames(spark, sf_dir)["subscriptions"]
    B.write_csv(df.select(*reversed(df.columns), F.lit("x").alias("note")), path)
    return B.read_csv(spark, path, "subscriptions")


@register("bronze_csv_deliveries", """
SELECT * EXCLUDE (ingestion_ts) REPLACE (
    CASE WHEN seats % 3 = 1 THEN true ELSE auto_renew_flag END AS auto_renew_flag,
    CASE WHEN seats % 3 = 2 THEN NULL ELSE billing_frequency END AS billing_frequency) FROM b_subscriptions""")
def bronze_csv_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three deliveries with different headers: a whole one, an older one without a column, and one in another order with a column less and one more."""
    root = scratch_path(spark, "landing")
    df = _source_frames(spark, sf_dir)["subscriptions"]
    third = F.coalesce(F.col("seats") % 3, F.lit(0))
    B.write_csv(df.where(third == 0), f"{root}/day1")
    B.write_csv(df.where(third == 1).drop("auto_renew_flag"), f"{root}/day2")
    B.write_csv(df.where(third == 2).drop("billing_frequency").select(F.lit("x").alias("note"), *[c for c in reversed(df.columns) if c != "billing_frequency"]), f"{root}/day3")
    return B.read_deliveries(spark, B.deliveries(spark, root), "subscriptions", {"auto_renew_flag": True, "billing_frequency": None})


@register("bronze_csv_malformed", "SELECT count(*) AS malformed_rows FROM b_subscriptions WHERE seats % 7 = 3 AND mrr_amount IS NOT NULL")
def bronze_csv_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines whose values do not fit the declared types, counted: nothing becomes NULL unseen."""
    path = f"{scratch_path(spark, 'landing')}/subscriptions.csv"
    df = _source_frames(spark, sf_dir)["subscriptions"]
    broken = F.when(F.col("seats") % 7 == 3, F.concat(F.col("mrr_amount").cast("string"), F.lit(".99"))).otherwise(F.col("mrr_amount").cast("string"))
    B.write_csv(df.withColumn("mrr_amount", broken), path)
    return B.malformed_rows(spark, path, "subscriptions").agg(F.count(F.lit(1)).alias("malformed_rows"))


@register("row_lookup_ordered", "SELECT * FROM s_subscriptions WHERE account_id = 'A-1' ORDER BY start_date DESC")
def row_lookup_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The point lookup: all subscriptions of one account, latest first."""
    return Q.lookup(pipeline(spark, sf_dir).stg_subscriptions, order_by="start_date", account_id="A-1")


def _stored(spark: SparkSession, sf_dir: str, model: str) -> DataFrame:
    root = scratch_path(spark, "run")
    return spark.read.parquet(Pipeline.from_driver_tables(spark, sf_dir, RunContext.pinned()).run(root, [model])[model])


@register("stored_mrr_trends_ordered", "SELECT * FROM g_mrr ORDER BY month_start, plan_tier")
def stored_mrr_trends_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trends as a run stores them, read back in presentation order."""
    return gold.ordered("gold_mrr_trends", _stored(spark, sf_dir, "gold_mrr_trends"))


@register("stored_account_360", "SELECT * FROM i_360")
def stored_account_360(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The account spine as a table of its own."""
    return _stored(spark, sf_dir, "int_account_360")


@register("bronze_stamp", "SELECT * FROM b_accounts")
def bronze_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _land_csv(spark, sf_dir, ["accounts"])
    return B.stamp(B.read_csv(spark, f"{root}/accounts.csv", "accounts"), RunContext.pinned())


def _ingest_twice(spark: SparkSession, sf_dir: str, mode: str) -> DataFrame:
    root = _land_csv(spark, sf_dir, ["accounts"])
    target = scratch_path(spark, "bronze", "accounts")
    for _ in range(2):
        B.ingest(spark, f"{root}/accounts.csv", "accounts", target, RunContext.pinned(), mode=mode)
    return spark.read.parquet(target)


@register("bronze_overwrite", "SELECT * FROM b_accounts")
def bronze_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ingest_twice(spark, sf_dir, "overwrite")


@register("bronze_append", "SELECT * FROM b_accounts UNION ALL SELECT * FROM b_accounts")
def bronze_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ingest_twice(spark, sf_dir, "append")


def _profile_sql() -> str:
    parts = []
    for t, schema in BRONZE_SCHEMAS.items():
        fields = [(f.name, f.dataType.simpleString()) for f in schema.fields] + [(STAMP, "timestamp")]
        for i, (c, typ) in enumerate(fields):
            parts.append(f"SELECT '{t}' AS table_name, {i + 1} AS ordinal, '{c}' AS column_name, "
                         f"'{typ}' AS data_type, count(*) AS row_count, "
                         f"count(*) FILTER (WHERE {c} IS NULL) AS null_count FROM b_{t}")
    return "\nUNION ALL\n".join(parts)


@register("bronze_ingest_all", _profile_sql())
def bronze_ingest_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The load loop: land all five CSVs, ingest each, profile what was written."""
    root = _land_csv(spark, sf_dir, list(BRONZE_SCHEMAS))
    written = B.ingest_all(spark, root, scratch_path(spark, "bronze"), RunContext.pinned(), files=SOURCE_FILES)
    return B.table_profile({t: spark.read.parquet(p) for t, p in written.items()})


@register("table_profile", _profile_sql())
def table_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.table_profile(pipeline(spark, sf_dir).bronze.as_dict())


@register("preview_accounts", "SELECT * FROM b_accounts ORDER BY account_id LIMIT 10")
def preview_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.preview(pipeline(spark, sf_dir).bronze.accounts, "account_id", 10)


@register("stored_feature_adoption_ordered",
          "SELECT * FROM g_features ORDER BY usage_month DESC, active_accounts DESC, feature_name, plan_tier, is_beta_feature")
def stored_feature_adoption_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature adoption as a run stores it, read back in presentation order."""
    return gold.ordered("gold_feature_adoption", _stored(spark, sf_dir, "gold_feature_adoption"))


@register("stored_support_performance_ordered", "SELECT * FROM g_support ORDER BY ticket_month DESC, priority")
def stored_support_performance_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The support report as a run stores it, read back in presentation order."""
    return gold.ordered("gold_support_performance", _stored(spark, sf_dir, "gold_support_performance"))


# ---------------------------------------------------------------- catalog
@register("catalog_after_ingest", "\nUNION ALL\n".join(
    f"SELECT 'bronze_{t}' AS table_name, false AS is_temporary, true AS in_new_schema, count(*) AS n_rows FROM b_{t}" for t in BRONZE_SCHEMAS))
def catalog_after_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Create a schema, load the five inputs into it, switch to it and list its tables with their row counts."""
    import uuid  # noqa: PLC0415

    schema, before = f"ingest_{uuid.uuid4().hex}", spark.catalog.currentDatabase()
    B.ensure_schema(spark, schema, scratch_path(spark, "schema"))
    B.ingest_all_to_catalog(spark, _land_csv(spark, sf_dir, list(BRONZE_SCHEMAS)), schema, RunContext.pinned())
    spark.catalog.setCurrentDatabase(schema)
    try:
        here = B.current_schema(spark).first()["current_schema"]
        listed = B.catalog_tables(spark).filter(F.col("database") == F.lit(here))
    finally:
        spark.catalog.setCurrentDatabase(before)
    counts = B.union_all([spark.table(f"{schema}.bronze_{t}").agg(F.count(F.lit(1)).alias("n_rows")).withColumn("table_name", F.lit(f"bronze_{t}"))
                          for t in BRONZE_SCHEMAS])
    return listed.join(counts, "table_name").select("table_name", "is_temporary", (F.col("database") == F.lit(schema)).alias("in_new_schema"), "n_rows")


# ---------------------------------------------------------------- stored layouts
from tidemark.plans import layout as L  # noqa: E402


def _bucketed(spark: SparkSession, sf_dir: str) -> Pipeline:
    return L.store_usage_layout(pipeline(spark, sf_dir), scratch_path(spark, "usage-layout"))


@register("bucketed_feature_usage", "SELECT * FROM i_usage")
def bucketed_feature_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The usage rollup per account over bucketed tables: no exchange below the join."""
    return _bucketed(spark, sf_dir).int_account_feature_usage


@register("bucketed_feature_adoption", "SELECT * FROM g_features")
def bucketed_feature_adoption(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature adoption over bucketed tables: no exchange below the join."""
    return _bucketed(spark, sf_dir).gold_feature_adoption


USAGE_GRAIN = ["subscription_id", "usage_date", "feature_name"]


def _usage_for_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "usage-lookup")
    L.store_for_lookup(pipeline(spark, sf_dir).bronze.feature_usage, path, USAGE_GRAIN, ["usage_id"])
    return L.lookup_table(spark, path)


@register("usage_lookup_by_id", "SELECT * FROM b_feature_usage WHERE usage_id = 'U-112-3' ORDER BY ingestion_ts")
def usage_lookup_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All raw usage rows of one id by ingest time: Bloom filters skip the row groups without it."""
    return Q.lookup(_usage_for_lookup(spark, sf_dir), order_by=STAMP, descending=False, usage_id="U-112-3")


@register("usage_lookup_by_grain", "SELECT * FROM b_feature_usage WHERE subscription_id = 'S-0' AND usage_date = DATE '1998-05-05' "
                                   "AND feature_name = 'feature_7' ORDER BY ingestion_ts DESC")
def usage_lookup_by_grain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All raw usage rows of one (subscription, day, feature), latest ingest first: the order of the files leaves few row groups."""
    return Q.lookup(_usage_for_lookup(spark, sf_dir), order_by=STAMP, subscription_id="S-0",
                    usage_date=F.lit("1998-05-05").cast("date"), feature_name="feature_7")


# ---------------------------------------------------------------- monthly tables, refreshed by month
import datetime as dt  # noqa: E402

from tidemark.plans.monthly import MonthlyTables  # noqa: E402

FIRST_LOAD, CUT = dt.datetime(2001, 11, 30), "2001-06-01"
DATED = {"feature_usage": "usage_date", "support_tickets": "submitted_at", "subscriptions": "start_date"}


def two_loads(spark: SparkSession, sf_dir: str) -> tuple[Pipeline, Pipeline]:
    """Bronze after a first load (rows dated before the cut) and after a second one, which brings the others."""
    first, second = pipeline(spark, sf_dir), pipeline(spark, sf_dir)
    for table in FX.BRONZE_TABLES:
        df, when = first.bronze.table(table), DATED.get(table)
        old = F.coalesce(F.col(when) < F.lit(CUT).cast("date"), F.lit(True)) if when else F.lit(True)
        stamped = df.withColumn(STAMP, F.when(old, F.lit(FIRST_LOAD)).otherwise(F.col(STAMP)))
        first.bronze._frames[table], second.bronze._frames[table] = stamped.filter(old), stamped
    return first, second


def _refreshed(table: str):
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        """The table after a first load, written by month, and a refresh of the months that the second load touches."""
        first, second = two_loads(spark, sf_dir)
        root = scratch_path(spark, "monthly")
        MonthlyTables(first, root).write_all()
        tables = MonthlyTables(second, root)
        tables.refresh(FIRST_LOAD)
        return tables.read(table)
    return build


for _table, _cte in (("gold_mrr_trends", "g_mrr"), ("gold_feature_adoption", "g_features"), ("gold_support_performance", "g_support")):
    register(f"monthly_{_table.removeprefix('gold_')}", f"SELECT * FROM {_cte}")(_refreshed(_table))
