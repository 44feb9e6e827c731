"""Model graph: bronze -> silver -> intermediate -> gold, as lazy DataFrames.

Each model is a property computed from its explicit upstream models, so one
Catalyst plan spans silver to gold and the optimizer prunes and pushes down
across layers. Only the account spine is materialized (when requested): it
is written as parquet to the shared folder named by the session and read
back, which cuts lineage and survives executor loss (no in-memory or
executor-local checkpoint).
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from tidemark.context import RunContext, scratch_path
from tidemark.operators import gold, intermediate as mid, silver
from tidemark.sources.fixtures import Bronze, load_bronze

GOLD_MODELS = [
    "gold_account_health_summary",
    "gold_churn_analysis",
    "gold_mrr_trends",
    "gold_feature_adoption",
    "gold_support_performance",
    "gold_customer_segments",
]
SPINE = "int_account_360"
SPINE_READERS = ("gold_account_health_summary", "gold_customer_segments")
SILVER_MODELS = ["stg_accounts", "stg_subscriptions", "stg_churn_events",
                 "stg_feature_usage", "stg_support_tickets"]
INTERMEDIATE_MODELS = ["int_account_subscriptions", "int_account_churn", "int_account_support",
                       "int_account_feature_usage", "int_account_360"]


def write_table(df: DataFrame, path: str, mode: str = "overwrite", fmt: str = "parquet") -> None:
    df.write.mode(mode).format(fmt).save(path)


class Pipeline:
    """All models over one set of bronze inputs and one run context."""

    def __init__(self, spark: SparkSession, bronze: Bronze, ctx: RunContext | None = None,
                 materialize_spine: bool = False):
        self.spark = spark
        self.bronze = bronze
        self.ctx = ctx or RunContext.now()  # one clock for the whole run
        self.materialize_spine = materialize_spine

    @classmethod
    def from_driver_tables(cls, spark: SparkSession, sf_dir: str, ctx: RunContext | None = None,
                           **kw) -> "Pipeline":
        ctx = ctx or RunContext.pinned()
        return cls(spark, load_bronze(spark, sf_dir, ctx), ctx, **kw)

    @classmethod
    def from_bronze_tables(cls, spark: SparkSession, root: str, ctx: RunContext | None = None,
                           fmt: str = "parquet", **kw) -> "Pipeline":
        """Bronze tables previously written under ``root/<table>``."""
        b = Bronze(factory=lambda n: spark.read.format(fmt).load(f"{root.rstrip('/')}/{n}"))
        return cls(spark, b, ctx, **kw)

    @classmethod
    def from_catalog(cls, spark: SparkSession, database: str, ctx: RunContext | None = None,
                     prefix: str = "bronze_", **kw) -> "Pipeline":
        """Bronze tables registered in the catalog as ``<database>.<prefix><table>``."""
        b = Bronze(factory=lambda n: spark.table(f"{database}.{prefix}{n}"))
        return cls(spark, b, ctx, **kw)

    # ---- silver
    @cached_property
    def stg_accounts(self) -> DataFrame:
        return silver.stg_accounts(self.bronze.accounts)

    @cached_property
    def stg_subscriptions(self) -> DataFrame:
        return silver.stg_subscriptions(self.bronze.subscriptions)

    @cached_property
    def stg_churn_events(self) -> DataFrame:
        return silver.stg_churn_events(self.bronze.churn_events)

    @cached_property
    def stg_feature_usage(self) -> DataFrame:
        return silver.stg_feature_usage(self.bronze.feature_usage)

    @cached_property
    def stg_support_tickets(self) -> DataFrame:
        return silver.stg_support_tickets(self.bronze.support_tickets)

    # ---- intermediate
    @cached_property
    def int_account_subscriptions(self) -> DataFrame:
        return mid.int_account_subscriptions(self.stg_subscriptions, self.stg_accounts, self.ctx)

    @cached_property
    def int_account_churn(self) -> DataFrame:
        return mid.int_account_churn(self.stg_churn_events, self.stg_accounts, self.stg_subscriptions)

    @cached_property
    def int_account_support(self) -> DataFrame:
        return mid.int_account_support(self.stg_support_tickets)

    @cached_property
    def int_account_feature_usage(self) -> DataFrame:
        return mid.int_account_feature_usage(self.stg_feature_usage, self.stg_subscriptions)

    @cached_property
    def latest_subscription(self) -> DataFrame:
        return mid.latest_subscription(self.stg_subscriptions)

    @cached_property
    def latest_churn(self) -> DataFrame:
        return mid.latest_churn(self.stg_churn_events, self.stg_accounts, self.stg_subscriptions)

    @cached_property
    def subscription_summary(self) -> DataFrame:
        return mid.subscription_summary(self.stg_subscriptions, self.stg_accounts)

    @cached_property
    def int_account_360(self) -> DataFrame:
        df = mid.int_account_360(
            self.stg_accounts,
            mid.subscription_summary(self.stg_subscriptions, self.stg_accounts, keep_latest=True),
            mid.latest_churn_event(self.stg_churn_events),
            self.int_account_support, self.int_account_feature_usage)
        if self.materialize_spine:
            path = scratch_path(self.spark, "int_account_360")
            write_table(df, path)
            df = self.spark.read.parquet(path)
        return df

    # ---- gold
    @cached_property
    def gold_account_health_summary(self) -> DataFrame:
        return gold.gold_account_health_summary(self.int_account_360, self.ctx)

    @cached_property
    def gold_customer_segments(self) -> DataFrame:
        return gold.gold_customer_segments(self.int_account_360, self.ctx)

    @cached_property
    def gold_churn_analysis(self) -> DataFrame:
        return gold.gold_churn_analysis(self.int_account_churn, self.ctx)

    @cached_property
    def mrr_movements(self) -> DataFrame:
        return gold.mrr_movements(self.int_account_subscriptions)

    @cached_property
    def mrr_movement_agg(self) -> DataFrame:
        return gold.mrr_movement_agg(self.stg_subscriptions, self.stg_accounts)

    @cached_property
    def gold_mrr_trends(self) -> DataFrame:
        return gold.gold_mrr_trends(self.mrr_movement_agg, self.ctx)

    @cached_property
    def month_spine(self) -> DataFrame:
        return gold.month_spine(self.stg_subscriptions, self.ctx)

    @cached_property
    def mrr_trends_dense(self) -> DataFrame:
        return gold.mrr_trends_dense(self.stg_subscriptions, self.gold_mrr_trends, self.ctx)

    @cached_property
    def gold_feature_adoption(self) -> DataFrame:
        return gold.gold_feature_adoption(self.stg_feature_usage, self.stg_subscriptions, self.ctx)

    @cached_property
    def gold_support_performance(self) -> DataFrame:
        return gold.gold_support_performance(self.stg_support_tickets, self.ctx)

    def model(self, name: str) -> DataFrame:
        return getattr(self, name)

    def store(self, name: str) -> None:
        """Compute a model that several others read once: it is written to the shared folder and read from there."""
        df, path = self.model(name), scratch_path(self.spark, name)
        write_table(df, path)
        self.__dict__[name] = self.spark.read.schema(df.schema).parquet(path)

    def models(self) -> dict[str, DataFrame]:
        return {n: self.model(n) for n in SILVER_MODELS + INTERMEDIATE_MODELS + GOLD_MODELS}

    def publish_views(self, prefix: str = "") -> list[str]:
        """Name the silver and intermediate models: each becomes the view ``<prefix><model>`` of the session.

        A view is its model's plan, computed when it is read; the stored spine
        is read where ``run`` has put it.
        """
        names = SILVER_MODELS + INTERMEDIATE_MODELS
        for n in names:
            self.model(n).createOrReplaceTempView(f"{prefix}{n}")
        return [f"{prefix}{n}" for n in names]

    def run(self, output_root: str, models: list[str] | None = None, fmt: str = "parquet",
            as_tables: bool = False, parallel_jobs: int = 4, views: str | None = None) -> dict[str, str]:
        """Write the gold tables (or ``models``) under ``output_root/<model>``.

        With ``views``, the silver and intermediate models can be queried
        afterwards as views of that prefix (see :meth:`publish_views`).

        With ``as_tables``, ``output_root`` is a database and each model is
        saved as the catalog table ``<database>.<model>`` (created if needed).
        The spine is a table of its own, ``int_account_360``: it is stored with its
        first reader and shared by both.
        The write jobs are submitted concurrently (``parallel_jobs`` driver
        threads), so small jobs do not leave the executors idle, and the
        tables that do not read the spine overlap its materialization. Each
        table is written in full with overwrite; re-running is safe.
        """
        from concurrent.futures import ThreadPoolExecutor  # noqa: PLC0415

        if as_tables:
            self.spark.sql(f"CREATE SCHEMA IF NOT EXISTS {output_root}")
        names = [n for n in models or GOLD_MODELS if n != SPINE]

        def write(name: str, df: DataFrame) -> tuple[str, str]:
            if as_tables:
                target = f"{output_root}.{name}"
                df.write.mode("overwrite").format(fmt).saveAsTable(target)
            else:
                target = f"{output_root.rstrip('/')}/{name}"
                write_table(df, target, fmt=fmt)
            return name, target

        # Models are defined on this thread (plans only); the write jobs run on
        # the pool. Tables that do not read the spine start at once, overlapping
        # the spine's own write; its two readers follow as soon as it is stored.
        with ThreadPoolExecutor(max_workers=max(1, parallel_jobs)) as pool:
            first = [pool.submit(write, n, self.model(n)) for n in names if n not in SPINE_READERS]
            readers = [n for n in names if n in SPINE_READERS]
            stored = {}
            if readers or SPINE in (models or ()):
                for n in (SPINE, *SPINE_READERS):
                    self.__dict__.pop(n, None)
                stored = dict([write(SPINE, self.model(SPINE))])
                target = stored[SPINE]
                self.__dict__[SPINE] = self.spark.table(target) if as_tables else self.spark.read.format(fmt).load(target)
            later = [pool.submit(write, n, self.model(n)) for n in readers]
            written = stored | dict(f.result() for f in first + later)
        if views is not None:
            self.publish_views(views)
        return written
