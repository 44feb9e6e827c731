"""Driver tables -> the five bronze inputs.

No source CSVs come with the pipeline. The test tables (TPC-H-like ``customer``,
``nation``, ``orders``, ``lineitem`` and ``events``) are mapped onto the five
subscription-business inputs by fixed rules (FIXTURES.md §3), kept as one SQL
text per input that Spark and the DuckDB oracle both run. All of it is narrow
per-row projection plus at most one join, so Catalyst pushes it into the
parquet scans and pipelines it into whatever model reads it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.context import RunContext
from tidemark.sources.schemas import STAMP


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# The mapping of FIXTURES.md §3 -- one SQL text per input that runs
# unchanged in Spark and in DuckDB (the oracle uses the same text). ``{name}``
# marks a driver table, bound to a DataFrame by ``spark.sql(text, name=df)``.
MAPPING_SQL: dict[str, str] = {
    "accounts": """
SELECT 'A-' || c_custkey AS account_id, c_name AS account_name, c_mktsegment AS industry, n_name AS country,
       DATE '1995-01-01' + CAST((c_custkey * 7919) % 2526 AS INT) AS signup_date,
       CASE c_custkey % 5 WHEN 0 THEN 'organic' WHEN 1 THEN 'ads' WHEN 2 THEN 'event' WHEN 3 THEN 'partner' ELSE 'other' END AS referral_source,
       CASE c_custkey % 3 WHEN 0 THEN 'Basic' WHEN 1 THEN 'Pro' ELSE 'Enterprise' END AS plan_tier,
       CAST(1 + c_custkey % 200 AS INT) AS seats,
       c_custkey % 6 = 0 AS is_trial,
       CASE WHEN c_custkey % 40 = 3 THEN CAST(NULL AS BOOLEAN) ELSE c_custkey % 5 = 2 END AS churn_flag
FROM {customer} LEFT JOIN {nation} ON c_nationkey = n_nationkey""",
    "subscriptions": """
SELECT 'S-' || o_orderkey AS subscription_id,
       CASE WHEN o_orderkey % 211 = 7 THEN CAST(NULL AS STRING) WHEN o_orderkey % 113 = 5 THEN 'A-orphan' ELSE 'A-' || o_custkey END AS account_id,
       CAST(o_orderdate AS DATE) AS start_date,
       CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE) + CAST(15 + o_orderkey % 400 AS INT) END AS end_date,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'Enterprise' WHEN '2-HIGH' THEN 'Pro' WHEN '3-MEDIUM' THEN 'Pro' ELSE 'Basic' END AS plan_tier,
       CAST(1 + o_orderkey % 200 AS INT) AS seats,
       CAST(floor(o_totalprice / 100) AS BIGINT) AS mrr_amount,
       12 * CAST(floor(o_totalprice / 100) AS BIGINT) AS arr_amount,
       o_orderkey % 8 = 0 AS is_trial, o_orderkey % 10 = 1 AS upgrade_flag, o_orderkey % 23 = 2 AS downgrade_flag,
       o_orderstatus = 'F' AND o_orderkey % 4 <> 3 AS churn_flag,
       CASE WHEN o_orderkey % 3 = 0 THEN 'annual' ELSE 'monthly' END AS billing_frequency,
       o_orderkey % 5 <> 0 AS auto_renew_flag
FROM {orders}""",
    "churn_events": """
SELECT 'C-' || o_orderkey AS churn_event_id, 'A-' || o_custkey AS account_id,
       DATE '1995-01-01' + CAST((o_custkey * 7919) % 2526 + o_orderkey % 500 - 10 AS INT) AS churn_date,
       CASE o_orderkey % 6 WHEN 0 THEN 'pricing' WHEN 1 THEN 'support' WHEN 2 THEN 'features' WHEN 3 THEN 'budget' WHEN 4 THEN 'competitor' ELSE 'unknown' END AS reason_code,
       CASE WHEN o_orderkey % 9 = 0 THEN CAST(NULL AS DOUBLE) ELSE CAST(o_orderkey % 500 AS DOUBLE) / 4 END AS refund_amount_usd,
       o_orderkey % 10 = 1 AS preceding_upgrade_flag, o_orderkey % 23 = 2 AS preceding_downgrade_flag,
       o_orderkey % 12 = 0 AS is_reactivation,
       CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END AS feedback_text
FROM {orders} WHERE o_orderstatus = 'F' AND o_custkey % 5 = 2""",
    "feature_usage": """
SELECT 'U-' || l_orderkey || '-' || l_linenumber AS usage_id,
       CASE WHEN l_partkey % 331 = 9 THEN CAST(NULL AS STRING) ELSE 'S-' || l_orderkey END AS subscription_id,
       CAST(l_shipdate AS DATE) AS usage_date,
       'feature_' || (l_partkey % (1 + o_custkey % 12)) AS feature_name,
       CASE WHEN l_linenumber = 7 THEN CAST(0 AS BIGINT) ELSE CAST(l_quantity AS BIGINT) END AS usage_count,
       CAST(floor(l_extendedprice / 10) AS BIGINT) AS usage_duration_secs,
       CAST(CASE WHEN l_returnflag = 'R' THEN l_linenumber ELSE 0 END AS INT) AS error_count,
       l_partkey % (1 + o_custkey % 12) >= 10 AS is_beta_feature
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey
WHERE l_linenumber <= 1 + o_custkey % 7 AND o_custkey % 50 <> 7""",
    "support_tickets": """
SELECT 'T-' || event_id AS ticket_id,
       CASE WHEN event_id % 97 = 0 THEN CAST(NULL AS STRING) ELSE 'A-' || user_id END AS account_id,
       CAST(ts AS TIMESTAMP) - CAST(8200 + event_id % 700 AS INT) * INTERVAL '1' DAY AS submitted_at,
       CASE WHEN event_id % 11 <> 0 THEN CAST(ts AS TIMESTAMP) - CAST(8200 + event_id % 700 AS INT) * INTERVAL '1' DAY + CAST(round(value * 4) AS INT) * INTERVAL '15' MINUTE END AS closed_at,
       CASE WHEN event_id % 11 <> 0 THEN round(value * 4) / 4 END AS resolution_time_hours,
       CASE event_type WHEN 'error' THEN 'urgent' WHEN 'purchase' THEN 'high' WHEN 'click' THEN 'medium' ELSE 'low' END AS priority,
       CAST(event_id % 240 AS INT) AS first_response_time_minutes,
       CASE WHEN event_id % 5 <> 0 THEN CAST(least(5, 1 + user_id % 5 + event_id % 2) AS INT) END AS satisfaction_score,
       event_type = 'error' AND user_id % 3 = 0 AS escalation_flag
FROM {events}""",
}

MAPPING_SOURCES: dict[str, list[str]] = {
    "accounts": ["customer", "nation"],
    "subscriptions": ["orders"],
    "churn_events": ["orders"],
    "feature_usage": ["lineitem", "orders"],
    "support_tickets": ["events"],
}


def map_input(spark: SparkSession, name: str, tables: Callable[[str], DataFrame]) -> DataFrame:
    """One bronze input from the driver tables (projection, filters, one join at most)."""
    return spark.sql(MAPPING_SQL[name], **{t: tables(t) for t in MAPPING_SOURCES[name]})


def mapping_text(name: str) -> str:
    """The mapping with the driver tables named plainly (for SQL engines with views)."""
    return MAPPING_SQL[name].format(**{t: t for t in MAPPING_SOURCES[name]})


BRONZE_TABLES = ["accounts", "subscriptions", "churn_events", "feature_usage", "support_tickets"]


class Bronze:
    """The five bronze inputs, stamped with ``ingestion_ts``.

    Each input is built on first access, so a query only resolves the source
    tables it actually reads.
    """

    def __init__(self, accounts=None, subscriptions=None, churn_events=None, feature_usage=None,
                 support_tickets=None, factory: Callable[[str], DataFrame] | None = None):
        given = dict(accounts=accounts, subscriptions=subscriptions, churn_events=churn_events,
                     feature_usage=feature_usage, support_tickets=support_tickets)
        self._frames = {k: v for k, v in given.items() if v is not None}
        self._factory = factory

    def table(self, name: str) -> DataFrame:
        if name not in self._frames:
            if self._factory is None:
                raise KeyError(name)
            self._frames[name] = self._factory(name)
        return self._frames[name]

    accounts = property(lambda self: self.table("accounts"))
    subscriptions = property(lambda self: self.table("subscriptions"))
    churn_events = property(lambda self: self.table("churn_events"))
    feature_usage = property(lambda self: self.table("feature_usage"))
    support_tickets = property(lambda self: self.table("support_tickets"))

    def as_dict(self) -> dict[str, DataFrame]:
        return {n: self.table(n) for n in BRONZE_TABLES}


def load_bronze(spark: SparkSession, sf_dir: str, ctx: RunContext | None = None) -> Bronze:
    """Bronze inputs derived from the driver tables under ``sf_dir`` (lazily)."""
    ctx = ctx or RunContext.pinned()
    handles: dict[str, DataFrame] = {}  # each source is resolved once for all models of these inputs

    def t(name: str) -> DataFrame:
        if name not in handles:
            handles[name] = read_table(spark, sf_dir, name)
        return handles[name]

    return Bronze(factory=lambda name: map_input(spark, name, t).withColumn(STAMP, ctx.stamp()))


# Stamps of the three subscription batches (FIXTURES.md §4).
BATCH_STAMPS = ["2001-10-01 00:00:00", "2001-11-01 00:00:00", "2001-12-01 00:00:00"]


def subscription_batches(stg_subscriptions: DataFrame) -> list[tuple[str, DataFrame]]:
    """Three successive deliveries of the subscriptions table, derived from it.

    1: without ids n % 17 = 3; 2: all ids, with plan / seat / end-date changes;
    3: as 2 with some churn flags set to NULL and ids n % 31 = 8 missing.
    Each batch carries its own stamp as ``ingestion_ts``.
    """
    n = F.substring(F.col("subscription_id"), 3, 1 << 20).cast("bigint")
    cols = stg_subscriptions.columns
    b1 = stg_subscriptions.filter(n % 17 != 3)
    b2 = stg_subscriptions.withColumns({
        "plan_tier": F.when(n % 10 == 1, F.lit("Enterprise")).otherwise(F.col("plan_tier")),
        "seats": F.when(n % 13 == 0, F.col("seats") + 5).otherwise(F.col("seats")),
        "end_date": F.when(n % 19 == 4, F.lit("2001-10-15").cast("date")).otherwise(F.col("end_date")),
    })
    b3 = b2.withColumn(
        "churn_flag", F.when(n % 29 == 6, F.lit(None).cast("boolean")).otherwise(F.col("churn_flag"))
    ).filter(n % 31 != 8)
    out = []
    for stamp, b in zip(BATCH_STAMPS, [b1, b2, b3]):
        out.append((stamp, b.withColumn(STAMP, F.to_timestamp(F.lit(stamp))).select(*cols)))
    return out
