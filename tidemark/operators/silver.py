"""Silver: cleaned staging views over the bronze tables.

Each one is a projection plus a null-key filter (lazy; Catalyst pushes the
filter into the scan). Feature usage is additionally rolled up to one row per
(subscription, day, feature) -- a map-side-combined aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.sources.schemas import STAMP

ACCOUNT_COLUMNS = [
    "account_id", "account_name", "industry", "country", "signup_date",
    "referral_source", "plan_tier", "seats", "is_trial", "churn_flag", STAMP,
]
SUBSCRIPTION_COLUMNS = [
    "subscription_id", "account_id", "start_date", "end_date", "plan_tier", "seats",
    "mrr_amount", "arr_amount", "is_trial", "upgrade_flag", "downgrade_flag",
    "churn_flag", "billing_frequency", "auto_renew_flag", STAMP,
]
CHURN_COLUMNS = [
    "churn_event_id", "account_id", "churn_date", "reason_code", "refund_amount_usd",
    "preceding_upgrade_flag", "preceding_downgrade_flag", "is_reactivation",
    "feedback_text", STAMP,
]
TICKET_COLUMNS = [
    "ticket_id", "account_id", "submitted_at", "closed_at", "resolution_time_hours",
    "priority", "first_response_time_minutes", "satisfaction_score", "escalation_flag", STAMP,
]
USAGE_KEYS = ["subscription_id", "usage_date", "feature_name"]


def _clean(df: DataFrame, columns: list[str], keys: list[str]) -> DataFrame:
    cond = None
    for k in keys:
        c = F.col(k).isNotNull()
        cond = c if cond is None else cond & c
    return df.select(*columns).filter(cond)


def stg_accounts(bronze_accounts: DataFrame) -> DataFrame:
    return _clean(bronze_accounts, ACCOUNT_COLUMNS, ["account_id"])


def stg_subscriptions(bronze_subscriptions: DataFrame) -> DataFrame:
    return _clean(bronze_subscriptions, SUBSCRIPTION_COLUMNS, ["subscription_id", "account_id"])


def stg_churn_events(bronze_churn_events: DataFrame) -> DataFrame:
    return _clean(bronze_churn_events, CHURN_COLUMNS, ["churn_event_id", "account_id"])


def stg_support_tickets(bronze_support_tickets: DataFrame) -> DataFrame:
    return _clean(bronze_support_tickets, TICKET_COLUMNS, ["ticket_id", "account_id"])


def stg_feature_usage(bronze_feature_usage: DataFrame) -> DataFrame:
    """Daily usage per (subscription, day, feature); repeated raw rows are summed."""
    return (
        bronze_feature_usage.filter(F.col("subscription_id").isNotNull())
        .groupBy(*USAGE_KEYS)
        .agg(
            F.sum("usage_count").alias("total_usage_count"),
            F.sum("usage_duration_secs").alias("total_usage_duration_secs"),
            F.sum("error_count").alias("total_error_count"),
            F.max("is_beta_feature").alias("is_beta_feature"),
        )
    )
