"""Declared schemas of the five bronze inputs (CSV columns, before the stamp)."""

from __future__ import annotations

from pyspark.sql import types as T

S, D, TS, B = T.StringType(), T.DateType(), T.TimestampType(), T.BooleanType()
I, L, DBL = T.IntegerType(), T.LongType(), T.DoubleType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


ACCOUNTS = _struct(
    ("account_id", S), ("account_name", S), ("industry", S), ("country", S),
    ("signup_date", D), ("referral_source", S), ("plan_tier", S), ("seats", I),
    ("is_trial", B), ("churn_flag", B),
)

SUBSCRIPTIONS = _struct(
    ("subscription_id", S), ("account_id", S), ("start_date", D), ("end_date", D),
    ("plan_tier", S), ("seats", I), ("mrr_amount", L), ("arr_amount", L),
    ("is_trial", B), ("upgrade_flag", B), ("downgrade_flag", B), ("churn_flag", B),
    ("billing_frequency", S), ("auto_renew_flag", B),
)

CHURN_EVENTS = _struct(
    ("churn_event_id", S), ("account_id", S), ("churn_date", D), ("reason_code", S),
    ("refund_amount_usd", DBL), ("preceding_upgrade_flag", B),
    ("preceding_downgrade_flag", B), ("is_reactivation", B), ("feedback_text", S),
)

FEATURE_USAGE = _struct(
    ("usage_id", S), ("subscription_id", S), ("usage_date", D), ("feature_name", S),
    ("usage_count", L), ("usage_duration_secs", L), ("error_count", I),
    ("is_beta_feature", B),
)

SUPPORT_TICKETS = _struct(
    ("ticket_id", S), ("account_id", S), ("submitted_at", TS), ("closed_at", TS),
    ("resolution_time_hours", DBL), ("priority", S),
    ("first_response_time_minutes", I), ("satisfaction_score", I),
    ("escalation_flag", B),
)

BRONZE_SCHEMAS: dict[str, T.StructType] = {
    "accounts": ACCOUNTS,
    "subscriptions": SUBSCRIPTIONS,
    "churn_events": CHURN_EVENTS,
    "feature_usage": FEATURE_USAGE,
    "support_tickets": SUPPORT_TICKETS,
}

# Name of the ingest stamp column every bronze table carries.
STAMP = "ingestion_ts"

# The source CSV file for each bronze table, in load order.
SOURCE_FILES: list[tuple[str, str]] = [
    ("accounts.csv", "accounts"),
    ("churn_events.csv", "churn_events"),
    ("feature_usage.csv", "feature_usage"),
    ("subscriptions.csv", "subscriptions"),
    ("support_tickets.csv", "support_tickets"),
]
