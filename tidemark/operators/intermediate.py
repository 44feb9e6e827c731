"""Intermediate models: account-level context, rollups and the account spine.

Plan notes (scale):

* Every "latest row per account" is an aggregate (``max_by``), combined
  map-side, so one account holding a large share of rows never lands whole in
  one task.
* The spine rolls the subscriptions up per account once (summary measures and
  the latest subscription in one aggregate) and completes the churn columns
  from that rollup and the account row, so it scans and shuffles the
  subscriptions and the accounts once each (plus the accounts' key count).
  The summary meets the accounts only after aggregation, through the
  accounts' key multiplicity, so results equal the join-then-aggregate form
  even if an account id were duplicated.
* Churn facts are enriched in one left join against the two per-account
  dimensions (joined first), so AQE may split a skewed account on the fact
  side. For the latest event per account the event is picked first, and the
  one-row-per-account sides are joined on the same key without a shuffle.
* The usage rollup pre-aggregates to (account, feature) and (account, day) in
  one pass (grouping sets) instead of three COUNT(DISTINCT)s over every daily
  row: the usage is scanned and joined once.
* The spine joins five inputs that are all keyed (and hash-partitioned) on
  ``account_id``; Spark reuses that partitioning across the chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.context import RunContext
from tidemark.functions.core import count_if, latest_per_key, pct, round2
from tidemark.functions.rules import churn_path, health_score

ACCOUNT_ATTRS = ["account_name", "industry", "country", "signup_date", "referral_source"]

INT_SUBSCRIPTION_COLUMNS = [
    "subscription_id", "account_id", *ACCOUNT_ATTRS, "start_date", "end_date",
    "plan_tier", "seats", "mrr_amount", "arr_amount", "is_trial", "upgrade_flag",
    "downgrade_flag", "churn_flag", "billing_frequency", "auto_renew_flag",
    "is_active", "subscription_duration_days",
]


def _with_activity(stg_subscriptions: DataFrame, ctx: RunContext) -> DataFrame:
    return stg_subscriptions.withColumns({
        "is_active": F.col("end_date").isNull(),
        "subscription_duration_days": F.datediff(
            F.coalesce(F.col("end_date"), ctx.today()), F.col("start_date")
        ),
    })


def int_account_subscriptions(stg_subscriptions: DataFrame, stg_accounts: DataFrame,
                              ctx: RunContext) -> DataFrame:
    """One row per subscription with account attributes; orphans keep NULL attributes."""
    subs = _with_activity(stg_subscriptions, ctx)
    accounts = stg_accounts.select("account_id", *ACCOUNT_ATTRS)
    return subs.join(accounts, "account_id", "left").select(*INT_SUBSCRIPTION_COLUMNS)


def account_multiplicity(stg_accounts: DataFrame) -> DataFrame:
    """(account_id, _k): how often an account row joins; ids that no account has are missing."""
    return stg_accounts.groupBy("account_id").agg(F.count(F.lit(1)).alias("_k"))


LATEST_SUBSCRIPTION_COLUMNS = ["subscription_id", "start_date", "plan_tier", "mrr_amount", "arr_amount",
                               "billing_frequency"]


def subscription_rollup(stg_subscriptions: DataFrame) -> DataFrame:
    """Everything the account models need from the subscriptions, in one aggregate per account.

    The summary measures and the latest subscription (``max_by`` on start
    date, then id) come from one pass, so the account spine needs a single
    scan and shuffle of the subscriptions. (Used alone, Catalyst prunes the
    aggregates a consumer does not read.)
    """
    active = F.col("end_date").isNull()
    latest = F.struct(*[F.col(c) for c in LATEST_SUBSCRIPTION_COLUMNS])
    return stg_subscriptions.groupBy("account_id").agg(
        F.count("subscription_id").alias("total_subscriptions"),
        F.sum("mrr_amount").alias("total_mrr"),
        F.sum("arr_amount").alias("total_arr"),
        F.max("mrr_amount").alias("peak_mrr"),
        count_if(active).alias("active_subscriptions"),
        F.max(F.when(active, F.col("plan_tier"))).alias("current_plan_tier"),
        F.max(F.when(active, F.col("mrr_amount"))).alias("current_mrr"),
        F.bool_or("upgrade_flag").alias("ever_upgraded"),
        F.bool_or("downgrade_flag").alias("ever_downgraded"),
        F.max("start_date").alias("latest_subscription_start"),
        F.max_by(latest, F.struct(F.col("start_date"), F.col("subscription_id"))).alias("_latest"),
    )


def latest_subscription(stg_subscriptions: DataFrame) -> DataFrame:
    """Most recently started subscription per account (ties: larger subscription_id)."""
    return subscription_rollup(stg_subscriptions).select("account_id", "_latest.*")


def _churn_dimensions(stg_accounts: DataFrame, stg_subscriptions: DataFrame) -> tuple[DataFrame, DataFrame]:
    accounts = stg_accounts.select(
        "account_id", "account_name", "industry", "country",
        F.col("plan_tier").alias("account_plan_tier"), "signup_date",
    )
    latest = latest_subscription(stg_subscriptions).select(
        "account_id",
        F.col("plan_tier").alias("subscription_plan_tier"),
        F.col("mrr_amount").alias("mrr_at_churn"),
        F.col("arr_amount").alias("arr_at_churn"),
        "billing_frequency",
    )
    return accounts, latest


def _account_context(stg_accounts: DataFrame, stg_subscriptions: DataFrame, churned: DataFrame) -> DataFrame:
    """Churned accounts full-outer their latest subscription: everything churn needs per account.

    Both dimensions are first cut down to the ids that churned (``churned``), so
    neither all subscriptions are rolled up nor all accounts joined.
    """
    ids = churned.select("account_id").distinct()
    accounts, latest = _churn_dimensions(stg_accounts.join(ids, "account_id", "left_semi"),
                                         stg_subscriptions.join(ids, "account_id", "left_semi"))
    return accounts.join(latest, "account_id", "full_outer")


INT_CHURN_COLUMNS = [
    "churn_event_id", "account_id", "account_name", "industry", "country", "signup_date",
    "days_to_churn", "churn_date", "reason_code", "refund_amount_usd",
    "preceding_upgrade_flag", "preceding_downgrade_flag", "is_reactivation", "feedback_text",
    "plan_tier_at_churn", "mrr_at_churn", "arr_at_churn", "billing_frequency", "churn_path",
]

_CHURN_EVENT_COLUMNS = [
    "churn_event_id", "churn_date", "reason_code", "refund_amount_usd",
    "preceding_upgrade_flag", "preceding_downgrade_flag", "is_reactivation", "feedback_text",
]


def _enrich_churn(events: DataFrame, account_ctx: DataFrame | tuple[DataFrame, DataFrame]) -> DataFrame:
    if isinstance(account_ctx, tuple):  # (accounts, latest subscription): two co-partitioned left joins
        accounts, latest = account_ctx
        j = events.join(accounts, "account_id", "left").join(latest, "account_id", "left")
    else:
        j = events.join(account_ctx, "account_id", "left")
    return j.select(
        "churn_event_id", "account_id", "account_name", "industry", "country", "signup_date",
        F.datediff("churn_date", "signup_date").alias("days_to_churn"),
        "churn_date", "reason_code", "refund_amount_usd", "preceding_upgrade_flag",
        "preceding_downgrade_flag", "is_reactivation", "feedback_text",
        F.coalesce("subscription_plan_tier", "account_plan_tier").alias("plan_tier_at_churn"),
        "mrr_at_churn", "arr_at_churn", "billing_frequency",
        churn_path(F.col("preceding_downgrade_flag"), F.col("preceding_upgrade_flag")).alias("churn_path"),
    )


def int_account_churn(stg_churn_events: DataFrame, stg_accounts: DataFrame,
                      stg_subscriptions: DataFrame) -> DataFrame:
    """One row per churn event with account demographics and the revenue lost."""
    events = stg_churn_events.select("account_id", *_CHURN_EVENT_COLUMNS)
    return _enrich_churn(events, _account_context(stg_accounts, stg_subscriptions, events))


def latest_churn(stg_churn_events: DataFrame, stg_accounts: DataFrame,
                 stg_subscriptions: DataFrame) -> DataFrame:
    """Latest enriched churn event per account (ties: larger churn_event_id).

    The latest event is picked before enrichment (map-side combined), so the
    enrichment joins see one row per account on both sides and are chained
    on the same key without a further shuffle. A last per-account pick keeps
    one row even if an account id repeats in the accounts table; it runs on
    the joins' own hash partitioning, so it adds no shuffle either.
    """
    events = latest_per_key(stg_churn_events, "account_id", ["churn_date", "churn_event_id"],
                            _CHURN_EVENT_COLUMNS)
    enriched = _enrich_churn(events, _churn_dimensions(stg_accounts, stg_subscriptions))
    cols = [c for c in INT_CHURN_COLUMNS if c != "account_id"]
    return latest_per_key(enriched, "account_id", ["churn_date", "churn_event_id", "days_to_churn"], cols) \
        .select(*INT_CHURN_COLUMNS)


def int_account_support(stg_support_tickets: DataFrame) -> DataFrame:
    """Ticket volume, resolution quality and escalation rate per account."""
    escalated = count_if(F.col("escalation_flag") == F.lit(True))
    return stg_support_tickets.groupBy("account_id").agg(
        F.count("ticket_id").alias("total_tickets"),
        count_if(F.col("priority") == "urgent").alias("urgent_tickets"),
        count_if(F.col("priority") == "high").alias("high_priority_tickets"),
        escalated.alias("escalated_tickets"),
        round2(F.avg("resolution_time_hours")).alias("avg_resolution_time_hours"),
        round2(F.avg("first_response_time_minutes")).alias("avg_first_response_time_minutes"),
        round2(F.avg("satisfaction_score")).alias("avg_satisfaction_score"),
        F.min("satisfaction_score").alias("min_satisfaction_score"),
        pct(escalated, F.count("ticket_id")).alias("escalation_rate_pct"),
        F.max("submitted_at").alias("last_ticket_date"),
        F.min("submitted_at").alias("first_ticket_date"),
    )


def usage_with_account(stg_feature_usage: DataFrame, stg_subscriptions: DataFrame,
                       extra: list[str] | None = None) -> DataFrame:
    """Daily usage rows tagged with their account (usage of unknown subscriptions is dropped)."""
    subs = stg_subscriptions.select("subscription_id", "account_id", *(extra or []))
    return stg_feature_usage.join(subs, "subscription_id", "inner")


def int_account_feature_usage(stg_feature_usage: DataFrame, stg_subscriptions: DataFrame) -> DataFrame:
    """Feature breadth, volume, errors, top feature and recency per account.

    The three distinct counts (features, beta features, days) come from two
    grouping sets, (account, feature) and (account, day), of one pass: every
    daily row feeds a feature's and a day's partial sums in the map task, so
    the usage is scanned and joined once and no row per distinct value is kept
    beyond them. What is shuffled are the combined rows; a second level sums
    them per account, again map-side first. Exact, at any number of features and days.
    """
    u = usage_with_account(stg_feature_usage, stg_subscriptions)
    cnt, feature, day = F.col("total_usage_count"), F.col("feature_name"), F.col("usage_date")
    keys = ["account_id", "feature_name", "usage_date"]
    per_key = u.groupingSets([["account_id", "feature_name"], ["account_id", "usage_date"]], *keys).agg(
        (F.grouping("usage_date") == 1).alias("_of_feature"),
        F.sum(cnt).alias("_count"),
        F.sum("total_usage_duration_secs").alias("_secs"),
        F.sum("total_error_count").alias("_errors"),
        F.max(F.col("is_beta_feature") == F.lit(True)).alias("_beta"),
        F.max(cnt).alias("_peak"),
    )
    of_feature = F.col("_of_feature")

    def total(col: str):
        return F.sum(F.when(of_feature, F.col(col)))

    return per_key.groupBy("account_id").agg(
        F.count(F.when(of_feature, feature)).alias("distinct_features_used"),
        total("_count").alias("total_usage_count"),
        round2(total("_secs") / 3600.0).alias("total_usage_hours"),
        total("_errors").alias("total_error_count"),
        pct(total("_errors"), total("_count")).alias("error_rate_pct"),
        count_if(of_feature & F.col("_beta") & feature.isNotNull()).alias("beta_features_used"),
        # Feature of the largest single daily row; ties go to the larger name.
        F.max_by(feature, F.when(of_feature & F.col("_peak").isNotNull(), F.struct(F.col("_peak"), feature)))
        .alias("top_feature"),
        F.max(F.when(~of_feature, day)).alias("last_usage_date"),
        F.min(F.when(~of_feature, day)).alias("first_usage_date"),
        F.count(F.when(~of_feature, day)).alias("active_days"),
    )


SUMMARY_COLUMNS = [
    "account_id", "total_subscriptions", "total_mrr", "total_arr", "peak_mrr",
    "active_subscriptions", "current_plan_tier", "current_mrr", "ever_upgraded",
    "ever_downgraded", "latest_subscription_start",
]


def subscription_summary(stg_subscriptions: DataFrame, stg_accounts: DataFrame,
                         keep_latest: bool = False) -> DataFrame:
    """Per-account subscription rollup over ``int_account_subscriptions``.

    Aggregated straight from the subscriptions (combined map-side), then
    scaled by how many account rows each key has -- the fan-out the
    subscription/account left join would have produced (1 for orphans).
    With ``keep_latest`` the latest subscription (struct ``_latest``) is kept
    too, so the spine needs no second pass over the subscriptions.
    """
    per_account = subscription_rollup(stg_subscriptions)
    multiplicity = stg_accounts.groupBy("account_id").agg(F.count(F.lit(1)).alias("_k"))
    k = F.coalesce(F.col("_k"), F.lit(1)).cast("bigint")
    scaled = {c: F.col(c) * k for c in ["total_subscriptions", "total_mrr", "total_arr", "active_subscriptions"]}
    cols = SUMMARY_COLUMNS + (["_latest"] if keep_latest else [])
    return per_account.join(multiplicity, "account_id", "left").withColumns(scaled).select(*cols)


def latest_churn_event(stg_churn_events: DataFrame) -> DataFrame:
    """The latest churn event per account (ties: larger churn_event_id), not yet enriched."""
    return latest_per_key(stg_churn_events, "account_id", ["churn_date", "churn_event_id"],
                          _CHURN_EVENT_COLUMNS)


ACCOUNT_360_COLUMNS = [
    "account_id", "account_name", "industry", "country", "signup_date", "referral_source",
    "original_plan_tier", "seats", "is_trial", "churn_flag",
    "total_subscriptions", "total_mrr", "total_arr", "peak_mrr", "active_subscriptions",
    "current_plan_tier", "current_mrr", "ever_upgraded", "ever_downgraded",
    "latest_subscription_start",
    "churn_date", "churn_reason", "refund_amount_usd", "churn_path", "days_to_churn", "mrr_at_churn",
    "total_tickets", "avg_resolution_time_hours", "avg_satisfaction_score", "escalation_rate_pct",
    "last_ticket_date",
    "distinct_features_used", "total_usage_count", "total_usage_hours", "error_rate_pct",
    "beta_features_used", "top_feature", "last_usage_date", "active_days",
    "health_score", "total_error_count",
]


def int_account_360(stg_accounts: DataFrame, summary: DataFrame, churn_event: DataFrame,
                    support: DataFrame, usage: DataFrame) -> DataFrame:
    """The account spine: accounts left-joined to four one-row-per-account rollups.

    ``summary`` must carry the latest subscription (``keep_latest=True``) and
    ``churn_event`` is the latest churn event per account. The churn columns
    are completed here from the account row itself (tenure at churn) and
    from the summary (revenue of the latest subscription), which equals
    enriching every event first and then picking the latest, without a
    second pass over accounts and subscriptions.
    """
    accounts = stg_accounts.select(
        "account_id", "account_name", "industry", "country", "signup_date", "referral_source",
        F.col("plan_tier").alias("original_plan_tier"), "seats", "is_trial", "churn_flag",
    )
    churn = churn_event.select(
        "account_id", F.col("churn_event_id").alias("_event"), "churn_date",
        F.col("reason_code").alias("churn_reason"), "refund_amount_usd",
        F.col("preceding_upgrade_flag").alias("_up"), F.col("preceding_downgrade_flag").alias("_down"),
    )
    tickets = support.select("account_id", "total_tickets", "avg_resolution_time_hours",
                             "avg_satisfaction_score", "escalation_rate_pct", "last_ticket_date")
    use = usage.select("account_id", "distinct_features_used", "total_usage_count", "total_usage_hours",
                       "total_error_count", "error_rate_pct", "beta_features_used", "top_feature",
                       "last_usage_date", "active_days")
    j = (accounts.join(summary, "account_id", "left")
         .join(churn, "account_id", "left")
         .join(tickets.withColumnsRenamed({"total_tickets": "_tickets",
                                           "escalation_rate_pct": "_esc"}), "account_id", "left")
         .join(use.withColumnsRenamed({
             "distinct_features_used": "_features", "total_usage_count": "_usage",
             "total_error_count": "_errors", "error_rate_pct": "_err_rate",
             "beta_features_used": "_beta", "active_days": "_days"}), "account_id", "left"))
    churned = F.col("_event").isNotNull()
    zero = F.lit(0)
    filled = {
        "churn_path": F.when(churned, churn_path(F.col("_down"), F.col("_up"))),
        "days_to_churn": F.datediff("churn_date", "signup_date"),
        "mrr_at_churn": F.when(churned, F.col("_latest.mrr_amount")),
        "total_tickets": F.coalesce("_tickets", zero).cast("bigint"),
        "escalation_rate_pct": F.coalesce(F.col("_esc"), F.lit(0.0)),
        "distinct_features_used": F.coalesce("_features", zero).cast("bigint"),
        "total_usage_count": F.coalesce("_usage", zero).cast("bigint"),
        "error_rate_pct": F.coalesce(F.col("_err_rate"), F.lit(0.0)),
        "beta_features_used": F.coalesce("_beta", zero).cast("bigint"),
        "active_days": F.coalesce("_days", zero).cast("bigint"),
        "total_error_count": F.coalesce("_errors", zero).cast("bigint"),
    }
    j = j.withColumns(filled)
    j = j.withColumn("health_score", health_score(
        F.col("active_days"), F.col("avg_satisfaction_score"), F.col("escalation_rate_pct"),
        F.col("distinct_features_used")))
    return j.select(*ACCOUNT_360_COLUMNS)
