"""Gold models: the reporting tables.

Every gold table carries ``updated_at`` = the run timestamp of the context.
Presentation order (``ORDER BY`` of the reporting queries) is applied on read
with :func:`ordered`; a stored table has no order, and sorting before a write
would cost a global range shuffle for nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.context import RunContext
from tidemark.functions.core import count_if, month_start, pct, round2, safe_divide
from tidemark.functions.rules import (
    MRR_TYPES,
    health_status,
    segment_and_action,
    segment_conditions,
    tenure_bucket,
)
from tidemark.operators.intermediate import account_multiplicity, usage_with_account

# Presentation orders of the reporting tables (applied on read).
PRESENTATION_ORDER = {  # (column, ascending)
    "gold_mrr_trends": [("month_start", True), ("plan_tier", True)],
    # After the report's own two columns, the rest of its grain: ties have one order.
    "gold_feature_adoption": [("usage_month", False), ("active_accounts", False), ("feature_name", True), ("plan_tier", True),
                              ("is_beta_feature", True)],
    "gold_support_performance": [("ticket_month", False), ("priority", True)],
    "gold_customer_segments": [("health_score", True)],
}


def ordered(name: str, df: DataFrame) -> DataFrame:
    keys = PRESENTATION_ORDER.get(name)
    if not keys:
        return df
    return df.orderBy(*[F.col(c).asc() if up else F.col(c).desc() for c, up in keys])


# ---------------------------------------------------------------- account health

def gold_account_health_summary(acct360: DataFrame, ctx: RunContext) -> DataFrame:
    c = F.col
    return acct360.select(
        "account_id", "account_name", "industry", "country", "referral_source", "signup_date",
        F.coalesce(c("current_plan_tier"), c("original_plan_tier")).alias("plan_tier"),
        "seats", "is_trial", "churn_flag",
        (c("active_subscriptions") > 0).alias("is_active_customer"),
        F.coalesce(c("current_mrr"), F.lit(0)).cast("bigint").alias("current_mrr"),
        F.coalesce(c("total_arr"), F.lit(0)).cast("bigint").alias("total_arr"),
        F.coalesce(c("peak_mrr"), F.lit(0)).cast("bigint").alias("peak_mrr"),
        "ever_upgraded", "ever_downgraded",
        "distinct_features_used", "total_usage_count", "total_usage_hours", "active_days",
        "top_feature", "last_usage_date", "beta_features_used",
        pct(c("total_error_count"), c("total_usage_count")).alias("error_rate_pct"),
        "total_tickets", "avg_resolution_time_hours", "avg_satisfaction_score",
        "escalation_rate_pct", "last_ticket_date",
        "churn_date", "churn_reason", "churn_path", "days_to_churn", "mrr_at_churn", "refund_amount_usd",
        "health_score",
        health_status(c("churn_flag"), c("health_score")).alias("health_status"),
        ctx.stamp().alias("updated_at"),
    )


def gold_customer_segments(acct360: DataFrame, ctx: RunContext) -> DataFrame:
    c = F.col
    base = acct360.filter(c("churn_flag") == F.lit(False))
    mrr = F.coalesce(c("current_mrr"), F.lit(0)).cast("bigint")
    idle = F.datediff(ctx.today(), c("last_usage_date"))
    tenure = F.datediff(ctx.today(), c("signup_date"))
    seg, act = segment_and_action(segment_conditions(
        c("health_score"), mrr, c("ever_upgraded"), c("ever_downgraded"), tenure, idle))
    return base.select(
        "account_id", "account_name", "industry", "country",
        F.coalesce(c("current_plan_tier"), c("original_plan_tier")).alias("plan_tier"),
        mrr.alias("current_mrr"),
        "health_score", "distinct_features_used", "active_days", "total_tickets",
        "avg_satisfaction_score", "escalation_rate_pct", "ever_upgraded", "ever_downgraded",
        "signup_date", "last_usage_date",
        idle.alias("days_since_last_activity"),
        seg.alias("customer_segment"),
        act.alias("recommended_action"),
        ctx.stamp().alias("updated_at"),
    )


def at_risk_accounts(segments: DataFrame, k: int = 50) -> DataFrame:
    """The ``k`` lowest-health active accounts (a top-k report; ties by account_id)."""
    return segments.orderBy(F.col("health_score").asc(), F.col("account_id").asc()).limit(k)


# ---------------------------------------------------------------- churn

def gold_churn_analysis(int_churn: DataFrame, ctx: RunContext) -> DataFrame:
    c = F.col
    return int_churn.select(
        "churn_event_id", "account_id", "account_name", "industry", "country",
        "plan_tier_at_churn", "billing_frequency", "signup_date", "churn_date", "days_to_churn",
        month_start(c("churn_date")).alias("churn_month"),
        tenure_bucket(c("days_to_churn")).alias("tenure_bucket"),
        c("reason_code").alias("churn_reason"), "churn_path",
        "preceding_upgrade_flag", "preceding_downgrade_flag", "is_reactivation", "feedback_text",
        F.coalesce(c("mrr_at_churn"), F.lit(0)).cast("bigint").alias("mrr_lost"),
        F.coalesce(c("arr_at_churn"), F.lit(0)).cast("bigint").alias("arr_lost"),
        F.coalesce(c("refund_amount_usd"), F.lit(0.0)).alias("refund_amount_usd"),
        ctx.stamp().alias("updated_at"),
    )


# ---------------------------------------------------------------- recurring revenue

def revenue_subscriptions(subs: DataFrame) -> DataFrame:
    """Non-trial subscriptions (a NULL trial flag is excluded too).

    ``subs`` is ``int_account_subscriptions`` or anything with its
    subscription columns and rows.
    """
    return subs.filter(F.col("is_trial") == F.lit(False))


def mrr_movements(int_subs: DataFrame, *keep: str) -> DataFrame:
    """Tagged revenue movements, one row per (subscription, movement type).

    new / expansion / contraction land in the start month, churned in the end
    month. Built in one pass: each subscription emits an array of up to four
    movement structs that is exploded -- one scan instead of a four-way union.
    """
    c = F.col
    mrr = c("mrr_amount")
    start, end = month_start(c("start_date")), month_start(c("end_date"))

    def move(month, amount, kind):
        return F.struct(month.alias("month_start"), amount.alias("mrr_amount"), F.lit(kind).alias("mrr_type"))

    churned = (c("churn_flag") == F.lit(True)) & c("end_date").isNotNull()
    moves = F.array(
        move(start, mrr, MRR_TYPES[0]),
        F.when(churned, move(end, -mrr, MRR_TYPES[1])),
        F.when(c("upgrade_flag") == F.lit(True), move(start, mrr, MRR_TYPES[2])),
        F.when(c("downgrade_flag") == F.lit(True), move(start, -mrr, MRR_TYPES[3])),
    )
    return (
        revenue_subscriptions(int_subs)
        .select(*keep, "plan_tier", F.explode(F.array_compact(moves)).alias("m"))
        .select(*keep, "m.month_start", "plan_tier", "m.mrr_amount", "m.mrr_type")
        .filter(c("month_start").isNotNull())
    )


def mrr_movement_agg(stg_subscriptions: DataFrame, stg_accounts: DataFrame) -> DataFrame:
    """Movements summed by month, tier and type, as the account join would repeat them.

    The left join with the accounts repeats a subscription once per account
    row with its id. Movements are first summed per account; then the
    account's multiplicity is joined and multiplied in. So the join's input is
    already aggregated, and nothing is repeated row by row.
    """
    keys = ["month_start", "plan_tier", "mrr_type"]
    per_account = mrr_movements(stg_subscriptions, "account_id").groupBy("account_id", *keys).agg(
        F.sum("mrr_amount").alias("_sum"), F.count(F.lit(1)).alias("_n"))
    k = F.coalesce(F.col("_k"), F.lit(1))
    return per_account.join(account_multiplicity(stg_accounts), "account_id", "left").groupBy(*keys).agg(
        F.sum(F.col("_sum") * k).alias("mrr_movement"), F.sum(F.col("_n") * k).alias("subscription_count"))


def gold_mrr_trends(movement_agg: DataFrame, ctx: RunContext) -> DataFrame:
    """Movement types pivoted to columns per (month, tier), plus the net change."""
    c = F.col

    def by_type(kind: str, measure: str):
        return F.sum(F.when(c("mrr_type") == kind, c(measure)).otherwise(F.lit(0))).cast("bigint")

    return movement_agg.groupBy("month_start", "plan_tier").agg(
        by_type("new", "mrr_movement").alias("new_mrr"),
        by_type("churned", "mrr_movement").alias("churned_mrr"),
        by_type("expansion", "mrr_movement").alias("expansion_mrr"),
        by_type("contraction", "mrr_movement").alias("contraction_mrr"),
        F.sum("mrr_movement").cast("bigint").alias("net_mrr_change"),
        by_type("new", "subscription_count").alias("new_subscriptions"),
        by_type("churned", "subscription_count").alias("churned_subscriptions"),
    ).withColumn("updated_at", ctx.stamp())


def _spine_length(first: Column, ctx: RunContext) -> Column:
    return F.floor(F.months_between(ctx.today(), first)).cast("int")


def month_spine(int_subs: DataFrame, ctx: RunContext) -> DataFrame:
    """Month starts from the earliest (non-trial) subscription start up to the as-of date.

    Only a minimum is needed, so the staging subscriptions can be passed
    directly: the account join's repetitions do not change it.

    Counts ``floor(months_between(as_of, first))`` months past the first, so a
    first day later in its month than the as-of day drops the last month.
    """
    first = revenue_subscriptions(int_subs).agg(F.min("start_date").alias("first"))
    n = _spine_length(F.col("first"), ctx)
    return first.select(
        F.explode(F.when(n >= 0, F.sequence(F.lit(0), n))).alias("pos"), "first"
    ).select(month_start(F.add_months("first", F.col("pos"))).alias("month_start"))


MRR_MEASURES = ["new_mrr", "churned_mrr", "expansion_mrr", "contraction_mrr", "net_mrr_change",
                "new_subscriptions", "churned_subscriptions"]


def mrr_trends_dense(int_subs: DataFrame, trends: DataFrame, ctx: RunContext) -> DataFrame:
    """``gold_mrr_trends`` with zero rows for every spine month x plan tier.

    Like the spine it needs only a minimum and a distinct set, so the staging
    subscriptions can be passed directly. The grid is generated per tier (the
    distinct tiers of revenue subscriptions) from the spine bounds, which enter as one scalar
    subquery -- no cross join. Rows of the trend table outside the spine are
    kept (full outer join), so nothing is dropped.
    """
    subs = revenue_subscriptions(int_subs)
    first = subs.agg(F.min("start_date")).scalar()
    n = _spine_length(first, ctx)
    tiers = subs.select("plan_tier").distinct()
    grid = tiers.select(
        "plan_tier", F.explode(F.when(n >= 0, F.sequence(F.lit(0), n))).alias("pos")
    ).select(month_start(F.add_months(first, F.col("pos"))).alias("month_start"), "plan_tier")
    # NULL-safe: a NULL tier is a tier like any other, on both sides.
    keys = ["month_start", "plan_tier"]
    g, t = grid.alias("g"), trends.drop("updated_at").alias("t")
    dense = g.join(t, F.col("g.month_start").eqNullSafe(F.col("t.month_start"))
                   & F.col("g.plan_tier").eqNullSafe(F.col("t.plan_tier")), "full_outer")
    return dense.select(
        *[F.coalesce(F.col(f"g.{k}"), F.col(f"t.{k}")).alias(k) for k in keys],
        *[F.coalesce(F.col(m), F.lit(0)).cast("bigint").alias(m) for m in MRR_MEASURES],
    ).withColumn("updated_at", ctx.stamp())


# ---------------------------------------------------------------- product usage

def gold_feature_adoption(stg_feature_usage: DataFrame, stg_subscriptions: DataFrame,
                          ctx: RunContext) -> DataFrame:
    """Reach, volume, duration and errors per feature x month x plan tier x beta flag.

    The daily rows meet the subscriptions as they are and are summed after
    that, map-side first: daily rows of one month lie in as many partitions as
    days, so summing them by month before the join would cost a shuffle of
    all of them and spare none. Averages over the daily rows are taken from
    sums and non-NULL counts, the way ``avg`` itself accumulates them.
    """
    c = F.col
    u = usage_with_account(stg_feature_usage, stg_subscriptions, extra=["plan_tier"]).withColumn("usage_month", month_start(c("usage_date")))
    total, secs, errors = F.sum("total_usage_count"), F.sum("total_usage_duration_secs"), F.sum("total_error_count")
    return u.groupBy("feature_name", "usage_month", "plan_tier", "is_beta_feature").agg(
        F.countDistinct("account_id").alias("active_accounts"),
        total.alias("total_usage_count"),
        round2(safe_divide(total.cast("double"), F.count("total_usage_count"))).alias("avg_usage_per_account"),
        round2(secs / 3600.0).alias("total_usage_hours"),
        round2(safe_divide(secs.cast("double"), F.count("total_usage_duration_secs")) / 60.0).alias("avg_session_minutes"),
        errors.alias("total_errors"),
        pct(errors, total).alias("error_rate_pct"),
    ).withColumn("updated_at", ctx.stamp())


# ---------------------------------------------------------------- support

DEFAULT_PERCENTILE_ACCURACY = 10000


def gold_support_performance(stg_support_tickets: DataFrame, ctx: RunContext,
                             accuracy: int = DEFAULT_PERCENTILE_ACCURACY) -> DataFrame:
    """SLA and satisfaction KPIs per month x priority.

    Medians and p95 are approximate percentiles (a mergeable sketch, combined
    map-side); ``accuracy`` trades memory for precision as in Spark's
    ``percentile_approx``.
    """
    c = F.col
    t = stg_support_tickets.withColumn("ticket_month", month_start(c("submitted_at")))
    escalated = count_if(c("escalation_flag") == F.lit(True))
    tickets = F.count("ticket_id")

    def q(col: str, p: float):
        return round2(F.percentile_approx(col, p, accuracy))

    # Distinct accounts from deduplicated keys, on their own: next to the
    # percentiles they would make Spark keep a sketch per account.
    accounts = t.select("ticket_month", "priority", "account_id").distinct().groupBy("ticket_month", "priority").agg(
        F.count("account_id").alias("accounts_with_tickets"))
    measures = t.groupBy("ticket_month", "priority").agg(
        tickets.alias("total_tickets"),
        escalated.alias("escalated_tickets"),
        round2(F.avg("resolution_time_hours")).alias("avg_resolution_time_hours"),
        q("resolution_time_hours", 0.5).alias("median_resolution_time_hours"),
        q("resolution_time_hours", 0.95).alias("p95_resolution_time_hours"),
        round2(F.avg("first_response_time_minutes")).alias("avg_first_response_minutes"),
        q("first_response_time_minutes", 0.5).alias("median_first_response_minutes"),
        round2(F.avg("satisfaction_score")).alias("avg_satisfaction_score"),
        count_if(c("satisfaction_score") >= 4).alias("satisfied_tickets"),
        count_if(c("satisfaction_score") <= 2).alias("dissatisfied_tickets"),
        pct(escalated, tickets).alias("escalation_rate_pct"),
        pct(F.count("satisfaction_score"), tickets).alias("csat_response_rate_pct"),
    )
    same = [F.col(f"m.{k}").eqNullSafe(F.col(f"a.{k}")) for k in ("ticket_month", "priority")]
    joined = measures.alias("m").join(accounts.alias("a"), same[0] & same[1])
    columns = [F.col(f"m.{x}") for x in measures.columns]
    return joined.select(*columns[:3], "accounts_with_tickets", *columns[3:]).withColumn("updated_at", ctx.stamp())


__all__ = [
    "gold_account_health_summary", "gold_customer_segments", "at_risk_accounts",
    "gold_churn_analysis", "mrr_movements", "mrr_movement_agg", "gold_mrr_trends",
    "month_spine", "mrr_trends_dense", "gold_feature_adoption", "gold_support_performance",
    "ordered",
]
