"""Oracle SQL (DuckDB dialect) for every registered query.

Each query is ``WITH <named CTEs it needs> SELECT ...`` over the driver
tables. The formulations are deliberately different from the Spark code
(window ranking instead of ``max_by``, a four-branch UNION ALL instead of the
one-pass explode, ``lag``/``lead`` instead of the history merge) so that the
comparison checks semantics, not a transcription.

Numeric conventions shared with the Spark side: rounded measures are
doubles rounded half-up to 2 places (via DECIMAL in DuckDB), sums and counts
are BIGINT, day differences INTEGER, months TIMESTAMP.
"""

from __future__ import annotations

import re

from tidemark.functions.rules import (
    CUSTOMER_SEGMENTS,
    RECOMMENDED_ACTIONS,
    TENURE_BUCKETS,
    TENURE_LIMITS_DAYS,
)
from tidemark.sources.fixtures import MAPPING_SOURCES, mapping_text

AS_OF = "DATE '2001-12-01'"
RUN_TS = "TIMESTAMP '2001-12-01 00:00:00'"


def r2(x: str) -> str:
    # Spark rounds a double through its shortest decimal string; DuckDB's
    # double -> VARCHAR is that same shortest form.
    return f"CAST(round(CAST(CAST(CAST(({x}) AS DOUBLE) AS VARCHAR) AS DECIMAL(38,18)), 2) AS DOUBLE)"


def pct(num: str, den: str) -> str:
    return r2(f"CAST({num} AS DOUBLE) * 100.0 / nullif({den}, 0)")


def big(x: str) -> str:
    return f"CAST({x} AS BIGINT)"


def month(x: str) -> str:
    return f"CAST(date_trunc('month', CAST({x} AS TIMESTAMP)) AS TIMESTAMP)"


def _sql_list(values: list[str]) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


CTES: dict[str, str] = {}


def cte(name: str, sql: str) -> None:
    CTES[name] = sql.strip()


# ---------------------------------------------------------------- driver mapping (FIXTURES.md §3)
# The fixture mapping is shared with the Spark side: it defines the inputs,
# it is not an operator under test.
for _t in MAPPING_SOURCES:
    cte(f"fx_{_t}", mapping_text(_t))

for _t in ["accounts", "subscriptions", "churn_events", "feature_usage", "support_tickets"]:
    cte(f"b_{_t}", f"SELECT *, {RUN_TS} AS ingestion_ts FROM fx_{_t}")

# ---------------------------------------------------------------- staging
cte("s_accounts", "SELECT * FROM b_accounts WHERE account_id IS NOT NULL")
cte("s_subscriptions", "SELECT * FROM b_subscriptions WHERE subscription_id IS NOT NULL AND account_id IS NOT NULL")
cte("s_churn", "SELECT * FROM b_churn_events WHERE churn_event_id IS NOT NULL AND account_id IS NOT NULL")
cte("s_tickets", "SELECT * FROM b_support_tickets WHERE ticket_id IS NOT NULL AND account_id IS NOT NULL")
cte("s_usage", f"""
SELECT subscription_id, usage_date, feature_name,
       {big('sum(usage_count)')} AS total_usage_count,
       {big('sum(usage_duration_secs)')} AS total_usage_duration_secs,
       {big('sum(error_count)')} AS total_error_count,
       bool_or(is_beta_feature) AS is_beta_feature
FROM b_feature_usage WHERE subscription_id IS NOT NULL
GROUP BY subscription_id, usage_date, feature_name""")

# ---------------------------------------------------------------- intermediate
cte("i_subs", f"""
SELECT s.subscription_id, s.account_id, a.account_name, a.industry, a.country, a.signup_date, a.referral_source,
       s.start_date, s.end_date, s.plan_tier, s.seats, s.mrr_amount, s.arr_amount, s.is_trial,
       s.upgrade_flag, s.downgrade_flag, s.churn_flag, s.billing_frequency, s.auto_renew_flag,
       s.end_date IS NULL AS is_active,
       CAST(coalesce(s.end_date, {AS_OF}) - s.start_date AS INTEGER) AS subscription_duration_days
FROM s_subscriptions s LEFT JOIN s_accounts a ON a.account_id = s.account_id""")
cte("i_latest_sub", """
SELECT account_id, subscription_id, start_date, plan_tier, mrr_amount, arr_amount, billing_frequency FROM (
  SELECT *, row_number() OVER (PARTITION BY account_id
                               ORDER BY start_date DESC NULLS LAST, subscription_id DESC) AS pick
  FROM s_subscriptions) ranked
WHERE pick = 1""")
cte("i_churn", """
SELECT e.churn_event_id, e.account_id, a.account_name, a.industry, a.country, a.signup_date,
       CAST(e.churn_date - a.signup_date AS INTEGER) AS days_to_churn,
       e.churn_date, e.reason_code, e.refund_amount_usd, e.preceding_upgrade_flag, e.preceding_downgrade_flag,
       e.is_reactivation, e.feedback_text,
       coalesce(l.plan_tier, a.plan_tier) AS plan_tier_at_churn,
       l.mrr_amount AS mrr_at_churn, l.arr_amount AS arr_at_churn, l.billing_frequency,
       CASE WHEN e.preceding_downgrade_flag THEN 'downgrade_to_churn'
            WHEN e.preceding_upgrade_flag THEN 'upgrade_to_churn'
            ELSE 'direct_churn' END AS churn_path
FROM s_churn e
LEFT JOIN s_accounts a ON a.account_id = e.account_id
LEFT JOIN i_latest_sub l ON l.account_id = e.account_id""")
cte("i_latest_churn", """
SELECT * EXCLUDE (pick) FROM (
  SELECT *, row_number() OVER (PARTITION BY account_id
                               ORDER BY churn_date DESC NULLS LAST, churn_event_id DESC) AS pick
  FROM i_churn) ranked
WHERE pick = 1""")
cte("i_support", f"""
SELECT account_id,
       count(ticket_id) AS total_tickets,
       count(*) FILTER (WHERE priority = 'urgent') AS urgent_tickets,
       count(*) FILTER (WHERE priority = 'high') AS high_priority_tickets,
       count(*) FILTER (WHERE escalation_flag) AS escalated_tickets,
       {r2('avg(resolution_time_hours)')} AS avg_resolution_time_hours,
       {r2('avg(first_response_time_minutes)')} AS avg_first_response_time_minutes,
       {r2('avg(satisfaction_score)')} AS avg_satisfaction_score,
       min(satisfaction_score) AS min_satisfaction_score,
       {pct('count(*) FILTER (WHERE escalation_flag)', 'count(ticket_id)')} AS escalation_rate_pct,
       max(submitted_at) AS last_ticket_date,
       min(submitted_at) AS first_ticket_date
FROM s_tickets GROUP BY account_id""")
cte("i_usage_rows", """
SELECT s.account_id, s.plan_tier, u.* FROM s_usage u JOIN s_subscriptions s ON s.subscription_id = u.subscription_id""")
cte("i_top_feature", """
SELECT account_id, feature_name AS top_feature FROM (
  SELECT account_id, feature_name,
         row_number() OVER (PARTITION BY account_id ORDER BY total_usage_count DESC, feature_name DESC) AS pick
  FROM i_usage_rows WHERE total_usage_count IS NOT NULL) ranked
WHERE pick = 1""")
cte("i_usage", f"""
SELECT r.account_id,
       count(DISTINCT feature_name) AS distinct_features_used,
       {big('sum(total_usage_count)')} AS total_usage_count,
       {r2('sum(total_usage_duration_secs) / 3600.0')} AS total_usage_hours,
       {big('sum(total_error_count)')} AS total_error_count,
       {pct('sum(total_error_count)', 'sum(total_usage_count)')} AS error_rate_pct,
       count(DISTINCT feature_name) FILTER (WHERE is_beta_feature) AS beta_features_used,
       any_value(t.top_feature) AS top_feature,
       max(usage_date) AS last_usage_date,
       min(usage_date) AS first_usage_date,
       count(DISTINCT usage_date) AS active_days
FROM i_usage_rows r LEFT JOIN i_top_feature t ON t.account_id = r.account_id
GROUP BY r.account_id""")
cte("i_sub_summary", """
SELECT account_id,
       count(subscription_id) AS total_subscriptions,
       CAST(sum(mrr_amount) AS BIGINT) AS total_mrr,
       CAST(sum(arr_amount) AS BIGINT) AS total_arr,
       max(mrr_amount) AS peak_mrr,
       count(*) FILTER (WHERE is_active) AS active_subscriptions,
       max(plan_tier) FILTER (WHERE is_active) AS current_plan_tier,
       max(mrr_amount) FILTER (WHERE is_active) AS current_mrr,
       bool_or(upgrade_flag) AS ever_upgraded,
       bool_or(downgrade_flag) AS ever_downgraded,
       max(start_date) AS latest_subscription_start
FROM i_subs GROUP BY account_id""")
_HEALTH = r2(
    "least(100.0, least(40.0, coalesce(u.active_days, 0) * 0.5)"
    " + coalesce(t.avg_satisfaction_score, 3) / 5.0 * 30"
    " + CASE WHEN coalesce(t.escalation_rate_pct, 0) = 0 THEN 15 ELSE 0 END"
    " + least(15.0, coalesce(u.distinct_features_used, 0) * 1.5))"
)
cte("i_360", f"""
SELECT a.account_id, a.account_name, a.industry, a.country, a.signup_date, a.referral_source,
       a.plan_tier AS original_plan_tier, a.seats, a.is_trial, a.churn_flag,
       s.total_subscriptions, s.total_mrr, s.total_arr, s.peak_mrr, s.active_subscriptions,
       s.current_plan_tier, s.current_mrr, s.ever_upgraded, s.ever_downgraded, s.latest_subscription_start,
       c.churn_date, c.reason_code AS churn_reason, c.refund_amount_usd, c.churn_path, c.days_to_churn, c.mrr_at_churn,
       coalesce(t.total_tickets, 0) AS total_tickets, t.avg_resolution_time_hours, t.avg_satisfaction_score,
       coalesce(t.escalation_rate_pct, 0.0) AS escalation_rate_pct, t.last_ticket_date,
       coalesce(u.distinct_features_used, 0) AS distinct_features_used,
       coalesce(u.total_usage_count, 0) AS total_usage_count, u.total_usage_hours,
       coalesce(u.error_rate_pct, 0.0) AS error_rate_pct, coalesce(u.beta_features_used, 0) AS beta_features_used,
       u.top_feature, u.last_usage_date, coalesce(u.active_days, 0) AS active_days,
       {_HEALTH} AS health_score,
       coalesce(u.total_error_count, 0) AS total_error_count
FROM s_accounts a
LEFT JOIN i_sub_summary s ON s.account_id = a.account_id
LEFT JOIN i_latest_churn c ON c.account_id = a.account_id
LEFT JOIN i_support t ON t.account_id = a.account_id
LEFT JOIN i_usage u ON u.account_id = a.account_id""")

# ---------------------------------------------------------------- gold
cte("g_health", f"""
SELECT account_id, account_name, industry, country, referral_source, signup_date,
       coalesce(current_plan_tier, original_plan_tier) AS plan_tier, seats, is_trial, churn_flag,
       active_subscriptions > 0 AS is_active_customer,
       coalesce(current_mrr, 0) AS current_mrr, coalesce(total_arr, 0) AS total_arr, coalesce(peak_mrr, 0) AS peak_mrr,
       ever_upgraded, ever_downgraded,
       distinct_features_used, total_usage_count, total_usage_hours, active_days, top_feature, last_usage_date,
       beta_features_used,
       {pct('total_error_count', 'total_usage_count')} AS error_rate_pct,
       total_tickets, avg_resolution_time_hours, avg_satisfaction_score, escalation_rate_pct, last_ticket_date,
       churn_date, churn_reason, churn_path, days_to_churn, mrr_at_churn, refund_amount_usd,
       health_score,
       CASE WHEN churn_flag THEN 'Churned' WHEN health_score >= 75 THEN 'Healthy'
            WHEN health_score >= 50 THEN 'At Risk' ELSE 'Critical' END AS health_status,
       {RUN_TS} AS updated_at
FROM i_360""")
_TENURE = f"CAST({AS_OF} - signup_date AS INTEGER)"
_IDLE = f"CAST({AS_OF} - last_usage_date AS INTEGER)"
cte("g_segments_base", f"""
SELECT *, coalesce(current_mrr, 0) AS mrr0, {_TENURE} AS tenure_days, {_IDLE} AS idle_days,
       CASE
         WHEN health_score >= 80 AND coalesce(current_mrr, 0) >= 1000 AND ever_upgraded THEN 1
         WHEN health_score >= 75 AND coalesce(current_mrr, 0) >= 500 THEN 2
         WHEN health_score >= 60 AND {_TENURE} <= 90 THEN 3
         WHEN health_score >= 50 AND {_TENURE} <= 30 THEN 4
         WHEN health_score < 50 AND ever_downgraded THEN 5
         WHEN health_score < 40 AND {_IDLE} > 30 THEN 6
         WHEN health_score < 30 THEN 7
         ELSE 8 END AS rule_no
FROM i_360 WHERE churn_flag = false""")
cte("g_segments", f"""
SELECT account_id, account_name, industry, country,
       coalesce(current_plan_tier, original_plan_tier) AS plan_tier, mrr0 AS current_mrr,
       health_score, distinct_features_used, active_days, total_tickets, avg_satisfaction_score,
       escalation_rate_pct, ever_upgraded, ever_downgraded, signup_date, last_usage_date,
       idle_days AS days_since_last_activity,
       {_sql_list(CUSTOMER_SEGMENTS)}[rule_no] AS customer_segment,
       {_sql_list(RECOMMENDED_ACTIONS)}[rule_no] AS recommended_action,
       {RUN_TS} AS updated_at
FROM g_segments_base""")
_TENURE_WHENS = " ".join(f"WHEN days_to_churn < {d} THEN '{b}'" for d, b in zip(TENURE_LIMITS_DAYS, TENURE_BUCKETS))
cte("g_churn", f"""
SELECT churn_event_id, account_id, account_name, industry, country, plan_tier_at_churn, billing_frequency,
       signup_date, churn_date, days_to_churn, {month('churn_date')} AS churn_month,
       CASE {_TENURE_WHENS} ELSE '{TENURE_BUCKETS[-1]}' END AS tenure_bucket,
       reason_code AS churn_reason, churn_path, preceding_upgrade_flag, preceding_downgrade_flag,
       is_reactivation, feedback_text,
       coalesce(mrr_at_churn, 0) AS mrr_lost, coalesce(arr_at_churn, 0) AS arr_lost,
       coalesce(refund_amount_usd, 0.0) AS refund_amount_usd,
       {RUN_TS} AS updated_at
FROM i_churn""")
cte("g_paying", "SELECT * FROM i_subs WHERE is_trial = false")
cte("g_moves", f"""
SELECT * FROM (
  SELECT {month('start_date')} AS month_start, plan_tier, mrr_amount, 'new' AS mrr_type FROM g_paying
  UNION ALL
  SELECT {month('end_date')}, plan_tier, -mrr_amount, 'churned' FROM g_paying
   WHERE churn_flag AND end_date IS NOT NULL
  UNION ALL
  SELECT {month('start_date')}, plan_tier, mrr_amount, 'expansion' FROM g_paying WHERE upgrade_flag
  UNION ALL
  SELECT {month('start_date')}, plan_tier, -mrr_amount, 'contraction' FROM g_paying WHERE downgrade_flag
) m WHERE month_start IS NOT NULL""")
cte("g_move_agg", """
SELECT month_start, plan_tier, mrr_type, CAST(sum(mrr_amount) AS BIGINT) AS mrr_movement,
       count(*) AS subscription_count
FROM g_moves GROUP BY month_start, plan_tier, mrr_type""")


def _by_type(kind: str, measure: str) -> str:
    return f"CAST(sum(CASE WHEN mrr_type = '{kind}' THEN {measure} ELSE 0 END) AS BIGINT)"


cte("g_mrr", f"""
SELECT month_start, plan_tier,
       {_by_type('new', 'mrr_movement')} AS new_mrr,
       {_by_type('churned', 'mrr_movement')} AS churned_mrr,
       {_by_type('expansion', 'mrr_movement')} AS expansion_mrr,
       {_by_type('contraction', 'mrr_movement')} AS contraction_mrr,
       CAST(sum(mrr_movement) AS BIGINT) AS net_mrr_change,
       {_by_type('new', 'subscription_count')} AS new_subscriptions,
       {_by_type('churned', 'subscription_count')} AS churned_subscriptions,
       {RUN_TS} AS updated_at
FROM g_move_agg GROUP BY month_start, plan_tier""")
# Whole months between the first start and the as-of date, counted the way
# Spark's floor(months_between(as_of, first)) does.
cte("g_spine_bounds", f"""
SELECT first,
       (year({AS_OF}) - year(first)) * 12 + month({AS_OF}) - month(first)
       - CASE WHEN day({AS_OF}) < day(first)
                   AND NOT (last_day({AS_OF}) = {AS_OF} AND last_day(first) = first) THEN 1 ELSE 0 END AS n
FROM (SELECT min(start_date) AS first FROM g_paying) f""")
cte("g_spine", f"""
SELECT {month("first + to_months(CAST(pos AS INTEGER))")} AS month_start
FROM g_spine_bounds, range(0, CASE WHEN n >= 0 THEN n + 1 ELSE 0 END) AS r(pos)
WHERE first IS NOT NULL""")
cte("g_mrr_dense", f"""
SELECT coalesce(g.month_start, t.month_start) AS month_start, coalesce(g.plan_tier, t.plan_tier) AS plan_tier,
       coalesce(t.new_mrr, 0) AS new_mrr, coalesce(t.churned_mrr, 0) AS churned_mrr,
       coalesce(t.expansion_mrr, 0) AS expansion_mrr, coalesce(t.contraction_mrr, 0) AS contraction_mrr,
       coalesce(t.net_mrr_change, 0) AS net_mrr_change, coalesce(t.new_subscriptions, 0) AS new_subscriptions,
       coalesce(t.churned_subscriptions, 0) AS churned_subscriptions, {RUN_TS} AS updated_at
FROM (SELECT s.month_start, p.plan_tier FROM g_spine s, (SELECT DISTINCT plan_tier FROM g_paying) p) g
FULL OUTER JOIN g_mrr t ON t.month_start = g.month_start AND t.plan_tier IS NOT DISTINCT FROM g.plan_tier""")
cte("g_features", f"""
SELECT feature_name, {month('usage_date')} AS usage_month, plan_tier, is_beta_feature,
       count(DISTINCT account_id) AS active_accounts,
       {big('sum(total_usage_count)')} AS total_usage_count,
       {r2('avg(total_usage_count)')} AS avg_usage_per_account,
       {r2('sum(total_usage_duration_secs) / 3600.0')} AS total_usage_hours,
       {r2('avg(total_usage_duration_secs) / 60.0')} AS avg_session_minutes,
       {big('sum(total_error_count)')} AS total_errors,
       {pct('sum(total_error_count)', 'sum(total_usage_count)')} AS error_rate_pct,
       {RUN_TS} AS updated_at
FROM i_usage_rows GROUP BY ALL""")
cte("g_support", f"""
SELECT {month('submitted_at')} AS ticket_month, priority,
       count(ticket_id) AS total_tickets,
       count(DISTINCT account_id) AS accounts_with_tickets,
       count(*) FILTER (WHERE escalation_flag) AS escalated_tickets,
       {r2('avg(resolution_time_hours)')} AS avg_resolution_time_hours,
       {r2('quantile_disc(resolution_time_hours, 0.5)')} AS median_resolution_time_hours,
       {r2('quantile_disc(resolution_time_hours, 0.95)')} AS p95_resolution_time_hours,
       {r2('avg(first_response_time_minutes)')} AS avg_first_response_minutes,
       {r2('quantile_disc(first_response_time_minutes, 0.5)')} AS median_first_response_minutes,
       {r2('avg(satisfaction_score)')} AS avg_satisfaction_score,
       count(*) FILTER (WHERE satisfaction_score >= 4) AS satisfied_tickets,
       count(*) FILTER (WHERE satisfaction_score <= 2) AS dissatisfied_tickets,
       {pct('count(*) FILTER (WHERE escalation_flag)', 'count(ticket_id)')} AS escalation_rate_pct,
       {pct('count(satisfaction_score)', 'count(ticket_id)')} AS csat_response_rate_pct,
       {RUN_TS} AS updated_at
FROM s_tickets GROUP BY 1, 2""")


# ---------------------------------------------------------------- assembly

_REF = re.compile(r"\b([a-z][a-z0-9_]*)\b")


def _deps(sql: str) -> list[str]:
    seen = []
    for tok in _REF.findall(sql):
        if tok in CTES and tok not in seen:
            seen.append(tok)
    return seen


def with_ctes(final_sql: str) -> str:
    """``final_sql`` prefixed by the CTEs it (transitively) references, in dependency order."""
    order: list[str] = []

    def visit(name: str, stack: tuple[str, ...] = ()) -> None:
        if name in order or name in stack:
            return
        for d in _deps(CTES[name]):
            if d != name:
                visit(d, stack + (name,))
        order.append(name)

    for d in _deps(final_sql):
        visit(d)
    if not order:
        return final_sql.strip()
    body = ",\n".join(f"{n} AS (\n{CTES[n]}\n)" for n in order)
    return f"WITH {body}\n{final_sql.strip()}"


# ---------------------------------------------------------------- subscription history
_N = "CAST(substr(subscription_id, 3) AS BIGINT)"
_SNAP = ("subscription_id, account_id, start_date, end_date, plan_tier, seats, mrr_amount, arr_amount, "
         "is_trial, upgrade_flag, downgrade_flag, churn_flag, billing_frequency, auto_renew_flag")
_B2 = (f"subscription_id, account_id, start_date, "
       f"CASE WHEN {_N} % 19 = 4 THEN DATE '2001-10-15' ELSE end_date END AS end_date, "
       f"CASE WHEN {_N} % 10 = 1 THEN 'Enterprise' ELSE plan_tier END AS plan_tier, "
       f"CASE WHEN {_N} % 13 = 0 THEN seats + 5 ELSE seats END AS seats, mrr_amount, arr_amount, is_trial, "
       f"upgrade_flag, downgrade_flag, churn_flag, billing_frequency, auto_renew_flag")
cte("h_batch2", f"SELECT {_B2} FROM s_subscriptions")
cte("h_rows", f"""
SELECT 1 AS batch_no, TIMESTAMP '2001-10-01 00:00:00' AS stamp, {_SNAP} FROM s_subscriptions WHERE {_N} % 17 <> 3
UNION ALL
SELECT 2, TIMESTAMP '2001-11-01 00:00:00', {_SNAP} FROM h_batch2
UNION ALL
SELECT 3, TIMESTAMP '2001-12-01 00:00:00', subscription_id, account_id, start_date, end_date, plan_tier, seats,
       mrr_amount, arr_amount, is_trial, upgrade_flag, downgrade_flag,
       CASE WHEN {_N} % 29 = 6 THEN CAST(NULL AS BOOLEAN) ELSE churn_flag END,
       billing_frequency, auto_renew_flag
FROM h_batch2 WHERE {_N} % 31 <> 8""")
_CHECKED = ["plan_tier", "mrr_amount", "arr_amount", "seats", "churn_flag", "upgrade_flag", "downgrade_flag",
            "auto_renew_flag"]
cte("h_marked", "SELECT *, lag(batch_no) OVER w AS prev_batch, ("
    + " OR ".join(f"lag({c}) OVER w IS DISTINCT FROM {c}" for c in _CHECKED)
    + ") AS differs FROM h_rows WINDOW w AS (PARTITION BY subscription_id ORDER BY batch_no)")
cte("h_history", f"""
SELECT {_SNAP}, stamp AS ingestion_ts, stamp AS valid_from,
       lead(stamp) OVER (PARTITION BY subscription_id ORDER BY batch_no) AS valid_to,
       sha256(subscription_id || '|' || CAST(stamp AS VARCHAR)) AS version_id
FROM h_marked WHERE prev_batch IS NULL OR differs""")

# ---------------------------------------------------------------- data quality
MODEL_CTE = {
    "stg_accounts": "s_accounts", "stg_subscriptions": "s_subscriptions", "stg_feature_usage": "s_usage",
    "stg_churn_events": "s_churn", "stg_support_tickets": "s_tickets",
    "int_account_subscriptions": "i_subs", "int_account_churn": "i_churn", "int_account_support": "i_support",
    "int_account_feature_usage": "i_usage", "int_account_360": "i_360",
    "gold_account_health_summary": "g_health", "gold_churn_analysis": "g_churn", "gold_mrr_trends": "g_mrr",
    "gold_feature_adoption": "g_features", "gold_support_performance": "g_support",
    "gold_customer_segments": "g_segments",
}


def _quote(v: str) -> str:
    return "'" + v.replace("'", "''") + "'"


def dq_check_sql(model: str, column: str, test: str, args: dict) -> str:
    src = MODEL_CTE[model]
    head = f"SELECT {_quote(model)} AS model, {_quote(column)} AS column_name, {_quote(test)} AS test, "
    if test == "not_null":
        return head + f"CAST(count(*) FILTER (WHERE {column} IS NULL) AS BIGINT) AS failures FROM {src}"
    if test == "unique":
        return head + (f"CAST(count(*) AS BIGINT) AS failures FROM (SELECT {column} FROM {src} "
                       f"WHERE {column} IS NOT NULL GROUP BY {column} HAVING count(*) > 1) d")
    if test == "unique_combination":
        return head + f"CAST(count(*) AS BIGINT) AS failures FROM (SELECT 1 FROM {src} GROUP BY {column} HAVING count(*) > 1) d"
    if test == "relationships":
        parent = MODEL_CTE[args["to"]]
        return head + (f"CAST(count(*) AS BIGINT) AS failures FROM {src} c WHERE c.{column} IS NOT NULL "
                       f"AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{args['field']} = c.{column})")
    if test == "accepted_values":
        vals = ", ".join(_quote(v) for v in args["values"])
        return head + (f"CAST(count(DISTINCT {column}) AS BIGINT) AS failures FROM {src} "
                       f"WHERE {column} IS NOT NULL AND {column} NOT IN ({vals})")
    raise ValueError(test)


def dq_report_sql(checks) -> str:
    body = "\nUNION ALL\n".join(dq_check_sql(c.model, c.column, c.test, c.args) for c in checks)
    return (f"SELECT *, CASE WHEN failures = 0 THEN 'pass' ELSE 'fail' END AS status FROM (\n{body}\n) r")
