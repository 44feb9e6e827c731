"""Rule edges on small hand-made frames (every CASE boundary, NULLs, zero denominators)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.context import RunContext
from tidemark.functions.core import pct
from tidemark.functions.rules import churn_path, health_score, health_status, tenure_bucket
from tidemark.operators import gold

D = dt.date
CTX = RunContext.pinned()  # as-of 2001-12-01


def days_before(n):
    return CTX.as_of_date - dt.timedelta(days=n)


@pytest.mark.parametrize("churn,score,expected", [
    (True, 90.0, "Churned"),
    (None, 75.0, "Healthy"),
    (False, 74.99, "At Risk"),
    (False, 50.0, "At Risk"),
    (False, 49.99, "Critical"),
    (None, None, "Critical"),
])
def test_health_status(spark, churn, score, expected):
    df = spark.createDataFrame([(churn, score)], "churn boolean, score double")
    got = df.select(health_status(F.col("churn"), F.col("score"))).first()[0]
    assert got == expected


@pytest.mark.parametrize("days,expected", [
    (-5, "< 1 month"), (29, "< 1 month"), (30, "1–3 months"), (89, "1–3 months"),
    (90, "3–6 months"), (179, "3–6 months"), (180, "6–12 months"), (364, "6–12 months"),
    (365, "12+ months"), (None, "12+ months"),
])
def test_tenure_bucket(spark, days, expected):
    df = spark.createDataFrame([(days,)], "d int")
    assert df.select(tenure_bucket(F.col("d"))).first()[0] == expected


@pytest.mark.parametrize("down,up,expected", [
    (True, True, "downgrade_to_churn"), (None, True, "upgrade_to_churn"),
    (False, None, "direct_churn"), (None, None, "direct_churn"),
])
def test_churn_path(spark, down, up, expected):
    df = spark.createDataFrame([(down, up)], "d boolean, u boolean")
    assert df.select(churn_path(F.col("d"), F.col("u"))).first()[0] == expected


@pytest.mark.parametrize("num,den,expected", [
    (1, 0, None), (0, 0, None), (1, 8, 12.5), (1, 3, 33.33), (2, 3, 66.67), (1, 160, 0.63), (None, 4, None),
])
def test_pct_half_up_and_zero_denominator(spark, num, den, expected):
    df = spark.createDataFrame([(num, den)], "n bigint, d bigint")
    assert df.select(pct(F.col("n"), F.col("d"))).first()[0] == expected


@pytest.mark.parametrize("days,sat,esc,feat,expected", [
    (0, None, 0.0, 0, 33.0),          # no usage, no tickets: neutral satisfaction + no escalation
    (80, 5.0, 0.0, 10, 100.0),        # every component at its cap
    (200, 5.0, 0.0, 50, 100.0),       # caps hold beyond the limits
    (10, 2.5, 12.5, 3, 24.5),         # 5 + 15 + 0 + 4.5
    (1, 3.67, 0.0, 1, 39.02),         # 0.5 + 22.02 + 15 + 1.5
])
def test_health_score(spark, days, sat, esc, feat, expected):
    df = spark.createDataFrame([(days, sat, esc, feat)], "a bigint, s double, e double, f bigint")
    got = df.select(health_score(F.col("a"), F.col("s"), F.col("e"), F.col("f"))).first()[0]
    assert got == expected


SPINE_SCHEMA = ("account_id string, account_name string, industry string, country string, "
                "current_plan_tier string, original_plan_tier string, current_mrr bigint, health_score double, "
                "distinct_features_used bigint, active_days bigint, total_tickets bigint, "
                "avg_satisfaction_score double, escalation_rate_pct double, ever_upgraded boolean, "
                "ever_downgraded boolean, signup_date date, last_usage_date date, churn_flag boolean")


def spine_row(i, health, mrr=0, up=False, down=False, tenure=1000, idle=0, churn=False):
    last = days_before(idle) if idle is not None else None
    return (f"A-{i}", "n", "ind", "c", "Pro", "Basic", mrr, health, 1, 1, 0, None, 0.0, up, down,
            days_before(tenure), last, churn)


SEGMENT_CASES = [
    (spine_row(1, 80.0, mrr=1000, up=True), "Champion", "Upsell / Advocacy program"),
    (spine_row(2, 79.99, mrr=1000, up=True), "Loyal", "Nurture and expand"),
    (spine_row(3, 80.0, mrr=999, up=True), "Loyal", "Nurture and expand"),
    (spine_row(4, 80.0, mrr=1000, up=None), "Loyal", "Nurture and expand"),
    (spine_row(5, 75.0, mrr=500), "Loyal", "Nurture and expand"),
    (spine_row(6, 74.99, mrr=500, tenure=90), "Promising", "Onboarding check-in"),
    (spine_row(7, 60.0, tenure=91), "Needs Attention", "Monitor and check in"),
    (spine_row(8, 50.0, tenure=30), "New Customer", "Send welcome sequence"),
    (spine_row(9, 50.0, tenure=31), "Needs Attention", "Monitor and check in"),
    (spine_row(10, 49.99, down=True), "At Risk – Downgraded", "CSM outreach – retention offer"),
    (spine_row(11, 39.99, idle=31), "Hibernating", "Re-engagement campaign"),
    (spine_row(12, 39.99, idle=30), "Needs Attention", "Monitor and check in"),
    (spine_row(13, 39.99, idle=None), "Needs Attention", "Monitor and check in"),
    (spine_row(14, 29.99, idle=None), "Critical – Likely to Churn", "Urgent CSM intervention"),
    (spine_row(15, 29.99, idle=31), "Hibernating", "Re-engagement campaign"),
]


def test_customer_segments_edges(spark):
    rows = [r for r, _, _ in SEGMENT_CASES]
    rows += [spine_row(90, 99.0, churn=True), spine_row(91, 99.0, churn=None)]  # excluded
    df = spark.createDataFrame(rows, SPINE_SCHEMA)
    out = {r.account_id: (r.customer_segment, r.recommended_action)
           for r in gold.gold_customer_segments(df, CTX).collect()}
    expected = {r[0]: (seg, act) for r, seg, act in SEGMENT_CASES}
    assert out == expected


def test_customer_segment_labels_are_exact_bytes():
    from tidemark.functions.rules import CUSTOMER_SEGMENTS
    assert "At Risk – Downgraded" in CUSTOMER_SEGMENTS
    assert "Critical – Likely to Churn" in CUSTOMER_SEGMENTS


TICKETS = ("ticket_id string, account_id string, submitted_at timestamp, closed_at timestamp, "
           "resolution_time_hours double, priority string, first_response_time_minutes int, "
           "satisfaction_score int, escalation_flag boolean, ingestion_ts timestamp")


def test_support_performance_satisfaction_edges(spark):
    t = dt.datetime(2001, 5, 3, 10, 0, 0)
    rows = [
        ("T1", "A-1", t, None, 1.0, "high", 10, 2, True, None),
        ("T2", "A-1", t, None, 2.0, "high", 20, 3, False, None),
        ("T3", "A-2", t, None, 3.0, "high", 30, 4, None, None),
        ("T4", "A-2", t, None, None, "high", 40, None, True, None),
        ("T5", "A-3", t, None, 5.0, "high", 50, 5, False, None),
        ("T6", "A-3", t, None, 6.0, "high", 60, 1, False, None),
    ]
    r = gold.gold_support_performance(spark.createDataFrame(rows, TICKETS), CTX).first()
    assert r.ticket_month == dt.datetime(2001, 5, 1)
    assert (r.total_tickets, r.accounts_with_tickets, r.escalated_tickets) == (6, 3, 2)
    assert (r.satisfied_tickets, r.dissatisfied_tickets) == (2, 2)
    assert r.avg_satisfaction_score == 3.0
    assert r.csat_response_rate_pct == 83.33
    assert r.escalation_rate_pct == 33.33
    assert r.avg_resolution_time_hours == 3.4
    assert r.median_resolution_time_hours == 3.0  # smallest value with >= half at or below it
    assert r.p95_resolution_time_hours == 6.0
    assert r.median_first_response_minutes == 30.0


def test_month_spine_from_month_end(spark):
    subs = spark.createDataFrame([(D(2001, 1, 31), False), (D(2001, 2, 15), None)],
                                 "start_date date, is_trial boolean")
    ctx = RunContext(D(2001, 3, 1), dt.datetime(2001, 3, 1))
    months = [r.month_start for r in gold.month_spine(subs, ctx).orderBy("month_start").collect()]
    # floor(months_between(1 Mar, 31 Jan)) = 1: the spine stops before March.
    assert months == [dt.datetime(2001, 1, 1), dt.datetime(2001, 2, 1)]


def test_month_spine_empty_and_future(spark):
    ctx = RunContext(D(2001, 3, 1), dt.datetime(2001, 3, 1))
    empty = spark.createDataFrame([], "start_date date, is_trial boolean")
    assert gold.month_spine(empty, ctx).count() == 0
    future = spark.createDataFrame([(D(2002, 1, 1), False)], "start_date date, is_trial boolean")
    assert gold.month_spine(future, ctx).count() == 0


def test_presentation_order_applied_on_read(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2001, 1, 1), "Pro"), (dt.datetime(2001, 2, 1), "Basic"), (dt.datetime(2001, 1, 1), "Basic")],
        "month_start timestamp, plan_tier string")
    got = [(r.month_start.month, r.plan_tier) for r in gold.ordered("gold_mrr_trends", df).collect()]
    assert got == [(1, "Basic"), (1, "Pro"), (2, "Basic")]
    assert gold.ordered("not_a_report", df) is df
