"""Business rule tables: labels, thresholds, ladders.

The labels and thresholds are fixed values that the results must reproduce
byte for byte (note the en dash U+2013 in three labels).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.core import rule_ladder

# ---- fixed values ---------------------------------------------------------
HEALTH_STATUSES = ["Healthy", "At Risk", "Critical", "Churned"]

CUSTOMER_SEGMENTS = [
    "Champion",
    "Loyal",
    "Promising",
    "New Customer",
    "At Risk – Downgraded",
    "Hibernating",
    "Critical – Likely to Churn",
    "Needs Attention",
]

RECOMMENDED_ACTIONS = [
    "Upsell / Advocacy program",
    "Nurture and expand",
    "Onboarding check-in",
    "Send welcome sequence",
    "CSM outreach – retention offer",
    "Re-engagement campaign",
    "Urgent CSM intervention",
    "Monitor and check in",
]

TENURE_BUCKETS = ["< 1 month", "1–3 months", "3–6 months", "6–12 months", "12+ months"]
TENURE_LIMITS_DAYS = [30, 90, 180, 365]

CHURN_PATHS = ["downgrade_to_churn", "upgrade_to_churn", "direct_churn"]

# Movement types of the recurring-revenue waterfall.
MRR_TYPES = ["new", "churned", "expansion", "contraction"]
# ---------------------------------------------------------------------------


def health_status(churn_flag: Column, health_score: Column) -> Column:
    return rule_ladder(
        [
            (churn_flag == F.lit(True), "Churned"),
            (health_score >= 75, "Healthy"),
            (health_score >= 50, "At Risk"),
        ],
        "Critical",
    )


def segment_conditions(
    health: Column, mrr: Column, upgraded: Column, downgraded: Column,
    days_since_signup: Column, days_idle: Column,
) -> list[Column]:
    """The seven ordered segment conditions; the eighth label is the fallback."""
    return [
        (health >= 80) & (mrr >= 1000) & (upgraded == F.lit(True)),
        (health >= 75) & (mrr >= 500),
        (health >= 60) & (days_since_signup <= 90),
        (health >= 50) & (days_since_signup <= 30),
        (health < 50) & (downgraded == F.lit(True)),
        (health < 40) & (days_idle > 30),
        health < 30,
    ]


def segment_and_action(conditions: list[Column]) -> tuple[Column, Column]:
    """One rule table drives both the segment label and the recommended action."""
    seg = rule_ladder(list(zip(conditions, CUSTOMER_SEGMENTS[:-1])), CUSTOMER_SEGMENTS[-1])
    act = rule_ladder(list(zip(conditions, RECOMMENDED_ACTIONS[:-1])), RECOMMENDED_ACTIONS[-1])
    return seg, act


def tenure_bucket(days: Column) -> Column:
    return rule_ladder(
        [(days < lim, label) for lim, label in zip(TENURE_LIMITS_DAYS, TENURE_BUCKETS)],
        TENURE_BUCKETS[-1],
    )


def churn_path(downgrade_flag: Column, upgrade_flag: Column) -> Column:
    return rule_ladder(
        [(downgrade_flag == F.lit(True), CHURN_PATHS[0]), (upgrade_flag == F.lit(True), CHURN_PATHS[1])],
        CHURN_PATHS[2],
    )


def health_score(active_days: Column, avg_satisfaction: Column, escalation_rate: Column,
                 distinct_features: Column) -> Column:
    """0-100 score: engagement (40) + satisfaction (30) + no escalations (15) + breadth (15).

    Inputs are already zero-filled where the spec says so, except the
    satisfaction average, which defaults to 3 (neutral) here.
    """
    engagement = F.least(F.lit(40.0), active_days.cast("double") * 0.5)
    satisfaction = F.coalesce(avg_satisfaction, F.lit(3.0)) / 5.0 * 30
    no_escalation = F.when(escalation_rate == 0, F.lit(15.0)).otherwise(F.lit(0.0))
    breadth = F.least(F.lit(15.0), distinct_features.cast("double") * 1.5)
    return F.round(F.least(F.lit(100.0), engagement + satisfaction + no_escalation + breadth), 2)
