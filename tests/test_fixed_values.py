"""Labels, limits and the list of checks, written out once more: the oracle imports them, so it cannot see a slip."""

from collections import Counter

from tidemark.functions import rules as R
from tidemark.operators import quality as Q


def test_labels():
    assert R.HEALTH_STATUSES == ["Healthy", "At Risk", "Critical", "Churned"]
    assert R.CUSTOMER_SEGMENTS == ["Champion", "Loyal", "Promising", "New Customer", "At Risk – Downgraded", "Hibernating",
                                   "Critical – Likely to Churn", "Needs Attention"]
    assert R.RECOMMENDED_ACTIONS == ["Upsell / Advocacy program", "Nurture and expand", "Onboarding check-in", "Send welcome sequence",
                                     "CSM outreach – retention offer", "Re-engagement campaign", "Urgent CSM intervention",
                                     "Monitor and check in"]
    assert R.TENURE_BUCKETS == ["< 1 month", "1–3 months", "3–6 months", "6–12 months", "12+ months"]
    assert R.TENURE_LIMITS_DAYS == [30, 90, 180, 365]
    assert R.CHURN_PATHS == ["downgrade_to_churn", "upgrade_to_churn", "direct_churn"]
    assert R.MRR_TYPES == ["new", "churned", "expansion", "contraction"]


def test_the_suite_has_all_checks():
    assert Counter(c.test for c in Q.SUITE) == {"not_null": 29, "unique": 12, "relationships": 4, "accepted_values": 2,
                                                "unique_combination": 1}
    assert {(c.model, c.column, c.args["to"]) for c in Q.SUITE if c.test == "relationships"} == {
        ("stg_subscriptions", "account_id", "stg_accounts"), ("stg_feature_usage", "subscription_id", "stg_subscriptions"),
        ("stg_churn_events", "account_id", "stg_accounts"), ("stg_support_tickets", "account_id", "stg_accounts")}
    unique = [(c.model, c.column) for c in Q.SUITE if c.test == "unique"]
    assert len(set(unique)) == 12 and set(unique) <= {(c.model, c.column) for c in Q.SUITE if c.test == "not_null"}
