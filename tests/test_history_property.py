"""Randomized check: folding batches with the Spark merge equals a plain-Python fold."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidemark.operators import history as H

SCHEMA = ("subscription_id string, account_id string, start_date date, end_date date, plan_tier string, "
          "seats int, mrr_amount bigint, arr_amount bigint, is_trial boolean, upgrade_flag boolean, "
          "downgrade_flag boolean, churn_flag boolean, billing_frequency string, auto_renew_flag boolean, "
          "ingestion_ts timestamp")
STAMPS = [dt.datetime(2001, m, 1) for m in range(1, 7)]

row_values = st.fixed_dictionaries({
    "plan_tier": st.sampled_from(["Basic", "Pro", None]),
    "seats": st.sampled_from([1, 5, None]),
    "churn_flag": st.sampled_from([True, False, None]),
    "end_date": st.sampled_from([None, dt.date(2001, 3, 1)]),  # stored, not checked
})
batch = st.dictionaries(st.sampled_from(["S-1", "S-2", "S-3", "S-4"]), row_values, max_size=4)
batches = st.lists(batch, min_size=1, max_size=4)


def to_row(key, v, stamp):
    return (key, "A-1", dt.date(2000, 1, 1), v["end_date"], v["plan_tier"], v["seats"], 10, 120, False,
            False, False, v["churn_flag"], "monthly", True, stamp)


CHECKED = ["plan_tier", "seats", "churn_flag"]  # the others are constant in these batches


def python_fold(seq):
    """versions: key -> list of [values, valid_from, valid_to]."""
    versions = {}
    for stamp, b in zip(STAMPS, seq):
        for key, v in b.items():
            vs = versions.setdefault(key, [])
            if not vs:
                vs.append([v, stamp, None])
            elif any(vs[-1][0][c] != v[c] for c in CHECKED):
                vs[-1][2] = stamp
                vs.append([v, stamp, None])
    return {(k, vf, vt, v["plan_tier"], v["seats"], v["churn_flag"], v["end_date"])
            for k, vs in versions.items() for v, vf, vt in vs}


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(seq=batches)
def test_merge_fold_matches_python_fold(spark, seq):
    hist = None
    for stamp, b in zip(STAMPS, seq):
        df = spark.createDataFrame([to_row(k, v, stamp) for k, v in b.items()], SCHEMA)
        hist = H.open_versions(df, stamp) if hist is None else H.merge_batch(hist, df, stamp)
    got = {(r.subscription_id, r.valid_from, r.valid_to, r.plan_tier, r.seats, r.churn_flag, r.end_date)
           for r in hist.collect()}
    assert got == python_fold(seq)
