"""Stored support percentiles: error of a large group, months touched, repeated deliveries, NULLs."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tidemark.operators import support_sketches as S

SCHEMA = "ticket_id string, submitted_at timestamp, priority string, resolution_time_hours double, first_response_time_minutes int"


def tickets(spark, n, month, start=0):
    return spark.range(start, start + n).select(
        F.col("id").cast("string").alias("ticket_id"), F.lit(dt.datetime(2001, month, 5)).alias("submitted_at"),
        F.lit("high").alias("priority"), ((F.col("id") * 7919) % 100_003).cast("double").alias("resolution_time_hours"),
        F.lit(None).cast("int").alias("first_response_time_minutes"))


def month_files(root):
    return {os.path.join(d, f) for d, _, fs in os.walk(root) for f in fs if f.endswith(".parquet")}


def test_merged_ranks_stay_within_the_stated_error(spark, tmp_path):
    store = S.SupportSketches(spark, str(tmp_path), k=1024)
    n = 60_000
    for k in range(5):
        store.add(tickets(spark, n // 5, 1, k * n // 5), f"d{k}")
    row = store.report().first()
    values = sorted((i * 7919) % 100_003 for i in range(n))
    assert row["total_tickets"] == n and row["avg_resolution_time_hours"] == pytest.approx(sum(values) / n, abs=0.01)
    for rank, name in ((0.5, "median_resolution_time_hours"), (0.95, "p95_resolution_time_hours")):
        position = sum(v <= row[name] for v in values) / n
        assert abs(position - rank) < 2.3 / 1024
    assert row["median_first_response_minutes"] is None and row["avg_first_response_minutes"] is None


def test_new_tickets_touch_their_own_months_only(spark, tmp_path):
    root = str(tmp_path)
    store = S.SupportSketches(spark, root)
    store.add(tickets(spark, 50, 1).union(tickets(spark, 50, 2, 50)), "first")
    before = {f: os.stat(f).st_mtime_ns for f in month_files(root)}
    store.add(tickets(spark, 30, 3, 100), "second")
    after = {f: os.stat(f).st_mtime_ns for f in month_files(root)}
    assert before.items() <= after.items()
    assert all("ticket_month=2001-03-01" in f for f in after.keys() - before.keys()) and len(after) > len(before)
    plan = store.read().filter("ticket_month = date'2001-03-01'")
    assert len(plan.inputFiles()) >= 1 and plan.count() == 1


def test_a_repeated_delivery_replaces_itself(spark, tmp_path):
    store = S.SupportSketches(spark, str(tmp_path))
    store.add(tickets(spark, 40, 1), "a")
    store.add(tickets(spark, 20, 1, 40), "b")
    first = store.report().collect()
    store.add(tickets(spark, 20, 1, 40), "b")
    assert store.report().collect() == first and first[0]["total_tickets"] == 60


def test_null_months_priorities_and_no_tickets(spark, tmp_path):
    store = S.SupportSketches(spark, str(tmp_path))
    rows = [("1", None, "low", 1.0, 5), ("2", None, None, 3.0, None), ("3", dt.datetime(2001, 1, 1), None, None, 7)]
    store.add(spark.createDataFrame(rows, SCHEMA), "a")
    got = {(r["ticket_month"], r["priority"]): (r["median_resolution_time_hours"], r["median_first_response_minutes"]) for r in store.report().collect()}
    assert got == {(None, "low"): (1.0, 5.0), (None, None): (3.0, None), (dt.datetime(2001, 1, 1), None): (None, 7.0)}
    empty = S.SupportSketches(spark, str(tmp_path / "empty"))
    empty.add(spark.createDataFrame([], SCHEMA), "a")
    assert empty.report().collect() == []
