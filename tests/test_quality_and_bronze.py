"""Data-quality checks find planted failures; bronze I/O keeps rows and types."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.context import RunContext, scratch_path
from tidemark.operators import quality as Q
from tidemark.sources import bronze as B
from tidemark.sources.schemas import BRONZE_SCHEMAS


def test_suite_counts_planted_failures(spark):
    parent = spark.createDataFrame([("A-1",), ("A-2",), ("A-2",), (None,)], "account_id string")
    child = spark.createDataFrame([("S-1", "A-1"), ("S-2", "A-9"), ("S-2", "A-9"), ("S-3", None)],
                                  "subscription_id string, account_id string")
    labels = spark.createDataFrame([("Healthy",), ("Bogus",), ("Bogus",), ("Other",), (None,)], "h string")
    models = {"p": parent, "c": child, "g": labels}
    checks = [
        Q.Check("p", "account_id", "not_null"),
        Q.Check("p", "account_id", "unique"),
        Q.Check("c", "subscription_id", "unique"),
        Q.Check("c", "account_id", "relationships", {"to": "p", "field": "account_id"}),
        Q.Check("c", "subscription_id,account_id", "unique_combination"),
        Q.Check("g", "h", "accepted_values", {"values": ["Healthy", "Critical"]}),
        Q.Check("g", "h", "not_null"),
    ]
    got = {(r.model, r.column_name, r.test): (r.failures, r.status)
           for r in Q.run_suite(models.__getitem__, checks).collect()}
    assert got == {
        ("p", "account_id", "not_null"): (1, "fail"),
        ("p", "account_id", "unique"): (1, "fail"),
        ("c", "subscription_id", "unique"): (1, "fail"),
        ("c", "account_id", "relationships"): (2, "fail"),
        ("c", "subscription_id,account_id", "unique_combination"): (1, "fail"),
        ("g", "h", "accepted_values"): (2, "fail"),
        ("g", "h", "not_null"): (1, "fail"),
    }


def test_declared_suite_has_48_tests():
    kinds = [c.test for c in Q.SUITE]
    assert len(kinds) == 48
    assert {k: kinds.count(k) for k in set(kinds)} == {
        "not_null": 29, "unique": 12, "relationships": 4, "accepted_values": 2, "unique_combination": 1}


def test_lookup_and_duplicate_rows(spark):
    df = spark.createDataFrame([("U-1", 1), ("U-1", 2), ("U-2", 3)], "usage_id string, v int")
    assert [r.v for r in Q.lookup(df, order_by="v", usage_id="U-1").collect()] == [2, 1]
    assert sorted(r.v for r in Q.duplicate_rows(df, "usage_id").collect()) == [1, 2]


def test_csv_read_rejects_unknown_options(spark):
    with pytest.raises(ValueError):
        B.read_csv(spark, "/nonexistent", "accounts", mergeSchema="true")


def test_csv_roundtrip_overwrite_and_append(spark):
    row = ("A-1", "n", "ind", "c", dt.date(2000, 1, 2), "ads", "Pro", 3, False, None)
    df = spark.createDataFrame([row], BRONZE_SCHEMAS["accounts"])
    landing = scratch_path(spark, "test-landing")
    B.write_csv(df, landing)
    back = B.read_csv(spark, landing, "accounts")
    assert back.schema == BRONZE_SCHEMAS["accounts"]
    assert back.collect() == df.collect()

    ctx = RunContext.pinned()
    target = scratch_path(spark, "test-bronze")
    B.ingest(spark, landing, "accounts", target, ctx, mode="overwrite")
    B.ingest(spark, landing, "accounts", target, ctx, mode="overwrite")
    assert spark.read.parquet(target).count() == 1
    B.ingest(spark, landing, "accounts", target, ctx, mode="append")
    stamped = spark.read.parquet(target)
    assert stamped.count() == 2
    assert stamped.select(F.max("ingestion_ts")).first()[0] == dt.datetime(2001, 12, 1)


def test_table_profile(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    got = {(r.column_name, r.data_type, r.row_count, r.null_count) for r in B.table_profile({"t": df}).collect()}
    assert got == {("a", "int", 2, 0), ("b", "string", 2, 1)}
