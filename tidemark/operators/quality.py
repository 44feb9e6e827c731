"""Data-quality checks, reported as tables.

The declared suite has five kinds of test -- not_null, unique, relationships,
accepted_values and unique combination of columns -- 48 tests over 16
models. Each test yields one report row ``(model, column_name, test, failures)``
where failures counts what the test would return:

* not_null: rows where the column is NULL;
* unique: distinct non-NULL values occurring more than once;
* relationships: child rows whose non-NULL key has no parent;
* accepted_values: distinct non-NULL values outside the list;
* unique_combination: combinations occurring more than once.

All not_null tests of a model are fused into one aggregate pass; the other
kinds are one aggregate (or anti join) each. Nothing is collected: the
report is a union of one-row aggregates.

The ad-hoc checks (duplicate keys in bronze, duplicate usage grain,
multi-subscription accounts, open subscriptions, duplicate-row lookup) return
the offending rows themselves.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.core import union_all
from tidemark.functions.rules import CUSTOMER_SEGMENTS, HEALTH_STATUSES

REPORT_COLUMNS = ["model", "column_name", "test", "failures", "status"]


@dataclass(frozen=True)
class Check:
    model: str
    column: str
    test: str  # not_null | unique | relationships | accepted_values | unique_combination
    args: dict = field(default_factory=dict)


def _check(model: str, column: str, test: str, **args) -> Check:
    return Check(model, column, test, args)


# The declared suite (48 tests).
SUITE: list[Check] = [
    # silver
    _check("stg_accounts", "account_id", "not_null"),
    _check("stg_accounts", "account_id", "unique"),
    _check("stg_accounts", "signup_date", "not_null"),
    _check("stg_accounts", "seats", "not_null"),
    _check("stg_subscriptions", "subscription_id", "not_null"),
    _check("stg_subscriptions", "subscription_id", "unique"),
    _check("stg_subscriptions", "account_id", "not_null"),
    _check("stg_subscriptions", "account_id", "relationships", to="stg_accounts", field="account_id"),
    _check("stg_feature_usage", "subscription_id,usage_date,feature_name", "unique_combination"),
    _check("stg_feature_usage", "subscription_id", "not_null"),
    _check("stg_feature_usage", "subscription_id", "relationships", to="stg_subscriptions",
           field="subscription_id"),
    _check("stg_churn_events", "churn_event_id", "not_null"),
    _check("stg_churn_events", "churn_event_id", "unique"),
    _check("stg_churn_events", "account_id", "not_null"),
    _check("stg_churn_events", "account_id", "relationships", to="stg_accounts", field="account_id"),
    _check("stg_support_tickets", "ticket_id", "not_null"),
    _check("stg_support_tickets", "ticket_id", "unique"),
    _check("stg_support_tickets", "account_id", "not_null"),
    _check("stg_support_tickets", "account_id", "relationships", to="stg_accounts", field="account_id"),
    # intermediate
    _check("int_account_subscriptions", "subscription_id", "not_null"),
    _check("int_account_subscriptions", "subscription_id", "unique"),
    _check("int_account_subscriptions", "account_id", "not_null"),
    _check("int_account_churn", "churn_event_id", "not_null"),
    _check("int_account_churn", "churn_event_id", "unique"),
    _check("int_account_churn", "account_id", "not_null"),
    _check("int_account_support", "account_id", "not_null"),
    _check("int_account_support", "account_id", "unique"),
    _check("int_account_feature_usage", "account_id", "not_null"),
    _check("int_account_feature_usage", "account_id", "unique"),
    _check("int_account_360", "account_id", "not_null"),
    _check("int_account_360", "account_id", "unique"),
    _check("int_account_360", "health_score", "not_null"),
    # gold
    _check("gold_account_health_summary", "account_id", "not_null"),
    _check("gold_account_health_summary", "account_id", "unique"),
    _check("gold_account_health_summary", "health_status", "not_null"),
    _check("gold_account_health_summary", "health_status", "accepted_values", values=HEALTH_STATUSES),
    _check("gold_churn_analysis", "churn_event_id", "not_null"),
    _check("gold_churn_analysis", "churn_event_id", "unique"),
    _check("gold_churn_analysis", "mrr_lost", "not_null"),
    _check("gold_mrr_trends", "month_start", "not_null"),
    _check("gold_feature_adoption", "feature_name", "not_null"),
    _check("gold_feature_adoption", "usage_month", "not_null"),
    _check("gold_support_performance", "ticket_month", "not_null"),
    _check("gold_support_performance", "priority", "not_null"),
    _check("gold_customer_segments", "account_id", "not_null"),
    _check("gold_customer_segments", "account_id", "unique"),
    _check("gold_customer_segments", "customer_segment", "not_null"),
    _check("gold_customer_segments", "customer_segment", "accepted_values", values=CUSTOMER_SEGMENTS),
]

TEST_KINDS = ["not_null", "unique", "relationships", "accepted_values", "unique_combination"]


def _row(model: str, column: str, test: str, failures) -> list:
    return [F.lit(model).alias("model"), F.lit(column).alias("column_name"), F.lit(test).alias("test"),
            failures.cast("bigint").alias("failures")]


def finish(df: DataFrame) -> DataFrame:
    return df.withColumn("status", F.when(F.col("failures") == 0, "pass").otherwise("fail"))


def not_null_counts(model: str, df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """All not_null tests of one model in one pass, one report row per column."""
    agg = df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(f"_n{i}") for i, c in enumerate(columns)])
    rows = F.array(*[F.struct(*_row(model, c, "not_null", F.col(f"_n{i}"))) for i, c in enumerate(columns)])
    return agg.select(F.explode(rows).alias("r")).select("r.*")


def duplicate_groups(df: DataFrame, columns: Sequence[str], skip_nulls: bool = True) -> DataFrame:
    """Key values (or combinations) that occur more than once, with their counts."""
    src = df
    if skip_nulls and len(columns) == 1:
        src = src.filter(F.col(columns[0]).isNotNull())
    return src.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_records")).filter(F.col("n_records") > 1)


def unique_count(model: str, df: DataFrame, column: str) -> DataFrame:
    return duplicate_groups(df, [column]).agg(*_row(model, column, "unique", F.count(F.lit(1))))


def key_counts(model: str, df: DataFrame, column: str) -> DataFrame:
    """The not_null and unique tests of one key in one aggregate: two report rows."""
    null, n = F.col(column).isNull(), F.col("_n")
    agg = df.groupBy(column).agg(F.count(F.lit(1)).alias("_n")).agg(
        F.coalesce(F.sum(F.when(null, n)), F.lit(0)).alias("_nulls"), F.count(F.when(~null & (n > 1), 1)).alias("_dups"))
    rows = F.array(F.struct(*_row(model, column, "not_null", F.col("_nulls"))),
                   F.struct(*_row(model, column, "unique", F.col("_dups"))))
    return agg.select(F.explode(rows).alias("r")).select("r.*")


def unique_combination_count(model: str, df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return duplicate_groups(df, list(columns), skip_nulls=False).agg(
        *_row(model, ",".join(columns), "unique_combination", F.count(F.lit(1))))


def orphans(child: DataFrame, column: str, parent: DataFrame, field_name: str) -> DataFrame:
    """Child rows whose non-NULL key is missing from the parent (anti join)."""
    keys = parent.select(F.col(field_name).alias("_parent_key"))
    return child.filter(F.col(column).isNotNull()).join(
        keys, F.col(column) == F.col("_parent_key"), "left_anti")


def relationship_count(model: str, df: DataFrame, column: str, parent: DataFrame, field_name: str) -> DataFrame:
    return orphans(df, column, parent, field_name).agg(*_row(model, column, "relationships", F.count(F.lit(1))))


def accepted_values_count(model: str, df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    bad = df.filter(F.col(column).isNotNull() & ~F.col(column).isin(list(values))).select(column).distinct()
    return bad.agg(*_row(model, column, "accepted_values", F.count(F.lit(1))))


def run_suite(models: Callable[[str], DataFrame], checks: Sequence[Check] = SUITE,
              kinds: Sequence[str] | None = None) -> DataFrame:
    """Report of ``checks`` (optionally only some test kinds); ``models(name)`` gives a model.

    A key's not_null and unique tests are one aggregate; the other not_null
    tests of a model are one pass. Give stored models where a model is costly.
    """
    chosen = [c for c in checks if kinds is None or c.test in kinds]
    parts: list[DataFrame] = []
    nn: dict[str, list[str]] = {}
    not_null = {(c.model, c.column) for c in chosen if c.test == "not_null"}
    keys = [(c.model, c.column) for c in chosen if c.test == "unique" and (c.model, c.column) in not_null]
    for c in chosen:
        if c.test == "not_null" and (c.model, c.column) not in keys:
            nn.setdefault(c.model, []).append(c.column)
    for model, column in keys:
        parts.append(key_counts(model, models(model), column))
    for model, cols in nn.items():
        parts.append(not_null_counts(model, models(model), cols))
    for c in chosen:
        df = models(c.model)
        if c.test == "unique" and (c.model, c.column) not in keys:
            parts.append(unique_count(c.model, df, c.column))
        elif c.test == "unique_combination":
            parts.append(unique_combination_count(c.model, df, c.column.split(",")))
        elif c.test == "relationships":
            parts.append(relationship_count(c.model, df, c.column, models(c.args["to"]), c.args["field"]))
        elif c.test == "accepted_values":
            parts.append(accepted_values_count(c.model, df, c.column, c.args["values"]))
    return finish(union_all(parts))


# ---------------------------------------------------------------- ad-hoc checks

# The key column of each bronze table.
BRONZE_KEYS = {
    "accounts": "account_id",
    "subscriptions": "subscription_id",
    "feature_usage": "usage_id",
    "churn_events": "churn_event_id",
    "support_tickets": "ticket_id",
}


def bronze_duplicates(bronze: dict[str, DataFrame]) -> DataFrame:
    """Duplicated key values in every bronze table: (table_name, key_value, n_records)."""
    return union_all([
        duplicate_groups(bronze[t], [k]).select(
            F.lit(t).alias("table_name"), F.col(k).alias("key_value"), "n_records")
        for t, k in BRONZE_KEYS.items()
    ])


USAGE_GRAIN = ["subscription_id", "usage_date", "feature_name"]


def usage_grain_duplicates(bronze_usage: DataFrame) -> DataFrame:
    """Raw usage rows sharing one (subscription, day, feature)."""
    return duplicate_groups(bronze_usage, USAGE_GRAIN, skip_nulls=False)


def multi_subscription_accounts(stg_subscriptions: DataFrame) -> DataFrame:
    return duplicate_groups(stg_subscriptions, ["account_id"]).withColumnRenamed("n_records", "n_subscriptions")


def open_subscriptions(stg_subscriptions: DataFrame) -> DataFrame:
    return stg_subscriptions.agg(F.count(F.when(F.col("end_date").isNull(), 1)).alias("open_subscriptions"))


def lookup(df: DataFrame, order_by: str | None = None, descending: bool = True, **equals) -> DataFrame:
    """Point lookup: rows equal to ``equals`` (pushed into the scan), ordered by ``order_by``."""
    cond = None
    for c, v in equals.items():
        e = F.col(c) == (v if isinstance(v, Column) else F.lit(v))
        cond = e if cond is None else cond & e
    out = df.filter(cond) if cond is not None else df
    if order_by:
        out = out.orderBy(F.col(order_by).desc() if descending else F.col(order_by).asc())
    return out


def duplicate_rows(df: DataFrame, key: str) -> DataFrame:
    """All rows of every key value that occurs more than once (the rows a lookup would inspect)."""
    dups = duplicate_groups(df, [key]).select(key)
    return df.join(dups, key, "left_semi")
