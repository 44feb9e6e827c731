"""A run that measures the declared tests while it writes.

Every model with a test is computed once, in its write: NULL counts and rows
outside the accepted values are observed on the rows as they are written
(``DataFrame.observe``), so these tests cost no scan of their own. Gold
tables, and the models that later ones read, are stored whole; of any other
model only its tested columns. What needs a shuffle (unique keys,
combinations, relationships) then reads the stored key columns.

An observation sits in the stage that writes, where a task's numbers count
once however often it is retried.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.functions.core import union_all
from tidemark.operators import quality as Q
from tidemark.plans.layout import buckets_for, store_usage
from tidemark.plans.pipeline import GOLD_MODELS, Pipeline, write_table

# Models that later models read, so they are stored whole.
SHARED = ("stg_feature_usage", "int_account_churn", "int_account_support", "int_account_feature_usage", "int_account_360")
# A model is written after those it reads from storage; the models of a wave are written at the same time.
WAVES = (
    ("stg_feature_usage", "int_account_churn", "int_account_support", "stg_accounts", "stg_subscriptions", "stg_churn_events",
     "stg_support_tickets", "int_account_subscriptions", "gold_mrr_trends", "gold_support_performance"),
    ("int_account_feature_usage", "gold_feature_adoption", "gold_churn_analysis"),
    ("int_account_360",),
    ("gold_account_health_summary", "gold_customer_segments"),
)


def tested_columns(model: str, checks: Sequence[Q.Check]) -> list[str]:
    """Columns of ``model`` that some test looks at, as child or as parent."""
    own = [c for check in checks if check.model == model for c in check.column.split(",")]
    parent = [c.args["field"] for c in checks if c.test == "relationships" and c.args["to"] == model]
    return list(dict.fromkeys(own + parent))


def _observe(df: DataFrame, checks: Sequence[Q.Check]) -> tuple[DataFrame, Observation | None]:
    measures = []
    for i, c in enumerate(checks):
        bad = F.col(c.column).isNull() if c.test == "not_null" else F.col(c.column).isNotNull() & ~F.col(c.column).isin(list(c.args["values"]))
        measures.append(F.count(F.when(bad, 1)).alias(f"c{i}"))
    if not measures:
        return df, None
    observation = Observation()
    return df.observe(observation, *measures), observation


def tested_run(p: Pipeline, root: str, checks: Sequence[Q.Check] = Q.SUITE, parallel_jobs: int = 8) -> DataFrame:
    """Write the models of ``p`` under ``root/<model>``; returns the report of ``checks`` (see :func:`quality.run_suite`)."""
    root, spark = root.rstrip("/"), p.spark
    observed: list[tuple[Q.Check, int]] = []
    stored: dict[str, DataFrame] = {}
    with ThreadPoolExecutor(max_workers=max(1, parallel_jobs)) as pool:
        for wave in WAVES:
            jobs = []
            for model in wave:
                mine = [c for c in checks if c.model == model and c.test in ("not_null", "accepted_values")]
                df = p.model(model)
                whole = model in GOLD_MODELS or model in SHARED
                if not whole:
                    if not (columns := tested_columns(model, checks)):
                        continue
                    df = df.select(*columns)
                if model == "stg_feature_usage":
                    # Four readers join or group it by subscription: stored in buckets, none of them shuffles it. Observed after this shuffle.
                    buckets = buckets_for(p.bronze.feature_usage)
                    measured, observation = _observe(df.repartition(buckets, "subscription_id"), mine)
                    job = pool.submit(store_usage, measured, f"{root}/{model}", buckets)
                else:
                    measured, observation = _observe(df, mine)
                    job = pool.submit(write_table, measured, f"{root}/{model}")
                jobs.append((model, whole, df.schema, mine, observation, job))
            for model, whole, schema, mine, observation, job in jobs:
                table = job.result()
                stored[model] = spark.read.schema(schema).parquet(f"{root}/{model}") if table is None else table
                if whole:
                    p.__dict__[model] = stored[model]
                if observation is not None:
                    observed += [(c, observation.get[f"c{i}"]) for i, c in enumerate(mine)]

    parts = []
    rows = [(c.model, c.column, c.test, n) for c, n in observed if c.test == "not_null" or n == 0]
    if rows:
        parts.append(spark.createDataFrame(rows, "model string, column_name string, test string, failures long"))
    for c in [c for c, n in observed if c.test == "accepted_values" and n]:  # how many different values, only if there is any
        parts.append(Q.accepted_values_count(c.model, stored[c.model], c.column, c.args["values"]))
    for c in checks:
        if c.test == "unique":
            parts.append(Q.unique_count(c.model, stored[c.model], c.column))
        elif c.test == "unique_combination":
            parts.append(Q.unique_combination_count(c.model, stored[c.model], c.column.split(",")))
        elif c.test == "relationships":
            parts.append(Q.relationship_count(c.model, stored[c.model], c.column, stored[c.args["to"]], c.args["field"]))
    return Q.finish(union_all(parts))
