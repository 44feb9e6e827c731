"""Stored layouts that spare later shuffles and scans.

* :func:`store_usage_layout`: the daily usage rollup and the subscriptions as
  tables bucketed and sorted by ``subscription_id``. Every model that joins
  usage with subscriptions then does so without an exchange below the join.
  The one cost is written out here: the rollup's own aggregation, and one
  shuffle each of the *rolled-up* usage and the subscriptions into buckets. Raw usage is
  never bucketed: a subscription that holds a third of all raw rows
  is combined map-side first, and has at most days x features rows in its bucket.
* :func:`store_for_lookup`: a table for point lookups, range-partitioned and
  sorted by the grain (row groups have narrow minima and maxima) with Parquet
  Bloom filters for ids that the order does not help with.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans.pipeline import Pipeline

BUCKET_BYTES, MIN_BUCKETS = 4 << 20, 8  # input file bytes a bucket; a join task holds about fifty times as much


def buckets_for(df: DataFrame) -> int:
    """Buckets that keep a task's share the same at any size: by the sizes of the files that ``df`` is computed from."""
    spark, size = df.sparkSession, 0
    for name in df.inputFiles():
        path = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(name))
        size += path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path).getLen()
    return max(MIN_BUCKETS, -(-size // BUCKET_BYTES))


def write_bucketed(df: DataFrame, table: str, path: str, key: str, buckets: int) -> None:
    """One file a bucket, sorted by ``key``: the rows are shuffled into the buckets once."""
    save_bucketed(df.repartition(buckets, key), table, path, key, buckets)


def save_bucketed(df: DataFrame, table: str, path: str, key: str, buckets: int) -> None:
    """``df``, whose partitions are the buckets already."""
    df.write.mode("overwrite").format("parquet").option("path", path).bucketBy(buckets, key).sortBy(key).saveAsTable(table)


def store_usage(placed: DataFrame, path: str, buckets: int) -> DataFrame:
    """Daily usage, repartitioned into ``buckets`` by subscription, as a bucketed table: readers join and group by subscription without shuffling it."""
    table = f"usage_{uuid.uuid4().hex}"
    save_bucketed(placed, table, path, "subscription_id", buckets)
    return placed.sparkSession.table(table)


def store_usage_layout(p: Pipeline, root: str, *, buckets: int | None = None, prefix: str | None = None) -> Pipeline:
    """Store the daily usage and the subscriptions of ``p`` under ``root``; returns a pipeline that reads them there.

    The tables are named ``<prefix>usage_daily`` and ``<prefix>subscriptions`` in the current schema (by default a prefix of their own).
    ``buckets`` fixes the number of tasks of the joins; by default it grows with the input (:func:`buckets_for`).
    """
    buckets = buckets or buckets_for(p.bronze.feature_usage)
    prefix = f"layout_{uuid.uuid4().hex}_" if prefix is None else prefix
    stored = Pipeline(p.spark, p.bronze, p.ctx, p.materialize_spine)
    for model, name in (("stg_feature_usage", "usage_daily"), ("stg_subscriptions", "subscriptions")):
        write_bucketed(p.model(model), f"{prefix}{name}", f"{root.rstrip('/')}/{name}", "subscription_id", buckets)
        stored.__dict__[model] = p.spark.table(f"{prefix}{name}")
    return stored


def store_for_lookup(df: DataFrame, path: str, grain: list[str], ids: list[str], *, partitions: int | None = None, row_group_bytes: int = 16 << 20) -> None:
    """``df`` ordered by ``grain`` across and within files, with Bloom filters on ``ids``."""
    columns = [F.col(c) for c in grain]
    placed = df.repartitionByRange(partitions, *columns) if partitions else df.repartitionByRange(*columns)
    w = placed.sortWithinPartitions(*columns).write.mode("overwrite").option("parquet.block.size", row_group_bytes)
    for c in ids:
        w = w.option(f"parquet.bloom.filter.enabled#{c}", "true")
    w.parquet(path)


def lookup_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
