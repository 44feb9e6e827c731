"""Monthly reporting tables that are refreshed by month.

Revenue trends, feature adoption and support performance have one row group
per month. They are kept partitioned by month; a refresh finds the months that
new bronze rows touch, computes these months only and replaces their
partitions (dynamic partition overwrite). All other partitions' files stay.

A month is touched by (new = stamped after ``since``)

* support: a new ticket of the month;
* adoption: new usage in the month, or usage in it of a new subscription;
* trends: a movement in the month of a new subscription, or of any
  subscription of a new account row (it repeats them).

The set of touched months reaches the driver (one value per month); rows with
no month are a month of their own. Bronze is append-only here, as the append loader
leaves it: a row that is changed or removed in place has no new stamp, so after an
overwrite of a bronze table call :meth:`MonthlyTables.write_all`.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.core import month_start
from tidemark.operators import gold
from tidemark.plans.pipeline import Pipeline
from tidemark.sources.schemas import STAMP

MONTH = {"gold_mrr_trends": "month_start", "gold_feature_adoption": "usage_month", "gold_support_performance": "ticket_month"}


def within(month: Column, months: list[dt.datetime | None]) -> Column:
    """Is ``month`` one of ``months`` (None: no month)?"""
    known = [m for m in months if m is not None]
    inside = month.isin(known) if known else F.lit(False)
    return inside | month.isNull() if None in months else F.coalesce(inside, F.lit(False))


def date_range(date: Column, months: list[dt.datetime | None]) -> Column:
    """A condition that a scan can use: from the first of ``months`` to the end of the last."""
    known = [m for m in months if m is not None]
    if not known or None in months:
        return F.lit(True)
    return (date >= F.lit(min(known))) & (date < F.add_months(F.lit(max(known)), 1))


class MonthlyTables:
    """The three monthly tables of ``p`` under ``root/<table>``."""

    def __init__(self, p: Pipeline, root: str):
        self.p, self.root = p, root.rstrip("/")

    def _path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def _write(self, table: str, df: DataFrame) -> None:
        month = MONTH[table]
        # One shuffle by month, so that a month is a few files and not one of every task; a month's rows are few.
        (df.repartition(F.col(month)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(month).parquet(self._path(table)))

    def read(self, table: str) -> DataFrame:
        schema = self.p.model(table).schema
        return self.p.spark.read.schema(schema).parquet(self._path(table)).select(*schema.names)

    def write_all(self) -> None:
        self._at_once([lambda w=self.p.model(t).write, t=t: w.mode("overwrite").partitionBy(MONTH[t]).parquet(self._path(t)) for t in MONTH])

    def _at_once(self, jobs: list[Callable[[], object]]) -> list:
        """Results of ``jobs``, run together: the tables are apart, and the last tasks of one leave no executor idle."""
        with ThreadPoolExecutor(max_workers=len(MONTH)) as pool:
            return [f.result() for f in [pool.submit(job) for job in jobs]]

    def touched(self, since: dt.datetime) -> dict[str, list[dt.datetime | None]]:
        """The months of each table that rows stamped after ``since`` touch."""
        p, stamp = self.p, F.to_timestamp(F.lit(since.strftime("%Y-%m-%d %H:%M:%S")))
        new = F.col(STAMP) > stamp
        subscriptions = p.stg_subscriptions
        fresh = subscriptions.filter(new)
        usage = p.bronze.feature_usage.filter(F.col("subscription_id").isNotNull())
        # The usage is read once, for both reasons; a repeated id repeats a month, and months are made distinct.
        ids = fresh.select("subscription_id", F.lit(True).alias("_fresh"))
        usage_months = (usage.select("subscription_id", "usage_date", new.alias("_new")).join(ids, "subscription_id", "left")
                        .filter(F.col("_new") | F.col("_fresh").isNotNull()).select(month_start(F.col("usage_date")).alias("month")))
        accounts = p.stg_accounts.filter(new).select("account_id")
        moved = fresh.union(subscriptions.join(accounts, "account_id", "left_semi"))
        months = {
            "gold_mrr_trends": gold.mrr_movements(moved).select(F.col("month_start").alias("month")),
            "gold_feature_adoption": usage_months,
            "gold_support_performance": p.stg_support_tickets.filter(new).select(month_start(F.col("submitted_at")).alias("month")),
        }
        found = self._at_once([df.distinct().collect for df in months.values()])
        return {t: sorted((r["month"] for r in rows), key=lambda m: (m is None, m)) for t, rows in zip(months, found)}

    def _of_months(self, table: str, months: list[dt.datetime | None]) -> DataFrame:
        p = self.p
        if table == "gold_support_performance":
            at = F.col("submitted_at")
            return gold.gold_support_performance(p.stg_support_tickets.filter(date_range(at, months) & within(month_start(at), months)), p.ctx)
        if table == "gold_feature_adoption":
            at = F.col("usage_date")
            return gold.gold_feature_adoption(p.stg_feature_usage.filter(date_range(at, months) & within(month_start(at), months)),
                                              p.stg_subscriptions, p.ctx)
        start, end = month_start(F.col("start_date")), month_start(F.col("end_date"))
        subscriptions = p.stg_subscriptions.filter(within(start, months) | within(end, months))
        moves = gold.mrr_movement_agg(subscriptions, p.stg_accounts).filter(within(F.col("month_start"), months))
        return gold.gold_mrr_trends(moves, p.ctx)

    def refresh(self, since: dt.datetime) -> dict[str, list[dt.datetime | None]]:
        """Recompute the months that rows stamped after ``since`` touch; returns them."""
        touched = self.touched(since)
        self._at_once([lambda t=t, df=self._of_months(t, months): self._write(t, df) for t, months in touched.items() if months])
        return touched
