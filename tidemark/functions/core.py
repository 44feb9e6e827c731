"""Column-level helpers shared by the models (all JVM-side expressions)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def safe_divide(numerator: Column, denominator: Column) -> Column:
    """``numerator / nullif(denominator, 0)``: NULL instead of a division error."""
    return numerator / F.nullif(denominator, F.lit(0))


def round2(c: Column) -> Column:
    """Round half-up to two places, as a double."""
    return F.round(c.cast("double"), 2)


def pct(numerator: Column, denominator: Column) -> Column:
    """Percentage ``numerator * 100 / denominator`` rounded to two places; NULL on a zero denominator."""
    return round2(safe_divide(numerator.cast("double") * 100.0, denominator))


def count_if(cond: Column) -> Column:
    """``count(case when cond then 1 end)`` -- rows where ``cond`` is TRUE (NULL counts as no)."""
    return F.count(F.when(cond, F.lit(1)))


def month_start(c: Column) -> Column:
    """``date_trunc('month', c)`` -- a timestamp at the first of the month."""
    return F.date_trunc("month", c.cast("timestamp"))


def rule_ladder(rules: Sequence[tuple[Column, str]], default: str) -> Column:
    """First matching rule wins, like a SQL ``CASE WHEN ... WHEN ... ELSE``.

    A rule whose condition evaluates to NULL does not match.
    """
    out = None
    for cond, label in rules:
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out.otherwise(F.lit(default)) if out is not None else F.lit(default)


def latest_per_key(
    df: DataFrame,
    key: str | Sequence[str],
    order: Sequence[str],
    columns: Sequence[str],
    prefix: str = "",
) -> DataFrame:
    """One row per ``key``: the row with the greatest ``order`` (descending, NULLs last).

    Equivalent to ``row_number() over (partition by key order by o1 desc, o2 desc ...) = 1``
    but written as an aggregate: ``max_by`` is combined map-side, so a key
    holding a large share of the rows is reduced before the shuffle instead of
    being sorted inside one task.
    """
    keys = [key] if isinstance(key, str) else list(key)
    payload = F.struct(*[F.col(c) for c in columns])
    ordering = F.struct(*[F.col(c) for c in order])
    picked = df.groupBy(*keys).agg(F.max_by(payload, ordering).alias("_latest"))
    if not prefix:
        return picked.select(*keys, "_latest.*")
    return picked.select(*keys, *[F.col(f"_latest.{c}").alias(prefix + c) for c in columns])


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """``UNION ALL BY NAME`` of many frames, combined pairwise.

    A balanced tree instead of a left-deep chain: every union re-analyzes the
    plan built so far, so pairing keeps plan construction near n log n.
    Catalyst flattens the nested unions into one operator either way.
    """
    level = list(frames)
    if not level:
        raise ValueError("union_all needs at least one frame")
    while len(level) > 1:
        level = [level[i].unionByName(level[i + 1]) if i + 1 < len(level) else level[i]
                 for i in range(0, len(level), 2)]
    return level[0]
