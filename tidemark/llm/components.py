"""Connected components of a graph given by its edges, as repeated star contraction over DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialize


def _large_star(e: DataFrame) -> DataFrame:
    """Each node's larger neighbours are linked to its smallest neighbour (or itself)."""
    both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(e: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are linked to the smallest of them."""
    least = e.groupBy("u").agg(F.min("v").alias("m"))
    linked = e.join(least, "u")
    return (linked.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
            .union(least.select("u", F.col("m").alias("v"))).distinct())


def _state(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (columns u, v of one ordered type); a component is named by its smallest node.

    Both steps keep the edges of a node apart by its neighbour, aggregate before they shuffle, and shrink the distance to
    the smallest node by a constant factor a round, so a component takes rounds in the logarithm of its size. Each
    round is written to the shared folder. Loops and repeated edges do no harm; no edge, no row.
    """
    e = materialize(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    state = _state(e)
    while state[0]:
        e = materialize(_small_star(_large_star(e)), "edges")
        if (new := _state(e)) == state:
            break
        state = new
    nodes = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.union(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()).distinct()
