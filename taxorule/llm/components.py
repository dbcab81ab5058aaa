"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keep


def _largest_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above a node is linked to the smallest node the node can see."""
    both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("low"))
    return (both.filter("b > a").join(low, "a")
            .select(F.col("b").alias("a"), F.col("low").alias("b")))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node's lower neighbours, and the node itself, are linked to the smallest of them."""
    low = edges.groupBy("a").agg(F.min("b").alias("low"))
    inner = edges.join(low, "a")
    return (inner.filter("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
            .unionAll(low.select("a", F.col("low").alias("b"))))


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``node, root`` for every node of ``edges (a, b)``; the root is the smallest node.

    Each round is two aggregations and two joins over the edge table, which never grows: a
    round writes it to the shared folder, so neither the plan nor the loss of an executor
    reaches back over rounds. Minima combine before the shuffle, so a node with very many
    neighbours is no hot group. Self links and repeated links change nothing; rows with a
    null end are left out; no links give no rows.
    """
    now = keep(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
               .distinct(), "links")
    mark = None
    for _ in range(max_rounds):
        now = keep(_small_star(keep(_largest_star(now).distinct(), "star")).distinct(), "star")
        new = now.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if new == mark or not new[0]:
            break
        mark = new
    else:
        raise RuntimeError(f"components: not settled after {max_rounds} rounds")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
