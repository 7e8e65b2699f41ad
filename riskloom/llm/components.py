"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.session import discard, materialize

MAX_ROUNDS = 60


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest node around."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least.hint("merge"), "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked to the smallest one."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least.hint("merge"), "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b")))


def _print(edges: DataFrame) -> tuple:
    """Row count and an order-free checksum: equal for two rounds means that nothing moved."""
    row = edges.agg(
        F.count("*").alias("n"),
        F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")).alias("h"),
    ).first()
    return row["n"], row["h"]


def components(edges: DataFrame) -> DataFrame:
    """`node`, `component` for every node that has a link; the component is its smallest node.

    `edges` has columns `a`, `b` of one orderable type; direction, repeats, loops and
    nulls do not matter. Each round is two joins on the links alone, staged in the
    shared folder; the number of rounds grows with the logarithm of the longest chain.
    The joins are shuffled: staged names compress so well that a table which looks small
    enough to broadcast may not fit in the driver.
    """
    clean = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = materialize(clean.distinct(), "links")
    seen = _print(edges)
    for _ in range(MAX_ROUNDS):
        if not seen[0]:
            break
        older, edges = edges, materialize(_small_star(_large_star(edges)).where("a <> b").distinct(), "links")
        discard(older)
        now = _print(edges)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("the components did not settle")
    roots = edges.select(F.col("b").alias("node")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        roots.select("node", F.col("node").alias("component"))
    )
