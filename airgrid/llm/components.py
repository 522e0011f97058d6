"""Connected components of a graph that is too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import cut_lineage


def _stars(edges: DataFrame, low: DataFrame) -> DataFrame:
    """Edges of both directions joined with the least neighbour of their first node."""
    return edges.join(low, "a")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of edges(a, b); a component is named by its least node.

    Alternates large-star and small-star steps, each of which only moves edges towards smaller
    nodes, until nothing moves; the number of rounds grows with the logarithm of the longest path.
    Nodes are compared by value and must not be null; self-loops and repeated edges do no harm.
    Every round is written to the shared checkpoint folder. Nothing is collected but two sums.
    """
    ordered = edges.where(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    current = cut_lineage(ordered.distinct())
    mark = None
    while True:
        # Large star: each larger neighbour of a node links to the node's least neighbour.
        both = current.union(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = _stars(both, low).where(F.col("b") > F.col("a")).select(
            F.col("b").alias("a"), F.col("m").alias("b")
        )
        large = large.distinct()
        # Small star: each node and its smaller neighbours link to the least of them.
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = _stars(large, low).where(F.col("b") != F.col("m")).select(
            F.col("b").alias("a"), F.col("m").alias("b")
        )
        current = cut_lineage(small.union(low.select("a", F.col("m").alias("b"))).distinct())
        total = current.agg(
            F.count(F.lit(1)),
            F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")),
        ).first()
        if tuple(total) == mark:
            break
        mark = tuple(total)
    leaves = current.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return leaves.union(roots)
