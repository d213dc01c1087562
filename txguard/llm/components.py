"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txguard.session import materialise


def connected(links: DataFrame, a: str, b: str) -> DataFrame:
    """``node`` and ``component``, the smallest node reachable, for every node that has a link.

    Links are rewritten until they form stars around the smallest nodes: a node's larger
    neighbours are linked to the least of its neighbourhood, then its smaller ones. Both steps keep
    the components and the table does not grow with the size of a star, because a
    node's least neighbour is found by a partial aggregation. The number of rounds grows with the logarithm of the
    longest path. Links to oneself, repeated links and an empty table are allowed.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct()
    edges = materialise(edges, "edges")
    before = None
    while True:
        edges = materialise(_small_star(_large_star(edges)), "edges")
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if state == before:
            break
        before = state
    roots = edges.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("component"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node links its larger neighbours to the least of itself and its neighbours."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node links itself and its smaller neighbours to the least of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return least.select("u", F.col("m").alias("v")).union(moved).distinct()
