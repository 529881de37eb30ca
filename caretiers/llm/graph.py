"""Connected components of a graph given as links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caretiers.llm.common import scratch, spread_join, stored


def _stars(edges: DataFrame, large: bool, count: int) -> DataFrame:
    """Links every node's neighbours (larger ones, or the others) to the smallest of node and neighbours.

    The links of a node with very many, of ``count`` in all or fewer, are dealt over tasks.
    """
    if large:
        edges = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = edges.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"), F.count("*").alias("n"))
    met = spread_join(edges, least, "a", "n", total=2 * count if large else count)
    if large:
        return met.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
    return met.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b"))).where("a > b").distinct()


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``node`` and ``root``, the smallest node of its component, for every node with a link.

    Each round is written to the shared folder. Rounds grow with the logarithm of the longest path.
    """
    edges = stored(links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where("a > b").distinct())
    mark = None
    while True:
        count, _ = found = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if found == mark:
            break
        mark = found
        with scratch() as kept:
            # A large round may link each node anew: as many links as nodes, at most.
            wide = stored(_stars(edges, True, count))
            edges = kept(stored(_stars(wide, False, 2 * count)))
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
