"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdshort.operators.spread import spread_join
from holdshort.session import freeze


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of a link (a, b) that is not the smallest of its component.

    Alternates two steps (Kiveris and others, 2014) that hang neighbours on the smallest one they know, until nothing
    changes; the number of rounds grows with the logarithm of the longest path. Links are never more than at the start,
    every round is cut from the plan in the shared folder, and a node may have any share of the links.
    """
    def smallest(edges: DataFrame) -> DataFrame:
        return edges.groupBy("a").agg(F.min("b").alias("least"))

    def mark(edges: DataFrame):
        return edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b") % (1 << 30))).first()

    edges = freeze(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    last = mark(edges)
    while last[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = smallest(both).select("a", F.least("a", "least").alias("least"))
        hung = spread_join(both, near, ["a"]).where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()
        low = smallest(hung)
        lowered = spread_join(hung, low, ["a"]).where("b > least").select(F.col("b").alias("a"), F.col("least").alias("b"))
        edges = freeze(lowered.unionByName(low.withColumnRenamed("least", "b")).distinct())
        now = mark(edges)
        if now == last:
            break
        last = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
