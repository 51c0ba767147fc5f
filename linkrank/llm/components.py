"""Connected components of a table of links, without a node's links in one task or the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkrank.operators.staging import stage


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest of its neighbourhood."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("least"))
    moved = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.filter("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("least"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.unionByName(least.withColumnRenamed("least", "b")).filter("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each linked node can reach, from links (a, b).

    Alternating large-star and small-star steps until every link goes to a root.  Each round
    is written to the shared folder, so a lost executor costs one round at most.
    """
    edges = stage(links.select("a", "b").filter("a <> b").distinct(), "links")
    while True:
        edges = stage(_small_star(_large_star(edges)), "links")
        roots = edges.select(F.col("b").alias("a")).distinct()
        unsettled = edges.join(roots, "a", "left_semi")
        repeated = edges.groupBy("a").count().filter("count > 1")
        if unsettled.isEmpty() and repeated.isEmpty():
            break
    return stage(
        edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
            edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
        ),
        "components",
    )
