"""Connected components of a distributed graph: smallest reachable id of each node.

Large-star and small-star rounds in turn; each round is a table in the shared folder, so a
round is never computed twice. Minima are combined before the shuffle; the join of a hub's
links with its minimum is an equality join that AQE can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from floodmark.llm.base import keep


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b) that is linked with another.

    Null ends and loops link nothing.
    """
    edges = keep(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct(), "links")
    while True:
        # Large star: the larger neighbours of a node move to the smallest of all.
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = keep(
            both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct(),
            "large",
        )
        # Small star: the smaller neighbours and the node itself move to the smallest of them.
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = keep(moved.unionAll(low.select("a", F.col("m").alias("b"))).where("a != b").distinct(), "small")
        # Done when every node has one link, and none of the targets has a link of its own.
        if small.count() == small.select("a").distinct().count() and not small.join(small.select(F.col("a").alias("b")), "b", "left_semi").take(1):
            roots = small.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("component"))
            return small.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(roots)
        edges = small
