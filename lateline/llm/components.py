"""Connected components of a table of links, by hooking and contraction.

In each round every node with a smaller neighbour takes the least of them as its parent, parents are
followed to the root of their tree by doubling the steps, and links are drawn between roots instead. Of
the nodes that still have links, two rounds leave at most half: whatever a hooked node was linked with
is greater than its root or has hooked on it, so only roots of trees of two or more nodes are left. Nodes, links and
parents stay in tables; the driver sees whether there are links or steps left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lateline.sources.staging import stage


def _drawn(links: DataFrame) -> DataFrame:
    """Different links between different nodes, from the greater to the smaller."""
    return links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _roots(parents: DataFrame) -> DataFrame:
    """node and parent, the root of its tree, from the parents of all nodes but roots."""
    while True:
        above = parents.select(F.col("node").alias("parent"), F.col("parent").alias("grandparent"))
        stepped = parents.join(above, "parent", "left").select("node", F.coalesce("grandparent", "parent").alias("parent"), F.col("grandparent").isNotNull().alias("moved"))
        stepped = stage(stepped, "parents")
        parents = stepped.select("node", "parent")
        if stepped.where("moved").isEmpty():
            return parents


def components(links: DataFrame) -> DataFrame:
    """node and component, the least node that links lead to, for the nodes of ``links`` (a, b).

    Self-links make no node; repeated links count once. No links give an empty result. There are at most
    2 log2(nodes) rounds, each of as many steps as the logarithm of its trees' depth. A node with very
    many links is a hot key of the joins, whose other side has one row for each node; adaptive
    execution splits it.
    """
    left = stage(_drawn(links), "links")
    labels = left.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("component", F.col("node"))
    while not left.isEmpty():
        # Links go from the greater node to the smaller, so the least smaller neighbour is among the b of its own a.
        roots = _roots(left.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("parent")))
        by_a, by_b = (roots.select(F.col("node").alias(n), F.col("parent").alias(f"parent_{n}")) for n in "ab")
        moved = left.join(by_a, "a").join(by_b, "b", "left")
        left = stage(_drawn(moved.select(F.col("parent_a").alias("a"), F.coalesce("parent_b", "b").alias("b"))), "links")
        step = roots.select(F.col("node").alias("component"), "parent")
        labels = labels.join(step, "component", "left").select("node", F.coalesce("parent", "component").alias("component"))
        labels = stage(labels, "labels")
    return labels
