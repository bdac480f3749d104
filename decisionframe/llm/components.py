"""Connected components by contraction over a staged edge table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged


def components(edges: DataFrame) -> DataFrame:
    """edges (a, b): node, comp (the smallest node reachable), for every node that has an edge.

    Each level points every node to its smallest neighbour. Such pointers have no cycles but pairs that point to each
    other, whose smaller node becomes the root; so every tree has two nodes at least, and a level halves the nodes at
    least. Pointer jumping flattens the trees in rounds logarithmic in their depth, and the roots with the links between
    them are the next level, whatever the order of the ids. Both kinds of loop end by themselves. Joins are on plain keys
    without an aggregate above them in the same stage, so a hub's rows can be split."""
    both = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(edges.select(F.col("b").alias("node"), F.col("a").alias("other")))
    links, labels = staged(both, "links"), None
    while labels is None or links.take(1):
        nearest = staged(links.groupBy("node").agg(F.min("other").alias("up")), "nearest")
        tree = _jump(nearest, F.least("up", "top"))
        while tree.where("moved").take(1):
            tree = _jump(tree, F.col("top"))
        tree = tree.select("node", "up")
        if labels is None:
            labels = tree.withColumnRenamed("up", "root")
        else:
            higher = labels.join(tree.withColumnRenamed("node", "root"), "root", "left")
            labels = staged(higher.select("node", F.coalesce("up", "root").alias("root")), "labels")
        of_node = links.join(tree, "node").select(F.col("up").alias("a"), "other")
        of_both = of_node.join(tree.withColumnRenamed("node", "other"), "other").select(F.col("a").alias("node"), F.col("up").alias("other"))
        links = staged(of_both.where("node <> other").distinct(), "links")
    lowest = staged(labels.groupBy("root").agg(F.min("node").alias("comp")), "lowest")
    return staged(labels.join(lowest, "root").select("node", "comp"), "labels")


def _jump(tree: DataFrame, to: Column) -> DataFrame:
    """node, up, moved: every pointer follows its target's own, `top`."""
    above = tree.select(F.col("node").alias("up"), F.col("up").alias("top"))
    return staged(tree.join(above, "up").select("node", to.alias("up"), (to != F.col("up")).alias("moved")), "tree")
