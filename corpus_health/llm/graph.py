"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpus_health.llm.common import land


def components(links: DataFrame) -> DataFrame:
    """node, label: for each end of a link the least node that it is connected to.

    `links` has the columns a and b. In each round every node hooks to its least
    neighbour, hooks are followed to their roots, and the links are drawn between the
    roots anew; links inside a root go, so at most half of the nodes are left each
    time. Rounds go on until no link is left. Each is landed, so a lost executor costs
    one round. A node with most of the links is combined before each shuffle.
    """
    edges = _drawn(links)
    labels = None
    while labels is None or not edges.isEmpty():
        ends = edges.select(F.col("a").alias("node"), F.col("b").alias("near")).union(edges.select("b", "a"))
        hooks = ends.groupBy("node").agg(F.min("near").alias("near"))
        roots = _followed(land(hooks.select("node", F.least("node", "near").alias("root")), "hooks"))
        if labels is None:
            labels = roots.withColumnRenamed("root", "label")
        else:
            onward = roots.withColumnRenamed("node", "label")
            moved = labels.join(onward, "label", "left")
            labels = land(moved.select("node", F.coalesce("root", "label").alias("label")), "labels")
        for side in "ab":
            edges = edges.join(roots.select(F.col("node").alias(side), F.col("root").alias(f"root_{side}")), side)
        edges = _drawn(edges.select(F.col("root_a").alias("a"), F.col("root_b").alias("b")))
    return labels


def _drawn(links: DataFrame) -> DataFrame:
    """Each link once, its lesser end first, without those from a node to itself."""
    ordered = links.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return land(ordered.distinct(), "links")


def _followed(hooks: DataFrame) -> DataFrame:
    """Every node with the end of its chain of hooks; chains get half as long each time."""
    while True:
        onward = hooks.select(F.col("node").alias("root"), F.col("root").alias("next"))
        after = hooks.join(onward, "root").select("node", F.col("next").alias("root"), (F.col("next") != F.col("root")).alias("moved"))
        after = land(after, "hooks")
        hooks = after.drop("moved")
        if after.where("moved").isEmpty():
            return hooks
