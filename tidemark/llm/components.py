"""Connected components by repeated hooking and shortcutting of labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import drop_stored, stored


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); root is the smallest node reachable.

    Each round hooks a node and its label to the smallest label seen across an edge,
    and halves the distance to the root, so the rounds grow with the logarithm of the
    longest path. Labels are written to the shared folder each round. The driver sees
    one count for each round.
    """
    both = stored(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), "edges")
    labels = stored(both.groupBy("a").agg(F.min("b").alias("b")).select(
        F.col("a").alias("node"), F.least("a", "b").alias("root")), "labels")
    while True:
        parent = labels.select(F.col("node").alias("root"), F.col("root").alias("grand"))
        near = labels.join(parent, "root").select("node", "root", "grand")
        seen = both.join(near.select(F.col("node").alias("b"), "grand"), "b").groupBy("a").agg(
            F.min("grand").alias("seen"))
        least = near.join(seen, near.node == seen.a).select(
            "node", "root", F.least("grand", "seen").alias("least"))
        hooks = least.select(F.col("root").alias("node"), "least").unionByName(least.select("node", "least"))
        after = stored(hooks.groupBy("node").agg(F.min("least").alias("root")), "labels")
        changed = after.join(labels.withColumnRenamed("root", "before"), "node").filter("root <> before")
        settled = changed.isEmpty()
        drop_stored(labels)
        if settled:
            drop_stored(both)
            return after
        labels = after
