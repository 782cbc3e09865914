"""Connected components of an undirected graph."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from maskwright.session import materialise


def components(edges: DataFrame) -> DataFrame:
    """node, comp (the smallest node of its component) for every node of ``edges`` (a, b).

    Each round hooks every component onto the smallest one beside it, then shortens the chains that
    arise by following them twice. Edges within one component leave, so rounds get cheaper; nothing
    but the count of open edges reaches the driver.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    labels = materialise(both.groupBy(F.col("a").alias("node")).agg(
        F.min("b").alias("b")).select("node", F.least("node", "b").alias("comp")), "components")
    names = labels.select(F.col("node").alias("a"), F.col("comp").alias("to"))
    left = both
    while True:
        left = left.join(names, "a").select(F.col("to").alias("x"), F.col("b").alias("a"))
        left = left.join(names, "a").select(F.col("x").alias("a"), F.col("to").alias("b"))
        left = materialise(left.where("a != b").distinct(), "components-left")
        if left.isEmpty():
            return labels
        hooks = left.groupBy("a").agg(F.min("b").alias("b")).select("a", F.least("a", "b").alias("to"))
        for _ in range(2):
            again = hooks.select(F.col("a").alias("to"), F.col("to").alias("next"))
            hooks = hooks.join(again, "to", "left").select("a", F.coalesce("next", "to").alias("to"))
        names = materialise(hooks, "components-hooks")
        labels = materialise(labels.join(names, labels.comp == names.a, "left").select(
            "node", F.coalesce("to", "comp").alias("comp")), "components")
