"""Connected groups of a graph, by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from slideloom.session import checkpointed


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, root): the smallest id that each node is connected with.

    ``nodes`` has id, ``edges`` has a and b, in any direction; edges to unknown nodes, loops and
    repeats do no harm; a node without edges is its own root. Each round hooks the roots of
    both ends of every edge to the smaller one and halves the paths, so that rounds grow with
    the logarithm of a group's width; lineage is cut after each.
    """
    roots = checkpointed(nodes.select("id", F.col("id").alias("root")).distinct())
    links = checkpointed(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct())
    while True:  # each round joins every open group to a smaller one
        a = roots.select(F.col("id").alias("a"), F.col("root").alias("ra"))
        b = roots.select(F.col("id").alias("b"), F.col("root").alias("rb"))
        open_ = checkpointed(links.join(a, "a").join(b, "b").where("ra <> rb").select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct())
        if open_.isEmpty():
            return roots
        # Roots with a smaller neighbour take the smallest; chains of them are then shortened.
        hook = open_.groupBy("b").agg(F.min("a").alias("to")).withColumnRenamed("b", "root")
        hook = checkpointed(hook)
        while True:
            next_ = hook.select(F.col("root").alias("to"), F.col("to").alias("further"))
            shorter = checkpointed(hook.join(next_, "to", "left").select("root", F.coalesce("further", "to").alias("to"), F.col("further").isNotNull().alias("moved")))
            hook = shorter.drop("moved")
            if shorter.where("moved").isEmpty():
                break
        roots = checkpointed(roots.join(hook, "root", "left").select("id", F.coalesce("to", "root").alias("root")))
        links = open_
