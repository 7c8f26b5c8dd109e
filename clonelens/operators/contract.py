"""Clean-up and trimming of trees given as edges (tree, parent, child, dist, silent), trees of any size and depth.

Chains are halved in every round, so rounds are logarithmic in the longest chain; a round holds one row a node at most."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .checkpoints import checkpointed


def with_reads_below(edges: DataFrame) -> DataFrame:
    """The edges to nodes that are not silent or have such a node below them, and to roots.

    Between a silent node and the nearest others below it lie silent nodes only, so marks climb along those."""
    silent = edges.where("silent and parent is not null").select("tree", F.col("child").alias("node"), F.col("parent").alias("up"))
    names = checkpointed(silent.select("tree", "node"))
    marked = checkpointed(edges.where("not silent and parent is not null").select("tree", F.col("parent").alias("node")).distinct().join(names, ["tree", "node"], "left_semi"))
    jump = checkpointed(silent.join(names.withColumnRenamed("node", "up"), ["tree", "up"], "left_semi").select("tree", "node", "up"))
    while not jump.isEmpty():
        climbed = marked.join(jump, ["tree", "node"]).select("tree", F.col("up").alias("node"))
        marked = checkpointed(marked.unionByName(climbed).distinct())
        further = jump.select("tree", F.col("node").alias("up"), F.col("up").alias("top"))
        jump = checkpointed(jump.join(further, ["tree", "up"]).select("tree", "node", F.col("top").alias("up")))
    bare = names.join(marked, ["tree", "node"], "left_anti").withColumnRenamed("node", "child")
    return edges.join(bare, ["tree", "child"], "left_anti")


def without_idle(edges: DataFrame) -> DataFrame:
    """Without silent nodes that have nothing but silent nodes below them, and without those left with one child, which
    hangs from the next node up that stays, the lengths on the way being added.

    A node spliced out has one child, so no key of the joins holds more than one row."""
    kept = checkpointed(with_reads_below(edges))
    single = kept.where("parent is not null").groupBy("tree", F.col("parent").alias("child")).agg(F.count("*").alias("n")).where("n = 1").select("tree", "child")
    way = checkpointed(kept.where("silent and parent is not null").join(single, ["tree", "child"], "left_semi").select("tree", F.col("child").alias("node"), F.col("parent").alias("up"), F.col("dist").cast("long").alias("length")))
    spliced = way.select("tree", F.col("node").alias("child"))
    while not (going := way.join(way.select("tree", F.col("node").alias("up")), ["tree", "up"], "left_semi")).isEmpty():
        further = way.select("tree", F.col("node").alias("up"), F.col("up").alias("top"), F.col("length").alias("more"))
        moved = going.join(further, ["tree", "up"]).select("tree", "node", F.col("top").alias("up"), (F.col("length") + F.col("more")).alias("length"))
        way = checkpointed(moved.unionByName(way.join(going.select("tree", "node"), ["tree", "node"], "left_anti")))
    over = way.select("tree", F.col("node").alias("parent"), "up", "length")
    rest = kept.join(spliced, ["tree", "child"], "left_anti").join(over, ["tree", "parent"], "left")
    return rest.select("tree", F.coalesce("up", "parent").alias("parent"), "child", (F.col("dist") + F.coalesce("length", F.lit(0))).cast("long").alias("dist"), "silent")


def trimmed_edges(edges: DataFrame, texts: DataFrame, distance: Column) -> DataFrame:
    """edges (tree, parent, child) and texts (tree, node, text) -> (tree, parent, child, dist): a node no farther from its
    grandparent than from its parent hangs there.

    ``distance`` refers to ``a.text`` and ``b.text``. From the leaves up a node's parent has not moved yet when the node
    does, so every node looks at its first grandparent and one pass does."""
    own = texts.select("tree", F.col("node").alias("child"), F.col("text").alias("own"))
    rows = edges.where("parent is not null").select("tree", "parent", "child").join(own, ["tree", "child"])
    above = edges.where("parent is not null").select("tree", F.col("child").alias("parent"), F.col("parent").alias("grand"))
    rows = rows.join(above, ["tree", "parent"], "left")
    for end in ("parent", "grand"):
        rows = rows.join(texts.select("tree", F.col("node").alias(end), F.col("text").alias(f"{end}_text")), ["tree", end], "left")
    far = rows.select("*", F.struct(F.col("own").alias("text")).alias("a"), F.struct(F.col("parent_text").alias("text")).alias("b")).withColumn("near", distance)
    far = far.withColumn("b", F.struct(F.col("grand_text").alias("text"))).withColumn("away", F.when(F.col("grand").isNotNull(), distance))
    up = F.coalesce(F.col("away") <= F.col("near"), F.lit(False))
    return far.select("tree", F.when(up, F.col("grand")).otherwise(F.col("parent")).alias("parent"), "child", F.when(up, F.col("away")).otherwise(F.col("near")).cast("long").alias("dist"))
