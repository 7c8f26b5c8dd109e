"""Questions about trees given as edges (tree, parent, child, dist); the root's parent is null or absent as a child."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .checkpoints import checkpointed


def ancestors(edges: DataFrame) -> DataFrame:
    """(tree, node, ancestor, steps, length): all ancestors by path doubling, in a logarithmic number of rounds."""
    paths = checkpointed(edges.where("parent is not null").select("tree", F.col("child").alias("node"), F.col("parent").alias("ancestor"), F.lit(1).alias("steps"), F.col("dist").cast("long").alias("length")))
    reach = 1
    while True:
        far = paths.where(F.col("steps") == reach).select("tree", "node", F.col("ancestor").alias("via"), F.col("steps").alias("s"), F.col("length").alias("l"))
        up = paths.select("tree", F.col("node").alias("via"), "ancestor", "steps", "length")
        more = checkpointed(far.join(up, ["tree", "via"]).select("tree", "node", "ancestor", (F.col("s") + F.col("steps")).alias("steps"), (F.col("l") + F.col("length")).alias("length")))
        if more.isEmpty():
            return paths
        paths = paths.unionByName(more)
        reach *= 2


def depths(edges: DataFrame) -> DataFrame:
    """(tree, node, depth, root): steps to the root, of all nodes but roots.

    Each node's pointer doubles its reach in a round, one row a node; nodes that point at a root rest."""
    links = edges.where("parent is not null").select("tree", F.col("child").alias("node"), F.col("parent").alias("up"))
    below = links.select("tree", F.col("node").alias("up"), F.lit(True).alias("going"))
    state = links.join(below, ["tree", "up"], "left").select("tree", "node", "up", F.lit(1).alias("steps"), F.coalesce("going", F.lit(False)).alias("going"))
    state, done = checkpointed(state), []
    while True:
        done.append(state.where("not going").select("tree", "node", F.col("steps").alias("depth"), F.col("up").alias("root")))
        open_ = state.where("going").drop("going")
        if open_.isEmpty():
            return reduce(DataFrame.unionByName, done)
        # Pointers into the part that rests end there; the others carry on as far as their targets do.
        ahead = reduce(DataFrame.unionByName, done).select("tree", F.col("node").alias("up"), F.col("root").alias("top"), F.col("depth").alias("more"), F.lit(False).alias("going"))
        ahead = ahead.unionByName(open_.select("tree", F.col("node").alias("up"), F.col("up").alias("top"), F.col("steps").alias("more"), F.lit(True).alias("going")))
        state = checkpointed(open_.join(ahead, ["tree", "up"]).select("tree", "node", F.col("top").alias("up"), (F.col("steps") + F.col("more")).alias("steps"), "going"))


def jump_tables(edges: DataFrame) -> list[DataFrame]:
    """For k = 0, 1, ...: (tree, node, up) with the ancestor 2^k steps above, of nodes that have one; n rows each at most."""
    level, out = checkpointed(edges.where("parent is not null").select("tree", F.col("child").alias("node"), F.col("parent").alias("up"))), []
    while not level.isEmpty():
        out.append(level)
        level = checkpointed(level.join(level.select("tree", F.col("node").alias("up"), F.col("up").alias("top")), ["tree", "up"]).select("tree", "node", F.col("top").alias("up")))
    return out


def lowest_common(edges: DataFrame, pairs: DataFrame) -> DataFrame:
    """pairs (tree, a, b) -> with lca, the first node on both ways to the root, either end included.

    The deeper end is lifted to the other's depth by the bits of the difference, then both climb by the longest jumps that
    do not meet yet; their parent is the answer. Pairs without a common ancestor are left out."""
    nodes = edges.select("tree", F.explode(F.array("parent", "child")).alias("node")).where("node is not null").distinct()
    depth = checkpointed(nodes.join(depths(edges).select("tree", "node", "depth"), ["tree", "node"], "left").select("tree", "node", F.coalesce("depth", F.lit(0)).alias("depth")))
    side = lambda s: depth.select("tree", F.col("node").alias(s), F.col("depth").alias(f"d_{s}"))
    at = pairs.select("tree", "a", "b").distinct().join(side("a"), ["tree", "a"]).join(side("b"), ["tree", "b"])
    deep, high = F.col("d_a") >= F.col("d_b"), F.abs(F.col("d_a") - F.col("d_b"))
    at = checkpointed(at.select("tree", "a", "b", F.when(deep, F.col("a")).otherwise(F.col("b")).alias("x"), F.when(deep, F.col("b")).otherwise(F.col("a")).alias("y"), high.alias("gap")))
    tables = jump_tables(edges)
    up = lambda k, s: tables[k].select("tree", F.col("node").alias(s), F.col("up").alias(f"u_{s}"))
    for k in reversed(range(len(tables))):
        lift = F.col("gap").bitwiseAND(1 << k) > 0
        at = checkpointed(at.join(up(k, "x"), ["tree", "x"], "left").select("tree", "a", "b", F.when(lift, F.col("u_x")).otherwise(F.col("x")).alias("x"), "y", "gap"))
    for k in reversed(range(len(tables))):
        met = at.join(up(k, "x"), ["tree", "x"], "left").join(up(k, "y"), ["tree", "y"], "left")
        climb = F.coalesce((F.col("x") != F.col("y")) & (F.col("u_x") != F.col("u_y")), F.lit(False))
        at = checkpointed(met.select("tree", "a", "b", F.when(climb, F.col("u_x")).otherwise(F.col("x")).alias("x"), F.when(climb, F.col("u_y")).otherwise(F.col("y")).alias("y")))
    if not tables:
        return at.where("x = y").select("tree", "a", "b", F.col("x").alias("lca"))
    last = at.join(up(0, "x"), ["tree", "x"], "left").join(up(0, "y"), ["tree", "y"], "left")
    return last.where("x = y or u_x = u_y").select("tree", "a", "b", F.when(F.col("x") == F.col("y"), F.col("x")).otherwise(F.col("u_x")).alias("lca"))


def cost(edges: DataFrame, silent: str | None = None) -> DataFrame:
    """(tree, cost): summed distance of labelled nodes to their nearest labelled ancestor; ``silent`` names a flag of unlabelled nodes."""
    if silent is None:
        return edges.where("parent is not null").groupBy("tree").agg(F.sum("dist").cast("long").alias("cost"))
    unlabelled = edges.where(silent).select("tree", F.col("child").alias("ancestor"), F.lit(True).alias("skip"))
    up = ancestors(edges).join(unlabelled, ["tree", "ancestor"], "left").where("skip is null")
    labelled = edges.where(~F.col(silent)).select("tree", F.col("child").alias("node"))
    near = up.join(labelled, ["tree", "node"]).groupBy("tree", "node").agg(F.min_by("length", "steps").alias("l"))
    return near.groupBy("tree").agg(F.sum("l").cast("long").alias("cost"))


def inconsistent_labels(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """(tree, label, n): labels that occur in the tree other than once."""
    seen = edges.groupBy("tree", F.col("child").alias("label")).agg(F.count("*").alias("n"))
    both = labels.join(seen, ["tree", "label"], "full")
    return both.select("tree", "label", F.coalesce("n", F.lit(0)).alias("n")).where("n != 1")
