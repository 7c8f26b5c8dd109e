"""Spanning trees of clones of any size.

A clone's aligned rows are dealt to blocks, and each pair of blocks is a group of its own, in which the minimum spanning
tree of the two blocks' rows is found. An edge that is not in the tree of some pair of blocks is the heaviest of a cycle
there, so the clone's tree is among the edges of those trees: few against all pairs. Over these, Borůvka rounds join each
component to its nearest other by the lightest edge that leaves it, until one is left; components at least halve in a
round. Edges are ordered by distance, then by the larger summed abundance, then by the two numbers, so that no two are
equal and the tree is one, however rows are dealt."""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .checkpoints import checkpointed
from .tiles import BLOCK, dealt

EDGES = "clone long, a long, b long, dist long, abundance long"


def tree_of(rows: np.ndarray, number: np.ndarray, abundance: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(a, b, dist, abundance) of the minimum spanning tree of ``rows``, grown from the first: a < b are numbers."""
    n = len(rows)
    if n < 2:
        return []
    kind = np.dtype([("dist", np.int64), ("less", np.int64), ("a", np.int64), ("b", np.int64)])

    def edges_from(k: int) -> np.ndarray:
        out = np.empty(n, kind)
        out["dist"] = (rows != rows[k]).sum(1)
        out["less"] = -(abundance + abundance[k])
        out["a"], out["b"] = np.minimum(number, number[k]), np.maximum(number, number[k])
        return out

    def before(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x), bool)
        equal = np.ones(len(x), bool)
        for name in kind.names:
            out |= equal & (x[name] < y[name])
            equal &= x[name] == y[name]
        return out

    best, left, found = edges_from(0), np.ones(n, bool), []
    left[0] = False
    for _ in range(n - 1):
        at = np.flatnonzero(left)
        k = int(at[np.lexsort(tuple(best[at][name] for name in reversed(kind.names)))[0]])
        e = best[k]
        found.append((int(e["a"]), int(e["b"]), int(e["dist"]), -int(e["less"])))
        left[k] = False
        new = edges_from(k)
        nearer = left & before(new, best)
        best[nearer] = new[nearer]
    return found


def candidate_edges(nodes: DataFrame, block: int = BLOCK) -> DataFrame:
    """nodes (clone, node, text, abundance) -> EDGES of the trees of all pairs of blocks, each once."""
    d = dealt(nodes, "clone", "node", block).select("clone", "node", "text", "abundance", "block", "blocks")
    other = F.explode(F.expr("sequence(0L, blocks - 1)"))
    # Two different blocks meet; a clone of one block is a tile alone.
    tiles = d.withColumn("with", other).where("block <> with or blocks = 1")
    tiles = tiles.select("clone", F.least("block", "with").alias("lo"), F.greatest("block", "with").alias("hi"), "node", "text", "abundance")

    def run(t):
        import pyarrow as pa

        t = t.sort_by("node")
        texts = t.column("text").to_pylist()
        rows = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).reshape(len(texts), -1)
        small, coded = np.unique(rows, return_inverse=True)
        rows = coded.reshape(rows.shape).astype(np.uint8) if len(small) < 256 else rows
        found = tree_of(rows, t.column("node").to_numpy(), t.column("abundance").to_numpy())
        columns = list(zip(*found, strict=True)) or [()] * 4
        clone = [t.column("clone")[0].as_py()] * len(found)
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("clone", "a", "b", "dist", "abundance"), (clone, *columns), strict=True)})

    return tiles.groupBy("clone", "lo", "hi").applyInArrow(run, EDGES).distinct()


def spanning_forest(nodes: DataFrame, block: int = BLOCK) -> DataFrame:
    """nodes (clone, node, text, abundance), texts of a clone equally long -> EDGES of each clone's minimum spanning tree."""
    edges = checkpointed(candidate_edges(nodes, block))
    # Where a clone's candidates are one fewer than its rows they are its tree.
    sizes = nodes.groupBy("clone").agg(F.count("*").alias("n"))
    loose = checkpointed(edges.groupBy("clone").agg(F.count("*").alias("m")).join(sizes, "clone").where("m >= n").select("clone"))
    done = [edges.join(loose, "clone", "left_anti")]
    open_ = checkpointed(edges.join(loose, "clone", "left_semi"))
    label = checkpointed(nodes.join(loose, "clone", "left_semi").select("clone", "node", F.col("node").alias("part")))
    while not open_.isEmpty():
        end = lambda s: label.select("clone", F.col("node").alias(s), F.col("part").alias(f"part_{s}"))
        # Ends are joined by node, not by part, so that a large part is no hot key.
        named = checkpointed(open_.join(end("a"), ["clone", "a"]).join(end("b"), ["clone", "b"]).where("part_a <> part_b"))
        if named.isEmpty():
            break
        rank = F.struct("dist", (-F.col("abundance")).alias("less"), "a", "b", "part_a", "part_b")
        leaving = named.select("clone", F.explode(F.array("part_a", "part_b")).alias("part"), rank.alias("e"))
        chosen = checkpointed(leaving.groupBy("clone", "part").agg(F.min("e").alias("e")))
        taken = chosen.select("clone", F.col("e.a").alias("a"), F.col("e.b").alias("b"), F.col("e.dist").alias("dist"), (-F.col("e.less")).alias("abundance")).distinct()
        done.append(checkpointed(taken))
        # Each part hangs on the one it joins; of two that chose one edge the smaller is the root. Pointers double to roots.
        over = F.when(F.col("part") == F.col("e.part_a"), F.col("e.part_b")).otherwise(F.col("e.part_a"))
        up = chosen.select("clone", "part", over.alias("up"))
        back = up.select("clone", F.col("part").alias("up"), F.col("up").alias("back"))
        up = checkpointed(up.join(back, ["clone", "up"]).select("clone", "part", F.when((F.col("back") == F.col("part")) & (F.col("part") < F.col("up")), F.col("part")).otherwise(F.col("up")).alias("up")))
        while True:
            above = up.select("clone", F.col("part").alias("up"), F.col("up").alias("top"))
            doubled = checkpointed(up.join(above, ["clone", "up"]).select("clone", "part", F.col("top").alias("up"), (F.col("top") != F.col("up")).alias("moved")))
            up = doubled.select("clone", "part", "up")
            if doubled.where("moved").isEmpty():
                break
        label = checkpointed(label.join(up, ["clone", "part"], "left").select("clone", "node", F.coalesce("up", "part").alias("part")))
        open_ = named.select(*open_.columns)
    return reduce(DataFrame.unionByName, done)
