"""Median strings of clusters: texts with a small sum of edit distances to all members.

A cluster's distinct texts are dealt to blocks. Each block finds a median of its own: its medoid, improved by single edits
as long as one helps, and by pairs of edits where none does. A cluster of one block is done. The block medians of a larger
one are texts of a cluster again, weighted by their blocks, until one block is left; from that text the search goes on over
the whole cluster in rounds, each of which sums the blocks' votes for edits and the costs of the texts these give."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.editlanes import Lanes, edit_votes, edited
from .checkpoints import checkpointed
from .tiles import dealt

BLOCK = 512
LOOK = 6  # edits after which a second one is looked for where no single one helps


def _step(text: str, cost: int, texts: list[str], weights: np.ndarray, lanes: Lanes) -> tuple[int, str]:
    """The cheapest text one edit away, or ``text``; ties to the first text in order."""
    best = (cost, text)
    for (kind, place, letter), votes in sorted(edit_votes(text, texts, weights).items(), key=lambda x: (-x[1], x[0])):
        if votes < cost - best[0] or votes == 0:
            break  # an edit gains its votes at most
        new = edited(text, kind, place, letter)
        c = int(lanes.distances(new) @ weights)
        if c < cost and (c, new) < best:
            best = (c, new)
    return best


def improve(text: str, texts: list[str], weights: np.ndarray) -> tuple[int, str]:
    """(cost, text) from ``text`` on by steps that lower the cost."""
    lanes = Lanes(texts)
    at = (int(lanes.distances(text) @ weights), text)
    while True:
        new = _step(at[1], at[0], texts, weights, lanes)
        if new[0] == at[0]:
            # No single edit helps: the likeliest ones are tried together with a second one.
            votes = sorted(edit_votes(at[1], texts, weights).items(), key=lambda x: (-x[1], x[0]))[:LOOK]
            for (kind, place, letter), _ in votes:
                by_way = edited(at[1], kind, place, letter)
                second = _step(by_way, int(lanes.distances(by_way) @ weights), texts, weights, lanes)
                if second[0] < new[0]:
                    new = second
            if new[0] == at[0]:
                return at
        at = new


def median_string(texts: list[str], weights: list[int] | None = None) -> str:
    """A string whose sum of edit distances no single edit lowers, never above the medoid's; ties to the earlier text."""
    order = list(dict.fromkeys(texts))
    count = dict.fromkeys(order, 0)
    for t, w in zip(texts, weights or [1] * len(texts), strict=True):
        count[t] += w
    w = np.array([count[t] for t in order], np.int64)
    lanes = Lanes(order)
    medoid = min(order, key=lambda t: int(lanes.distances(t) @ w))
    return improve(medoid, order, w)[1]


PARTIAL = "cluster_id long, t string, w long, ordinal long, blocks long"


def _partial(texts: DataFrame, size: int) -> DataFrame:
    """A median for each block of ``texts`` (cluster_id, t, w, ordinal), with the block's weight and first ordinal."""

    def run(rows):
        import pyarrow as pa

        rows = rows.sort_by([("ordinal", "ascending"), ("t", "ascending")])
        t, w = rows.column("t").to_pylist(), rows.column("w").to_pylist()
        median = t[0] if sum(w) < 3 else median_string(t, w)
        cluster, ordinal, blocks = (rows.column(c)[0].as_py() for c in ("cluster_id", "ordinal", "blocks"))
        values = (cluster, median, sum(w), ordinal, blocks)
        return pa.table({f.split()[0]: pa.array([v], pa.string() if f == "t string" else pa.int64()) for f, v in zip(PARTIAL.split(", "), values, strict=True)})

    return dealt(texts, "cluster_id", "t", size).select("cluster_id", "block", "blocks", "t", "w", "ordinal").groupBy("cluster_id", "block").applyInArrow(run, PARTIAL)


def _votes(blocks: DataFrame, state: DataFrame) -> DataFrame:
    """(cluster_id, tried): the texts that single edits of each cluster's ``text`` give and that bring some member nearer."""

    def run(key, rows, at):
        import pyarrow as pa

        some = []
        if len(at) and len(rows):
            text = at.column("text")[0].as_py()
            votes = edit_votes(text, rows.column("t").to_pylist(), np.array(rows.column("w").to_pylist()))
            some = list(dict.fromkeys(edited(text, *e) for e in votes))
        return pa.table({"cluster_id": pa.array([key[0].as_py()] * len(some), pa.int64()), "tried": pa.array(some, pa.string())})

    found = blocks.groupBy("cluster_id", "block").cogroup(state.groupBy("cluster_id", "block")).applyInArrow(run, "cluster_id long, tried string")
    return found.distinct()


def _costs(blocks: DataFrame, tried: DataFrame) -> DataFrame:
    """(cluster_id, tried, cost) over all blocks; ``tried`` stands under each block of its cluster."""

    def run(key, rows, some):
        import pyarrow as pa

        names = some.column("tried").to_pylist()
        cost = []
        if names and len(rows):
            lanes, w = Lanes(rows.column("t").to_pylist()), np.array(rows.column("w").to_pylist())
            cost = [int(lanes.distances(x) @ w) for x in names]
        return pa.table({"cluster_id": pa.array([key[0].as_py()] * len(cost), pa.int64()), "tried": pa.array(names[: len(cost)], pa.string()), "cost": pa.array(cost, pa.int64())})

    part = blocks.groupBy("cluster_id", "block").cogroup(tried.groupBy("cluster_id", "block")).applyInArrow(run, "cluster_id long, tried string, cost long")
    return part.groupBy("cluster_id", "tried").agg(F.sum("cost").alias("cost"))


def medians(members: DataFrame, text: str = "cdr3_aa", size: int = BLOCK) -> DataFrame:
    """members (cluster_id, ordinal, text) -> (cluster_id, centroid, size): the median string; the first text of fewer than three members."""
    texts = members.groupBy("cluster_id", F.col(text).alias("t")).agg(F.count("*").alias("w"), F.min("ordinal").alias("ordinal"))
    found = checkpointed(_partial(texts, size))
    single = found.where("blocks = 1").select("cluster_id", F.col("t").alias("centroid"), F.col("w").alias("size"))
    many = found.where("blocks > 1").groupBy("cluster_id").agg(F.sum("w").alias("size"))
    if many.isEmpty():
        return single
    many = checkpointed(many)
    large = dealt(texts.join(many, "cluster_id", "left_semi"), "cluster_id", "t", size)
    large = checkpointed(large)
    every = large.select("cluster_id", F.explode(F.expr("sequence(0L, blocks - 1)")).alias("block")).distinct()
    partial = found.join(many, "cluster_id", "left_semi")
    tried = partial.select("cluster_id", F.col("t").alias("tried"))
    while partial.groupBy("cluster_id").count().where("count > 1").count():
        level = partial.groupBy("cluster_id", "t").agg(F.sum("w").alias("w"), F.min("ordinal").alias("ordinal"))
        partial = checkpointed(_partial(level, size))
        tried = tried.unionByName(partial.select("cluster_id", F.col("t").alias("tried")))
    cheapest = lambda costs: costs.groupBy("cluster_id").agg(F.min(F.struct("cost", "tried")).alias("m")).select("cluster_id", F.col("m.tried").alias("text"), F.col("m.cost").alias("cost"))
    state = checkpointed(cheapest(_costs(large, tried.distinct().join(every, "cluster_id"))))
    done = []
    while not state.isEmpty():
        votes = _votes(large, state.join(every, "cluster_id"))
        new = cheapest(_costs(large, votes.join(every, "cluster_id"))).select("cluster_id", F.col("text").alias("new"), F.col("cost").alias("new_cost"))
        both = checkpointed(state.join(new, "cluster_id", "left"))
        done.append(both.where("new_cost is null or new_cost >= cost").select("cluster_id", F.col("text").alias("centroid")))
        state = both.where("new_cost < cost").select("cluster_id", F.col("new").alias("text"), F.col("new_cost").alias("cost"))
    for d in done:
        single = single.unionByName(d.join(many, "cluster_id"))
    return single
