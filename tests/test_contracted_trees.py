"""Clean-up and trimming on edge tables, beside the versions on trees in memory."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from clonelens.functions import distances as d
from clonelens.operators import contract, lineage, simplify

EDGES = "tree string, parent string, child string, dist int, silent boolean"


def grown(rng, n, deep):
    rows = [("r", "0", 1, rng.random() < 0.2)]
    for i in range(1, n):
        rows.append((str(rng.randrange(max(0, i - deep), i)), str(i), rng.randrange(1, 5), rng.random() < 0.7))
    return rows


def test_clean_up_equals_the_tree_in_memory(spark):
    """Random trees, bushy and deep, with chains of silent nodes, in one table."""
    rng = random.Random(5)
    trees = {f"t{k}": grown(rng, n, deep) for k, (n, deep) in enumerate([(1, 1), (40, 40), (40, 3), (60, 2), (30, 1)])}
    rows = [(t, *e) for t, edges in trees.items() for e in edges] + [(t, None, "r", 0, False) for t in trees]
    out = contract.without_idle(spark.createDataFrame(rows, EDGES)).collect()
    for t, edges in trees.items():
        want = simplify.tidy(simplify.Tree("r", [(p, c, s) for p, c, _, s in edges], {}))
        got = [(r.parent, r.child) for r in out if r.tree == t and r.parent]
        assert sorted(got) == sorted(want.edges())
        up, length = {c: p for p, c, _, _ in edges}, {c: k for _, c, k, _ in edges}
        for r in (r for r in out if r.tree == t and r.parent):
            x, sum_ = r.child, 0
            while x != r.parent:
                x, sum_ = up[x], sum_ + length[x]
            assert r.dist == sum_
    assert contract.without_idle(spark.createDataFrame([], EDGES)).count() == 0


def test_a_long_chain_takes_few_rounds(spark, monkeypatch):
    """3000 silent nodes in a row above one with reads."""
    rows = [("t", str(i), str(i + 1), 1, i < 2999) for i in range(3000)]
    calls, plain = [], contract.checkpointed
    monkeypatch.setattr(contract, "checkpointed", lambda df: calls.append(1) or plain(df))
    out = contract.without_idle(spark.createDataFrame(rows, EDGES)).collect()
    assert [(r.parent, r.child, r.dist) for r in out] == [("0", "3000", 3000)]
    assert len(calls) < 50


@pytest.mark.parametrize("seed", [1, 2])
def test_trimming_equals_the_tree_in_memory(spark, seed):
    rng = random.Random(seed)
    texts = ["".join(rng.choices("ac", k=6)) for _ in range(30)]
    m = np.array([[sum(x != y for x, y in zip(a, b, strict=True)) for b in texts] for a in texts])
    edges = lineage.spanning_tree(m, [1] * 30)
    table = spark.createDataFrame([("t", p, c) for p, c, _ in edges], "tree string, parent long, child long")
    named = spark.createDataFrame([("t", i, t) for i, t in enumerate(texts)], "tree string, node long, text string")
    out = contract.trimmed_edges(table, named, d.hamming(F.col("a.text"), F.col("b.text"))).collect()
    assert sorted((r.parent, r.child, r.dist) for r in out) == sorted(lineage.trimmed(edges, m))
