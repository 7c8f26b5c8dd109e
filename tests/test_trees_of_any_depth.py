"""Depths and common ancestors by doubling pointers, beside walks to the root."""

import random

from clonelens.operators import treeops

EDGES = "tree string, parent long, child long, dist int"


def test_random_forests(spark):
    rng = random.Random(1)
    rows, up = [], {}
    for tree in ("s", "t"):
        for i in range(60):
            parent = None if i in (0, 40) else rng.randrange(40 if i > 40 and rng.random() < 0.2 else 0, i) if i < 40 or rng.random() < 0.5 else 40
            up[tree, i] = parent
            rows.append((tree, parent, i, 1))

    def way(tree, n):
        out = [n]
        while up[tree, out[-1]] is not None:
            out.append(up[tree, out[-1]])
        return out

    edges = spark.createDataFrame(rows, EDGES)
    got = {(r.tree, r.node): (r.depth, r.root) for r in treeops.depths(edges).collect()}
    assert got == {k: (len(way(*k)) - 1, way(*k)[-1]) for k, p in up.items() if p is not None}
    pairs = [(rng.choice("st"), rng.randrange(60), rng.randrange(60)) for _ in range(150)] + [("s", 3, 3), ("s", 5, 999)]
    want = {}
    for t, a, b in pairs:
        if b in range(60):
            common = [x for x in way(t, a) if x in way(t, b)]
            if common:
                want[t, a, b] = common[0]
    found = treeops.lowest_common(edges, spark.createDataFrame(pairs, "tree string, a long, b long"))
    assert {(r.tree, r.a, r.b): r.lca for r in found.collect()} == want


def test_a_chain_needs_few_rows(spark):
    """A chain of 20,000 nodes: 15 tables of n rows at most instead of n * n / 2 pairs."""
    n = 20_000
    edges = spark.range(1, n).selectExpr("'t' as tree", "id - 1 as parent", "id as child", "1 as dist")
    tables = treeops.jump_tables(edges)
    assert len(tables) == 15 and sum(t.count() for t in tables) < n * 15
    depth = {r.node: r.depth for r in treeops.depths(edges).where("node % 4999 = 0").collect()}
    assert depth == {k: k for k in range(4999, n, 4999)}
    pairs = spark.createDataFrame([("t", n - 1, 17), ("t", 5, n - 1), ("t", 0, 9)], "tree string, a long, b long")
    assert {(r.a, r.b): r.lca for r in treeops.lowest_common(edges, pairs).collect()} == {(n - 1, 17): 17, (5, n - 1): 5, (0, 9): 0}


def test_no_edges(spark):
    edges = spark.createDataFrame([], EDGES)
    assert treeops.depths(edges).count() == 0
    assert treeops.lowest_common(edges, spark.createDataFrame([("t", 1, 2)], "tree string, a long, b long")).count() == 0
