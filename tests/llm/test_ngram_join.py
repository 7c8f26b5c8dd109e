import re

import numpy as np
from cases import edge_docs, no_docs

from clonelens.llm import ngram_join as j

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def shingles(text):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(docs):
    sets = [(i, shingles(t)) for i, t in docs]
    by = {}
    for k, (_, s) in enumerate(sets):
        for g in s:
            by.setdefault(g, []).append(k)
    links = {k: set() for k in range(len(sets))}
    for k, (_, s) in enumerate(sets):
        seen = {}
        for g in s:
            for o in by[g]:
                seen[o] = seen.get(o, 0) + 1
        for o, n in seen.items():
            if o != k and n >= 0.8 * (len(s) + len(sets[o][1]) - n) - 1e-9:
                links[k].add(o)
    label = {}

    def walk(k, c):
        todo = [k]
        while todo:
            x = todo.pop()
            if x not in label:
                label[x] = c
                todo += links[x]

    for k in sorted(range(len(sets)), key=lambda k: (sets[k][0] is None, sets[k][0])):
        if k not in label:
            walk(k, sets[k][0])
    return sorted(((sets[k][0], label[k], len(links[k]), len(sets[k][1])) for k in range(len(sets))), key=str)


def run(docs):
    return sorted(((r.id, r.class_id, r.n_links, r.n_shingles) for r in j.join(docs).collect()), key=str)


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    assert sum(r[2] > 0 for r in want) > 50
    assert run(docs) == want


def test_blocks_and_large_buckets(spark, monkeypatch):
    rng = np.random.default_rng(1)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(700):
        w = list(base)
        for k in rng.choice(120, rng.integers(0, 4), replace=False):
            w[k] = f"x{rng.integers(1000)}"
        rows.append((i, " ".join(w)))
    rows += [(1000 + i, " ".join(f"y{rng.integers(10**6)}" for _ in range(50))) for i in range(50)]
    want = brute(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert run(docs) == want
    monkeypatch.setattr(j, "BUCKET", 20)
    monkeypatch.setattr(j, "BLOCK_SHINGLES", 12_000)
    assert run(docs) == want


def test_components(spark):
    """A star, a chain, two nodes linked twice and by themselves, and random links."""
    rng = np.random.default_rng(4)
    links = [(500, 1000 + i) for i in range(400)] + [(2000 + i, 2001 + i) for i in range(90)] + [(7, 8), (8, 7), (7, 7)]
    links += [(3000 + int(a), 3000 + int(b)) for a, b in rng.integers(0, 200, (120, 2))]
    up = {x: x for e in links for x in e if e[0] != e[1]}
    for _ in range(len(up)):
        now = dict(up)
        for a, b in links:
            if a != b:
                up[a] = up[b] = min(up[a], up[b])
        if up == now:
            break
    got = j.components(spark.createDataFrame(links, "a long, b long")).collect()
    assert len(got) == len(up) and {r.id: r.label for r in got} == up


def test_lookup_keeps_rows_without_a_match(spark):
    rows = spark.createDataFrame([(i, 1 if i < 90 else i) for i in range(100)], "id long, k long")
    found = spark.createDataFrame([(1, "one"), (95, "other")], "k long, v string")
    got = j.lookup(rows, "k", "id", found, "left").collect()
    assert sorted((r.id, r.v) for r in got) == [(i, "one" if i < 90 else "other" if i == 95 else None) for i in range(100)]
    assert j.lookup(rows, "k", "id", found).count() == 91


def test_edges(spark):
    docs = edge_docs(spark).where("doc_id is not null")
    assert run(docs) == brute([(r.doc_id, r.text) for r in docs.collect()])
    assert len(run(edge_docs(spark))) == edge_docs(spark).count()
    assert run(no_docs(spark)) == []


def test_pruning_keeps_what_reaches_the_threshold():
    for bits in (8, 32):
        least = j.fewest_equal(bits)
        assert least == sorted(least) and 0.5 * j.HASHES < least[-1] < 0.8 * j.HASHES


def test_null_and_repeated_ids(spark):
    """Sets whose ids are all null, and two sets under one smallest id, keep their near copies."""
    text = lambda name, *other: " ".join([*(f"{name}{i}" for i in range(60)), *other])
    rows = [(None, text("a")), (None, text("a", "x")), (3, text("a", "x", "y")), (None, text("b")), (None, text("b", "x")), (None, text("b"))]
    rows += [(5, text("c")), (5, text("d")), (5, text("c", "x")), (6, text("c", "x", "y")), (7, text("d", "x")), (5, text("c").upper()), (None, ""), (5, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert run(docs) == brute(rows)
    assert {(r.id, r.class_id) for r in j.join(docs).collect()} == {(None, 3), (3, 3), (None, None), (5, 5), (6, 5), (7, 5)}


def test_stated_loss_of_pruning():
    for bits, at, stated in ((8, 0.8, 8.5e-5), (32, 0.8, 8.3e-5), (8, 0.82, 1.7e-5), (32, 0.82, 1.7e-5), (8, 0.85, 1.9e-6), (32, 0.85, 2.0e-6)):
        least, p = j.fewest_equal(bits), at + (1 - at) / 2.0**bits
        chance = np.eye(1, j.HASHES + 1)[0]
        for n in range(1, j.HASHES + 1):
            chance = chance * (1 - p) + np.concatenate([[0], chance[:-1]]) * p
            if n % j.STEP == 0:
                chance[: least[n // j.STEP]] = 0
        assert abs(1 - chance.sum() - stated) < 0.05 * stated


def test_query_equals_sql(spark):
    from sqlcheck import equals_sql

    equals_sql(spark, "op5_ngram_join")
