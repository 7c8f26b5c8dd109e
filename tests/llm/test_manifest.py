import hashlib
import zlib

import pytest
from cases import edge_docs, no_docs
from pyspark.sql import functions as F
from sqlcheck import equals_sql

from clonelens.llm import manifest


def h(x):
    return hashlib.sha256(x.encode()).hexdigest()


def leaf(r):
    return h("".join("-" if r[c] is None else f"{len(str(r[c]).encode())}:{r[c]}" for c in manifest.FIELDS))


def climb(nodes, fan=3):
    """Root and the proof of each node, level by level."""
    at, proofs = list(range(len(nodes))), [[] for _ in nodes]
    while len(nodes) > 1:
        for i, p in enumerate(at):
            run = range(p // fan * fan, min(p // fan * fan + fan, len(nodes)))
            proofs[i].append(("".join(nodes[j] for j in run if j < p), "".join(nodes[j] for j in run if j > p)))
        nodes, at = [h("".join(nodes[i : i + fan])) for i in range(0, len(nodes), fan)], [p // fan for p in at]
    return nodes[0], proofs


def brute(docs):
    rows = [r.asDict() for r in docs.collect()]
    sources = sorted({r["source"] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    grouped = [sorted((r for r in rows if r["source"] == s), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r))) for s in sources]
    trees = [climb([leaf(r) for r in g]) for g in grouped]
    if not trees:
        return []
    root, above = climb([t[0] for t in trees])
    out = []
    for g, (sub, proofs), top in zip(grouped, trees, above, strict=True):
        for r, proof in zip(g, proofs, strict=True):
            bad = dict(r)
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0 and r["text"]:
                bad["text"] = r["text"].replace("\n", "")
            x = leaf(bad)
            for lo, hi in proof + top:
                x = h(lo + x + hi)
            out.append((r["doc_id"], leaf(r), sub, root, h("".join(lo + hi for lo, hi in proof + top)), x, x == root))
    return sorted(out, key=str)


def query(spark, docs, tmp_path):
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = manifest.op12_manifest(spark, str(tmp_path))
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted(map(tuple, got.collect()), key=str)


@pytest.mark.parametrize("n,height", [(1, 2), (2, 2), (9, 2), (10, 2), (11, 2), (27, 2), (28, 2), (82, 2), (100, 1), (100, 6)])
def test_traversals_equal_the_whole_tree(spark, n, height):
    rows = spark.createDataFrame([("g", i, n, h(str(i)), i) for i in range(n)], "group string, pos long, n long, digest string, item long")
    levels, roots = manifest.forest(rows, height=height)
    root, proofs = climb([h(str(i)) for i in range(n)])
    assert [tuple(r) for r in roots.collect()] == [("g", root)]
    top = spark.createDataFrame([("g", None)], f"group string, above {manifest.PROOF}")
    got = {r["item"]: [tuple(x) for x in r["proof"]] for r in manifest.unwound(levels, top).collect()}
    assert got == dict(enumerate(proofs))


def test_edges(spark, tmp_path):
    docs = edge_docs(spark, [(90 - i, f"line\n{i}", "en", "hot", i) for i in range(40)] + [(5, "x\n", None, None, None)] * 3)
    want = brute(docs)
    got = query(spark, docs, tmp_path)
    assert got == want
    assert {r[-1] for r in got} == {True, False}


def test_many_sources(spark, tmp_path):
    docs = edge_docs(spark, [(i, "a\nb", "en", f"s{i % 30}", i) for i in range(200)])
    assert query(spark, docs, tmp_path) == brute(docs)


def test_one_source_alone(spark, tmp_path):
    docs = edge_docs(spark).where("doc_id = 2")
    got = query(spark, docs, tmp_path)
    assert got == brute(docs)
    assert got[0][1] == got[0][2] == got[0][3]


def test_empty(spark, tmp_path):
    assert query(spark, no_docs(spark), tmp_path) == []


def test_a_changed_row_is_found(spark):
    docs = edge_docs(spark)
    good = manifest.manifest(docs)
    assert good.where(manifest.fold(F.col("leaf"), F.col("proof")) == F.col("root")).count() == docs.count()
    assert good.where(manifest.fold(F.lit(h("other")), F.col("proof")) == F.col("root")).count() == 0


def test_equals_sql(spark):
    equals_sql(spark, "op12_manifest")
