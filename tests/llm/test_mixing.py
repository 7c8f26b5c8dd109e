import re

from cases import edge_docs, no_docs

from clonelens.llm import mixing as m

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def targets(sizes):
    """Water filling by hand: share by weight, cap, share the excess again among those below."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(order)}
    total, full = sum(sizes.values()), set()
    while True:
        left = total - sum(3 * sizes[s] for s in full)
        w = sum(weight[s] for s in order if s not in full)
        out = {s: 3.0 * sizes[s] if s in full else left * weight[s] / w for s in order}
        over = {s for s in order if s not in full and out[s] > 3 * sizes[s]}
        if not over:
            return out
        full |= over


def check(docs, **kw):
    src = docs.collect()
    sizes = {}
    for r in src:
        sizes[r.source] = sizes.get(r.source, 0) + len(WORD.findall(r.text or ""))
    want = targets(sizes)
    rows = m.mix(docs, **kw).collect()
    assert sorted((str(r.id), r.size) for r in rows) == sorted((str(r.doc_id), len(WORD.findall(r.text or ""))) for r in src)
    for s in sizes:
        mine = [r for r in rows if r.source == s]
        assert all(r.source_size == sizes[s] and abs(r.target - want[s]) < 1e-6 * (1 + want[s]) for r in mine)
        assert all(0 <= r.taken <= 3 * r.size for r in mine)
        assert sum(r.taken for r in mine) == int(want[s] + 1e-6)
    assert sorted(map(str, rows)) == sorted(map(str, m.mix(docs, **kw).collect()))
    return rows


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    check(docs)
    check(docs, rows_a_bucket=10)


def test_edges(spark):
    check(edge_docs(spark))
    assert m.mix(no_docs(spark)).count() == 0 and m.apply_mix(no_docs(spark)).count() == 0


def test_applied(spark):
    docs = edge_docs(spark, [(20 + i, f" a  b\tc{i} d", "en", f"q{i % 7}", 9) for i in range(40)])
    taken = sorted((str(r.id), r.taken) for r in m.mix(docs).collect() if r.taken)
    out = m.apply_mix(docs)
    assert out.schema == docs.schema
    got, texts = {}, {}
    for r in docs.collect():
        texts.setdefault(r.doc_id, []).append(r.text or "")
    for r in out.collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + len(WORD.findall(r.text))
        assert any(t.startswith(r.text) for t in texts[r.doc_id])
    want = {}
    for i, n in taken:
        want[i] = want.get(i, 0) + n
    assert {str(k): v for k, v in got.items()} == want


def test_ties_of_equal_ids_and_sizes_agree(spark):
    rows = [(1, f"w{i} x y", "s") for i in range(30)] + [(2, "a " * 300, "t")]
    runs = []
    for n in (1, 5):
        docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(n)
        runs.append(sorted(map(tuple, m.apply_mix(docs).collect())))
    assert runs[0] == runs[1]


def test_query_equals_sql(spark):
    from sqlcheck import equals_sql

    equals_sql(spark, "op7_mixing")
