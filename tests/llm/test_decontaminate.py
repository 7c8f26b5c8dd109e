import re

import pytest
from cases import edge_docs, no_docs
from hypothesis import given, settings
from hypothesis import strategies as st

from clonelens.llm import decontaminate as d

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, window=10):
    pats = {}
    for i, t in items:
        w = words(t)
        for k in range(max(1, len(w) - window + 1)) if w else ():
            pats.setdefault(tuple(w[k : k + window]), set()).add(i)
    lengths = {len(p) for p in pats}
    out = []
    for i, t in docs:
        w, hit, found = words(t), set(), set()
        for n in lengths:
            for k in range(len(w) - n + 1):
                if (p := tuple(w[k : k + n])) in pats:
                    hit |= set(range(k, k + n))
                    found |= pats[p]
        out.append((i, len(w), len(hit), sorted(found)))
    return sorted(out, key=str)


def run(spark, docs, items, **kw):
    rows = d.find_leaks(docs, items, **kw).collect()
    return sorted(((r.id, r.n_words, sum(h.end - h.start for h in r.hits), list(r.items)) for r in rows), key=str)


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    items = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    want = brute([(r.doc_id, r.text) for r in docs.collect()], [(str(r.item_id), r.text) for r in items.collect()])
    assert sum(bool(r[2]) for r in want) > 5
    assert run(spark, docs, items) == want
    assert run(spark, docs, items, item_bytes=2000) == want


def test_edges(spark):
    docs = edge_docs(spark, [(9, "Word WORD-word! a B c d é", "", "", 1)])
    items = spark.createDataFrame([(None, "word word word"), ("b", None), ("c", "..."), ("d", "A,b;c")], "item_id string, text string")
    want = brute([(r.doc_id, r.text) for r in docs.collect()], [("", "word word word"), ("d", "A,b;c")])
    assert run(spark, docs, items) == want
    assert run(spark, no_docs(spark), items) == []
    assert all(not r[2] for r in run(spark, docs, items.limit(0)))


@given(st.lists(st.text("aAb é.", max_size=60), min_size=1, max_size=5), st.lists(st.text("ab é", max_size=12), min_size=1, max_size=4), st.sampled_from([2, 10]))
@settings(max_examples=200, deadline=None)
def test_matcher(texts, items, window):
    import pyarrow as pa

    named = [(str(i), t) for i, t in enumerate(items)]
    got = list(d.Matcher(named, window).rows(*d.buffers(pa.array(texts))))
    got = sorted(((i, n, sum(b - a for a, b in d.merged(r)), sorted(s)) for i, (n, r, s) in enumerate(got)), key=str)
    assert got == brute(list(enumerate(texts)), named, window)


@pytest.mark.parametrize("n", [1, 3, 300])
def test_long_words(n):
    import pyarrow as pa

    text = " ".join(f"w{i:03d}" * 9 for i in range(n))
    m = d.Matcher([("x", text)], 10)
    assert [r[2] for r in m.rows(*d.buffers(pa.array(["pre " + text + " post", text[:-1]])))] == [{"x"}, {"x"} if n > 10 else ()]


def test_query_equals_sql(spark):
    from sqlcheck import equals_sql

    equals_sql(spark, "op6_decontamination")
