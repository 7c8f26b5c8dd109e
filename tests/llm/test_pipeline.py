import zlib

import numpy as np
import pytest
from cases import DOCS, edge_docs, no_docs
from test_decontaminate import brute as leaks
from test_mixing import WORD, targets
from test_ngram_join import brute as near
from test_pfor import plain

import corpus_pipeline as c
from clonelens.llm import toxicity

SF = "/root/testdata/sf0.01"
STAGE = dict(c.STAGES)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_toxicity(spark, docs):
    out = STAGE["toxicity"](spark, docs, SF)
    assert out.schema == docs.schema
    model = toxicity.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    scores = {r.doc_id: r.score for r in toxicity.score_rows(docs, model, ("doc_id",)).collect()}
    assert rows(out) == sorted((tuple(r) for r in docs.collect() if scores[r.doc_id] < 0.5), key=str)
    assert out.count() < docs.count()


def test_near_duplicates(spark, docs):
    out = STAGE["ngram_jaccard_join"](spark, docs, SF)
    assert out.schema == docs.schema
    keep = {r[0] for r in near([(r.doc_id, r.text) for r in docs.collect()]) if r[0] == r[1]}
    assert rows(out) == sorted((tuple(r) for r in docs.collect() if r.doc_id in keep), key=str)


def test_near_duplicates_of_null_and_repeated_ids(spark):
    text = lambda name, *other: " ".join([*(f"{name}{i}" for i in range(60)), *other])
    kept = [(5, text("b")), (5, text("c")), (None, text("d")), (4, text("a")), (None, ""), (None, ""), (5, None), (5, "!")]
    dropped = [(None, text("a", "x")), (6, text("b", "x")), (7, text("c", "x")), (None, text("d")), (None, text("d")), (4, text("a")), (None, text("b"))]
    df = spark.createDataFrame(kept + dropped, "doc_id long, text string")
    out = STAGE["ngram_jaccard_join"](spark, df, SF)
    assert out.schema == df.schema and rows(out) == sorted(kept, key=str)


def test_decontamination(spark, docs):
    out = STAGE["benchmark_decontamination"](spark, docs, SF)
    items = [(str(r.item_id), r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = {r[0] for r in leaks([(r.doc_id, r.text) for r in docs.collect()], items) if not r[2]}
    assert out.schema == docs.schema and rows(out) == sorted((tuple(r) for r in docs.collect() if r.doc_id in clean), key=str)


def test_mixing(spark, docs):
    out = STAGE["mixing"](spark, docs, SF)
    size = lambda t: len(WORD.findall(t or ""))
    sizes, got = {}, {}
    for r in docs.collect():
        sizes[r.source] = sizes.get(r.source, 0) + size(r.text)
    for r in out.collect():
        got[r.source] = got.get(r.source, 0) + size(r.text)
        assert r.n_chars == len(r.text)
    assert out.schema == docs.schema and got == {s: int(t + 1e-6) for s, t in targets(sizes).items()}


def test_token_blocks(spark, docs):
    got = sorted(STAGE["token_blocks"](spark, docs, SF).collect(), key=lambda r: r.start)
    want = sorted((r.doc_id, r.text) for r in docs.collect())
    at = 0
    for r, (i, ids) in zip(got, zip([w[0] for w in want], plain([w[1] for w in want]), strict=True), strict=True):
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


def test_edges(spark):
    for make in (edge_docs, no_docs):
        df = make(spark)
        for name, stage in c.STAGES[:-1]:
            out = stage(spark, df, SF)
            assert out.schema == df.schema, name
            assert {r.doc_id for r in out.collect()} <= {r.doc_id for r in df.collect()}
        assert STAGE["token_blocks"](spark, df, SF).count() == df.count()
    assert len(DOCS.split(",")) == 9


def test_run(spark):
    out = c.run(spark, "/root/testdata/sf0.001")
    assert out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and out.count() > 50
