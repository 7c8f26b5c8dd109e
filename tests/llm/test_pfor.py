import zlib

import numpy as np
import pyarrow as pa
import pytest
from cases import edge_docs, no_docs
from hypothesis import given, settings
from hypothesis import strategies as st

from clonelens.llm import pfor

SF = "/root/testdata/sf0.001"


@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), max_size=700), st.sampled_from([0.5, 0.9, 0.98, 1.0]))
@settings(max_examples=60, deadline=None)
def test_segment_round_trip(values, percentile):
    ids = np.array(values, np.uint32)
    s = pfor.Segment(pfor.write_segment([5, None], np.array([len(ids), 0]), ids, percentile))
    assert s.ids().tolist() == values
    assert s.row_ids == [5, None] and s.lengths.tolist() == [len(ids), 0]
    assert [x for i in range(len(s.mins)) for x in s.block(i).tolist()] == values


def test_outliers_become_exceptions():
    ids = np.ones(128, np.uint32)
    ids[7] = 1 << 30
    s = pfor.Segment(pfor.write_segment([1], np.array([128]), ids))
    assert s.widths.tolist() == [0] and s.counts.tolist() == [1] and s.positions.tolist() == [7]


def plain(texts):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(pfor.token_file())
    return [[*tok.encode(t, add_special_tokens=False).ids, 0] for t in texts]


@given(st.lists(st.text(alphabet=" \n\tab'sé1. \x1c ", max_size=30), max_size=6))
@settings(max_examples=150, deadline=None)
def test_encoder_equals_library(texts):
    enc = pfor.encoder(pfor.token_file())
    for _ in range(2):
        ids, per = enc.encode(pa.array(texts, pa.string()))
        ends = np.cumsum(per)
        assert [ids[e - n : e].tolist() for e, n in zip(ends, per, strict=True)] == plain(texts)


def check(spark, docs, tmp_path, **kw):
    pfor.write_ids(docs, str(tmp_path / "x"), pfor.token_file(), **kw)
    got = pfor.read_ids(spark, str(tmp_path / "x"), values=True).collect()
    want = sorted(((r.doc_id, r.text or "") for r in docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0))
    got.sort(key=lambda r: r.start)
    assert [r.id for r in got] == [w[0] for w in want]
    assert sorted(map(tuple, (r.ids for r in got))) == sorted(map(tuple, plain([w[1] for w in want])))
    at = 0
    for r in got:
        assert (r.start, r.n_tokens) == (at, len(r.ids))
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        at += r.n_tokens


def test_edges(spark, tmp_path):
    check(spark, edge_docs(spark), tmp_path)


def test_empty(spark, tmp_path):
    pfor.write_ids(no_docs(spark), str(tmp_path / "x"), pfor.token_file())
    assert pfor.read_ids(spark, str(tmp_path / "x")).count() == 0


@pytest.mark.parametrize("segment_ids", [1 << 20, 500])
def test_documents(spark, tmp_path, segment_ids):
    check(spark, spark.read.parquet(f"{SF}/documents.parquet"), tmp_path, segment_ids=segment_ids)
