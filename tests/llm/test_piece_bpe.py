import hashlib

import public_tokenizers
import pytest
import tiktoken
from cases import edge_docs, no_docs
from hypothesis import given, settings
from hypothesis import strategies as st

from clonelens.llm import piece_bpe

SF = "/root/testdata/sf0.001"
PATH, PATTERN = piece_bpe.defaults(None, None)


@pytest.fixture(scope="module")
def plain():
    ranks = piece_bpe.read_ranks(PATH)
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


ODD = ["a" * 5000, " " * 3000 + "x", "▁ ▁Ā<unk>", "\x00\x1c\x85​　 힣", "<|endoftext|><s></s>", "don't I'LL 've", "\r\n\r\n \t x", "\U0001f600\U0001f1e9\U0001f1ea é"]


@given(st.one_of(st.text(max_size=60), st.text(alphabet=" \n\tab'stleé1. \x1c▁ā", max_size=80)))
@settings(max_examples=300, deadline=None)
def test_equals_library(plain, text):
    c = piece_bpe.coder(PATH, PATTERN)
    ids = c.encode(text)
    assert ids.tolist() == plain.encode_ordinary(text)
    assert c.decode(ids.tolist()) == text.encode()


@pytest.mark.parametrize("text", ODD)
def test_odd_texts(plain, text):
    c = piece_bpe.coder(PATH, PATTERN)
    assert c.encode(text).tolist() == plain.encode_ordinary(text)
    assert c.decode(c.encode(text).tolist()) == text.encode()


def test_many_texts_at_once(plain):
    c = piece_bpe.coder(PATH, PATTERN)
    texts = ["", *ODD, "", "one two", ODD[0], ""]
    ids, counts = c.encode_many(texts)
    assert counts.tolist() == [len(plain.encode_ordinary(t)) for t in texts]
    assert ids.tolist() == [i for t in texts for i in plain.encode_ordinary(t)]
    assert c.encode_many([""])[1].tolist() == [0]


def test_every_token_is_its_own_encoding(plain):
    """Also tokens that no chain of merges reaches, where they are pre-tokens."""
    c = piece_bpe.coder(PATH, PATTERN)
    for data, rank in c.ranks.items():
        assert c.decode([rank]) == data
        try:
            text = data.decode()
        except UnicodeDecodeError:
            continue
        assert c.encode(text).tolist() == plain.encode_ordinary(text)


def test_portions(plain, monkeypatch):
    monkeypatch.setattr(piece_bpe, "PORTION", 3)
    monkeypatch.setattr(piece_bpe, "MEMO_WORDS", 4)
    c = piece_bpe.Coder(piece_bpe.read_ranks(PATH), PATTERN)
    text = "one two, three; four five one two six don't"
    assert c.encode(text).tolist() == plain.encode_ordinary(text)


def test_other_vocabulary():
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    own = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=piece_bpe.read_ranks(path), special_tokens={})
    text = "Some text, with numbers 12345 and ümläuts."
    assert piece_bpe.coder(path, PATTERN).encode(text).tolist() == own.encode_ordinary(text)


def test_bad_vocabularies_are_refused():
    for ranks in ({b"a": 0}, {bytes([b]): b + 1 for b in range(256)}):
        with pytest.raises(ValueError):
            piece_bpe.serialise(ranks)


def brute(docs, plain):
    out = []
    for r in docs.collect():
        text = r.text or ""
        ids = plain.encode_ordinary(text)
        out.append((r.doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


def query(spark, docs, tmp_path):
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = piece_bpe.op13_byte_bpe(spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    return sorted(map(tuple, got.collect()), key=str)


def test_edges(spark, tmp_path, plain):
    docs = edge_docs(spark, [(20 + i, t, None, "s", 1) for i, t in enumerate(ODD)])
    assert query(spark, docs, tmp_path) == brute(docs, plain)


def test_empty(spark, tmp_path):
    assert query(spark, no_docs(spark), tmp_path) == []


def test_null_ids_stay_null(spark):
    rows = spark.createDataFrame([(1, None), (2, [])], "id long, ids array<int>")
    assert sorted(map(tuple, piece_bpe.decode(rows).collect())) == [(1, None, None), (2, [], b"")]


def test_documents(spark, tmp_path, plain):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert query(spark, docs, tmp_path) == brute(docs, plain)
