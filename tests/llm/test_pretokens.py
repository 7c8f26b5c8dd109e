import time

import numpy as np
import pyarrow as pa
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from clonelens.llm import piece_bpe, pretokens

PATH, PATTERN = piece_bpe.defaults(None, None)
SPLIT = regex.compile(PATTERN)
TEXTS = st.one_of(st.text(max_size=40), st.text(alphabet=" \n\t'stmdrevl1é.　\xa0́½x中\U0001f600\x1c\x85", max_size=40))


def cut(texts):
    parts = [t.encode() for t in texts]
    data, offsets = np.frombuffer(b"".join(parts), np.uint8), np.cumsum([0, *map(len, parts)])
    at = [*pretokens.starts(data, offsets).tolist(), len(data)]
    return [data[a:b].tobytes().decode() for a, b in zip(at, at[1:])]


def test_pattern_is_the_public_one():
    assert pretokens.BYTE_PATTERN == PATTERN


@given(st.lists(TEXTS, max_size=6))
@settings(max_examples=500, deadline=None)
def test_equals_pattern(texts):
    assert cut(texts) == [w for t in texts for w in SPLIT.findall(t)]


@pytest.mark.parametrize("texts", [["'", "s"], ["x'l", "l"], ["a ", "b"], [" ", "'s"], ["", "'", "", "t"], ["x's't'll 's  's\n's''s"], []])
def test_texts_do_not_run_into_each_other(texts):
    assert cut(texts) == [w for t in texts for w in SPLIT.findall(t)]


def test_every_character():
    every = [chr(c) for c in [*range(0xD800), *range(0xE000, 0x110000)]]
    text = "a".join(every) + " " + " ".join(every)
    assert cut([text]) == SPLIT.findall(text)


@given(TEXTS, st.integers(1, 9))
@settings(max_examples=300, deadline=None)
def test_windows(text, size):
    data = np.frombuffer(text.encode(), np.uint8)
    parts = [data[a:b].tobytes().decode() for a, b in pretokens.windows(data, size)]
    assert "".join(parts) == text
    assert [w for p in parts for w in SPLIT.findall(p)] == SPLIT.findall(text)


def test_windows_keep_to_their_size():
    data = np.frombuffer(b"four five " * 100, np.uint8)
    assert max(b - a for a, b in pretokens.windows(data, 50)) <= 50


def test_long_text_in_windows(monkeypatch):
    c = piece_bpe.coder(PATH, PATTERN)
    text = "don't 12 \n\n x  é中, we'll " * 40
    whole = c.encode(text).tolist()
    monkeypatch.setattr(piece_bpe, "BATCH_BYTES", 16)
    monkeypatch.setattr(piece_bpe, "PORTION", 3)
    assert c.encode(text).tolist() == whole


def test_other_patterns(monkeypatch):
    """Also such as leave characters out."""
    pattern, texts = r"\w+|[.,]", ["One, two.  Three's", "", "é!", "four"]
    c = piece_bpe.Coder(piece_bpe.read_ranks(PATH), pattern)
    own = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=c.ranks, special_tokens={})
    want = [own.encode_ordinary(t) for t in texts]
    ids, counts = c.encode_many(texts)
    assert (ids.tolist(), counts.tolist()) == ([i for w in want for i in w], [*map(len, want)])
    assert [c.encode(t).tolist() for t in texts] == want


def test_decoded_slices():
    c = piece_bpe.coder(PATH, PATTERN)
    rows = [[1, 2], None, [], [300, 5, 49_000], [7]]
    want = [None if r is None else b"".join(c.table[i].as_py() for i in r) for r in rows]
    lists = pa.array(rows, pa.list_(pa.int32()))
    for a in range(5):
        for n in range(6 - a):
            assert c.decode_many(lists.slice(a, n)).to_pylist() == want[a : a + n]
    with pytest.raises(ValueError):
        c.decode_many(pa.array([[1, None]], pa.list_(pa.int32())))
    with pytest.raises(IndexError):
        c.decode([len(c.ranks)])


def test_words_do_not_pass_through_python_one_by_one():
    """Encoding texts of few different words takes less than half of the time that the pattern alone needs to list their words."""
    c = piece_bpe.coder(PATH, PATTERN)
    texts = ["Some plain words, don't they, of 12 or 345 people in a naïve street.\n" * 40] * 500

    def seconds(work):
        took = []
        for _ in range(3):
            t = time.process_time()
            work()
            took.append(time.process_time() - t)
        return min(took)

    assert seconds(lambda: c.encode_many(texts)) < 0.5 * seconds(lambda: [SPLIT.findall(t) for t in texts])
