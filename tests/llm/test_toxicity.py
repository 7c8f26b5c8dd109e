import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from cases import edge_docs, no_docs
from pyspark.sql import functions as F

from clonelens.llm import strings as g
from clonelens.llm import toxicity as t

SF = "/root/testdata/sf0.1"


def brute_kernel(a, b):
    """Gap-weighted subsequences of three symbols within the span, by enumeration."""

    def phi(s):
        out = {}
        for i in range(len(s)):
            for j in range(i + 1, len(s)):
                for k in range(j + 1, min(len(s), i + g.SPAN)):
                    out[s[i], s[j], s[k]] = out.get((s[i], s[j], s[k]), 0) + g.DECAY ** (k - i + 1)
        return out

    x, y = phi(a), phi(b)
    dot = lambda u, v: sum(w * v.get(k, 0) for k, w in u.items())
    return dot(x, y) / max(1e-9, (dot(x, x) * dot(y, y)) ** 0.5)


UNITS = ["stupid", "stxupid", "s.t.u.p.i.d", "idiot", "banana", "aaaa", "ab", "a", "abc", "anaana", "дурак", "добро", "z" * 24]
LETTERS = ["^" + "".join(c for c in u if c.isalpha()) for u in UNITS]


def test_machine_equals_enumerated_kernel():
    """Folded weights and coordinates against kernel x root x weights."""
    m, owner = g.units_matrix(UNITS)
    assert owner.tolist() == list(range(len(UNITS))) and (g.as_matrix(g.as_text(m)) == m).all()
    few = [0, 3, 4, 10, 12]
    marks = g.Landmarks(m[few], 1e-2)
    kernel = np.array([[brute_kernel(a, LETTERS[k]) for k in few] for a in LETTERS])
    x = marks.features(m)
    assert np.allclose(x[:, :-1], kernel @ marks.root, atol=1e-4) and (x[:, -1] == 1).all()
    w = np.random.default_rng(0).normal(size=len(few))
    want = kernel @ marks.root @ w + 0.25
    some = [len(u) > 2 for u in LETTERS]
    assert np.allclose(g.margins(m, marks.fold(w), 0.25, -9)[some], want[some], atol=1e-3)
    codes, weights = g.subsequences(m)
    assert np.allclose(g.norms(codes, weights)[2], g.norms(codes, weights)[0])


def test_long_units_are_windowed_whole():
    word = "x" * 100 + "worthless" + "y" * 61
    m, owner = g.units_matrix([word, "", "ab"])
    assert set(owner.tolist()) == {0, 2}
    rows = ["".join(chr(97 - g.FIRST_LETTER + v) for v in r if v > g.START) for r in m[owner == 0]]
    joined = rows[0] + "".join(r[g.LONGEST - g.STRIDE :] for r in rows[1:])
    assert joined == word
    assert (m[:, 0] == g.START).sum() == 2


def test_symbols():
    text = lambda *w: g.as_text(g.units_matrix(list(w))[0])
    assert text("1d10t") == text("idiot") and text("$tup1d!") == text("stupid")
    assert text("ídìot")[1] == text("idiot")[0] != text("ídìot")[0]
    assert len(text("ídìot")) == 2 and len(g.units_matrix(["ídìot"], fold=False)[0]) == 1
    words = ["дурак", "добро", "хороший", "ηλίθιος", "καλός", "笨蛋", "你好", "바보", "안녕"]
    assert len({u for w in words for u in text(w)[:1]}) == len(words)


def test_units_of_rows():
    rows = ["Ab b ab", None, "", "s t u p i d one  ONE", "x\u2003y", " pad "]
    words, row, word = t.distinct_tokens(pa.array(rows).fill_null(""))
    got = [{words[w] for r, w in zip(row.tolist(), word.tolist(), strict=True) if r == k} for k in range(len(rows))]
    assert got == [{"ab", "b"}, set(), set(), {"s", "t", "u", "p", "i", "d", "one", "stupid"}, {"x", "y"}, {"pad"}]
    units, row, unit = t.units_of(pa.array(["one, two one", "two 2!"]))
    text = lambda w: g.as_text(g.units_matrix([w])[0])[0]
    assert {(r, units[u]) for r, u in zip(row.tolist(), unit.tolist(), strict=True)} == {(0, text("one")), (0, text("two")), (1, text("two")), (1, text("2"))}


def test_blanks_at_the_end_of_the_last_row(monkeypatch):
    """Whatever bytes lie behind an array's last row."""
    rows = [b"one two ", b" pad \xe2\x80\x83"]
    ends = pa.py_buffer(np.cumsum([0, *map(len, rows)]).astype(np.int32).tobytes())
    for behind in (b"\0", b" ", b"x", b"\xff", b"\xc3", b"\xe2\x80"):
        texts = pa.StringArray.from_buffers(len(rows), ends, pa.py_buffer(b"".join(rows) + behind * 32))
        monkeypatch.setattr(pc, "utf8_lower", lambda x: x)
        words, row, word = t.distinct_tokens(texts)
        assert sorted((r, words[w]) for r, w in zip(row.tolist(), word.tolist(), strict=True)) == [(0, "one"), (0, "two"), (1, "pad")]


def test_top_margins():
    weights = np.random.default_rng(1).normal(size=g.CODES).astype(np.float32)
    weights[0] = 0  # no subsequence
    model = t.Model(weights, 0.0, None, 0.0)
    rows = ["one two three four five five", "", "tie tie", "two " * 50_000 + "insult"]
    for texts in (rows, [rows[3]], rows[:2]):
        got = t.Scorer(model).top(pa.array(texts))
        for text, seen in zip(texts, got, strict=True):
            words = sorted(set(text.split()))
            best = sorted(np.maximum(model.margins(words), t.NONE).tolist(), reverse=True)[: t.TOP] if words else []
            assert np.allclose(seen, [*best, *[t.NONE] * (t.TOP - len(best)), np.log1p(len(words)) - 5], atol=1e-6)


def test_held_out_accuracy(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    model = t.train(docs, labels)
    y = {r.doc_id: r.toxic for r in labels.collect()}
    rows = [(r.doc_id, r.score) for r in t.score_rows(docs, model, ("doc_id",)).collect()]
    assert len(rows) == docs.count() and all(0 <= s <= 1 for _, s in rows)
    out = [(s, y[i]) for i, s in rows if i in y and zlib.crc32(str(i).encode()) % 5 == 0]
    pos, neg = [s for s, v in out if v], [s for s, v in out if not v]
    auc = np.mean([(p > n) + (p == n) / 2 for p in pos for n in neg])
    assert len(pos) > 50 and auc > 0.97 and sum(n >= 0.5 for n in neg) <= 0.01 * len(neg)
    assert sum(p >= 0.5 for p in pos) >= 0.9 * len(pos)
    margins = dict(zip(["stupid", "stuxpid", "st*pid", "s.t.u.p.i.d", "stone"], model.margins(["stupid", "stuxpid", "st*pid", "s.t.u.p.i.d", "stone"]), strict=True))
    assert margins["s.t.u.p.i.d"] == margins["stupid"] > margins["stuxpid"] > margins["stone"] and margins["st*pid"] > margins["stone"]


def test_edges(spark):
    docs = edge_docs(spark)
    labels = spark.createDataFrame([(1, 1, 1), (3, 0, 0), (4, 0, None), (8, 0, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")
    model = t.train(docs, labels)
    rows = t.score_rows(docs, model, ("doc_id",)).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    alone = t.train(docs, labels.where("toxic = 0"))
    assert {r.score for r in t.score_rows(docs, alone, ("doc_id",)).collect()} == {0.0}
    assert t.score_rows(no_docs(spark), model, ("doc_id",)).count() == 0
    assert t.train(no_docs(spark), labels.limit(0)).prior == 0.0


def test_query(spark):
    from clonelens.llm import queries

    small = "/root/testdata/sf0.001"
    rows = queries.queries()["op1_toxicity"](spark, small).collect()
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id").collect())
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)


def test_violators_are_found_to_the_last(spark, monkeypatch):
    """However few join the solver at once, the next pass finds the rest."""
    monkeypatch.setattr(t, "WORST", 3)
    names = g.as_text(g.units_matrix([f"word{chr(97 + i)}{chr(98 + i)}" for i in range(11)])[0])
    units = spark.createDataFrame([(u, 1, True) for u in names], "unit string, c long, can boolean")
    state, known = (np.zeros(g.CODES, np.float32), 0.5), {}
    while more := t._violators(units, state, known):
        assert not known.keys() & more.keys()
        known |= more
    assert known.keys() == set(names)


def test_altered_spellings_are_found(spark):
    """Held-out toxic texts whose insults have a letter put in, left out or doubled, by their scores."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{n}.parquet") for n in ("documents", "labels"))
    model = t.train(docs, labels)
    held = docs.join(labels, "doc_id").where(F.crc32(F.col("doc_id").cast("string")) % 5 == 0).select("text", "toxic").collect()
    scorer = t.Scorer(model)
    scores = lambda texts: model.score(scorer.top(pa.array(texts, pa.string())))
    toxic, clean = ([r.text or "" for r in held if r.toxic == y] for y in (1, 0))
    assert (scores(toxic) >= 0.5).mean() >= 0.9 and (scores(clean) >= 0.5).mean() <= 0.01
    words = sorted({w for x in toxic for w in x.split()})
    insults = {w for w, f in zip(words, model.margins([w.lower() for w in words]), strict=True) if f > 0}
    half = lambda w: len(w) // 2
    changes = [lambda w: w[: half(w)] + "x" + w[half(w) :], lambda w: w[: half(w)] + w[half(w) + 1 :], lambda w: w[: half(w)] + w[half(w)] + w[half(w) :], ".".join, " ".join, lambda w: w[: half(w)] + "*" + w[half(w) :]]
    for change in changes:
        texts = ["".join(change(p) if p in insults else p for p in re.split(r"(\s+)", x)) for x in toxic]
        assert (scores(texts) >= 0.5).mean() >= 0.75
