import random
import re
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from cases import edge_docs, no_docs
from hypothesis import given, settings
from hypothesis import strategies as st
from sqlcheck import equals_sql

from clonelens.llm import collocations

COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def brute(rows, min_count=100, longest=5, covered=100, best=2000):
    """``rows`` of (lang, text)."""
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", low):
            ws = [w for w in re.split("[ \t]+", piece) if w]
            n[lang] += len(ws)
            for k in range(1, longest + 1):
                f[lang].update(tuple(ws[i : i + k]) for i in range(len(ws) - k + 1))
    out = []
    for lang, c in f.items():
        found = {g: a for g, a in c.items() if len(g) > 1 and a >= min_count}
        inside = lambda g, h: any(h[i : i + len(g)] == g for i in range(len(h) - len(g) + 1))
        kept = []
        for g, a in found.items():
            if any(len(h) > len(g) and 100 * b >= covered * a and inside(g, h) for h, b in found.items()):
                continue
            score, k = min((1000 * a * n[lang] // (c[g[:k]] * c[g[k:]]), k) for k in range(1, len(g)))
            kept.append((-score, -a, " ".join(g).encode(), c[g[:k]], c[g[k:]]))
        for i, (score, a, phrase, left, right) in enumerate(sorted(kept)[:best], 1):
            out.append((lang, i, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def docs_of(spark, rows):
    return edge_docs(spark, [(100 + i, text, lang, "s", 1) for i, (lang, text) in enumerate(rows)])


def run(docs, **kw):
    got = collocations.collocations(docs, **kw)
    assert got.columns == COLUMNS
    return sorted(map(tuple, got.collect()))


def some_rows(n=150, seed=3):
    rng = random.Random(seed)
    words = ["New", "york", "city", "hall", "a", "A", "é", "of", "the", "x\x00y", "\x1c"]
    gaps = [" ", " ", " ", "\t", "  ", ". ", ",", "\n", "\x0b", "\r\n", " ! "]
    out = []
    for _ in range(n):
        text = "".join(rng.choice(words) + rng.choice(gaps) for _ in range(rng.randrange(60)))
        out.append((rng.choice(["en", "en", "de", None, "und"]), text + rng.choice(["", "new york city hall of the x"])))
    return out


@pytest.mark.parametrize("kw", [{}, {"covered": 60}, {"longest": 3, "best": 7}, {"block_rows": 4}, {"block_bytes": 9, "block_rows": 7}])
def test_equals_brute_force(spark, kw):
    docs = docs_of(spark, some_rows())
    rows = [(r.lang, r.text) for r in docs.collect()]
    want = brute(rows, min_count=8, **{k: v for k, v in kw.items() if k[:5] != "block"})
    assert len(want) > 10
    assert run(docs, min_count=8, **kw) == want


def test_long_pieces_are_not_cut(spark, monkeypatch):
    monkeypatch.setattr(collocations, "ROW_IDS", 5)
    rows = [("en", "a b c d " * 200), ("en", "a b c d. " * 30)]
    docs = docs_of(spark, rows)
    assert run(docs, min_count=20) == brute([(r.lang, r.text) for r in docs.collect()], min_count=20)


def test_products_beyond_64_bits(spark):
    f, n = 4 * 10**12, 9 * 10**13
    row = spark.createDataFrame([(f, n, [f + 1], [f + 2])], "f long, n long, heads array<long>, tails array<long>")
    got = row.select(collocations.cut_scores(2).alias("c")).first().c
    assert got.score == 1000 * f * n // ((f + 1) * (f + 2))


@given(st.lists(st.integers(0, 3), max_size=60), st.integers(1, 9))
@settings(max_examples=200, deadline=None)
def test_squeezing_keeps_all_pairs(values, size):
    x = np.array([*values, 0], np.int64)
    pairs = lambda y: Counter(zip(y[collocations.neighbours(y)].tolist(), y[collocations.neighbours(y) + 1].tolist()))  # noqa: E731, B905
    y = collocations.squeezed(x)
    assert pairs(y) == pairs(x)
    lists = collocations._lists(y, size).to_pylist()
    assert [v for r in lists for v in r] == y.tolist()
    assert all(r[-1] == 0 for r in lists)


def test_empty(spark):
    assert run(no_docs(spark)) == []


def test_nothing_frequent(spark):
    assert run(edge_docs(spark), min_count=10**6) == []


def test_equals_sql(spark):
    equals_sql(spark, "op11_collocations")


def test_equals_sql_of_the_larger_table(spark):
    equals_sql(spark, "op11_collocations", "/root/testdata/sf0.01")


class Taken:
    """Stands for a frame, of which it keeps the function over batches."""

    columns, schema = ["prev"], []

    def mapInArrow(self, run, schema):
        self.run = run
        return self

    def groupBy(self, *_):
        return self

    def agg(self, *_):
        return self


def test_memory_of_a_task_does_not_grow_with_its_batch(spark):
    ids = np.random.default_rng(1).integers(1, 300, (1500, 4096))
    ids[:, -1] = 0
    batch = pa.RecordBatch.from_arrays([pa.FixedSizeListArray.from_arrays(pa.array(ids.ravel()), 4096).cast(pa.list_(pa.int64()))], ["prev"])
    frame = Taken()
    collocations.pair_counts(frame)
    tracemalloc.start()
    counts = sum(int(np.sum(b.column("n").to_numpy())) for b in frame.run([batch]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert counts == 1500 * 4094
    assert peak < 160e6  # 49 MB in the batch


def test_runs_hold_each_row_once(monkeypatch):
    monkeypatch.setattr(collocations, "PART_IDS", 10)
    monkeypatch.setattr(collocations, "PART_BYTES", 10)
    lists = [[1, 0]] * 7 + [[], [2] * 50 + [0], []] + [[3, 4, 0]] * 9
    texts = ["ab c"] * 7 + ["", "x" * 70, ""] + ["é"] * 9
    for name, rows, kind in (("prev", lists, pa.list_(pa.int64())), ("text", texts, pa.string())):
        batch = pa.RecordBatch.from_arrays([pa.array(rows, kind)], [name])
        runs = [r.column(name).to_pylist() for r in collocations._runs(batch, name)]
        assert [x for r in runs for x in r] == rows and len(runs) > 3
        assert list(collocations._runs(batch.slice(0, 0), name))[0].num_rows == 0


def test_short_runs_give_the_same(spark, monkeypatch):
    rng = random.Random(4)
    rows = [(rng.choice(["a", None]), " ".join(rng.choice("abcde") for _ in range(30)) + "." + "x y z " * rng.randrange(3)) for _ in range(60)]
    docs = spark.createDataFrame(rows, "lang string, text string")
    kw = dict(min_count=5, block_rows=8)
    want = sorted(map(tuple, collocations.collocations(docs, **kw).select(*COLUMNS).collect()))
    monkeypatch.setattr(collocations, "PART_IDS", 40)
    monkeypatch.setattr(collocations, "PART_BYTES", 100)
    assert want and sorted(map(tuple, collocations.collocations(docs, **kw).select(*COLUMNS).collect())) == want
