"""Progressive alignment and spanning trees in blocks beside plain restatements."""

import itertools
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from clonelens.operators import progressive as p
from clonelens.operators import spanning
from clonelens.operators.lineage_rows import star_align


def pair_score(a, b):
    """One pair of rows, column by column."""
    score, last = 0, ""
    for x, y in zip(a, b, strict=True):
        if x == y == "-":
            continue
        state = "a" if x == "-" else "b" if y == "-" else "m"
        if state == "m":
            score += p.MATCH if x == y else p.MISMATCH
        else:
            score += p.EXTEND + (p.OPEN if state != last else 0)
        last = state
    return score


def total(rows):
    return sum(pair_score(a, b) for a, b in itertools.combinations(rows, 2))


texts = st.lists(st.text(alphabet="acgt", min_size=1, max_size=12), min_size=1, max_size=6)


@given(st.lists(st.text(alphabet="ac-", min_size=7, max_size=7), min_size=2, max_size=5))
@settings(max_examples=150, deadline=None)
def test_sum_of_pairs(rows):
    assert p.sum_of_pairs(p.as_rows(rows)) == total(rows)


@given(texts)
@settings(max_examples=100, deadline=None)
def test_alignment_keeps_texts_and_is_never_below_the_star(given_):
    rows = p.align(given_)
    assert [r.replace("-", "") for r in rows] == given_
    assert len({len(r) for r in rows}) == 1
    order = list(dict.fromkeys(given_))
    if len(order) > 1:
        assert total(p.align(order)) >= total(star_align(order[0], order[1:]))


def optimum(a, b, c):
    """The best of all alignments of three texts, by enumeration."""
    best = [-(10**9)]

    def grow(i, j, k, rows):
        if (i, j, k) == (len(a), len(b), len(c)):
            best[0] = max(best[0], total(["".join(r) for r in rows]))
            return
        for x, y, z in itertools.product((0, 1), repeat=3):
            if x + y + z and i + x <= len(a) and j + y <= len(b) and k + z <= len(c):
                grow(i + x, j + y, k + z, [[*rows[0], a[i] if x else "-"], [*rows[1], b[j] if y else "-"], [*rows[2], c[k] if z else "-"]])

    grow(0, 0, 0, [[], [], []])
    return best[0]


def test_three_short_texts_reach_the_optimum():
    rng = random.Random(3)
    hit = 0
    for _ in range(12):
        three = ["".join(rng.choice("acg") for _ in range(rng.randrange(1, 4))) for _ in range(3)]
        got, best = total(p.align(three)), optimum(*three)
        assert len(set(three)) < 3 or got <= best
        hit += len(set(three)) < 3 or got == best
    assert hit == 12


def test_two_texts_are_aligned_at_best():
    rng = random.Random(8)
    for _ in range(60):
        a, b = ("".join(rng.choice("acgt") for _ in range(rng.randrange(1, 9))) for _ in range(2))
        rows = p.align_profiles(p.as_rows([a]), p.as_rows([b]))
        got = total(p.as_texts(np.concatenate(rows)))

        def best(i, j, last, a=a, b=b, memo={}):  # noqa: B006
            key = (a, b, i, j, last)
            if key not in memo:
                options = []
                if i < len(a) and j < len(b):
                    options.append((p.MATCH if a[i] == b[j] else p.MISMATCH) + best(i + 1, j + 1, "m"))
                if i < len(a):
                    options.append(p.EXTEND + (p.OPEN if last != "b" else 0) + best(i + 1, j, "b"))
                if j < len(b):
                    options.append(p.EXTEND + (p.OPEN if last != "a" else 0) + best(i, j + 1, "a"))
                memo[key] = max(options, default=0)
            return memo[key]

        assert got == best(0, 0, "")


def family(rng, n, length=60):
    """Descendants of one text by changes, insertions and deletions of up to three letters."""
    out = ["".join(rng.choice("acgt") for _ in range(length))]
    for _ in range(n):
        t = list(rng.choice(out))
        for _ in range(rng.randrange(1, 4)):
            k = rng.randrange(len(t) - 4)
            t[k : k + rng.randrange(3)] = [rng.choice("acgt") for _ in range(rng.randrange(4))]
        out.append("".join(t))
    return out


def test_families_are_not_below_the_star():
    rng, better = random.Random(11), 0
    for _ in range(6):
        some = list(dict.fromkeys(family(rng, 12)))
        got, star = total(p.align(some)), total(star_align(some[0], some[1:]))
        assert got >= star
        better += got > star
    assert better >= 3


def test_guide_tree_joins_near_texts_first():
    merges = p.guide_tree(p.kmer_distances(["aaaaaaaa", "ccccccgc", "aaaaaata", "ccccccgg"]))
    assert [set(m) for m in merges[:2]] in ([{0, 2}, {1, 3}], [{1, 3}, {0, 2}]) and set(merges[2]) == {4, 5}


def plain_tree(rows):
    """Kruskal's pass over all pairs in the order of edges."""
    edges = sorted((sum(x != y for x, y in zip(s, t, strict=True)), -(m + n), min(i, j), max(i, j)) for (i, s, m), (j, t, n) in itertools.combinations(rows, 2))
    part, out = {i: i for i, _, _ in rows}, []
    for d, less, a, b in edges:
        if part[a] != part[b]:
            out.append((a, b, d, -less))
            old, new = part[a], part[b]
            part = {i: new if x == old else x for i, x in part.items()}
    return sorted(out)


@pytest.mark.parametrize("block", [4, 16, 1000])
def test_spanning_forest_equals_kruskal(spark, block):
    """One clone with most of the rows, one of a few, one of one row; blocks of any size give one tree."""
    rng = random.Random(6)
    clones = {1: 70, 2: 5, 3: 1, 4: 2}
    rows = []
    for clone, n in clones.items():
        centre = [rng.choice("acgt") for _ in range(20)]
        for i in range(n):
            t = list(centre)
            for _ in range(rng.randrange(5)):
                t[rng.randrange(20)] = rng.choice("acgt-")
            rows.append((clone, i, "".join(t), rng.randrange(1, 4)))
    df = spark.createDataFrame(rows, "clone long, node long, text string, abundance long")
    got = spanning.spanning_forest(df, block).collect()
    for clone in clones:
        want = plain_tree([(i, t, m) for c, i, t, m in rows if c == clone])
        assert sorted((r.a, r.b, r.dist, r.abundance) for r in got if r.clone == clone) == want


def test_no_rows(spark):
    df = spark.createDataFrame([], "clone long, node long, text string, abundance long")
    assert spanning.spanning_forest(df).collect() == []
