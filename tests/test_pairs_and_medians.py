"""Tiled pairs, bit-parallel distances, median strings and nearest texts beside plain restatements."""

import itertools
import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clonelens.functions.editlanes import Lanes, edit_votes, edited
from clonelens.operators import cluster, median, refine, tiles

words = st.text(alphabet="abcé", max_size=9)


@given(words, st.lists(words, max_size=8))
@settings(max_examples=200, deadline=None)
def test_lanes(pattern, texts):
    assert Lanes(texts).distances(pattern).tolist() == [cluster.levenshtein(pattern, t) for t in texts]


def test_lanes_over_several_words():
    rng = random.Random(1)
    texts = ["".join(rng.choice("acgt") for _ in range(n)) for n in (0, 1, 63, 64, 65, 127, 128, 129, 200, 300)]
    lanes = Lanes(texts)
    for p in texts + [texts[-1][3:150] + "a" + texts[-1][160:]]:
        assert lanes.distances(p).tolist() == [cluster.levenshtein(p, t) for t in texts]


@given(words, st.lists(words, min_size=1, max_size=6))
@settings(max_examples=100, deadline=None)
def test_votes_are_the_texts_that_come_nearer(pattern, texts):
    votes = edit_votes(pattern, texts, np.ones(len(texts), np.int64))
    edits = [(k, i, c) for k in ("sub", "put") for i in range(len(pattern) + (k == "put")) for c in "abcé" if k == "put" or pattern[i] != c] + [("cut", i, "") for i in range(len(pattern))]
    for e in edits:
        nearer = sum(cluster.levenshtein(edited(pattern, *e), t) < cluster.levenshtein(pattern, t) for t in texts)
        assert votes.get(e, 0) == nearer


def cost(s, texts):
    return sum(cluster.levenshtein(s, t) for t in texts)


def test_median_equals_exhaustive_search_on_short_strings():
    rng = random.Random(5)
    every = ["".join(x) for n in range(6) for x in itertools.product("abc", repeat=n)]
    for _ in range(40):
        texts = ["".join(rng.choice("abc") for _ in range(rng.randrange(1, 5))) for _ in range(rng.randrange(3, 8))]
        found = cost(median.median_string(texts), texts)
        assert found <= min(cost(t, texts) for t in texts)
        assert found == min(cost(s, texts) for s in every)


def family(rng, n, length=14, changes=3, letters="ACDEFGHIKL"):
    centre = [rng.choice(letters) for _ in range(length)]
    out = []
    for _ in range(n):
        t = list(centre)
        for _ in range(min(len(t) - 1, rng.randrange(changes + 1))):
            k = rng.randrange(len(t))
            t[k : k + 1] = rng.choice([[], [rng.choice(letters)], [t[k], rng.choice(letters)]])
        out.append("".join(t))
    return "".join(centre), out


@pytest.mark.parametrize("block", [8, 64, 10_000])
def test_medians_of_a_dominant_cluster(spark, block):
    """One cluster with 90 % of the members, in blocks and in one: never worse than the medoid."""
    rng = random.Random(9)
    centre, large = family(rng, 180)
    rows = [(1, i, t) for i, t in enumerate(large)] + [(2 + i // 4, 1000 + i, t) for i, t in enumerate(family(rng, 20)[1])]
    df = spark.createDataFrame(rows, "cluster_id long, ordinal long, cdr3_aa string")
    got = {r.cluster_id: (r.centroid, r["size"]) for r in median.medians(df, size=block).collect()}
    assert set(got) == {r[0] for r in rows}
    for c, (m, size) in got.items():
        texts = [r[2] for r in rows if r[0] == c]
        assert size == len(texts) and cost(m, texts) <= min(cost(t, texts) for t in texts)
    assert got[1][0] == centre


def test_a_large_cluster_is_spread_over_tasks(spark):
    df = spark.range(20_000).select(F.lit(1).cast("long").alias("cluster_id"), F.col("id").alias("ordinal"), F.translate(F.substring(F.md5(F.col("id").cast("string")), 1, 9), "0123456789abcdef", "ACDEFGHIKLMNPQRS").alias("cdr3_aa"))
    blocks = tiles.dealt(df, "cluster_id", "ordinal").groupBy("block").count().collect()
    assert len(blocks) == 40 and max(r["count"] for r in blocks) < 2 * tiles.BLOCK


def skewed(spark):
    rng = random.Random(2)
    rows = []
    for c, n in ((1, 90), (2, 6), (3, 4), (4, 1)):
        for t in family(rng, n)[1]:
            rows.append((c, f"s{len(rows)}", len(rows), len(rows), f"V{rng.randrange(3)}", t))
    return rows, spark.createDataFrame(rows, "cluster_id long, id string, ordinal long, pos long, v_call string, cdr3_aa string")


def far(a, b):
    return (a[4] != b[4]) + cluster.levenshtein(a[5], b[5]) / 17


def distance():
    return (F.col("a.v_call") != F.col("b.v_call")).cast("int") + F.levenshtein("a.cdr3_aa", "b.cdr3_aa") / 17


@pytest.mark.parametrize("block", [5, 512])
def test_tiled_pairs_of_a_skewed_cluster(spark, block):
    rows, df = skewed(spark)
    got = {(r.cluster_id, r.id): (round(r.ai, 9), round(r.nearest, 9)) for r in refine.intra_distances(df, distance(), block).collect()}
    want = {}
    for a in rows:
        d = [far(a, b) for b in rows if b[0] == a[0] and b[1] != a[1]]
        want[a[0], a[1]] = (round(sum(d) / len(d), 9), round(min(d), 9)) if d else (0.0, 0.0)
    assert got == want
    medoid = {r.cluster_id: r.medoid for r in refine.set_medoid(df, block=block).collect()}
    for c, m in medoid.items():
        own = [r for r in rows if r[0] == c]
        assert m == min(own, key=lambda a: (cost(a[5], [r[5] for r in own]), a[2]))[5]


def test_each_pair_once_and_no_large_key(spark):
    rows, df = skewed(spark)
    met = tiles.pairs(df, "cluster_id", "id", 8)
    got = sorted(tuple(sorted((r[0], r[1]))) for r in met.select("a.id", "b.id").collect())
    assert got == sorted(tuple(sorted((a[1], b[1]))) for a, b in itertools.combinations(rows, 2) if a[0] == b[0])
    keys = met.groupBy("a.cluster_id", "a._lo", "a._hi").count().collect()
    assert len(keys) > 60 and max(r["count"] for r in keys) < 700


@pytest.mark.parametrize("size", [5, 512])
def test_pairs_across_linked_groups(spark, size):
    rows, df = skewed(spark)
    link = spark.createDataFrame([(1, 2), (2, 1), (3, 1), (4, 4)], "g long, h long")
    got = sorted(tuple(r) for r in tiles.across(df, df, link, "id", size).select("a.id", "b.id").collect())
    assert got == sorted((a[1], b[1]) for a in rows for b in rows if (a[0], b[0]) in {(1, 2), (2, 1), (3, 1), (4, 4)})


@given(st.text(alphabet="ab", max_size=12), st.text(alphabet="ab", max_size=12))
@settings(max_examples=300, deadline=None)
def test_segment_bound(a, b):
    """The places that ``probes`` looks at hold a whole segment of every text within the distance."""
    for most in (3, 4, 8):
        if cluster.levenshtein(a, b) > most or len(b) <= most:
            continue
        base, extra = divmod(len(b), most + 1)
        hit = False
        for i in range(most + 1):
            start, size = i * base + max(0, i - (most + 1 - extra)), base + (i >= most + 1 - extra)
            d = len(a) - len(b)
            places = range(max(0, start - i, start + d - (most - i)), min(len(a) - size, start + i, start + d + (most - i)) + 1)
            hit = hit or any(a[p : p + size] == b[start : start + size] for p in places)
        assert hit


@pytest.mark.parametrize("most", [2, 4, 8])
def test_candidates_hold_all_near_pairs(spark, most):
    rng = random.Random(most)
    texts = [t for _ in range(12) for t in family(rng, 8, rng.randrange(1, 16), 5, "ABCD")[1]]
    df = spark.createDataFrame(list(enumerate(texts)), "cluster_id long, t string")
    got = {(r.a_id, r.b_id) for r in refine.near_candidates(df, df, most).collect()}
    near = {(i, j) for i, a in enumerate(texts) for j, b in enumerate(texts) if i != j and cluster.levenshtein(a, b) <= most}
    assert near <= got


@pytest.mark.parametrize("few", [0, 2000])
@pytest.mark.parametrize("length,letters", [(12, "ABC"), (18, "ACDEFGHIKLMNPQRSTVWY"), (3, "AB")])
def test_nearest_texts_equal_brute_force(spark, length, letters, few):
    rng = random.Random(length)
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(length + 1))) for _ in range(70)]
    df = spark.createDataFrame(list(enumerate(texts)), "cluster_id long, centroid string")
    got = {r.cluster_id: (r.dist, r.neighbour) for r in refine.nearest_centroids(df, few).collect()}
    assert got == {i: min((cluster.levenshtein(t, o), j) for j, o in enumerate(texts) if j != i) for i, t in enumerate(texts)}


def test_few_of_many_pairs_are_compared(spark):
    rng = random.Random(4)
    texts = ["".join(rng.choice("ACDEFGHIKLMNPQRSTVWY") for _ in range(rng.randrange(10, 18))) for _ in range(3000)]
    df = spark.createDataFrame(list(enumerate(texts)), "cluster_id long, t string")
    assert refine.near_candidates(df, df, 4).count() < 0.01 * len(texts) ** 2


@pytest.mark.parametrize("held, side", [(512, 4096), (3, 6)])
def test_read_pairs_of_large_and_odd_reads(spark, monkeypatch, held, side):
    """A read with many copies, nulls, and two reads of one number, which are no pair by their order."""
    monkeypatch.setattr(refine, "READS", held)
    monkeypatch.setattr(refine, "SIDE", side)
    rows = [("V1", "J1", "CASSF", "acgt", i) for i in range(40)] + [(f"V{i % 3}", f"J{i % 2}", "CASS" + "AGH"[i % 3], "acg" + "tca"[i % 3], 100 + i) for i in range(12)]
    rows += [("V1", "J1", "CAF", "acgg", 7), (None, "J1", "CAF", "acgt", 200), ("V1", None, "CAF", "acgt", 201), ("V1", "J1", "CAF", None, 202)]
    reads = spark.createDataFrame(rows, "v_call string, j_call string, cdr3_aa string, j_nt string, ordinal long")
    longest = spark.createDataFrame([(5,)], "cdr3 int")
    got = refine.read_pairs(reads, longest, 6).collect()
    met = reads.alias("a").join(reads.alias("b"), (F.col("a.j_call") == F.col("b.j_call")) & (F.col("a.ordinal") < F.col("b.ordinal")))
    want = met.select("a.ordinal", "b.ordinal", F.round(refine.pair_distance("a", "b", F.lit(5)), 6)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, want), key=str)


def test_read_pairs_of_one_gene_are_dealt_to_all_tasks_in_runs(spark):
    """4000 reads of one J gene fit one tile of SIDE; a task's pairs come in runs of one earlier read."""
    reads = spark.range(4000).select(F.lit("V1").alias("v_call"), F.lit("J1").alias("j_call"), F.concat(F.lit("CA"), F.col("id") % 10).alias("cdr3_aa"), F.concat(F.lit("acg"), F.col("id") % 20).alias("j_nt"), F.col("id").alias("ordinal"))
    pairs = refine.read_pairs(reads, spark.createDataFrame([(3,)], "cdr3 int"), 6).withColumn("task", F.spark_partition_id())

    def shares(batches):
        for t in batches:
            a = t.column("a").to_numpy()
            yield pa.record_batch([pa.array([t.column("task")[0].as_py()], pa.int32()), pa.array([len(a)]), pa.array([int((a[1:] != a[:-1]).sum()) + 1])], ["task", "n", "runs"])

    got = pairs.mapInArrow(shares, "task int, n long, runs long").groupBy("task").agg(F.sum("n").alias("n"), F.sum("runs").alias("runs")).collect()
    assert sum(r.n for r in got) == 4000 * 3999 // 2
    assert max(r.n for r in got) < 0.5 * 4000 * 3999 / 2
    assert sum(r.runs for r in got) < 0.2 * sum(r.n for r in got)
