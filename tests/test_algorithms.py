import json
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clonelens.functions import distances as d
from clonelens.operators import cluster, lineage, quality, refine, seeds, simplify, treeops
from clonelens.operators.numbering import numbered
from clonelens.sources import airr, fasta, newick


def naive_consensus(texts):
    return "".join(max(cluster.LETTERS, key=lambda c: (sum(t[i] == c for t in texts), -cluster.LETTERS.index(c))) for i in range(len(texts[0])))


def naive_greedy(texts, th):
    out = []
    for k, t in enumerate(texts):
        scores = [sum(a == b for a, b in zip(naive_consensus([texts[m] for m in c]), t, strict=True)) / len(t) * 100 for c in out]
        if scores and max(scores) >= th:
            at = max(i for i, s in enumerate(scores) if s == max(scores))
            out.append([*out.pop(at), k])
        else:
            out.append([k])
    return out


@given(st.lists(st.text("ACD", min_size=4, max_size=4), min_size=1, max_size=25, unique=True), st.sampled_from([50.0, 70.0]))
@settings(max_examples=100, deadline=None)
def test_greedy_equals_plain_restatement(texts, th):
    assert cluster.greedy(texts, th) == naive_greedy(texts, th)


def test_chunks_meet_again(spark):
    for n in (250, 251, 500):
        rng = random.Random(n)
        seen = {}
        while len(seen) < n:
            t = list("ACDEFGHIKLMN")
            for i in rng.sample(range(12), 2):
                t[i] = rng.choice("ACDEFGHIKLMNPQRSTVWY")
            seen.setdefault("".join(t), len(seen))
        rows = [(f"s{i}", i, "IGHV1", "IGHJ1", t, 1) for t, i in seen.items()]
        df = spark.createDataFrame(rows, "sequence_id string, ordinal long, v_call string, j_call string, cdr3_aa string, occurrence int")
        out = cluster.cluster_reads(df).collect()
        texts = sorted(seen, key=seen.get)
        blocks = [(12, [texts[250 * b + m[0]] for m in cluster.greedy(texts[250 * b : 250 * b + 250], 70.0)]) for b in range(-(-n // 250))]
        assert len({r.cluster_id for r in out}) == len(plain_merge(blocks, 0, 70.0))
        assert len(out) == n


def plain_merge(blocks, tolerance, threshold):
    """blocks (length, seeds) in order -> merged clusters as lists of (block, number), seed by seed."""
    out = []
    for b, (length, names) in enumerate(blocks):
        before = [(m, blocks[m[0][0]][1][m[0][1]]) for m in out]
        for k, seed in enumerate(names):
            scores = [(cluster.similarity(seed, t), i) for i, (_, t) in enumerate(before) if abs(len(t) - length) <= tolerance]
            best = max(scores, default=(-1, -1))
            out[best[1]].append((b, k)) if best[0] >= threshold and best[1] >= 0 else out.append([(b, k)])
    return out


SEEDS = "number long, v_call string, j_call string, len int, first long, chunk long, text string"


def merged_seeds(spark, blocks, gene, threshold):
    names = [(b, k, t) for b, (_, seeds_) in enumerate(blocks) for k, t in enumerate(seeds_)]
    rows = [(i + 1, "V", gene, len(t), b, 0, t) for i, (b, _, t) in enumerate(names)]
    out = {}
    for r in sorted(seeds.owners(spark.createDataFrame(rows, SEEDS), threshold, "IGHJ6").collect()):
        out.setdefault(r.head, []).append(names[r.number - 1][:2])
    return [out[h] for h in sorted(out)]


def test_seeds_join_the_last_best_and_never_their_own_block(spark):
    blocks = [(4, ["AAAA", "CCCC"]), (4, ["AACC", "AACD"])]
    assert merged_seeds(spark, blocks, "IGHJ1", 50.0) == [[(0, 0), (1, 1)], [(0, 1), (1, 0)]]
    assert merged_seeds(spark, [(4, ["AAAA"]), (5, ["AAAAA"])], "IGHJ1", 70.0) == [[(0, 0)], [(1, 0)]]
    assert merged_seeds(spark, [(4, ["AAAA"]), (5, ["AAAAA"])], "IGHJ6", 70.0) == [[(0, 0), (1, 0)]]
    assert merged_seeds(spark, [(0, [""]), (1, ["A", "C"])], "IGHJ6", 70.0) == [[(0, 0)], [(1, 0)], [(1, 1)]]


@pytest.mark.parametrize("threshold", [50.0, 70.0, 90.0])
def test_seeds_by_index_equal_the_pass_seed_by_seed(spark, threshold):
    """Random and mutated seeds of many blocks, lengths apart by one meeting for the tolerant gene only."""
    rng = random.Random(int(threshold))
    bases = ["".join(rng.choices("ACDFG", k=13)) for _ in range(6)]
    for gene, tolerance in (("IGHJ1", 0), ("IGHJ6", 1)):
        blocks = []
        for _ in range(14):
            n, names = rng.choice([11, 12, 13]), set()
            for _ in range(8):
                t = list(rng.choice(bases))
                for i in rng.sample(range(13), rng.choice([0, 2, 4])):
                    t[i] = rng.choice("ACDFG")
                for _ in range(13 - n):
                    del t[rng.randrange(len(t))]
                names.add("".join(t))
            blocks.append((n, sorted(names)))
        seen, unique = set(), []
        for n, names in blocks:
            unique.append((n, [t for t in names if t not in seen]))
            seen |= set(names)
        got = merged_seeds(spark, unique, gene, threshold)
        assert got == plain_merge(unique, tolerance, threshold)
        assert any(len(m) > 1 for m in got)


def test_a_chain_of_seeds_is_decided_in_order(spark):
    """Each seed is like the one before it only, so every second one is a head."""
    rows = [(i, i - 1) for i in range(1, 9)]
    met = spark.createDataFrame(rows, "late long, early long")
    assert sorted(r.number for r in seeds.heads(met).collect()) == [0, 2, 4, 6, 8]


@given(st.text("ACGT", max_size=8), st.text("ACGT", max_size=8))
def test_levenshtein(a, b):
    from functools import cache

    @cache
    def lev(i, j):
        return max(i, j) if not i or not j else min(lev(i - 1, j) + 1, lev(i, j - 1) + 1, lev(i - 1, j - 1) + (a[i - 1] != b[j - 1]))

    assert cluster.levenshtein(a, b) == lev(len(a), len(b))


def test_python_and_column_similarity_agree(spark):
    rng = random.Random(5)
    rows = [("".join(rng.choices("ACDE", k=rng.randint(1, 9))), "".join(rng.choices("ACDE", k=rng.randint(1, 9)))) for _ in range(300)]
    got = spark.createDataFrame(rows, "a string, b string").select("a", "b", d.mixed_similarity("a", "b").alias("s")).collect()
    assert all(abs(r.s - cluster.similarity(r.a, r.b)) < 1e-9 for r in got)


@pytest.mark.parametrize("texts", [["CAST", "CAST", "CSST"], ["AB", "BA", "AA"], ["X"]])
def test_median_string_is_no_worse_than_the_medoid(texts):
    cost = lambda s: sum(cluster.levenshtein(s, t) for t in texts)
    assert cost(refine.median_string(texts)) <= min(map(cost, texts))


def test_first_matching(spark):
    rng = random.Random(2)
    pairs = [(rng.randrange(30), rng.randrange(30), r) for r in range(60)]
    pairs = [p for p in pairs if p[0] != p[1]]
    used, want = set(), []
    for a, b, r in pairs:
        if not {a, b} & used:
            used |= {a, b}
            want.append((a, b, r))
    got = refine.first_matching(spark.createDataFrame(pairs, "a long, b long, rank long"))
    assert sorted(map(tuple, got.collect())) == sorted(want)


MEMBERS = "cluster_id long, id string, pos long, ordinal long, v_call string, cdr3_aa string, j_nt string"


def test_refinement_stops_at_one_cluster(spark):
    rows = [(0, "a", 0, 0, "V", "CASSSSSF", "acgt"), (0, "b", 1, 1, "V", "CTTTTTTF", "acgt"), (1, "c", 0, 2, "V", "CASSSSTF", "acgt")]
    out = refine.refine(spark.createDataFrame(rows, MEMBERS)).collect()
    assert {r.cluster_id for r in out} == {1} and len(out) == 3


def test_singletons_join(spark):
    rows = [(0, f"a{i}", i, i, "V", "CASSSSSSSSSSSSS" + c, "acgt") for i, c in enumerate("FGH")] + [(1, "z", 0, 9, "V", "CASSSSSSSSSSSSSK", "acgt")]
    out = refine.refine(spark.createDataFrame(rows, MEMBERS), merge_singletons=True)
    assert out.select("cluster_id").distinct().count() == 1


def test_uniform_clusters_join(spark):
    rows = [(c, f"{c}{i}", i, 10 * c + i, "V", "CASSSSSSSSSSSSS" + x, "acgt") for c in (0, 1) for i, x in enumerate("FGH")]
    df = spark.createDataFrame(rows, MEMBERS)
    out = refine.merge_uniform(df, refine.pair_distance("a", "b", F.lit(16)))
    assert out.select("cluster_id").distinct().count() == 1


def test_uniform_clusters_of_other_lengths_stay(spark):
    rows = [(c, f"{c}{i}", i, 10 * c + i, "V", "CASSSSSSSSSSSSS" + x + "F" * c, "acgt") for c in (0, 1) for i, x in enumerate("FGH")]
    out = refine.merge_uniform(spark.createDataFrame(rows, MEMBERS), refine.pair_distance("a", "b", F.lit(17)))
    assert out.select("cluster_id").distinct().count() == 2


def part_distance(a, b, longest):
    return ((a[4] != b[4]) + cluster.levenshtein(a[5], b[5]) / longest + 1 - cluster.similarity(a[6], b[6]) / 100) / 3


def near_clusters(clusters):
    """Each cluster's nearest other one by centroid, the first of equal ones."""
    middle = {c: m[0][5] if len(m) < 3 else refine.median_string([r[5] for r in m]) for c, m in clusters.items()}
    return {c: min((o for o in sorted(middle) if o != c), key=lambda o: cluster.levenshtein(middle[c], middle[o])) for c in middle} if len(middle) > 1 else {}


def plain_refine(rows, rounds=11):
    """Refinement member by member and merge by merge, as a single pass over lists."""
    longest = max(len(r[5]) for r in rows)
    clusters = {}
    for r in sorted(rows, key=lambda r: (r[0], r[2])):
        clusters.setdefault(r[0], []).append(r)
    for _ in range(rounds):
        near, found = near_clusters(clusters), []
        for c in sorted(near):
            for r in clusters[c]:
                others = [part_distance(r, o, longest) for o in clusters[c] if o is not r]
                best = min(clusters[near[c]], key=lambda o: part_distance(r, o, longest))
                if others and part_distance(r, best, longest) < sum(others) / len(others) - 1e-12 and len(best[5]) == len(r[5]) and c not in found:
                    found.append(c)
        used = set()
        for c in found:
            if not {c, near[c]} & used:
                clusters[near[c]] += clusters.pop(c)
                used |= {c, near[c]}
        if not used:
            break
    return {r[1]: c for c, m in clusters.items() for r in m}


@pytest.mark.parametrize("seed", range(4))
def test_refinement_equals_plain_restatement(spark, seed):
    rng = random.Random(seed)
    bases = ["".join(rng.choices("ACDF", k=rng.choice([9, 9, 10]))) for _ in range(5)]
    rows = []
    for i in range(26):
        t = list(rng.choice(bases))
        for k in rng.sample(range(len(t)), rng.choice([0, 1, 1, 2])):
            t[k] = rng.choice("ACDF")
        rows.append((i % 7, f"s{i}", i, i, rng.choice(["V1", "V1", "V2"]), "".join(t), rng.choice(["acgt", "acgg"])))
    out = refine.refine(spark.createDataFrame(rows, MEMBERS)).collect()
    assert {r.id: r.cluster_id for r in out} == plain_refine(rows)


def test_later_rounds_measure_what_merges_touched(spark, monkeypatch):
    """Two clusters of one family are split apart among many others that stay as they are; each round equals one from scratch."""
    rng = random.Random(8)
    rows = []
    for c in range(12):
        base = rng.choices("ACDEFGHIKLMNPQRSTVWY", k=12)
        for i in range(4):
            t = list(base)
            t[i] = "A" if t[i] != "A" else "C"
            rows.append((c if c or i % 2 else 99, f"s{c}-{i}", len(rows), len(rows), "V1", "".join(t), "acgt"))
    rows.append((0, "far", len(rows), len(rows), "V2", rows[1][5][::-1], "ttgg"))
    measured, plain = [], refine.intra_distances
    monkeypatch.setattr(refine, "intra_distances", lambda m, *a: measured.append(m.select("cluster_id").distinct().count()) or plain(m, *a))
    out = refine.refine(spark.createDataFrame(rows, MEMBERS)).collect()
    assert {r.id: r.cluster_id for r in out} == plain_refine(rows)
    assert measured[0] == 13 and len(measured) > 1 and set(measured[1:]) == {1}


def test_renewed_neighbours_equal_a_search_from_scratch(spark):
    rng = random.Random(3)
    texts = {c: "".join(rng.choices("ACD", k=rng.choice([6, 7, 8]))) for c in range(40)}
    frame = lambda: spark.createDataFrame([(c, t, 1) for c, t in texts.items()], "cluster_id long, centroid string, size long")
    old = refine.nearest_centroids(frame())
    near = {r.cluster_id: r.neighbour for r in old.collect()}
    merged = [(c, near[c]) for c in (5, 17) if near[c] not in (5, 17)]
    for a, b in merged:
        del texts[a]
        texts[b] = "".join(rng.choices("ACD", k=7))
    changed = spark.createDataFrame([(b,) for _, b in merged], "cluster_id long").distinct()
    got = refine.renewed_neighbours(old, frame(), changed)
    assert merged and {r.cluster_id: (r.dist, r.neighbour) for r in got.collect()} == {i: min((cluster.levenshtein(t, o), j) for j, o in texts.items() if j != i) for i, t in texts.items()}


def test_merges_go_by_cluster_order(spark):
    pairs = spark.createDataFrame([(0, 7, 0), (3, 7, 3)], "a long, b long, rank long")
    assert [(r.a, r.b) for r in refine.first_matching(pairs).collect()] == [(0, 7)]


def test_lone_members_look_at_the_nearest_member(spark):
    """The neighbour's nearest member is as long as the lone one though a shorter member is there; a chain follows merges."""
    long = "CASSSSSSSSSSSSSSSSSSSSSS"
    rows = [(0, "a", 0, 0, "V", long + "FF", "acgt"), (0, "b", 1, 1, "V", long + "FG", "acgt"), (0, "c", 2, 2, "V", long + "F", "acgt"), (1, "x", 0, 3, "V", long + "GG", "acgt"), (2, "y", 0, 4, "V", long + "GGGG", "acgt")]
    out = refine.merge_lone(spark.createDataFrame(rows, MEMBERS), refine.pair_distance("a", "b", F.lit(28)))
    got = {r.id: r.cluster_id for r in out.collect()}
    assert got["x"] == 0 and got["y"] == 2


def test_nearest_centroids_equal_brute_force(spark):
    rng = random.Random(7)
    texts = list(dict.fromkeys("".join(rng.choices("ACD", k=rng.choice([3, 6, 7, 8, 14]))) for _ in range(60))) + ["ACDACD", "W" * 25]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "cluster_id long, centroid string")
    got = {r.cluster_id: (r.dist, r.neighbour) for r in refine.nearest_centroids(df).collect()}
    assert got == {i: min((cluster.levenshtein(t, o), j) for j, o in enumerate(texts) if j != i) for i, t in enumerate(texts)}
    assert refine.nearest_centroids(df.limit(1)).count() == 0


def test_weighted_distance(spark):
    one = spark.range(1).select(d.combined(F.lit(1.0), F.lit(0.5), F.lit(0.0), (1, 2, 1)).alias("w"), d.combined(F.lit(1.0), F.lit(0.5), F.lit(0.0)).alias("m")).first()
    assert (one.w, one.m) == (0.5, 0.5)


def test_embedding_distance(spark):
    vectors = {k: np.array(x) for k, x in d.amino_acid_vectors().items()}
    assert len(vectors) == 20 and all(len(x) == 16 for x in vectors.values())
    far = lambda a, b: np.linalg.norm(vectors[a] - vectors[b])
    assert far("I", "V") < far("I", "G") and far("F", "Y") < far("F", "P")

    def plain(t):
        out = np.zeros((6, 16))
        for i, c in enumerate(t):
            out[(len(t) - i) % 6] += vectors[c]
        return out

    rows = [("CASSF", "CASTF"), ("CASSLGQGYF", "CASF"), ("A", "A"), ("CAX", "CAS")]
    got = [r.x for r in spark.createDataFrame(rows, "a string, b string").coalesce(1).select(d.embedding_distance("a", "b").alias("x")).collect()]
    assert got[3] is None and np.allclose(got[:3], [np.sqrt(((plain(a) - plain(b)) ** 2).mean()) for a, b in rows[:3]])


@pytest.mark.parametrize("kinds", [("kmers", "kmers", "kmers"), ("levenshtein", "embedding", "binary"), ("embedding", "binary", "embedding")])
def test_kinds_of_distance(spark, kinds):
    cols = MEMBERS + ", v_nt string, v_aa string, j_aa string"
    rows = [(c, f"{c}{i}", i, 10 * c + i, "V", "CASSSSSS" + x + "F", "acgtacgt", "acgtacgtac", "CASS", "WGQG") for c in (0, 1) for i, x in enumerate("AGH")]
    out = refine.refine(spark.createDataFrame(rows, cols), kinds=refine.Distances(*kinds, (1, 1, 2)))
    assert out.count() == 6


def test_offsets_without_a_start(spark):
    from clonelens.functions import validators as v

    rows = spark.createDataFrame([(79, None), (79, 3), (None, 3)], "p int, s int").coalesce(1).select(v.region_offset("p", "s").alias("x")).collect()
    assert [r.x for r in rows] == [79, 77, -1]


def test_seeds_of_one_length_meet_as_in_one_group(spark):
    """The numbers are those of one pass over all blocks of a gene."""
    rng = random.Random(4)
    texts = list(dict.fromkeys("".join(rng.choices("AC", k=rng.choice([5, 6, 7]))) for _ in range(60)))
    for gene, tolerance in (("IGHJ1", 0), ("IGHJ6", 1)):
        rows = [(f"s{i}", i, "IGHV1", gene, t, 1) for i, t in enumerate(texts)]
        df = spark.createDataFrame(rows, "sequence_id string, ordinal long, v_call string, j_call string, cdr3_aa string, occurrence int")
        blocks, owners = [], []
        for n in dict.fromkeys(map(len, texts)):
            own = [t for t in texts if len(t) == n]
            for a in range(0, len(own), 20):
                groups = cluster.greedy(own[a : a + 20], 70.0)
                blocks.append((n, [own[a + g[0]] for g in groups]))
                owners.append([[own[a + k] for k in g] for g in groups])
        want = {}
        for m, members in enumerate(plain_merge(blocks, tolerance, 70.0)):
            want |= {t: m for b, k in members for t in owners[b][k]}
        got = {texts[int(r.sequence_id[1:])]: r.cluster_id for r in cluster.cluster_reads(df, size=20).collect()}
        assert got == want


def weight(edges):
    return sum(e[2] for e in edges)


@given(st.integers(2, 14), st.integers(0, 10**6))
@settings(max_examples=60, deadline=None)
def test_spanning_tree_laws(n, seed):
    rng = np.random.default_rng(seed)
    rows = ["".join(rng.choice(list("acgt"), 6)) for _ in range(n)]
    dist, ab = lineage.distance_matrix(rows), rng.integers(1, 9, n).tolist()
    edges = lineage.spanning_tree(dist, ab)
    assert sorted(c for _, c, _ in edges) == list(range(1, n))
    order = [0, *(rng.permutation(n - 1) + 1).tolist()]
    again = lineage.spanning_tree(dist[np.ix_(order, order)], [ab[i] for i in order])
    assert weight(edges) == weight(again) == weight(lineage.spanning_tree(dist, ab, by_abundance=False))
    grown = lineage.silent_nodes(edges, dist)
    assert sorted(c for _, c, _, s in grown if not s) == list(range(1, n))
    for name in {c for _, c, _, s in grown if s}:
        top = next(p for p, c, _, _ in grown if c == name)
        kids = [c for p, c, _, _ in grown if p == name]
        assert len(kids) > 1 and all(dist[kids[0], k] == dist[k, top] == dist[kids[0], top] for k in kids[1:])
    assert sorted(c for _, c, _ in lineage.trimmed(edges, dist)) == list(range(1, n))


def test_equidistant_sequences_get_a_silent_node():
    dist = np.array([[0, 1, 1, 3], [1, 0, 1, 3], [1, 1, 0, 3], [3, 3, 3, 0]])
    grown = lineage.silent_nodes([(0, 1, 1), (0, 2, 1), (0, 3, 3)], dist)
    assert (0, "ni1", 0, True) in grown and ("ni1", 1, 1, False) in grown and ("ni1", 2, 1, False) in grown and (0, 3, 3, False) in grown


@given(st.text("acgt", min_size=1, max_size=12), st.lists(st.text("acgt", min_size=1, max_size=12), max_size=4))
@settings(max_examples=80, deadline=None)
def test_star_alignment(centre, texts):
    rows = lineage.star_align(centre, texts)
    assert len({len(r) for r in rows}) == 1
    assert [r.replace("-", "") for r in rows] == [centre, *texts]


def star(n):
    return simplify.Tree("germline", [("germline", f"s{i}", False) for i in range(n)], {"germline": 1} | {f"s{i}": 1000 if i == 0 else 1 for i in range(n)})


def chain(n):
    names = ["germline", *(f"s{i}" for i in range(n))]
    return simplify.Tree("germline", [(a, b, False) for a, b in zip(names, names[1:], strict=False)], dict.fromkeys(names, 1))


def test_simplifications():
    for tree in (star(40), chain(40)):
        one = simplify.simplify_by_share(tree)
        assert simplify.most_abundant(tree) <= set(one.nodes()) <= set(tree.nodes())
        two = simplify.simplify_by_count(one, lambda a, b: 1)
        assert len(two.nodes()) + 1 <= 30 or all(two.reads(x) / 40 >= 0.01 or x in simplify.most_abundant(one) for x in two.leaves())
    assert len(simplify.simplify_by_share(star(40)).nodes()) == 30
    for n in (16, 21, 29, 30, 31):
        assert len(simplify.simplify_by_share(star(n - 1)).nodes()) == min(n, 30)
    assert set(simplify.simplify_by_share(star(3)).nodes()) == {"germline", "s0", "s1", "s2"}


def test_tidy():
    t = simplify.Tree("g", [("g", "n1", True), ("n1", "a", False), ("g", "n2", True), ("g", "n3", True), ("n3", "b", False), ("n3", "c", False)], {})
    assert simplify.tidy(t).edges() == [("g", "a"), ("g", "n3"), ("n3", "b"), ("n3", "c")] or set(simplify.tidy(t).edges()) == {("g", "a"), ("g", "n3"), ("n3", "b"), ("n3", "c")}


def test_lineages_skip(spark):
    cols = "clone_rank int, name string, reads long, whole_seq string, germline string, subclone_rank int"
    rows = [(1, "C1-1", 5, "acgt", "acgt", 1), (2, "C2-1", 5, "acgt", None, 1), (2, "C2-2", 5, "acgg", None, 2), (3, "C3-1", 4, "acgt", "acga", 1), (3, "C3-2", 3, "acgg", "acga", 2)]
    out = lineage.lineages(spark.createDataFrame(rows, cols)).collect()
    assert {r.clone_rank for r in out} == {3} and {r.complexity for r in out} == {"all", "simplification1", "simplification2"}


def test_deep_chain(spark):
    edges = spark.createDataFrame([("t", None if i == 0 else i - 1, i, 1) for i in range(300)], "tree string, parent long, child long, dist int")
    assert {r.node: r.depth for r in treeops.depths(edges).collect()} == {i: i for i in range(1, 300)}


@given(st.recursive(st.just(None), lambda x: st.lists(x, min_size=1, max_size=4), max_leaves=15))
def test_newick(shape):
    children, count = {}, [0]

    def grow(s):
        count[0] += 1
        me = f"x{count[0]}"
        if s:
            children[me] = [grow(k) for k in s]
        return me

    root = grow(shape)
    lengths = {k: 2.5 for kids in children.values() for k in kids}
    got_root, edges = newick.loads(newick.dumps(root, children, lengths))
    assert got_root == root and sorted(edges) == sorted((p, k, 2.5) for p, kids in children.items() for k in kids)


def test_aligned_columns_clamp(spark):
    r = spark.createDataFrame([("ac--gt", [1, 3, 99])], "a string, p array<int>").select(d.aligned_columns("a", "p").alias("x")).first()
    assert r.x == [1, 5, 6]


def test_numbered(spark):
    df = spark.range(1000).select((F.col("id") * 37 % 1000).alias("k"))
    assert all(r.number == r.k + 1 for r in numbered(df, [F.col("k")]).collect())


def test_fasta(spark, tmp_path):
    (tmp_path / "x.fa").write_text(">a@3\nACG\nT\n>b\nGG\n>a@2\nTTTT\n")
    got = {r.id: (r.sequence, r.abundance) for r in fasta.read_fasta(spark, str(tmp_path / "x.fa")).collect()}
    assert got == {"a": ("ACGT", 5), "b": ("GG", 1)}
    fasta.write_fasta(spark.createDataFrame([("a", "AC", 2)], "name string, sequence string, abundance int"), str(tmp_path / "out"))
    assert fasta.read_fasta(spark, str(tmp_path / "out" / "*.txt")).first().sequence == "AC"


def test_fasta_folded_by_name(spark):
    rows = [("a", 1, "ACG", 0), ("x germline", 1, "GG", 1), ("b", 1, "ACG", 2), ("c", 1, "TT", 3)]
    folded, names = fasta.fold_named(spark.createDataFrame(rows, "id string, abundance long, sequence string, ordinal long"))
    assert sorted((r.id, r.sequence) for r in folded.collect()) == [("germline", "GG"), ("seq1", "ACG"), ("seq2", "TT")]
    assert sorted(r.line for r in names.collect()) == ["germline\tx germline", "seq1\ta,b", "seq2\tc"]


def test_regions_by_aligned_column(spark):
    from clonelens.operators import export

    row = "ac--gt-a"
    at = [1, 2, 3, None, 4, 5, 99, 1, 2, 3, 4, 5]
    plain = [1, 2, 3, 3, 4, 5, 99, 1, 2, 3, 4, 5]
    got = spark.createDataFrame([(row, plain)], "a string, p array<int>").select(d.aligned_columns("a", "p").alias("x")).first().x
    assert export.regions_in(row, at) == {k: [got[i], got[j]] for k, (i, j) in export.REGIONS.items()}


def test_statistics_equal_the_parts(spark):
    """One pass gives what the rejected reads of ``split_reads`` sum up to."""
    rng = random.Random(3)
    rows = [(f"s{i}", i, rng.randint(1, 4), rng.random() < 0.7, rng.random() < 0.7, rng.random() < 0.7, f"q{rng.randrange(30)}") for i in range(200)]
    rows = [(*r[:4], r[3] or r[4], *r[5:]) for r in rows]
    df = spark.createDataFrame(rows, "sequence_id string, ordinal long, occurrence long, cluster_ok boolean, tree_ok boolean, quality_ok boolean, whole_seq string")
    for least in (0, 3, 6):
        s, (_, rejected) = quality.filter_statistics(df, least).first(), quality.split_reads(df, least)
        bad = [(r.occurrence, [not r.cluster_ok, not r.tree_ok, not r.quality_ok, not r.minimum_ok]) for r in rejected.collect()]
        assert [s.cluster_failed, s.tree_failed, s.quality_failed, s.minimum_failed] == [sum(n for n, f in bad if f[k]) for k in range(4)]
        assert [s.failed_one, s.failed_two, s.failed_three, s.failed_four] == [sum(n for n, f in bad if sum(f) == k) for k in (1, 2, 3, 4)]
        assert s.filtered == sum(n for n, f in bad if not (f[1] and sum(f) == 1)) and s.total == sum(r[2] for r in rows)
    empty = quality.filter_statistics(df.limit(0), 1).first()
    assert empty.total == empty.filtered == 0


def test_statistics_of_the_known_log(spark):
    """The published example: 21 filtered reads are 4 of poor quality, 2 without annotation, and 15 with both faults."""
    rows = [("p", 4, True, True, False), ("m", 2, False, False, True), ("b", 15, False, False, False), ("g", 4978, True, True, True)]
    df = spark.createDataFrame([(n, i, o, c, t, q, n) for i, (n, o, c, t, q) in enumerate(rows)], "sequence_id string, ordinal long, occurrence long, cluster_ok boolean, tree_ok boolean, quality_ok boolean, whole_seq string")
    accepted, _ = quality.split_reads(df, 0)
    s = quality.filter_statistics(df, 0).first()
    assert (s.total, s.analysed, s.filtered) == (4999, 4978, 21)
    assert (s.cluster_failed, s.tree_failed, s.quality_failed) == (17, 17, 19)
    assert (s.failed_one, s.failed_two, s.failed_three, s.failed_four) == (4, 2, 15, 0)
    assert accepted.count() == 1


def test_minimum_reads():
    assert quality.minimum_reads(1000, 0.5, "percentage") == 5 and quality.minimum_reads(1000, 2, "percentage") == 1
    assert quality.minimum_reads(100, 3, "number") == 3 and quality.minimum_reads(4, 3, "number") == 1


def table(n=60):
    rng = random.Random(1)
    head = [*airr.CLUSTER, *airr.GERMLINE, *airr.REGIONS, *airr.INTEGERS, *airr.FLOATS]
    head = list(dict.fromkeys(head))
    lines = ["\t".join(head)]
    germ = "acgtacgtacgtacgtacgtacgtacgt"
    for i in range(n):
        family = i % 3
        seq = list(germ)
        for k in rng.sample(range(28), i % 4):
            seq[k] = rng.choice("acgt")
        seq = "".join(seq)
        cdr3 = "CASSLGQGYEQYF"[: 10 + family] + "FY"[i // 3 % 2]  # two sub-clones a clone
        row = dict.fromkeys(head, "1") | {"sequence_id": f"read{i}", "sequence": seq, "productive": "T", "v_call": f"Homsap IGHV{family + 1}-1*01 F", "j_call": "Homsap IGHJ4*02 F", "cdr3_aa": cdr3}
        row |= {f"{g}_sequence_alignment": seq[:12] for g in "vdj"} | {f"{g}_germline_alignment": germ[:10] for g in "vdj"} | {f"{g}_sequence_alignment_aa": "CAS" for g in "vdj"}
        row |= {r: seq[4 * k : 4 * k + 4] for k, r in enumerate(airr.REGIONS)} | {"np1": "ac", "np2": "gt"} | {c: "97.5" for c in airr.FLOATS}
        if i == 5:
            row["cdr3_aa"] = ""
        lines.append("\t".join(row[c] for c in head))
    lines.append(lines[1].replace("read0", "again0"))
    return "\n".join(lines) + "\n"


def test_whole_analysis(spark, tmp_path):
    from clonelens.plans.analysis import Settings, run

    (tmp_path / "reads.tsv").write_text(table())
    r = run(spark, str(tmp_path / "reads.tsv"), str(tmp_path / "out"), Settings(threshold=0, kind="number"), "reads")
    s = r.statistics.first()
    assert s.total == 61 and s.cluster_failed == 1 and s.analysed == 60
    assert r.ranks.agg(F.sum("reads")).first()[0] == s.analysed
    assert r.ranks.select("cluster_id").distinct().count() == 3
    trees = spark.read.json(str(tmp_path / "out" / "reads_trees"))
    for row in trees.collect():
        tree = json.loads(row.json)
        assert tree["name"] == "HAUS" and set(tree) == {"name", "value", "color", "stroke", "style", "seq", "uniq_seq", "aligned_seq", "region", "children"}
        todo = tree["children"]
        while todo:
            x = todo.pop()
            todo += x.get("children", [])
            if x["style"] != "2,2":
                assert set(x) - {"children"} == {"name", "value", "reads", "ab", "ab_rep", "functionality", "cdr3", "seq", "v_identity", "d_identity", "j_identity", "uniq_seq", "color", "stroke", "style", "aligned_seq", "region", "length"}
                assert set(x["region"]) == {"V_region", "D_region", "J_region", "CDR1", "CDR2", "CDR3"} and float(x["length"]) >= 0
    for row in spark.read.json(str(tmp_path / "out" / "reads_newick")).collect():
        assert newick.loads(row.newick)[0] == lineage.GERMLINE
    import zipfile

    from clonelens.plans.analysis import bundle

    bundle(r, str(tmp_path / "x.zip"), "reads")
    with zipfile.ZipFile(tmp_path / "x.zip") as z:
        names = set(z.namelist())
        assert {"reads_repertoire.json", "reads_tree_all.json", "reads_log.json", "reads_C1_HAUS_sequence.fasta"} <= names
        whole = json.loads(z.read("reads_repertoire.json"))
    assert whole["reads"]["analysed"] == 60 and len(whole["children"]) == 3
    assert list(whole) == ["name", "value", "reads", "color", "stroke", "style", "children"]
    for clone in whole["children"]:
        assert {"name", "value", "reads", "ab", "idV", "idJ", "cdr3", "functionality", "color", "stroke", "style", "children"} == set(clone)
        assert sum(x["reads"] for x in clone["children"]) == clone["reads"]
        for x in clone["children"]:
            assert sum(u["reads"] for u in x["uniq_seq"]) == x["reads"] and x["sequence"] and x["germline"] and len(x["region"]) == 6
    with pytest.raises(FileExistsError):
        run(spark, str(tmp_path / "reads.tsv"), str(tmp_path / "out"))
    with pytest.raises(FileNotFoundError):
        run(spark, str(tmp_path / "no.tsv"), str(tmp_path / "new"))


def test_missing_columns(spark, tmp_path):
    (tmp_path / "x.tsv").write_text("sequence_id\tsequence\na\tac\n")
    with pytest.raises(ValueError, match="cdr3_aa"):
        airr.read_lines(spark, str(tmp_path / "x.tsv"))


def test_arguments():
    from clonelens.cli import arguments

    assert arguments(["a.tsv", "out", "1", "number"]).threshold == 1
    assert arguments(["a.tsv", "out", "1", "number", "--weights", "1,2,1"]).weights == (1, 2, 1)
    for bad in (["--weights", "1,x,1"], ["--weights", "1,2"], ["--distances", "binary,kmers"], ["--distances", "similarity,kmers,kmers"]):
        with pytest.raises(SystemExit):
            arguments(["a.tsv", "out", "1", "number", *bad])
    with pytest.raises(SystemExit):
        arguments(["a.csv", "out", "1", "number"])
