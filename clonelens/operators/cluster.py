"""Clones from CDR3s: greedy consensus clustering in blocks, then merging of blocks by seeds.

Greedy steps depend on order, which ``ordinal`` fixes. They run as grouped functions on bounded groups: at most CHUNK
distinct CDR3s of one (v, j, length). Their seeds then meet through an index of segments (``seeds``), in no group."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import seeds
from .blocking import CHUNK, chunked, distinct_cdr3
from .checkpoints import checkpointed
from .numbering import numbered

# The order in which equally frequent letters are preferred; the gap comes last.
LETTERS = "ACDEFGHIKLMNPQRSTVWY*.X-"


def consensus_columns(rows: DataFrame, group: list[str], text: str) -> DataFrame:
    """(group, consensus): at each place the most frequent letter, ties to the first in LETTERS; counted, never gathered."""
    cells = rows.select(*group, F.posexplode(F.split(text, "")).alias("pos", "letter")).groupBy(*group, "pos", "letter").agg(F.count("*").alias("n"))
    best = cells.groupBy(*group, "pos").agg(F.max_by("letter", F.struct(F.col("n"), -F.instr(F.lit(LETTERS), F.col("letter")))).alias("letter"))
    ordered = F.array_sort(F.collect_list(F.struct("pos", "letter")))
    return best.groupBy(*group).agg(F.array_join(F.transform(ordered, lambda x: x["letter"]), "").alias("consensus"))


def greedy(texts: list[str], threshold: float) -> list[list[int]]:
    """Clusters (lists of indices) of equal-length texts, as the order of the texts has it.

    A text joins the cluster whose current consensus it matches best (the last of equal ones) if that is at least
    ``threshold`` percent; the cluster then moves to the end of the list. Otherwise it opens a cluster at the end."""
    code = {c: k for k, c in enumerate(LETTERS)}
    n = len(texts[0]) if texts else 0
    clusters: list[tuple[list[int], np.ndarray]] = []
    for k, t in enumerate(texts):
        row = np.array([code[c] for c in t], np.int64)
        best, at = -1.0, -1
        for c, (_, counts) in enumerate(clusters):
            score = float((counts.argmax(1) == row).sum()) / n * 100 if n else 100.0
            if score >= best:
                best, at = score, c
        if at < 0 or best < threshold:
            counts = np.zeros((n, len(LETTERS)), np.int64)
            members = [k]
        else:
            members, counts = clusters.pop(at)
            members.append(k)
        counts[np.arange(n), row] += 1
        clusters.append((members, counts))
    return [m for m, _ in clusters]


def levenshtein(a: str, b: str) -> int:
    if len(a) < len(b):
        a, b = b, a
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def similarity(a: str, b: str) -> float:
    """The mixed similarity of ``functions.distances`` for plain strings."""
    share = lambda x, y, n: sum(p == q for p, q in zip(x, y, strict=False)) / n * 100
    if len(a) == len(b):
        return share(a, b, len(a)) if a else 100.0
    n = min(len(a), len(b))
    if not n:
        return 0.0
    return max(round(share(a, b, n)), round(share(a[-n:], b[-n:], n)), round((1 - levenshtein(a, b) / ((len(a) + len(b)) / 2)) * 100))


def pre_cluster(cdr3s: DataFrame, threshold: float = 70.0, size: int = CHUNK) -> DataFrame:
    """Distinct CDR3s -> (v_call, j_call, len, chunk, cluster, pos, cdr3_aa, ordinal)."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("ordinal", kind="stable").reset_index(drop=True)
        rows = [(c, p, k) for c, members in enumerate(greedy(pdf.cdr3_aa.tolist(), threshold)) for p, k in enumerate(members)]
        out = pdf.loc[[k for _, _, k in rows], ["v_call", "j_call", "len", "chunk", "cdr3_aa", "ordinal"]].reset_index(drop=True)
        return out.assign(cluster=[c for c, _, _ in rows], pos=[p for _, p, _ in rows])

    schema = "v_call string, j_call string, len int, chunk long, cdr3_aa string, ordinal long, cluster int, pos int"
    return chunked(cdr3s, size).select("v_call", "j_call", "len", "chunk", "cdr3_aa", "ordinal").groupBy("v_call", "j_call", "len", "chunk").applyInPandas(run, schema)


def merge_blocks(pre: DataFrame, threshold: float = 70.0, tolerant: str = "IGHJ6") -> DataFrame:
    """(v, j, len, chunk, cluster) -> the number of the seed that it is merged into and its own, which is its place there.

    Only seeds of the clusters meet, those of the tolerant gene also where lengths differ by one, in the order of the first
    read of a length, then of chunks and clusters."""
    first = F.min("ordinal").over(Window.partitionBy("v_call", "j_call", "len"))
    firsts = pre.withColumn("first", first).where("pos = 0").select("v_call", "j_call", "len", "first", "chunk", "cluster", F.col("cdr3_aa").alias("text"))
    order = [F.col(c) for c in ("v_call", "j_call", "first", "chunk", "cluster")]
    named = checkpointed(numbered(firsts, order))
    return named.join(seeds.owners(named, threshold, tolerant), "number").select("v_call", "j_call", "len", "chunk", "cluster", F.col("head").alias("merged"), F.col("number").alias("place"))


def cluster_reads(reads: DataFrame, threshold: float = 70.0, tolerant: str = "IGHJ6", size: int = CHUNK) -> DataFrame:
    """(cluster_id, sequence_id, pos): clusters numbered from 0 by the first read of their genes, then by order of creation."""
    pre = checkpointed(pre_cluster(distinct_cdr3(reads), threshold, size))
    merged = merge_blocks(pre, threshold, tolerant)
    placed = pre.join(merged, ["v_call", "j_call", "len", "chunk", "cluster"])
    members = placed.select("v_call", "j_call", "cdr3_aa", "merged", "place", F.col("pos").alias("inside"))
    rows = reads.select("sequence_id", "ordinal", "v_call", "j_call", "cdr3_aa").join(members, ["v_call", "j_call", "cdr3_aa"])
    genes = reads.groupBy("v_call", "j_call").agg(F.min("ordinal").alias("gene_first"))
    clusters = numbered(members.select("v_call", "j_call", "merged").distinct().join(genes, ["v_call", "j_call"]), [F.col(c) for c in ("gene_first", "v_call", "j_call", "merged")])
    rows = rows.join(clusters.select("v_call", "j_call", "merged", (F.col("number") - 1).alias("cluster_id")), ["v_call", "j_call", "merged"])
    pos = F.row_number().over(Window.partitionBy("cluster_id").orderBy("place", "inside", "ordinal")) - 1
    return rows.select("cluster_id", "sequence_id", pos.cast("long").alias("pos"))
