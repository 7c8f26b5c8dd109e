"""Lineage trees of the most abundant clones: alignment to the germline, distances, spanning tree, silent nodes.

A clone has at most some hundred sub-clones, so one clone is one group of a grouped function."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from .lineage_rows import star_align
from .progressive import align
from .simplify import Tree, simplify_by_count, simplify_by_share, tidy

GERMLINE = "germline"


def distance_matrix(aligned: list[str]) -> np.ndarray:
    """Different characters of each pair of equally long rows; a gap against a base counts, a gap against a gap does not."""
    m = np.frombuffer("".join(aligned).encode("ascii", "replace"), np.uint8).reshape(len(aligned), -1)
    return np.stack([(m != row).sum(1) for row in m])


def spanning_tree(d: np.ndarray, abundance: list[int], by_abundance: bool = True) -> list[tuple[int, int, int]]:
    """Edges (parent, child, distance) from node 0: the nearest unvisited node next; among equal distances the pair of the
    largest summed abundance, then the earliest visited parent, then the smallest child."""
    n = len(d)
    order, left, edges = [0], list(range(1, n)), []
    ab = np.asarray(abundance)
    while left:
        sub = d[np.ix_(order, left)]
        i, j = np.nonzero(sub == sub.min())
        k = int(np.argmax(ab[np.asarray(order)[i]] + ab[np.asarray(left)[j]])) if by_abundance else 0
        parent, child = order[i[k]], left[j[k]]
        edges.append((parent, child, int(sub.min())))
        order.append(child)
        left.remove(child)
    return edges


def silent_nodes(edges: list[tuple[int, int, int]], d: np.ndarray) -> list[tuple[object, object, int, bool]]:
    """Siblings that are as near to each other as to their parent hang below a common silent node: (parent, child, distance, silent)."""
    children: dict[int, list[int]] = {}
    for p, c, _ in edges:
        children.setdefault(p, []).append(c)
    out: list[tuple[object, object, int, bool]] = []
    count, stack = 1, [0]
    while stack:
        p = stack.pop()
        placed: set[int] = set()
        own = children.get(p, [])
        for k in own:
            if k in placed:
                continue
            near = [i for i in own if i != k and i not in placed and d[k, i] <= d[k, p] and d[k, i] <= d[i, p]]
            if near:
                name = f"ni{count}"
                count += 1
                out.append((p, name, 0, True))
                out += [(name, i, int(d[i, p]), False) for i in (k, *near)]
                placed |= {k, *near}
            else:
                out.append((p, k, int(d[k, p]), False))
                placed.add(k)
        stack += reversed(own)
    return out


def trimmed(edges: list[tuple[int, int, int]], d: np.ndarray) -> list[tuple[int, int, int]]:
    """From the leaves up, a node that is no farther from its grandparent than from its parent hangs there."""
    up = {c: p for p, c, _ in edges}
    for _, c, _ in reversed(edges):
        p = up[c]
        if p in up and d[c, up[p]] <= d[c, p]:
            up[c] = up[p]
    return [(up[c], c, int(d[c, up[c]])) for _, c, _ in edges]


SCHEMA = "clone_rank int, complexity string, parent string, child string, dist int, silent boolean, abundance long, aligned string"


def lineages(subs: DataFrame, trim: bool = False, nodes: int = 30, share: float = 0.01, by_abundance: bool = True, star: bool = False) -> DataFrame:
    """subs (clone_rank, name, reads, whole_seq, germline, subclone_rank) -> tree edges of three complexities.

    ``germline`` is the clone's chosen one; without ``by_abundance`` the first of equally near nodes is taken. Sequences are aligned
    progressively, or with ``star`` each to the germline only, which suits clones of many hundred sub-clones. A clone of one sub-clone or without a germline has no tree."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("subclone_rank", kind="stable")
        germ = next((g for g in pdf.germline if g), None)
        cols = [x.split()[0] for x in SCHEMA.split(", ")]
        if len(pdf) < 2 or not germ:
            kinds = {"int": "int32", "long": "int64", "boolean": "bool", "string": "object"}
            return pd.DataFrame({x.split()[0]: pd.Series([], dtype=kinds[x.split()[1]]) for x in SCHEMA.split(", ")})
        names, reads = [GERMLINE, *pdf.name], [1, *(int(x) for x in pdf.reads)]
        texts = [germ.upper(), *(s.upper() for s in pdf.whole_seq)]
        rows = star_align(texts[0], texts[1:]) if star else align(texts)
        d = distance_matrix(rows)
        edges = spanning_tree(d, reads, by_abundance)
        if trim:
            edges = trimmed(edges, d)
        label = lambda x: names[x] if isinstance(x, int) else x
        grown = silent_nodes(edges, d)
        tree = Tree(GERMLINE, [(label(p), label(c), s) for p, c, _, s in grown], dict(zip(names, reads, strict=True)))
        lengths = {(label(p), label(c)): k for p, c, k, _ in grown}
        at = dict(zip(names, range(len(names)), strict=True))
        far = lambda a, b: int(d[at[a], at[b]])
        one = simplify_by_share(tree, nodes, share)
        two = simplify_by_count(one, far, nodes, share)
        out = []
        for kind, t in (("all", tree), ("simplification1", tidy(one)), ("simplification2", tidy(two))):
            out.append((kind, None, GERMLINE, 0, False))
            out += [(kind, p, c, lengths.get((p, c), 0 if c in t.silent or p in t.silent else far(p, c)), c in t.silent) for p, c in t.edges()]
        table = pd.DataFrame(out, columns=["complexity", "parent", "child", "dist", "silent"])
        table["clone_rank"] = int(pdf.clone_rank.iloc[0])
        table["abundance"] = [0 if s else reads[at[c]] for c, s in zip(table.child, table.silent, strict=True)]
        table["aligned"] = [None if s else rows[at[c]] for c, s in zip(table.child, table.silent, strict=True)]
        return table[cols]

    return subs.groupBy("clone_rank").applyInPandas(run, SCHEMA)
