"""Progressive multiple alignment: a guide tree from shared k-mers, profiles aligned up the tree, one by one realigned.

A pair of rows scores MATCH or MISMATCH where both have a letter, and OPEN + EXTEND * length for each run of columns in
which one of them has a gap, columns without a letter of either left out. The score of an alignment is the sum over all
pairs of rows. Two profiles are aligned for the largest sum over their cross pairs by dynamic programming with affine gaps;
whether a gap goes on from an older one is seen for the new gaps only, so profiles are judged a little too strictly and the
sum of pairs decides at the end."""

from __future__ import annotations

import numpy as np

from .lineage_rows import star_align

MATCH, MISMATCH, OPEN, EXTEND = 2, -1, -2, -1
K = 3
GAP = ord("-")
_LOW = np.int64(-(1 << 40))


def kmer_distances(texts: list[str], k: int = K) -> np.ndarray:
    """1 less the shared k-mers over those of the shorter text, occurrences counted."""
    names: dict[str, int] = {}
    rows = [[names.setdefault(t[i : i + k], len(names)) for i in range(len(t) - k + 1)] for t in texts]
    counts = np.zeros((len(texts), max(1, len(names))), np.int32)
    for r, found in zip(counts, rows, strict=True):
        np.add.at(r, found, 1)
    shared = np.stack([np.minimum(counts, r).sum(1) for r in counts])
    least = np.minimum.outer(counts.sum(1), counts.sum(1))
    return 1 - shared / np.maximum(least, 1)


def guide_tree(d: np.ndarray) -> list[tuple[int, int]]:
    """Merges by average distance, the nearest pair first: (a, b) are joined to node len(d), len(d) + 1, ... in turn."""
    n = len(d)
    d = d.astype(float).copy()
    np.fill_diagonal(d, np.inf)
    node, size, merges = list(range(n)), np.ones(n), []
    for step in range(n - 1):
        i, j = sorted(divmod(int(np.argmin(d)), n))
        merges.append((node[i], node[j]))
        mean = (size[i] * d[i] + size[j] * d[j]) / (size[i] + size[j])
        mean[[i, j]] = np.inf
        # The joined node stands in place of the first; infinite rows are gone.
        mean[np.isinf(d[i]) | np.isinf(d[j])] = np.inf
        d[i], d[:, i] = mean, mean
        d[j], d[:, j] = np.inf, np.inf
        size[i] += size[j]
        node[i] = n + step
    return merges


def _counts(rows: np.ndarray, letters: np.ndarray) -> np.ndarray:
    """(column, letter): how many rows have the letter."""
    return (rows[:, :, None] == letters).sum(0).astype(np.int64)


def align_profiles(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows of both with gap columns put in; diagonal steps first among equals, then gaps in ``b``."""
    letters = np.unique(np.concatenate([a.ravel(), b.ravel()]))
    letters = letters[letters != GAP]
    x, y = _counts(a, letters), _counts(b, letters)
    full_x, full_y = x.sum(1), y.sum(1)
    # Letters against letters, and against gaps that stand in the columns already.
    pair = MATCH * (x @ y.T) + MISMATCH * (np.outer(full_x, full_y) - x @ y.T)
    pair = pair + EXTEND * (np.outer(full_x, len(b) - full_y) + np.outer(len(a) - full_x, full_y))
    n, m = len(full_x), len(full_y)
    open_x, open_y = OPEN * len(b) * full_x, OPEN * len(a) * full_y
    more_x, more_y = EXTEND * len(b) * full_x, EXTEND * len(a) * full_y
    met, in_b, in_a = (np.full((n + 1, m + 1), _LOW) for _ in range(3))
    met[0, 0] = 0
    total = np.concatenate([[0], np.cumsum(more_y)])

    def along(i: int) -> None:
        """Gaps in ``a`` of any length at the end of row i: the best start of one less what lies before it."""
        start = np.maximum(met[i], in_b[i])[:-1] + open_y - total[:-1]
        in_a[i, 1:] = np.maximum.accumulate(start) + total[1:]

    if m:
        along(0)
    for i in range(1, n + 1):
        best = np.maximum(np.maximum(met[i - 1], in_b[i - 1]), in_a[i - 1])
        met[i, 1:] = best[:-1] + pair[i - 1]
        in_b[i] = np.maximum(np.maximum(met[i - 1], in_a[i - 1]) + open_x[i - 1], in_b[i - 1]) + more_x[i - 1]
        if m:
            along(i)
    steps, i, j = [], n, m
    kind = int(np.argmax([met[n, m], in_b[n, m], in_a[n, m]]))
    while i or j:
        steps.append(kind)
        if kind == 0:
            i, j = i - 1, j - 1
            kind = int(np.argmax([met[i, j], in_b[i, j], in_a[i, j]]))
        elif kind == 1:
            i -= 1
            left = in_b[i + 1, j] - more_x[i]
            kind = next(k for k, v in ((1, in_b[i, j]), (0, met[i, j] + open_x[i]), (2, in_a[i, j] + open_x[i])) if v == left)
        else:
            j -= 1
            left = in_a[i, j + 1] - more_y[j]
            kind = next(k for k, v in ((2, in_a[i, j]), (0, met[i, j] + open_y[j]), (1, in_b[i, j] + open_y[j])) if v == left)
    steps = np.array(steps[::-1], np.int64)

    def spread(rows: np.ndarray, missing: int) -> np.ndarray:
        out = np.full((len(rows), len(steps)), GAP, rows.dtype)
        out[:, steps != missing] = rows
        return out

    return spread(a, 2), spread(b, 1)


def scores_with(rows: np.ndarray, k: int) -> np.ndarray:
    """The pair score of row ``k`` with each row (0 with itself)."""
    one = rows[k]
    gap, own = rows == GAP, one == GAP
    both = ~gap & ~own
    out = MATCH * (both & (rows == one)).sum(1) + MISMATCH * (both & (rows != one)).sum(1)
    state = np.where(gap & ~own, 1, np.where(~gap & own, 2, np.where(both, 3, 0)))
    out = out + EXTEND * ((state == 1) | (state == 2)).sum(1)
    # Columns without a letter of either are passed over: each takes the state before it.
    at = np.maximum.accumulate(np.where(state > 0, np.arange(rows.shape[1]), -1), axis=1)
    before = np.concatenate([np.full((len(rows), 1), -1), at[:, :-1]], axis=1)
    last = np.where(before >= 0, np.take_along_axis(state, np.maximum(before, 0), 1), 0)
    for kind in (1, 2):
        out = out + OPEN * ((state == kind) & (last != kind)).sum(1)
    out[k] = 0
    return out


def sum_of_pairs(rows: np.ndarray) -> int:
    return int(sum(scores_with(rows, k).sum() for k in range(len(rows)))) // 2


def as_rows(texts: list[str]) -> np.ndarray:
    return np.array([[ord(c) for c in t] for t in texts], np.int32).reshape(len(texts), -1)


def as_texts(rows: np.ndarray) -> list[str]:
    return ["".join(map(chr, r)) for r in rows.tolist()]


def progressive(texts: list[str]) -> np.ndarray:
    """Rows aligned up the guide tree, in the order of ``texts``."""
    parts = {i: ([i], as_rows([t])) for i, t in enumerate(texts)}
    for step, (i, j) in enumerate(guide_tree(kmer_distances(texts))):
        (of_i, a), (of_j, b) = parts.pop(i), parts.pop(j)
        a, b = (a, b) if a.shape == b.shape and np.array_equal(a[:1], b[:1]) and len(a) == len(b) == 1 else align_profiles(a, b)
        parts[len(texts) + step] = of_i + of_j, np.concatenate([a, b])
    ((order, rows),) = parts.values()
    out = np.empty_like(rows)
    out[order] = rows
    return out


def refined(rows: np.ndarray, rounds: int = 1) -> np.ndarray:
    """Each row taken out and aligned to the others anew, kept where its score with them rises."""
    for _ in range(rounds):
        better = False
        for k in range(len(rows)):
            others = np.delete(rows, k, 0)
            one, rest = rows[k : k + 1, rows[k] != GAP], others[:, (others != GAP).any(0)]
            a, b = align_profiles(rest, one)
            new = np.insert(a, k, b[0], axis=0)
            if scores_with(new, k).sum() > scores_with(rows, k).sum():
                rows, better = new, True
        if not better:
            break
    return rows


def align(texts: list[str], rounds: int = 2) -> list[str]:
    """``texts`` aligned, the better by sum of pairs of the progressive alignment and of the star around the first text, both refined."""
    if len(set(texts)) < 2:
        return list(texts)
    # Texts that repeat are aligned once; a pair of equal rows has the same score wherever their gaps are.
    order = list(dict.fromkeys(texts))
    star = as_rows(star_align(order[0], order[1:]))
    best = max((refined(progressive(order), rounds), refined(star, rounds), star), key=sum_of_pairs)
    best = best[:, (best != GAP).any(0)]
    row = dict(zip(order, as_texts(best), strict=True))
    return [row[t] for t in texts]
