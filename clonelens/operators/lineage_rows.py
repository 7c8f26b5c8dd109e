"""Pairwise alignment, and the star around one text."""

from __future__ import annotations

import numpy as np


def align_pair(a: str, b: str, match: int = 2, mismatch: int = -1, gap: int = -2) -> tuple[str, str]:
    """Global alignment; among equal scores diagonal steps come first, then gaps in ``b``."""
    n, m = len(a), len(b)
    if n == m and a == b:
        return a, b
    x, y = np.frombuffer(a.encode("ascii", "replace"), np.uint8), np.frombuffer(b.encode("ascii", "replace"), np.uint8)
    score = np.zeros((n + 1, m + 1), np.int32)
    score[0], score[:, 0] = np.arange(m + 1) * gap, np.arange(n + 1) * gap
    run = np.arange(m + 1) * gap
    for i in range(1, n + 1):
        diag = score[i - 1, :-1] + np.where(y == x[i - 1], match, mismatch)
        row = np.concatenate([[score[i, 0]], np.maximum(diag, score[i - 1, 1:] + gap)])
        # A gap in ``a`` of any length: running maximum of scores freed from the gap costs along the row.
        score[i] = np.maximum.accumulate(row - run) + run
    out, i, j = [], n, m
    while i or j:
        if i and j and score[i, j] == score[i - 1, j - 1] + (match if x[i - 1] == y[j - 1] else mismatch):
            out.append((a[i - 1], b[j - 1]))
            i, j = i - 1, j - 1
        elif i and score[i, j] == score[i - 1, j] + gap:
            out.append((a[i - 1], "-"))
            i -= 1
        else:
            out.append(("-", b[j - 1]))
            j -= 1
    return "".join(p for p, _ in reversed(out)), "".join(q for _, q in reversed(out))


def star_align(centre: str, texts: list[str]) -> list[str]:
    """All texts aligned to ``centre`` (first of the result), pairwise alignments put together: once a gap, always a gap."""
    pairs = [align_pair(centre, t) for t in texts]
    room = np.zeros(len(centre) + 1, np.int64)
    for c, _ in pairs:
        k, run = 0, 0
        for ch in c:
            if ch == "-":
                run += 1
            else:
                room[k] = max(room[k], run)
                k, run = k + 1, 0
        room[k] = max(room[k], run)

    def spread(c: str, t: str) -> str:
        out, k, part = [], 0, []
        for ch, v in zip(c, t, strict=True):
            if ch == "-":
                part.append(v)
            else:
                out.append("".join(part).rjust(room[k], "-") + v)
                k, part = k + 1, []
        return "".join(out) + "".join(part).ljust(room[k], "-")

    return [spread(centre, centre), *(spread(c, t) for c, t in pairs)]
