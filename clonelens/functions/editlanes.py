"""Edit distances of one text to many at once in NumPy: bit-parallel columns, a lane for each text."""

from __future__ import annotations

import numpy as np

_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)
_ONE = np.uint64(1)
_TOP = np.uint64(63)


class Lanes:
    """Many texts, prepared for distances to any number of patterns."""

    def __init__(self, texts: list[str]):
        self.letters = {c: i for i, c in enumerate(sorted({c for t in texts for c in t}))}
        self.length = np.fromiter(map(len, texts), np.int64, len(texts))
        # Lanes by falling length: at each step those still running stand in front.
        self.order = np.argsort(-self.length, kind="stable")
        self.codes = np.zeros((int(self.length.max(initial=0)), len(texts)), np.int32)
        for lane, k in enumerate(self.order.tolist()):
            self.codes[: len(texts[k]), lane] = [self.letters[c] for c in texts[k]]
        running = self.length[self.order]
        self.running = [int((running > j).sum()) for j in range(len(self.codes))]

    def distances(self, pattern: str) -> np.ndarray:
        """The edit distance of ``pattern`` to each text, by Myers' column steps over words of 64 rows."""
        m = len(pattern)
        if not m:
            return self.length.copy()
        words = -(-m // 64)
        equal = np.zeros((words, len(self.letters) + 1), np.uint64)
        for i, c in enumerate(pattern):
            if c in self.letters:
                equal[i // 64, self.letters[c]] |= _ONE << np.uint64(i % 64)
        n = len(self.length)
        up, down = np.full((words, n), _ALL), np.zeros((words, n), np.uint64)
        score = np.full(n, m, np.int64)
        last = np.uint64((m - 1) % 64)
        for j, k in enumerate(self.running):
            carry = np.zeros(k, np.uint64)
            into_up, into_down = np.ones(k, np.uint64), np.zeros(k, np.uint64)
            for w in range(words):
                pv, mv = up[w, :k], down[w, :k]
                eq = equal[w, self.codes[j, :k]]
                xv = eq | mv
                eq = eq | into_down
                low = eq & pv
                total = low + pv
                over = total < low
                total = total + carry
                carry = (over | (total < carry)).astype(np.uint64)
                xh = (total ^ pv) | eq
                ph, mh = mv | ~(xh | pv), pv & xh
                if w == words - 1:
                    score[:k] += ((ph >> last) & _ONE).astype(np.int64) - ((mh >> last) & _ONE).astype(np.int64)
                next_up, next_down = ph >> _TOP, mh >> _TOP
                ph, mh = (ph << _ONE) | into_up, (mh << _ONE) | into_down
                up[w, :k], down[w, :k] = mh | ~(xv | ph), ph & xv
                into_up, into_down = next_up, next_down
        out = np.empty(n, np.int64)
        out[self.order] = score
        return out


def _tables(pattern: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """(lane, i, j): the distance of the first i symbols of ``pattern`` to the first j of each row of ``texts``."""
    n, width = texts.shape
    out = np.zeros((n, len(pattern) + 1, width + 1), np.int32)
    step = np.arange(width + 1)
    out[:, 0] = step
    for i, c in enumerate(pattern.tolist(), 1):
        row = out[:, i]
        row[:, 0] = i
        row[:, 1:] = np.minimum(out[:, i - 1, 1:] + 1, out[:, i - 1, :-1] + (texts != c))
        row[:] = np.minimum.accumulate(row - step, axis=1) + step
    return out


CELLS = 4_000_000


def edit_votes(pattern: str, texts: list[str], weights: np.ndarray) -> dict[tuple[str, int, str], int]:
    """Weight of the texts that each single edit of ``pattern`` brings nearer: (kind, place, letter).

    An edit brings a text nearer just if it lies on one of its shortest paths, so edits that are not listed bring none."""
    found: dict[tuple[str, int, str], int] = {}
    p = np.array([ord(c) for c in pattern], np.int64)
    by_length: dict[int, list[int]] = {}
    for k, t in enumerate(texts):
        by_length.setdefault(len(t), []).append(k)
    for width, every in by_length.items():
        room = max(1, CELLS // ((len(p) + 1) * (width + 1)))
        for a in range(0, len(every), room):
            some = every[a : a + room]
            t = np.array([[ord(c) for c in texts[k]] for k in some], np.int64).reshape(len(some), width)
            w = weights[some]
            ahead, behind = _tables(p, t), _tables(p[::-1], t[:, ::-1])[:, ::-1, ::-1]
            least = ahead[:, -1:, -1:] - 1

            def vote(kind: str, mask: np.ndarray, lettered: bool, t=t, w=w) -> None:
                lane, i, j = np.nonzero(mask)
                letter = t[lane, j] if lettered else np.zeros(len(lane), np.int64)
                key = np.unique((lane * (len(p) + 1) + i) * (1 << 21) + letter)
                place, lanes = (key >> 21) % (len(p) + 1), (key >> 21) // (len(p) + 1)
                for q, c, v in zip(place.tolist(), (key & ((1 << 21) - 1)).tolist(), w[lanes].tolist(), strict=True):
                    name = (kind, q, chr(c) if lettered else "")
                    found[name] = found.get(name, 0) + int(v)

            vote("sub", (ahead[:, :-1, :-1] + behind[:, 1:, 1:] == least) & (p[None, :, None] != t[:, None, :]), True)
            vote("put", ahead[:, :, :-1] + behind[:, :, 1:] == least, True)
            vote("cut", ahead[:, :-1, :] + behind[:, 1:, :] == least, False)
    return found


def edited(text: str, kind: str, place: int, letter: str) -> str:
    return text[:place] + letter + text[place + (kind != "put") :]
