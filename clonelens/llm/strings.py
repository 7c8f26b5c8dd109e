"""Gap-weighted subsequence kernel of short units in NumPy.

A unit is a run of at most LONGEST symbols out of 63, the first of a token after the symbol START. Letters a to z have
symbols of their own, digits and signs that are written for letters have theirs, and all other letters of all scripts are
dealt over 36 symbols, so that neighbours in an alphabet differ. As text a unit has a character from "1" on a symbol.

The kernel counts common subsequences of ORDER symbols within a span of SPAN, each weighted by DECAY a symbol spanned,
and is normalised.
"""

from __future__ import annotations

import functools
import unicodedata

import numpy as np

SPAN, DECAY, ORDER = 6, 0.6, 3
LONGEST, STRIDE = 24, 16
BITS = 6
CODES = 1 << (BITS * ORDER)
START, FIRST_LETTER, FIRST_OTHER, OTHERS = 1, 2, 28, 36
ZERO = 0x30
ROWS_AT_ONCE = 4000
_OFFSETS = [(a, b) for a in range(1, SPAN) for b in range(1, SPAN - a)]
# Digits and signs that are written for letters.
_WRITTEN_FOR = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}


@functools.cache
def _symbols() -> tuple[np.ndarray, np.ndarray]:
    """Symbol of each code point below 2^16, 0 for what is left out, and the same with accents dropped."""
    plain, folded = np.zeros(1 << 16, np.uint8), np.zeros(1 << 16, np.uint8)
    for cp in range(1 << 16):
        c = chr(cp).lower()[0]
        c = _WRITTEN_FOR.get(c, c)
        if c.isalnum():
            letter = lambda x: FIRST_LETTER + ord(x) - 97 if "a" <= x <= "z" else FIRST_OTHER + ord(x) % OTHERS
            plain[cp], folded[cp] = letter(c), letter(unicodedata.normalize("NFD", c)[0])
    return plain, folded


def units_matrix(tokens: list[str], fold: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(symbols, token of each row): a row of LONGEST + 1 symbols per unit, zero at the end.

    A longer token gives overlapping units; with ``fold`` one with accents gives the same units again without them."""
    plain, folded = _symbols()
    if not tokens:
        return np.zeros((0, LONGEST + 1), np.uint8), np.zeros(0, np.int64)
    cp = np.frombuffer("\n".join(tokens).encode("utf-32-le", "surrogatepass"), np.uint32)
    end = cp == 10
    token = np.cumsum(end) - end
    low = np.minimum(cp, 0xFFFF)
    s, f = (np.where(cp < 1 << 16, t[low], FIRST_OTHER + cp % OTHERS).astype(np.uint8) for t in (plain, folded))
    keep = (s > 0) & ~end
    s, f, token = s[keep], f[keep], token[keep]
    accented = np.bincount(token, (s != f) & fold, len(tokens)) > 0
    again = accented[token]
    # Accented tokens follow as tokens of their own.
    number = np.cumsum(accented) - 1 + len(tokens)
    s, place = np.concatenate([s, f[again]]), np.concatenate([token, number[token[again]]])
    owner = np.concatenate([np.arange(len(tokens)), np.flatnonzero(accented)])
    n = np.bincount(place, minlength=len(owner))
    at = np.arange(len(s)) - (np.cumsum(n) - n)[place]
    rows = np.where(n > 0, np.maximum(1, -(-(n - LONGEST) // STRIDE) + 1), 0)
    first = np.cumsum(rows) - rows
    out = np.zeros((int(rows.sum()), LONGEST + 1), np.uint8)
    begin = np.zeros(len(out), bool)
    begin[first[n > 0]] = True
    out[begin, 0] = START
    for back in range(-(-LONGEST // STRIDE)):
        row = at // STRIDE - back
        col = at - row * STRIDE
        ok = (row >= 0) & (row < rows[place]) & (col < LONGEST)
        r = first[place[ok]] + row[ok]
        out[r, col[ok] + begin[r]] = s[ok]
    return out, np.repeat(owner, rows)


def as_text(m: np.ndarray) -> list[str]:
    """Units as text."""
    return [bytes(r).rstrip(b"0").decode("ascii") for r in m + np.uint8(ZERO)]


def as_matrix(units) -> np.ndarray:
    """The rows whose text is in ``units``, a list or an Arrow array."""
    import pyarrow as pa
    import pyarrow.compute as pc

    units = pa.array(units, pa.string()) if isinstance(units, list) else units
    full = pa.concat_arrays([pc.utf8_rpad(units, LONGEST + 1, padding="0")])
    data = full.buffers()[2]
    out = np.frombuffer(data, np.uint8, len(units) * (LONGEST + 1)) if len(units) else np.zeros(0, np.uint8)
    return out.reshape(len(units), LONGEST + 1) - np.uint8(ZERO)


def subsequences(m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the ORDER-symbol subsequences of each row, 0 where there is none, and the weight of each column."""
    width = max(1, int((m > 0).sum(1).max(initial=1)))
    x = m[:, :width].astype(np.int32)
    codes, weights = [np.zeros((len(m), 1), np.int32)], [np.zeros(1, np.float32)]
    for a, b in _OFFSETS:
        if (k := width - a - b) > 0:
            last = x[:, a + b : a + b + k]
            code = (x[:, :k] << (2 * BITS)) | (x[:, a : a + k] << BITS) | last
            codes.append(np.where(last > 0, code, 0))
            weights.append(np.full(k, DECAY ** (a + b + 1), np.float32))
    return np.concatenate(codes, 1), np.concatenate(weights)


def norms(codes: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Square root of the kernel of each row with itself: equal subsequences of a row add up before they are squared."""
    bits = max(1, int(len(weights) - 1).bit_length())
    key = np.sort((codes.astype(np.int64) << bits) | np.arange(len(weights)), axis=1)
    code = key >> bits
    w = np.where(code > 0, weights[key & ((1 << bits) - 1)], np.float32(0))
    begins = np.ones(code.shape, bool)
    begins[:, 1:] = code[:, 1:] != code[:, :-1]
    at = np.flatnonzero(begins)
    total = np.add.reduceat(w.ravel(), at) if len(at) else np.zeros(0, np.float32)
    return np.sqrt(np.bincount(at // code.shape[1], total.astype(np.float64) ** 2, len(codes)))


def margins(m: np.ndarray, folded: np.ndarray, bias: float, none: float) -> np.ndarray:
    """Values of the machine whose weight of each subsequence is in ``folded``; ``none`` for units without one."""
    out = np.full(len(m), none, np.float32)
    # Rows of like length together: each run is only as wide as its longest row.
    order = np.argsort((m > 0).sum(1), kind="stable")
    for a in range(0, len(m), ROWS_AT_ONCE):
        some = order[a : a + ROWS_AT_ONCE]
        codes, weights = subsequences(m[some])
        n = norms(codes, weights)
        f = folded[codes] @ weights
        out[some] = np.where(n > 0, f / np.maximum(n, 1e-9) + bias, none)
    return out


class Landmarks:
    """The Nyström space that the units of ``m`` span: ``features`` of rows are coordinates in it, ``fold`` turns weights of
    coordinates into weights of subsequences."""

    def __init__(self, m: np.ndarray, ridge: float):
        codes, weights = subsequences(m)
        n = np.maximum(norms(codes, weights), 1e-9)
        self.known = np.unique(codes)
        self.column = np.zeros(CODES, np.int32)
        self.column[self.known] = np.arange(len(self.known))
        absent = np.ones(CODES, bool)
        absent[self.known] = False
        self.column[absent] = len(self.known)
        dense = np.zeros((len(self.known) + 1, len(m)), np.float32)
        for k, c in enumerate(codes):
            np.add.at(dense[:, k], self.column[c], np.where(c > 0, weights / n[k], np.float32(0)))
        dense[self.column[0]] = 0
        value, vector = np.linalg.eigh((dense.T @ dense).astype(np.float64))
        self.root = (vector / np.sqrt(np.maximum(value, ridge))) @ vector.T
        self.rows = dense @ self.root.astype(np.float32)

    def features(self, m: np.ndarray) -> np.ndarray:
        """Coordinates of each row and a constant 1."""
        out = np.ones((len(m), self.rows.shape[1] + 1), np.float32)
        for a in range(0, len(m), 64):
            codes, weights = subsequences(m[a : a + 64])
            n = np.maximum(norms(codes, weights), 1e-9)
            out[a : a + 64, :-1] = weights @ self.rows[self.column[codes]] / n[:, None]
        return out

    def fold(self, w: np.ndarray) -> np.ndarray:
        out = np.zeros(CODES, np.float32)
        out[self.known] = (self.rows @ w.astype(np.float32))[:-1]
        out[0] = 0
        return out
