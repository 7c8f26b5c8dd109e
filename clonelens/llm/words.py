"""Words of whole texts in NumPy: ASCII digits and letters (lower-cased) and every character from U+0080 on make words."""

from __future__ import annotations

import numpy as np

CHUNK = 4 << 20
SEP = 1


def _table() -> np.ndarray:
    t = np.full(256, 32, np.uint8)
    for a, b in ((48, 58), (97, 123), (128, 256)):
        t[a:b] = np.arange(a, b)
    t[65:91] = np.arange(97, 123)
    return t


LOWER = _table()


def buffers(column) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and the n + 1 offsets of an Arrow string column; null counts as empty."""
    import pyarrow as pa

    if column.null_count:
        column = column.fill_null("")
    if pa.types.is_large_string(column.type):
        kind = np.int64
    else:
        kind = np.int32
    _, offsets, data = column.buffers()
    n = len(column)
    if offsets is None or not n:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    o = np.frombuffer(offsets, kind)[column.offset : column.offset + n + 1].astype(np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), o


def chunks(offsets: np.ndarray, size: int = CHUNK):
    """Row ranges [a, b) of about ``size`` bytes; a longer row is a range of its own."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + size, "right")) - 1)
        yield a, min(b, n)
        a = min(b, n)


class Canonical:
    """Rows a..b as one byte array: each row is SEP, then its words, each followed by one byte that is no word byte.

    bytes: the array; rows: where each row's SEP stands; starts: mask of first bytes of words; n_words: per row.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, a: int, b: int):
        o = offsets[a : b + 1] - offsets[a]
        low = LOWER[data[offsets[a] : offsets[b]]]
        x = np.full(len(low) + b - a + 1, SEP, np.uint8)
        for i in range(b - a):
            x[o[i] + i + 1 : o[i + 1] + i + 1] = low[o[i] : o[i + 1]]
        word = x > 32
        keep = word.copy()
        keep[1:] |= word[:-1]
        keep |= x == SEP
        self.bytes = c = x[keep]
        word = word[keep]
        self.starts = word.copy()
        self.starts[1:] &= ~word[:-1]
        self.word = word
        self.rows = np.flatnonzero(c == SEP)[: b - a]
        self.before = np.cumsum(self.starts)  # words that start up to and with each byte
        edges = self.before[np.append(self.rows, len(c) - 1)]
        self.n_words = np.diff(edges)
        self.first_word = edges[:-1]  # words of the rows before


def mix64(x: np.ndarray) -> np.ndarray:
    """A finaliser of 64 bits."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


_POWER = np.cumprod(np.full(4096, 0xA0761D6478BD642F, np.uint64))


def word_hashes(c: Canonical) -> np.ndarray:
    """64-bit hashes of all words of ``c``, in order."""
    at = np.flatnonzero(c.starts)
    if not len(at):
        return np.zeros(0, np.uint64)
    inside = np.arange(len(c.bytes)) - at[np.maximum(c.before - 1, 0)]
    value = (c.bytes.astype(np.uint64) + np.uint64(1)) * _POWER[inside & 4095] * c.word
    # Bytes 4096 apart in one word get different factors through their distance.
    if inside.max() > 4095:
        value = value * ((inside.astype(np.uint64) >> np.uint64(12)) * np.uint64(2) + np.uint64(1))
    return mix64(np.add.reduceat(value, at))
