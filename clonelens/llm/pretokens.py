"""Pre-tokens of many texts at once in NumPy, as the pattern of the public encoders cuts them.

BYTE_PATTERN gives a contraction, or a run of letters, of numbers or of other characters with at most one blank before it, or
white space. Every character is in one pre-token, so the pre-tokens of a text are known by their first bytes. What letters,
numbers and white space are is asked of the regex library.
"""

from __future__ import annotations

from functools import cache
from itertools import chain

import numpy as np

BYTE_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
OTHER, LETTER, NUMBER, SPACE = range(4)
SHORT = np.frombuffer(b"stmd", np.uint8)
LONG = np.array([a << 8 | b for a, b in (b"re", b"ve", b"ll")], np.uint16)


@cache
def kinds() -> np.ndarray:
    """The kind of each code point."""
    import regex

    every = "".join(map(chr, chain(range(0xD800), range(0xE000, 0x110000))))
    codes = np.frombuffer(every.encode("utf-32-le"), np.uint32)
    out = np.full(0x110000, OTHER, np.uint8)
    for kind, run in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
        for m in regex.finditer(run, every):
            out[codes[m.start() : m.end()]] = kind
    return out


def byte_kinds(data: np.ndarray) -> np.ndarray:
    """The kind of the character that each byte of UTF-8 belongs to."""
    of = kinds()
    out = of[:256][data]
    for low, high, more in ((0xC0, 0xDF, 1), (0xE0, 0xEF, 2), (0xF0, 0xF7, 3)):
        at = np.flatnonzero((data >= low) & (data <= high))
        if not len(at):
            continue
        code = data[at].astype(np.uint32) & (0x3F >> more)
        for i in range(more):
            code = code << 6 | (data[at + i + 1] & 63)
        kind = of[code]
        for i in range(more + 1):
            out[at + i] = kind
    return out


def starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """First bytes of the pre-tokens of the texts ``data[offsets[i]:offsets[i + 1]]``, which fill ``data``."""
    n = len(data)
    kind = byte_kinds(data)
    first = np.zeros(n + 1, bool)
    first[offsets] = True
    begins = first.copy()
    begins[1:n] |= kind[1:] != kind[:-1]
    # The last character of white space before something else stands alone, or in front of it where it is a blank.
    space = kind == SPACE
    after = np.flatnonzero(space[:-1] & ~space[1:] & ~first[1:n]) + 1
    last = after - 1
    while (inner := (data[last] & 0xC0) == 0x80).any():
        last = last - inner
    begins[last] = True
    begins[after[data[last] == 32]] = False
    # A pre-token that begins with an apostrophe is a contraction where its letters follow in the same text.
    mark = np.flatnonzero((data == 39) & begins[:n])
    mark = mark[~first[mark + 1]]
    short = np.isin(data[mark + 1], SHORT)
    long = mark[~short]
    long = long[~first[long + 2]]
    long = long[np.isin(data[long + 1].astype(np.uint16) << 8 | data[long + 2], LONG)]
    begins[mark[short] + 1] = begins[long + 1] = False
    begins[mark[short] + 2] = begins[long + 3] = True
    return np.flatnonzero(begins[:n])


def windows(data: np.ndarray, size: int):
    """Ranges [a, b) of one text, of about ``size`` bytes, whose pre-tokens are the text's: cut before a blank or a line end that
    follows a visible ASCII character. A range is longer where no such place comes sooner."""
    cuts = np.flatnonzero(((data[1:] == 32) | (data[1:] == 10)) & (data[:-1] > 32) & (data[:-1] < 127)) + 1
    a, n = 0, len(data)
    while n - a > size:
        i = int(np.searchsorted(cuts, a + size, "right"))
        if i and cuts[i - 1] > a:
            b = int(cuts[i - 1])
        elif i < len(cuts):
            b = int(cuts[i])
        else:
            break
        yield a, b
        a = b
    if a < n:
        yield a, n
