"""Sequence similarities and distances as Column expressions."""

from __future__ import annotations

import functools

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

from .validators import _c


def matches(a, b) -> Column:
    """Equal characters at equal places, up to the shorter length."""
    a, b = _c(a), _c(b)
    n = F.least(F.length(a), F.length(b))
    pairs = F.zip_with(F.split(F.left(a, n), ""), F.split(F.left(b, n), ""), lambda x, y: (x == y).cast("int"))
    return F.when(n > 0, F.aggregate(pairs, F.lit(0), lambda t, x: t + x)).otherwise(0)


def hamming(a, b) -> Column:
    """Different characters up to the shorter length."""
    return F.least(F.length(_c(a)), F.length(_c(b))) - matches(a, b)


def hamming_similarity(a, b) -> Column:
    """Percent of equal characters, relative to the first length."""
    return matches(a, b) / F.length(_c(a)) * 100


def equal_length_similarity(a, b) -> Column:
    """``hamming_similarity``, 0 for unequal lengths."""
    return F.when(F.length(_c(a)) == F.length(_c(b)), hamming_similarity(a, b)).otherwise(0.0)


def mixed_similarity(a, b) -> Column:
    """Equal lengths: ``hamming_similarity``. Otherwise the best of rounded prefix and suffix similarity over the shorter
    length and of the rounded edit similarity relative to the mean length."""
    a, b = _c(a), _c(b)
    n = F.least(F.length(a), F.length(b))
    part = lambda x, y: F.rint(matches(x, y) / n * 100)
    edit = F.rint((1 - F.levenshtein(a, b) / ((F.length(a) + F.length(b)) / 2)) * 100)
    unequal = F.greatest(part(F.left(a, n), F.left(b, n)), part(F.right(a, n), F.right(b, n)), edit)
    return F.when(F.length(a) == F.length(b), hamming_similarity(a, b)).otherwise(unequal)


def edit_similarity_distance(a, b) -> Column:
    return 1 - mixed_similarity(a, b) / 100


def normalised_levenshtein(a, b, longest) -> Column:
    return F.levenshtein(_c(a), _c(b)) / longest


def binary(a, b) -> Column:
    return (_c(a) != _c(b)).cast("int")


def kmers(c, k: int) -> Column:
    c = _c(c)
    return F.when(F.length(c) >= k, F.transform(F.sequence(F.lit(1), F.length(c) - k + 1), lambda i: F.substring(c, i, F.lit(k)))).otherwise(F.array().cast("array<string>"))


def kmer_distance(a, b, k: int) -> Column:
    """1 less the shared distinct k-mers over the k-mer places of the shorter; null where that is shorter than k."""
    n = F.least(F.length(_c(a)), F.length(_c(b))) - k + 1
    return F.when(n > 0, 1 - F.size(F.array_intersect(kmers(a, k), kmers(b, k))) / n)


def combined(v, cdr3, j, weights: tuple[float, float, float] | None = None) -> Column:
    """Mean of the three distances, by ``weights`` if given."""
    if weights is None:
        return (_c(cdr3) + _c(v) + _c(j)) / 3
    return (weights[0] * _c(v) + weights[1] * _c(cdr3) + weights[2] * _c(j)) / sum(weights)


def scaled_euclidean(a, b) -> Column:
    """Root of the mean squared difference of two arrays."""
    squares = F.zip_with(_c(a), _c(b), lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double")))
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda t, x: t + x) / F.size(_c(a)))


def letter_vectors(substitution: np.ndarray, dimensions: int = 16) -> np.ndarray:
    """Classical scaling of a substitution matrix (similarities) to coordinates, one row a letter."""
    s = np.asarray(substitution, float)
    d2 = (s.max() - s) ** 2
    np.fill_diagonal(d2, 0)
    centre = np.eye(len(s)) - 1 / len(s)
    value, vector = np.linalg.eigh(-centre @ d2 @ centre / 2)
    top = np.argsort(value)[::-1][:dimensions]
    out = vector[:, top] * np.sqrt(np.maximum(value[top], 0))
    return np.pad(out, ((0, 0), (0, dimensions - out.shape[1])))


# The BLOSUM62 substitution scores of each amino acid with those before it.
AMINO_ACIDS = "ARNDCQEGHILKMFPSTWYV"
SUBSTITUTIONS = """
R -1
N -2 0
D -2 -2 1
C 0 -3 -3 -3
Q -1 1 0 0 -3
E -1 0 0 2 -4 2
G 0 -2 0 -1 -3 -2 -2
H -2 0 1 -1 -3 0 0 -2
I -1 -3 -3 -3 -1 -3 -3 -4 -3
L -1 -2 -3 -4 -1 -2 -3 -4 -3 2
K -1 2 0 -1 -3 1 1 -2 -1 -3 -2
M -1 -1 -2 -3 -1 0 -2 -3 -2 1 2 -1
F -2 -3 -3 -3 -2 -3 -3 -3 -1 0 0 -3 0
P -1 -2 -2 -1 -3 -1 -1 -2 -2 -3 -3 -1 -2 -4
S 1 -1 1 0 -1 0 0 0 -1 -2 -2 0 -1 -2 -1
T 0 -1 0 -1 -1 -1 -1 -2 -2 -1 -1 -1 -1 -2 -1 1
W -3 -3 -4 -4 -2 -2 -3 -2 -2 -3 -2 -3 -1 1 -4 -3 -2
Y -2 -2 -2 -3 -2 -1 -2 -3 2 -1 -1 -2 -1 3 -3 -2 -2 2
V 0 -3 -3 -3 -1 -2 -2 -3 -3 3 1 -2 1 -1 -2 -2 0 -3 -1
"""
DIAGONAL = 4  # for every letter, so that equal letters are equally near


@functools.cache
def amino_acid_vectors(dimensions: int = 16) -> dict[str, list[float]]:
    """Coordinates of each amino acid by ``letter_vectors``, to six decimals; a direction's first value that is not 0 is positive."""
    n = len(AMINO_ACIDS)
    scores = np.full((n, n), float(DIAGONAL))
    for line in SUBSTITUTIONS.split("\n"):
        if line:
            k = AMINO_ACIDS.index(line[0])
            scores[k, :k] = scores[:k, k] = [int(x) for x in line.split()[1:]]
    out = letter_vectors(scores, dimensions)
    for d in range(dimensions):
        large = np.flatnonzero(np.abs(out[:, d]) > 1e-6)
        if len(large) and out[large[0], d] < 0:
            out[:, d] = -out[:, d]
    return {c: [round(float(x), 6) + 0.0 for x in row] for c, row in zip(AMINO_ACIDS, out, strict=True)}


def embedding_distance(a, b) -> Column:
    """Root of the mean squared difference of the two cyclic embeddings; null where a letter is no amino acid."""
    vectors = amino_acid_vectors()
    return scaled_euclidean(cyclic_embedding(a, vectors), cyclic_embedding(b, vectors))


def component(kind: str, a, b, longest=None, k: int = 5) -> Column:
    """One part of the combined distance: ``binary``, ``levenshtein`` over ``longest``, ``similarity``, ``kmers`` or ``embedding``."""
    if kind == "binary":
        return binary(a, b).cast("double")
    if kind == "levenshtein":
        return normalised_levenshtein(a, b, longest)
    if kind == "similarity":
        return edit_similarity_distance(a, b)
    if kind == "kmers":
        return kmer_distance(a, b, k)
    if kind == "embedding":
        return embedding_distance(a, b)
    raise ValueError(f"unknown distance {kind}")


def cyclic_embedding(c, vectors: dict[str, list[float]], cycle: int = 6) -> Column:
    """Sum of letter vectors by the residue class of the distance from the end, one class after another.

    Folding x -> M (x + e(letter)) with a block permutation M of order ``cycle`` comes to these sums. Letters without a
    vector make the result null."""
    c = _c(c)
    dims = len(next(iter(vectors.values())))
    table = F.create_map(*[x for k, v in vectors.items() for x in (F.lit(k), F.array(*[F.lit(float(y)) for y in v]))])
    letters = F.transform(F.split(c, ""), lambda x, i: F.struct(((F.length(c) - i) % cycle).alias("r"), F.try_element_at(table, x).alias("v")))

    def total(r: int) -> Column:
        own = F.filter(letters, lambda x: x["r"] == r)
        return F.aggregate(own, F.array(*[F.lit(0.0)] * dims), lambda t, x: F.zip_with(t, x["v"], lambda p, q: p + q))

    sums = [total(r) for r in range(cycle)]
    return F.when(F.forall(letters, lambda x: x["v"].isNotNull()), F.concat(*sums))


def aligned_columns(aligned, positions) -> Column:
    """1-based alignment column of each residue number; a number past the end takes the last residue's column."""
    at = F.filter(F.transform(F.split(_c(aligned), ""), lambda x, i: F.when(x != "-", i + 1)), lambda x: x.isNotNull())
    return F.transform(_c(positions), lambda p: F.element_at(at, F.greatest(F.lit(1), F.least(p.cast("int"), F.size(at)))))
