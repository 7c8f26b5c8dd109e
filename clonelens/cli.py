"""python -m clonelens.cli INPUT OUTPUT THRESHOLD KIND: analyse one table of annotated reads."""

from __future__ import annotations

import argparse
import time
from pathlib import PurePath

from .operators.refine import Distances
from .plans.analysis import Settings, bundle, run
from .session import session


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("input", help="tab-separated table of annotated reads, .tsv or .txt")
    p.add_argument("output", help="folder for the results; <name>_output below it must not exist")
    p.add_argument("threshold", type=float)
    p.add_argument("kind", choices=["percentage", "number"])
    p.add_argument("--clones", default="5")
    p.add_argument("--subclones", default="200")
    p.add_argument("--alleles", action="store_true")
    p.add_argument("--trim", action="store_true")
    p.add_argument("--merge-singletons", action="store_true")
    p.add_argument("--first-found", action="store_true", help="take the first of equally near nodes of a tree, not the most abundant")
    p.add_argument("--distances", default="binary,levenshtein,similarity", help="of gene, CDR3 and J: binary, levenshtein, similarity, kmers or embedding")
    p.add_argument("--weights", help="three numbers, comma-separated; without them the mean is taken")
    p.add_argument("--bundle", help="zip file on this machine for JSON, FASTA and statistics")
    a = p.parse_args(argv)
    if PurePath(a.input).suffix not in (".tsv", ".txt"):
        p.error("the input must be a .tsv or .txt table")
    a.distances = a.distances.split(",")
    if len(a.distances) != 3 or not set(a.distances) <= {"binary", "levenshtein", "similarity", "kmers", "embedding"} or "similarity" in a.distances[:2] or a.distances[2] == "levenshtein":
        p.error("--distances needs three kinds; similarity is for J only, levenshtein for gene and CDR3")
    try:
        a.weights = tuple(map(float, a.weights.split(","))) if a.weights else None
    except ValueError:
        p.error("--weights needs numbers")
    if a.weights and (len(a.weights) != 3 or min(a.weights) < 0 or not sum(a.weights)):
        p.error("--weights needs three numbers, not all 0")
    return a


def main(argv: list[str] | None = None) -> None:
    from .functions.validators import integer_option

    a = arguments(argv)
    name = PurePath(a.input).stem
    began = time.perf_counter()
    settings = Settings(a.threshold, a.kind, integer_option(a.clones, 5), integer_option(a.subclones, 200), a.alleles, trim=a.trim, merge_singletons=a.merge_singletons, by_abundance=not a.first_found, distances=Distances(*a.distances, a.weights))
    result = run(session(), a.input, f"{a.output}/{name}_output", settings, name)
    if a.bundle:
        bundle(result, a.bundle, name)
    print(f"run time: {time.perf_counter() - began:.0f} seconds")


if __name__ == "__main__":
    main()
