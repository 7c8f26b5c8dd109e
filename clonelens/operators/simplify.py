"""Trees in memory (one clone) and their two simplifications."""

from __future__ import annotations

from collections.abc import Callable, Iterable


class Tree:
    """Rooted tree with ordered children, abundances and a set of silent (unobserved) nodes."""

    def __init__(self, root: str, edges: Iterable[tuple[str, str, bool]], abundance: dict[str, int]):
        self.root, self.abundance = root, abundance
        self.children: dict[str, list[str]] = {root: []}
        self.parent: dict[str, str] = {}
        self.silent: set[str] = set()
        for p, c, silent in edges:
            self.children.setdefault(p, []).append(c)
            self.children.setdefault(c, [])
            self.parent[c] = p
            if silent:
                self.silent.add(c)

    def nodes(self) -> list[str]:
        out, stack = [], [self.root]
        while stack:
            x = stack.pop()
            out.append(x)
            stack += reversed(self.children[x])
        return out

    def edges(self) -> list[tuple[str, str]]:
        return [(self.parent[x], x) for x in self.nodes() if x in self.parent]

    def leaves(self) -> list[str]:
        return [x for x in self.nodes() if not self.children[x]]

    def reads(self, x: str) -> int:
        return 0 if x in self.silent else self.abundance.get(x, 0)

    def path(self, x: str) -> list[str]:
        out = [x]
        while out[-1] in self.parent:
            out.append(self.parent[out[-1]])
        return out

    def kept(self, names: set[str]) -> Tree:
        """The tree of ``names``, which hold all ancestors of their members."""
        return Tree(self.root, [(p, c, c in self.silent) for p, c in self.edges() if c in names], self.abundance)


def most_abundant(tree: Tree, n: int = 10) -> set[str]:
    """The ``n`` nodes of most reads, among equal ones those of the largest name."""
    named = [x for x in tree.nodes() if x not in tree.silent]
    return set(sorted(named, key=lambda x: (tree.reads(x), x))[-n:])


def simplify_by_share(tree: Tree, nodes: int = 30, share: float = 0.01) -> Tree:
    """Keeps what branches or is abundant among the leaves' siblings, the ten most abundant, and all ancestors; then fills up
    to ``nodes`` by abundance, each with its path."""
    total = sum(tree.reads(x) for x in tree.nodes()) or 1
    keep: set[str] = set()
    for p in dict.fromkeys(tree.parent[x] for x in tree.leaves() if x in tree.parent):
        kids = tree.children[p]
        if len(kids) == 1:
            keep.add(kids[0])
            continue
        good = {x for x in kids if tree.children[x] or tree.reads(x) / total > share}
        top = max(kids, key=tree.reads)
        keep |= good if good - keep else {top} | good
    keep |= most_abundant(tree)
    keep = {y for x in keep for y in tree.path(x)} | {tree.root}
    for x in sorted(tree.nodes(), key=tree.reads, reverse=True):
        if len(keep) >= nodes:
            break
        keep |= set(tree.path(x))
    return tree.kept(keep)


def simplify_by_count(tree: Tree, distance: Callable[[str, str], int], nodes: int = 30, share: float = 0.01) -> Tree:
    """Drops silent leaves, then of the nearest pair of leaves the rarer, until ``nodes`` are left (a nameless root counts)
    or all leaves are abundant or among the ten most abundant, or no pair is left."""
    total = sum(tree.reads(x) for x in tree.nodes()) or 1
    top, used = most_abundant(tree), set()
    spared = lambda x: tree.reads(x) / total >= share or x in top
    while len(tree.nodes()) + 1 > nodes:
        leaves = tree.leaves()
        if bare := {x for x in leaves if x in tree.silent}:
            tree = tree.kept(set(tree.nodes()) - bare)
            continue
        if all(map(spared, leaves)):
            break
        pairs = [(a, b) for i, a in enumerate(leaves) for b in leaves[i + 1 :] if (a, b) not in used]
        if not pairs:
            break
        a, b = min(pairs, key=lambda p: (distance(*p), tree.reads(p[0]) + tree.reads(p[1])))
        used.add((a, b))
        rare = a if tree.reads(a) <= tree.reads(b) else b
        if not spared(rare):
            tree = tree.kept(set(tree.nodes()) - {rare})
    return tree


def tidy(tree: Tree) -> Tree:
    """Without silent nodes of one child, which are spliced out, and without silent leaves."""
    edges = {c: p for p, c in tree.edges()}
    changed = True
    while changed:
        changed = False
        for x in [x for x in tree.silent if x in edges]:
            kids = [c for c, p in edges.items() if p == x]
            if len(kids) < 2:
                for c in kids:
                    edges[c] = edges[x]
                del edges[x]
                changed = True
    return Tree(tree.root, [(p, c, c in tree.silent) for c, p in edges.items()], tree.abundance)
