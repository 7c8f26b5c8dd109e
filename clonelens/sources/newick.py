"""Newick text of small trees."""

from __future__ import annotations

import re

def dumps(root: str, children: dict[str, list[str]], lengths: dict[str, float] | None = None) -> str:
    """Text with inner names; ``lengths`` by child."""
    done: dict[str, str] = {}
    stack = [(root, False)]
    while stack:
        x, ready = stack.pop()
        kids = children.get(x, [])
        if not ready and kids:
            stack.append((x, True))
            stack += [(k, False) for k in reversed(kids)]
            continue
        tail = f":{lengths[x]:g}" if lengths and x in lengths else ""
        done[x] = (f"({','.join(done.pop(k) for k in kids)})" if kids else "") + x + tail
    return done[root] + ";"


def loads(text: str) -> tuple[str, list[tuple[str, str, float | None]]]:
    """(root, edges (parent, child, length)); nameless nodes are called ``_1``, ``_2``, ..."""
    at, count, edges = 0, 0, []
    open_: list[list[str]] = [[]]
    lengths: dict[str, float | None] = {}

    def label():
        nonlocal at, count
        m = re.compile(r"\s*('[^']*'|[^\s(),;:']*)\s*(?::\s*([0-9.eE+-]+))?").match(text, at)
        at = m.end()
        name = m[1].strip("'")
        if not name:
            count += 1
            name = f"_{count}"
        lengths[name] = float(m[2]) if m[2] else None
        return name

    while at < len(text):
        c = text[at]
        if c.isspace():
            at += 1
        elif c == "(":
            open_.append([])
            at += 1
        elif c == ",":
            at += 1
        elif c == ")":
            at += 1
            kids = open_.pop()
            name = label()
            edges += [(name, k) for k in kids]
            open_[-1].append(name)
        elif c == ";":
            break
        else:
            open_[-1].append(label())
    if len(open_) != 1 or len(open_[0]) != 1:
        raise ValueError("unbalanced Newick text")
    return open_[0][0], [(p, c, lengths[c]) for p, c in edges]
