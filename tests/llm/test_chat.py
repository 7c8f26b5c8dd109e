import hashlib
import random

from hypothesis import given
from hypothesis import strategies as st

from clonelens.llm import chat

CONV = "conv_id long, turn long, role string, text string, tree int, pos int"


@given(st.lists(st.tuples(st.text("a\n\\|<n"), st.text("<|im_startend>\\\nn"))))
def test_escape_is_reversible(turns):
    text = "".join(chat.format_turn(*t)[0] for t in turns)
    assert [(r, t) for r, t, _, _ in chat.parse(text)] == turns


def digest(rows):
    rows = sorted(rows, key=lambda r: (r[0], r[1] or "", r[2] or ""))
    loss = "".join(t or "" for _, r, t in rows if r == "assistant")
    size = sum(len(chat.format_turn(r or "", t or "")[0]) for _, r, t in rows)
    h = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return len(rows), h("".join(f"{r or ''}\n{t or ''}\n" for _, r, t in rows)), len(loss), h(loss), size


def run(spark, rows):
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], CONV)
    out = chat.digests(chat.format_trees(chat.linear_tree(df))).collect()
    return {r.conv: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256, r.formatted_chars) for r in out}, len(out)


def test_conversations(spark):
    rows = [(c, t, r, x) for c, t, r, x in spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(None, 0, "user", "x"), (7000, 1, None, None), (7000, 1, "assistant", "é<|im_end|>\\"), (7000, 1, "assistant", "é<|im_end|>\\"), (7001, 0, "ro\nle", "")]
    rows += [(8000, i, random.Random(i).choice(["user", "assistant"]), f"turn {i} 😀") for i in range(1300)]
    want = {}
    for c, *r in rows:
        want.setdefault(c, []).append(r)
    got, n = run(spark, rows)
    assert n == len(want) and got == {c: digest(r) for c, r in want.items()}


def test_empty(spark):
    assert run(spark, []) == ({}, 0)


def test_branches(spark):
    rng = random.Random(3)
    nodes = {f"n{i}": (f"t{i % 3}", f"n{rng.randrange(i % 3, i, 3)}" if i > 2 and rng.random() < 0.95 else None, rng.choice([None, 0.5, 1.0, 2.0])) for i in range(120)}
    nodes |= {"c1": ("t9", "c2", 1.0), "c2": ("t9", "c1", 1.0), "c3": ("t9", "c2", 1.0), "o": ("t8", "missing", 1.0)}
    df = spark.createDataFrame([(t, i, p, s) for i, (t, p, s) in nodes.items()], "tree string, id string, parent string, score double")

    def path(i):
        out = []
        while i is not None and i in nodes and len(out) < 500:
            out.append(i)
            i = nodes[i][1]
        return out[::-1]

    parents = {p for _, p, _ in nodes.values()}
    for best in (1, 3):
        want = {}
        for tree in {t for t, _, _ in nodes.values()}:
            leaves = [i for i, (t, _, _) in nodes.items() if t == tree and i not in parents and i[0] != "c"]
            ranked = sorted(leaves, key=lambda i: (-sum(nodes[x][2] or 0 for x in path(i)), -len(path(i)), i))[:best]
            want |= {i: path(i) for i in ranked}
        got = {}
        for r in chat.branches(df, best).orderBy("leaf", "pos").collect():
            got.setdefault(r.leaf, []).append(r.id)
        assert got == want


def test_trees_that_share_ids_and_repeated_messages(spark):
    rows = [(t, i, p, s) for t in ("a", "b", None) for i, p, s in ((1, None, 1.0), (2, 1, 1.0), (3, 1, 2.0), (4, 3, None))]
    rows += [("a", 4, 3, None), ("a", 4, 9, 5.0), ("b", 1, None, 1.0), ("c", 7, 1, 1.0), ("c", None, 7, 1.0)]
    df = spark.createDataFrame(rows, "tree string, id long, parent long, score double")
    got = {}
    for r in chat.branches(df).orderBy("pos").collect():
        got.setdefault(r.tree, []).append(r.id)
    assert got == {"a": [1, 3, 4], "b": [1, 3, 4], None: [1, 3, 4], "c": [7, None]}
    turns = df.selectExpr("*", "'user' as role", "concat(id, tree) as text")
    parts = {r.conv: r.formatted for r in chat.format_trees(turns).collect()}
    assert [t for _, t, _, _ in chat.parse(parts["b"])] == ["1b", "3b", "4b"] and len(parts) == 4


def test_query_equals_sql(spark):
    from sqlcheck import equals_sql

    equals_sql(spark, "op4_chat")


def test_branches_of_trees_that_share_ids(spark):
    rows = [(t, i, p, 1.0, "user", f"{t}{i}") for t in ("s", "t") for i, p in (("a", None), ("b", "a"), ("c", "a"))]
    df = spark.createDataFrame(rows, "tree string, id string, parent string, score double, role string, text string")
    got = {(r.conv.tree, r.conv.leaf): [x[1] for x in chat.parse(r.formatted)] for r in chat.format_trees(df, 2).collect()}
    assert got == {(t, i): [f"{t}a", f"{t}{i}"] for t in ("s", "t") for i in ("b", "c")}
