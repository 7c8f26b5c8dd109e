"""Merkle manifest of a dataset: digests of rows, of groups and of the whole, with a proof for each row.

A row's leaf is the digest of its fields. The leaves of a group (a source) stand in order of their ids; runs of FAN
neighbouring nodes become one node until one is left, the group's root; the groups' roots, in order of the groups, form
the tree above. Spark numbers the leaves by a range-partitioned sort with prefix sums and deals them to blocks of
FAN ^ HEIGHT neighbours aligned to the tree, so that each block is a whole subtree. One task walks a block in postorder: a
subtree returns its digest, and while the walk unwinds each leaf below gets its run's siblings appended. The block roots
are the nodes of the next such traversal, until one block a group is left; then proofs are joined from the top down, block
by block, so that no join has more than FAN ^ HEIGHT rows of one key however large a group is.

A proof is an array of (left, right): the joined digests of the siblings on either side in each run on the way up; folding
it from a leaf gives the root.

Defined results: a null field is `-`, an empty one `0:`; null ids stand first, rows of one id by their leaf; equal rows are
leaves of their own, which of them stands where makes no difference; a null group is a group, the first; a group of one row
has that row's leaf as root and no siblings; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, partitions, table

FAN = 3
HEIGHT = 6  # levels of a block: 729 leaves
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
PROOF = "array<struct<left:string,right:string>>"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    value = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))


def leaf(row: dict[str, Column], fields: list[str] = FIELDS) -> Column:
    return digest(*[field(row[c]) for c in fields])


def fold(start: Column, proof: Column) -> Column:
    """The root that ``proof`` gives for the leaf ``start``."""
    return F.aggregate(proof, start, lambda node, run: digest(run["left"], node, run["right"]))


def siblings(proof: Column) -> Column:
    """All digests of ``proof`` as one string, level by level, left to right."""
    return F.array_join(F.transform(proof, lambda run: F.concat(run["left"], run["right"])), "")


def height_of(n: int, most: int, fan: int = FAN) -> int:
    """Levels above ``n`` nodes until one is left, ``most`` at most."""
    h = 0
    while h < most and fan**h < n:
        h += 1
    return h


def traverse(leaves: list[str], height: int, fan: int = FAN) -> tuple[str, list[list[tuple[str, str]]]]:
    """Digest of the subtree of ``height`` levels over ``leaves`` and the proof of each leaf inside it."""
    proofs: list[list[tuple[str, str]]] = [[] for _ in leaves]

    def visit(first: int, h: int) -> str:
        if h == 0:
            return leaves[first]
        width = fan ** (h - 1)
        starts = range(first, min(first + fan * width, len(leaves)), width)
        roots = [visit(s, h - 1) for s in starts]
        for i, s in enumerate(starts):
            run = ("".join(roots[:i]), "".join(roots[i + 1 :]))
            for proof in proofs[s : s + width]:
                proof.append(run)
        return hashlib.sha256("".join(roots).encode()).hexdigest()

    return visit(0, height), proofs


def placed(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` (group, ...) with pos, counting from 0 in each group in ``order``, and n, the group's rows."""
    # The last key parts rows that are equal otherwise, so that many of them spread over tasks.
    rows = rows.withColumn("_scan", F.monotonically_increasing_id())
    keys = [F.col("group"), *[F.col(c).asc_nulls_first() for c in order], F.col("_scan")]
    dealt = rows.repartitionByRange(partitions(rows.sparkSession), *keys).sortWithinPartitions(*keys)
    dealt = materialize(dealt.withColumn("_task", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id()).drop("_scan"), "manifest-placed")
    counts = dealt.groupBy("group", "_task").agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    by = Window.partitionBy("group")
    before = by.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("group", "_task", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_ahead"), F.sum("_n").over(by).alias("n"))
    return dealt.join(counts, ["group", "_task"]).withColumn("pos", F.col("_at") - F.col("_first") + F.col("_ahead")).drop("_task", "_at", "_first", "_ahead")


def _walk(nodes: DataFrame, fan: int, height: int) -> DataFrame:
    """``nodes`` (group, block, pos, n, digest, item) -> a row for each node with its proof inside its block, and a row for
    each block (is_root) with the block's digest."""
    item = nodes.schema["item"].dataType
    schema = f"group string, block long, n long, is_root boolean, digest string, item {item.simpleString()}, proof {PROOF}"

    def run(t):
        import pyarrow as pa

        t = t.sort_by("pos")
        n = t.column("n")[0].as_py()
        root, proofs = traverse(t.column("digest").to_pylist(), height_of(n, height, fan), fan)
        rows, group, block = len(t), t.column("group")[0].as_py(), t.column("block")[0].as_py()
        kind = t.schema.field("item").type
        pair = pa.struct([("left", pa.string()), ("right", pa.string())])
        flat = [x for p in proofs for x in p]
        lefts, rights = (pa.array([x[i] for x in flat] or [], pa.string()) for i in (0, 1))
        ends = [0]
        for p in proofs:
            ends.append(ends[-1] + len(p))
        lists = pa.ListArray.from_arrays(pa.array([*ends, ends[-1]], pa.int32()), pa.StructArray.from_arrays([lefts, rights], fields=list(pair)))
        many = rows + 1
        columns = {
            "group": pa.array([group] * many, pa.string()),
            "block": pa.array([block] * many, pa.int64()),
            "n": pa.array([n] * many, pa.int64()),
            "is_root": pa.array([False] * rows + [True]),
            "digest": pa.array([*t.column("digest").to_pylist(), root], pa.string()),
            "item": pa.chunked_array([*t.column("item").chunks, pa.nulls(1, kind)], kind),
            "proof": lists,
        }
        return pa.table(columns)

    return nodes.groupBy("group", "block").applyInArrow(run, schema)


def forest(nodes: DataFrame, fan: int = FAN, height: int = HEIGHT) -> tuple[list[DataFrame], DataFrame]:
    """``nodes`` (group, pos, n, digest, item) -> the traversals' rows from the leaves up, and (group, digest) of the roots."""
    levels = []
    width = fan**height
    while True:
        dealt = nodes.withColumn("block", F.expr(f"pos div {width}"))
        done = materialize(_walk(dealt, fan, height), "manifest-level")
        levels.append(done.where("not is_root").select("group", "block", "digest", "item", "proof"))
        roots = done.where("is_root")
        if (roots.agg(F.max("n")).first()[0] or 0) <= width:
            return levels, roots.select("group", "digest")
        # A block's number is its root's place among the nodes of the next traversal.
        nodes = roots.select("group", F.col("block").alias("pos"), F.ceil(F.col("n") / width).alias("n"), "digest", F.col("block").alias("item"))


def unwound(levels: list[DataFrame], top: DataFrame) -> DataFrame:
    """Rows (group, digest, item, proof, ...) of the lowest level: proofs of the blocks above joined on, from ``top`` (group,
    above and what else a group's rows are to carry) down."""
    upper = top.withColumn("up_block", F.lit(0).cast("long")).withColumnRenamed("group", "up_group")
    carried = [c for c in top.columns if c not in ("group", "above")]
    for i, level in reversed(list(enumerate(levels))):
        found = level.join(upper, (F.col("group") == F.col("up_group")) & (F.col("block") == F.col("up_block")))
        whole = F.concat("proof", F.coalesce("above", F.lit(None).cast(PROOF), F.array().cast(PROOF)))
        if not i:
            return found.select("group", "digest", "item", whole.alias("proof"), *carried)
        upper = found.select(F.col("group").alias("up_group"), F.col("item").alias("up_block"), whole.alias("above"), *carried)
    raise AssertionError("a forest has one level at least")


def manifest(docs: DataFrame, id_col: str = "doc_id", group_col: str = "source", fields: list[str] = FIELDS, carry: Column | None = None, fan: int = FAN, height: int = HEIGHT) -> DataFrame:
    """Rows (id, leaf, proof, subroot, root, carried): ``carried`` is the column ``carry`` of each row."""
    item = F.struct(F.col(id_col).alias("id"), (F.lit(None).cast("string") if carry is None else carry).alias("carried"))
    group = F.when(F.col(group_col).isNull(), "").otherwise(F.concat(F.lit("="), F.col(group_col).cast("string")))
    rows = docs.select(group.alias("group"), leaf({c: F.col(c) for c in fields}, fields).alias("digest"), item.alias("item"))
    levels, subroots = forest(placed(rows.withColumn("id", F.col("item.id")), ["id", "digest"]).drop("id"), fan, height)
    # The groups' roots are the nodes of one more tree, of one group.
    heads = subroots.select(F.lit("").alias("group"), "digest", F.col("group").alias("item"))
    over, root = forest(placed(heads, ["item"]), fan, height)
    one = root.select("group", F.col("digest").alias("root"), F.lit(None).cast(PROOF).alias("above"))
    top = unwound(over, one).select(F.col("item").alias("group"), F.col("proof").alias("above"), F.col("digest").alias("subroot"), "root")
    found = unwound(levels, top)
    return found.select(F.col("item")["id"].alias("id"), F.col("digest").alias("leaf"), "proof", "subroot", "root", F.col("item")["carried"].alias("carried"))


def op12_manifest(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    row = {c: F.col(c) for c in FIELDS}
    changed = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.lit(False))
    row["text"] = F.when(changed, F.translate(F.col("text"), "\n", "")).otherwise(F.col("text"))
    found = manifest(docs, carry=leaf(row))
    folded = found.withColumn("folded_root", fold(F.col("carried"), F.col("proof")))
    return folded.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", F.sha2(siblings(F.col("proof")), 256).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def _field_sql(c: str) -> str:
    return f"coalesce(octet_length(encode({c}::VARCHAR))::VARCHAR || ':' || {c}::VARCHAR, '-')"


_LEAF_SQL = " || ".join(map(_field_sql, FIELDS))
_CRC_SQL = "list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)), lambda a, b: list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END))"

OP12_SQL = f"""
WITH RECURSIVE
c AS (SELECT *, doc_id IS NOT NULL AND ({_CRC_SQL} & 1) = 1 AS changed FROM documents),
d AS (
  SELECT doc_id, coalesce('=' || source, '') AS g, sha256({_LEAF_SQL}) AS leaf, sha256({_LEAF_SQL.replace("text", "CASE WHEN changed THEN replace(text, chr(10), '') ELSE text END")}) AS bad FROM c),
l AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY g) AS n, row_number() OVER () AS i FROM d),
t AS (
  SELECT g, 0 AS lvl, pos, n, leaf AS h FROM l
  UNION ALL
  SELECT g, lvl + 1, pos // {FAN}, (n + {FAN - 1}) // {FAN}, sha256(string_agg(h, '' ORDER BY pos)) FROM t WHERE n > 1 GROUP BY g, lvl, pos // {FAN}, n),
s AS (SELECT g, h AS subroot, lvl AS depth, row_number() OVER (ORDER BY g) - 1 AS pos, count(*) OVER () AS n FROM t WHERE n = 1),
u AS (
  SELECT 0 AS lvl, pos, n, subroot AS h FROM s
  UNION ALL
  SELECT lvl + 1, pos // {FAN}, (n + {FAN - 1}) // {FAN}, sha256(string_agg(h, '' ORDER BY pos)) FROM u WHERE n > 1 GROUP BY lvl, pos // {FAN}, n),
r AS (SELECT h AS root FROM u WHERE n = 1),
sides AS (
  SELECT a.g, a.lvl, a.pos, coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS lo, coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS hi
  FROM t a JOIN t b ON a.g = b.g AND a.lvl = b.lvl AND a.pos // {FAN} = b.pos // {FAN} WHERE a.n > 1 GROUP BY a.g, a.lvl, a.pos
  UNION ALL
  SELECT s.g, s.depth + a.lvl, NULL, coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos < a.pos), ''), coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '')
  FROM s JOIN u a ON a.n > 1 AND a.pos = s.pos // ({FAN} ** a.lvl)::BIGINT JOIN u b ON a.lvl = b.lvl AND a.pos // {FAN} = b.pos // {FAN} GROUP BY s.g, s.depth, a.lvl, a.pos),
p AS (SELECT i, lvl, lo, hi FROM l JOIN sides x ON l.g = x.g AND (x.pos IS NULL OR x.pos = l.pos // ({FAN} ** x.lvl)::BIGINT)),
f AS (
  SELECT i, 0 AS lvl, bad AS h FROM l
  UNION ALL
  SELECT f.i, f.lvl + 1, sha256(lo || h || hi) FROM f JOIN p ON f.i = p.i AND f.lvl = p.lvl),
e AS (SELECT i, arg_max(h, lvl) AS folded_root FROM f GROUP BY i),
q AS (SELECT l.i, sha256(coalesce(string_agg(lo || hi, '' ORDER BY lvl), '')) AS proof_sha256 FROM l LEFT JOIN p ON l.i = p.i GROUP BY l.i)
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified
FROM l JOIN s ON l.g = s.g JOIN e ON l.i = e.i JOIN q ON l.i = q.i CROSS JOIN r
"""
