"""Sharding by extendible hashing, in DataFrame operations only.

A row's hash is the first 60 bits of md5(id). The directory is indexed by hash-prefix bits: a bucket is split on one
more bit only while its bytes are over the limit. Byte sums are taken once at a prefix some bits finer than the
expected leaf; sums of all shorter prefixes are rolled up from them, and only rows whose finest bucket is still over
the limit go another round with more bits. Rows of one id cannot be parted by bits: such a bucket at full depth is
continued on overflow pages, filled by numbering its rows in parts, not by collecting them.

Defined results: a null text has 0 bytes; a null id hashes as the empty string; a row larger than the limit is a
shard of its own as soon as its prefix holds no other row, and one that shares its id a page of its own; repeated rows count as rows of their own; an empty table gives no rows and writes an empty folder;
``shard`` ignores other columns, ``write_shards`` keeps them, whatever their names.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, table, text_of

BITS = 60
FINER = 6
PARTS = 64
LIMIT = 8 << 20


def _prefix(h: str, depth):
    return F.expr(f"shiftrightunsigned({h}, cast({BITS} - {depth} as int))")


def _hash(id_col: str):
    return F.conv(F.substring(F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 1, BITS // 4), 16, 10).cast("long")


def _paged(rows: DataFrame, limit: int) -> DataFrame:
    """``rows`` (id, n_bytes, bits, ...) of buckets over the limit at full depth, with their overflow page.

    Rows of one id and size are numbered in PARTS parts, each counted first, so a group of any size is spread; pages
    follow from the numbers by arithmetic."""
    kind = ["bits", "id", "n_bytes"]
    rows = materialize(rows.withColumn("row", F.monotonically_increasing_id()), "overflow").withColumn("part", F.col("row") % PARTS)
    parts = rows.groupBy(*kind, "part").agg(F.count("*").alias("n"))
    per = F.greatest(F.lit(1), F.floor(F.lit(limit) / F.greatest("n_bytes", F.lit(1)))).cast("long")
    kinds = parts.groupBy(*kind).agg(F.sum("n").alias("n")).withColumn("per", per).withColumn("pages", F.ceil(F.col("n") / F.col("per")).cast("long"))
    first = F.coalesce(F.expr("sum(pages) over (partition by bits order by n_bytes, id rows between unbounded preceding and 1 preceding)"), F.lit(0))
    kinds = kinds.select(*[F.col(c).alias(f"k_{c}") for c in kind], "per", first.alias("first"))
    ahead = F.coalesce(F.expr("sum(n) over (partition by bits, id, n_bytes order by part rows between unbounded preceding and 1 preceding)"), F.lit(0))
    same = lambda prefix: (F.col("bits") == F.col(f"{prefix}_bits")) & F.col("id").eqNullSafe(F.col(f"{prefix}_id")) & (F.col("n_bytes") == F.col(f"{prefix}_n_bytes"))
    parts = parts.select(*[F.col(c).alias(f"p_{c}") for c in (*kind, "part")], ahead.alias("ahead"))
    inside = F.row_number().over(Window.partitionBy(*kind, "part").orderBy("row")) - 1
    placed = rows.withColumn("inside", inside).join(parts, same("p") & (F.col("part") == F.col("p_part"))).join(kinds, same("k"))
    page = (F.col("first") + F.floor((F.col("ahead") + F.col("inside")) / F.col("per"))).cast("long")
    return placed.withColumn("page", page)


def _placed(rows: DataFrame, limit: int) -> DataFrame:
    """rows (id, n_bytes, h, ...) -> with shard, depth, page, shard_bytes, shard_docs."""
    own = rows.columns
    total = rows.agg(F.sum("n_bytes")).first()[0] or 0
    at = min(BITS, max(0, math.ceil(math.log2(total / limit))) + FINER if total > limit else 0)
    open_rows, low, leaves = rows, 0, []
    while True:
        fine = open_rows.groupBy(_prefix("h", at).alias("fine")).agg(F.sum("n_bytes").alias("b"), F.count("*").alias("n"))
        levels = fine.select("fine", "b", "n", F.explode(F.sequence(F.lit(low), F.lit(at))).alias("d")).withColumn("p", F.expr(f"shiftrightunsigned(fine, cast({at} - d as int))"))
        # A leaf is one bit deeper than the deepest prefix over the limit; a bucket still over it at ``at`` stays open.
        # One row alone is never split: no bit makes it smaller.
        full = levels.groupBy("d", "p").agg(F.sum("b").alias("s"), F.sum("n").alias("n")).where((F.col("s") > limit) & (F.col("n") > 1)).select("d", "p")
        over = levels.join(full, ["d", "p"]).groupBy("fine").agg((F.max("d") + 1).alias("depth"))
        found = fine.select("fine").join(over, "fine", "left").select("fine", F.coalesce("depth", F.lit(low)).alias("depth"))
        found = materialize(found, "directory")
        placed = open_rows.withColumn("fine", _prefix("h", at)).join(found, "fine")
        ready = F.col("depth") <= at
        leaves.append(placed.where(ready | F.lit(at == BITS)).select(*own, F.least("depth", F.lit(BITS)).cast("int").alias("depth"), (~ready).alias("over")))
        if at == BITS or found.where(~ready).isEmpty():
            break
        open_rows = materialize(placed.where(~ready).select(*own), "open")
        low, at = at + 1, min(BITS, at + FINER)
    out = leaves[0]
    for more in leaves[1:]:
        out = out.unionByName(more)
    out = out.withColumn("bits", F.when(F.col("depth") > 0, F.lpad(F.bin(_prefix("h", "depth")), F.col("depth"), F.lit("0"))).otherwise(F.lit("")))
    plain = out.where(~F.col("over")) if at == BITS else out
    plain = plain.select(*own, "bits", "depth", F.lit(0).cast("long").alias("page"))
    out = plain.unionByName(_paged(out.where("over").select(*own, "bits", "depth"), limit).select(*plain.columns)) if at == BITS else plain
    sizes = out.groupBy("bits", "page").agg(F.sum("n_bytes").alias("shard_bytes"), F.count("*").alias("shard_docs"))
    out = out.join(sizes, ["bits", "page"])
    name = F.concat("bits", F.when(F.col("page") > 0, F.concat(F.lit("+"), F.col("page").cast("string"))).otherwise(F.lit("")))
    return out.withColumn("shard", name)


def shard(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT) -> DataFrame:
    """Rows (id, n_bytes, shard, depth, page, shard_bytes, shard_docs); ``shard`` spells the prefix bits, then the page if above 0."""
    rows = materialize(docs.select(F.col(id_col).alias("id"), F.octet_length(text_of(text_col)).cast("long").alias("n_bytes"), _hash(id_col).alias("h")), "shard")
    return _placed(rows, limit).select("id", "n_bytes", "shard", "depth", "page", "shard_bytes", "shard_docs")


def write_shards(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT) -> str:
    """Write every row of ``docs`` once, one folder a shard, each by one task. Returns the name of the column of the folders:
    ``__shard``, or with more underscores where ``docs`` has that column."""
    name = "__shard"
    while name in map(str.lower, docs.columns):
        name = "_" + name
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    rows = materialize(docs.select(F.col(id_col).alias("id"), F.octet_length(text_of(text_col)).cast("long").alias("n_bytes"), _hash(id_col).alias("h"), whole), "shard")
    out = _placed(rows, limit).select("doc.*", F.col("shard").alias(name))
    out.repartition(name).write.partitionBy(name).parquet(path)
    return name


def op8_sharding(spark, sf_dir: str) -> DataFrame:
    return shard(table(spark, sf_dir, "documents")).select(F.col("id").alias("doc_id"), "n_bytes", "shard", "depth", "shard_bytes", "shard_docs")


OP8_SQL = f"""
WITH rows_ AS (
  SELECT doc_id, octet_length(encode(coalesce(text, '')))::BIGINT AS n_bytes,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, {BITS // 4}))::BIGINT AS h
  FROM documents),
depths AS (SELECT r.*, d.d FROM rows_ r, (SELECT unnest(generate_series(0, 40)) AS d) d),
sums AS (SELECT *, sum(n_bytes) OVER (PARTITION BY d, h >> ({BITS} - d)) AS s, count(*) OVER (PARTITION BY d, h >> ({BITS} - d)) AS c FROM depths),
leaf AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY d) AS k FROM sums WHERE s <= {LIMIT} OR c = 1)
SELECT doc_id, n_bytes, CASE WHEN d = 0 THEN '' ELSE right(bin(h >> ({BITS} - d) | (1::BIGINT << 62)), d::INT) END AS shard,
       d::INT AS depth, s::BIGINT AS shard_bytes, c::BIGINT AS shard_docs
FROM leaf WHERE k = 1
"""
