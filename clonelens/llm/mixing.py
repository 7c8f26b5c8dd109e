"""Mixing sources to target weights.

Every document gets a hash-random key. Keys are cut into ranges (buckets) of equal expected row count, rows are sorted
by key inside (source, bucket), and a prefix sum runs in two levels: over the bucket totals of a source, then over the
rows of one bucket. A source's budget is cut at its exact word: whole epochs first, then a prefix of the key order.

Defined results: a null or empty text has size 0 and takes 0; a null source is a source of its own and sorts last;
repeated rows count as rows of their own; ties of key are broken by id, size and a hash of the text; a row without
id has the key of its text; an empty table gives no rows; columns
other than the named ones are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, text_of

WORD = r"[^\x20\x09-\x0D]+"
MAX_EPOCHS = 3
SEED = 17
KEY_BITS = 60
ROWS_A_BUCKET = 4_000


def n_words(text: str = "text") -> Column:
    return F.regexp_count(text_of(text), F.lit(WORD)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size) -> with target: shares by weight, filled up to max_epochs times the source.

    The fill level v solves sum(min(cap, weight * v)) = total: sources reach their caps in order of cap / weight, so a
    running sum over that order names the sources that are full. One row a source, in one task.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    rank = (F.row_number().over(by_name) - 1) % len(weights)
    caps = sizes.select(
        "source", "source_size", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank + 1).cast("int")).alias("weight"), (F.col("source_size") * max_epochs).cast("double").alias("cap")
    )
    order = Window.orderBy((F.col("cap") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    level = caps.select(
        "*",
        F.sum("source_size").over(every).cast("double").alias("total"),
        F.coalesce(F.sum("cap").over(before), F.lit(0.0)).alias("full_caps"),
        (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))).alias("open_weight"),
    ).withColumn("v", (F.col("total") - F.col("full_caps")) / F.col("open_weight"))
    # The first source in the order that its share leaves below its cap sets the level for all after it.
    level = level.withColumn("at", F.row_number().over(order))
    first = F.min(F.when(F.col("weight") * F.col("v") <= F.col("cap"), F.struct("at", "v"))).over(every)
    return level.select("source", "source_size", F.least("cap", F.col("weight") * F.coalesce(first["v"], F.col("v"))).alias("target"))


def _keyed(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: int, buckets: int, *more: Column) -> DataFrame:
    """Rows (id, source, size, key, bucket) and ``more``."""
    name = F.coalesce(F.col(id_col).cast("string"), text_of(text_col))
    key = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), name)), 1, KEY_BITS // 4), 16, 10).cast("long")
    rows = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), n_words(text_col).alias("size"), key.alias("key"), F.xxhash64(text_of(text_col)).alias("tie"), *more)
    # Uniform keys: a range of keys is a multiple of 2^KEY_BITS / buckets, so no sampling pass is needed to find the ranges.
    return rows.withColumn("bucket", F.floor((F.col("key") / F.lit(float(1 << KEY_BITS))) * buckets).cast("long"))


def _take(rows: DataFrame, small: DataFrame, weights: tuple[int, ...], max_epochs: int) -> DataFrame:
    """``rows`` with source_size, target and taken; ``small`` has the same rows' source, bucket and size."""
    sums = small.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size"))
    targets = source_targets(sums.groupBy("source").agg(F.sum("bucket_size").alias("source_size")), weights, max_epochs)
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("ahead", F.coalesce(F.sum("bucket_size").over(before), F.lit(0)))
    t, s = targets.alias("t"), sums.alias("s")
    plan = s.join(t, F.col("s.source").eqNullSafe(F.col("t.source"))).select(F.col("s.source").alias("b_source"), F.col("s.bucket").alias("b_bucket"), "ahead", "source_size", "target")
    joined = rows.join(plan, F.col("source").eqNullSafe(F.col("b_source")) & (F.col("bucket") == F.col("b_bucket")))
    inside = Window.partitionBy("source", "bucket").orderBy("key", F.col("id").asc_nulls_first(), "size", "tie").rowsBetween(Window.unboundedPreceding, -1)
    budget = F.floor(F.col("target") + F.lit(1e-6)).cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size")).cast("long")).otherwise(0)
    start = F.col("ahead") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    rest = budget - epochs * F.col("source_size") - start
    taken = epochs * F.col("size") + F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), rest))
    return joined.withColumn("taken", taken.cast("long"))


def _buckets(docs: DataFrame, rows_a_bucket: int) -> int:
    return max(1, -(-docs.count() // rows_a_bucket))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = (1, 2, 3), max_epochs: int = MAX_EPOCHS, seed: int = SEED, rows_a_bucket: int = ROWS_A_BUCKET) -> DataFrame:
    """Rows (id, source, size, source_size, target, taken): ``taken`` counts the words that the mix takes of a row, repeats included."""
    rows = materialize(_keyed(docs, id_col, text_col, source_col, seed, _buckets(docs, rows_a_bucket)), "mix")
    return _take(rows, rows, weights, max_epochs).select("id", "source", "size", "source_size", "target", "taken")


def apply_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = (1, 2, 3), max_epochs: int = MAX_EPOCHS, seed: int = SEED, rows_a_bucket: int = ROWS_A_BUCKET, length_col: str = "n_chars") -> DataFrame:
    """The mixed rows with all columns of ``docs``: a row for each time that a document is taken whole, and for the
    document at a source's edge one more row whose text ends with the last word of the budget."""
    buckets = _buckets(docs, rows_a_bucket)
    keyed = lambda *more: _keyed(docs, id_col, text_col, source_col, seed, buckets, *more)
    small = materialize(keyed().select("source", "bucket", "size"), "mix")
    whole = keyed(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    times = F.ceil(F.col("taken") / F.greatest("size", F.lit(1))).cast("int")
    rows = _take(whole, small, weights, max_epochs).where("taken > 0").select("doc", "size", "taken", F.explode(F.sequence(F.lit(1), times)).alias("at"))
    rest = F.col("taken") - (F.col("at") - 1) * F.col("size")
    cut = F.array_join(F.slice(F.regexp_extract_all(F.col("doc")[text_col], F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0)), 1, rest.cast("int")), "")
    shorter = F.col("doc").withField(text_col, cut)
    if length_col in docs.columns:
        shorter = shorter.withField(length_col, F.char_length(cut).cast(docs.schema[length_col].dataType))
    return rows.select(F.when(rest < F.col("size"), shorter).otherwise(F.col("doc")).alias("doc")).select("doc.*")


def op7_mixing(spark, sf_dir: str) -> DataFrame:
    from .common import table

    return mix(table(spark, sf_dir, "documents")).select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


OP7_SQL = f"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5('{SEED}:' || coalesce(doc_id::VARCHAR, text, '')), 1, {KEY_BITS // 4}))::BIGINT AS key FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::DOUBLE AS weight, ({MAX_EPOCHS} * source_size)::DOUBLE AS cap FROM s),
o AS (
  SELECT *, row_number() OVER r AS k, (sum(source_size) OVER ())::DOUBLE AS total,
         coalesce(sum(cap) OVER (r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS full_caps,
         sum(weight) OVER () - coalesce(sum(weight) OVER (r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS open_weight
  FROM w WINDOW r AS (ORDER BY cap / weight, source NULLS LAST)),
v AS (SELECT *, (total - full_caps) / open_weight AS v FROM o),
level AS (SELECT arg_min(v, k) AS level FROM v WHERE weight * v <= cap),
t AS (SELECT source, source_size, least(cap, weight * coalesce(level, v)) AS target FROM v, level),
p AS (
  SELECT d.*, source_size, target, floor(target + 1e-6)::BIGINT AS budget,
         coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id NULLS FIRST, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
e AS (SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS epochs FROM p)
SELECT doc_id, size, source_size, target, (epochs * size + greatest(0, least(size, budget - epochs * source_size - ahead)))::BIGINT AS taken FROM e
"""
