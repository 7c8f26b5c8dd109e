"""The corpus pipeline: toxicity, near-duplicates, benchmark decontamination, mixing, token blocks.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next
one's docs. All but the last return the columns of documents, with the dtype and order of their input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clonelens.llm import decontaminate, mixing, ngram_join, pfor, toxicity
from clonelens.llm.common import materialize, shared_path, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose toxicity score is below one half; the classifier learns from labelled rows of ``docs``."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score_docs(docs, model).where(F.col("score") < 0.5).select("doc.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each class of near-duplicates: of the smallest id, null ids last, and the smallest hash.

    Rows without words are in no class and stay."""
    found = ngram_join.classed(docs)
    place = F.struct(F.col("id").isNull().alias("last"), "id", "hash")
    best = found.where("label is not null").groupBy("label").agg(F.min(place).alias("m")).select("m.id", "m.hash", F.lit(False).alias("alone"))
    keep = best.unionByName(found.where("label is null").select("id", "hash", F.lit(True).alias("alone")).distinct())
    known = lambda c: F.coalesce(F.col(c).cast("long"), F.lit(0))
    keep = materialize(keep.select(known("id").alias("k_id"), F.col("hash").alias("k_hash"), "alone"), "keep")
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), known("doc_id").alias("d_id"), ngram_join.row_hash("doc_id", "text").alias("d_hash"))
    named = packed.join(keep, (F.col("d_id") == F.col("k_id")) & (F.col("d_hash") == F.col("k_hash")))
    # Of rows of one id and text one stays; each row without words is a group of its own.
    named = named.withColumn("d_own", F.when(F.col("alone"), F.monotonically_increasing_id()))
    first = F.row_number().over(Window.partitionBy("d_id", "d_hash", "d_own").orderBy(F.xxhash64("doc")))
    return named.withColumn("d_row", first).where("d_row = 1").select("doc.*")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents in which no window of a benchmark item occurs."""
    found = decontaminate.leaks_of(docs, table(spark, sf_dir, "benchmark"))
    return found.where(F.size("hits") == 0).select("doc.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats each document as often as the mix takes it whole; the document at a budget's edge comes once more, cut at the exact word."""
    return mixing.apply_mix(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the mixed rows in patched frame-of-reference files, read back: doc_id, start, n_tokens, ids_crc32."""
    path = shared_path(spark, "pfor")
    pfor.write_ids(docs, path, pfor.token_file())
    return pfor.read_ids(spark, path).withColumnRenamed("id", "doc_id")


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("token_blocks", write_tokens),
]

# The stages are a trained classifier, hashed candidate search and a tokeniser: SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet in the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
