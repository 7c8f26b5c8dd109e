"""FASTA with abundances in headers (``>id@reads``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.numbering import numbered


def parse_records(records: DataFrame) -> DataFrame:
    """(value, ordinal) of records without their ``>`` -> (id, abundance, sequence, ordinal)."""
    head = F.substring_index("value", "\n", 1)
    body = F.regexp_replace(F.substring(F.col("value"), F.length(head) + 2, F.length("value")), r"\s", "")
    parts = F.split(F.trim(F.regexp_replace(head, r"[\r>]", "")), "@")
    rows = records.where(F.trim("value") != "").select(F.get(parts, F.lit(0)).alias("id"), F.coalesce(F.get(parts, F.lit(1)).try_cast("long"), F.lit(1)).alias("abundance"), body.alias("sequence"), "ordinal")
    return rows


def read_records(spark: SparkSession, path: str) -> DataFrame:
    return parse_records(spark.read.text(path, lineSep=">").withColumn("ordinal", F.monotonically_increasing_id()))


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """(id, sequence, abundance, ordinal): a repeated id keeps its first sequence and adds up abundances."""
    return fold_ids(read_records(spark, path))


def fold_ids(rows: DataFrame) -> DataFrame:
    return rows.groupBy("id").agg(F.min_by("sequence", "ordinal").alias("sequence"), F.sum("abundance").cast("long").alias("abundance"), F.min("ordinal").alias("ordinal"))


def fold_sequences(rows: DataFrame) -> DataFrame:
    """(sequence, id, ids, abundance, ordinal): equal sequences fold into the first id."""
    ids = F.array_sort(F.collect_list(F.struct("ordinal", "id")))
    out = rows.groupBy("sequence").agg(ids.alias("x"), F.sum("abundance").cast("long").alias("abundance"))
    return out.select("sequence", F.get("x", F.lit(0))["id"].alias("id"), F.transform("x", lambda r: r["id"]).alias("ids"), "abundance", F.get("x", F.lit(0))["ordinal"].alias("ordinal"))


def lines(name: str = "name", sequence: str = "sequence", abundance: str | None = "abundance"):
    head = [F.lit(">"), F.col(name)] + ([F.lit("@"), F.col(abundance).cast("string")] if abundance else [])
    return F.concat(*head, F.lit("\n"), F.col(sequence))


def write_fasta(df: DataFrame, path: str, name: str = "name", sequence: str = "sequence", abundance: str | None = "abundance") -> None:
    df.select(lines(name, sequence, abundance).alias("value")).write.text(path)


def fold_named(rows: DataFrame, root: str = "germline") -> tuple[DataFrame, DataFrame]:
    """(sequences, map) of ``parse_records``: equal sequences fold into one named seq1, seq2, ... by first record, or
    ``root`` where an id holds that word; the map is (id, line) with the folded ids, tab- and comma-separated."""
    folded = numbered(fold_sequences(rows).withColumn("rooted", F.exists("ids", lambda x: F.contains(x, F.lit(root)))), [F.col("rooted"), F.col("ordinal")])
    name = F.when(F.col("rooted"), F.lit(root)).otherwise(F.concat(F.lit("seq"), F.col("number").cast("string")))
    folded = folded.select(name.alias("id"), "sequence", F.size("ids").cast("long").alias("abundance"), "ids", "ordinal")
    return folded.drop("ids"), folded.select("id", F.concat("id", F.lit("\t"), F.array_join("ids", ",")).alias("line"))
