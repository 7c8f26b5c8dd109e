"""Collapsing, validation, filtering, deduplication and statistics of reads."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import validators as v

MISSING, POOR, BOTH, FEW = "Missing annotation", "Poor quality sequence", "Missing annotation and poor quality sequence", "Number of reads below the threshold"


def merge_lines(df: DataFrame, id_col: str, order_col: str) -> DataFrame:
    """Rows equal in all other columns become one: ids in ``old_ids`` by order, their number, the smallest order."""
    keys = [c for c in df.columns if c not in (id_col, order_col)]
    folded = df.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(order_col, id_col))).alias("ids"))
    return folded.select(*keys, F.transform("ids", lambda x: x[id_col]).alias("old_ids"), F.size("ids").alias("occurrence"), F.get("ids", F.lit(0))[order_col].alias(order_col))


def missing_columns(found: list[str], cluster: list[str], tree: list[str]) -> tuple[str, list[str]]:
    """("cluster" | "tree" | "none", names): the first kind of required column that is lacking."""
    for kind, need in (("cluster", cluster), ("tree", tree)):
        if lack := [c for c in need if c not in found]:
            return kind, lack
    return "none", []


def completeness(cluster_columns: list[str], tree_columns: list[str], sequence: str = "whole_seq") -> dict[str, Column]:
    """Flags: cluster annotations filled; tree annotations filled, looked at only if a cluster one lacks; quality."""
    cluster = v.all_filled(cluster_columns)
    quality = v.filled(sequence) & ~F.contains(F.lower(F.coalesce(sequence, F.lit(""))), F.lit("n"))
    return {"cluster_ok": cluster, "tree_ok": cluster | v.all_filled(tree_columns), "quality_ok": quality}


def reject_reason(cluster_ok="cluster_ok", quality_ok="quality_ok") -> Column:
    c, q = v._c(cluster_ok), v._c(quality_ok)
    return F.when(~c & ~q, BOTH).when(~c, MISSING).when(~q, POOR)


def minimum_reads(total: int, threshold: float, kind: str) -> int:
    """Reads that a sequence must exceed: a percentage below 2, a number below half of all reads, otherwise 1."""
    if kind == "percentage":
        return round(threshold * total / 100) if threshold < 2 else 1
    if kind == "number":
        return int(threshold) if threshold < total / 2 else 1
    return int(round(0.005 * total) / 100)


def minimum_reads_column(total: Column, threshold: float, kind: str) -> Column:
    """``minimum_reads`` of a column of totals."""
    if kind == "percentage":
        return F.rint(threshold * total / 100).cast("long") if threshold < 2 else F.lit(1).cast("long")
    if kind == "number":
        return F.when(F.lit(threshold) < total / 2, F.lit(math.floor(threshold))).otherwise(1).cast("long")
    return F.floor(F.rint(0.005 * total) / 100).cast("long")


def unique_sequences(reads: DataFrame, sequence: str = "whole_seq", id_col: str = "sequence_id", order_col: str = "ordinal") -> DataFrame:
    """A row per sequence: first id, the other ids by order, summed occurrence, smallest order."""
    ids = F.array_sort(F.collect_list(F.struct(order_col, id_col)))
    out = reads.groupBy(sequence).agg(ids.alias("ids"), F.sum("occurrence").cast("long").alias("occurrence"))
    first = F.get("ids", F.lit(0))
    return out.select(sequence, first[id_col].alias("ref_id"), F.transform(F.slice("ids", 2, F.greatest(F.size("ids") - 1, F.lit(0))), lambda x: x[id_col]).alias("dup_ids"), "occurrence", first[order_col].alias(order_col))


def split_reads(reads: DataFrame, least: int, sequence: str = "whole_seq") -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) of reads with flags: an accepted sequence keeps the first read's annotations and all reads' occurrence."""
    good = F.col("cluster_ok") & F.col("quality_ok")
    bad = reads.where(~good).withColumn("criteria", reject_reason()).withColumn("minimum_ok", F.col("occurrence") >= least)
    unique = Window.partitionBy(sequence)
    one = reads.where(good).withColumn("_all", F.sum("occurrence").over(unique)).withColumn("_k", F.row_number().over(unique.orderBy("ordinal")))
    one = one.where("_k = 1").withColumn("occurrence", F.col("_all").cast("long")).drop("_k", "_all")
    few = one.where(F.col("occurrence") <= least).withColumn("criteria", F.lit(FEW)).withColumn("minimum_ok", F.lit(False))
    return one.where(F.col("occurrence") > least), bad.withColumn("occurrence", F.col("occurrence").cast("long")).unionByName(few)


def filter_statistics(reads: DataFrame, least: int, sequence: str = "whole_seq") -> DataFrame:
    """One row over ``reads`` with flags: totals, reads failing each criterion, reads by number of failed criteria, reads
    failing only the tree one, as ``split_reads`` parts them.

    One pass: reads of accepted flags are summed by sequence, all others fall into one group of map-side sums."""
    good = F.col("cluster_ok") & F.col("quality_ok")
    n = F.col("occurrence")
    flags = {"cluster": ~F.col("cluster_ok"), "tree": ~F.col("tree_ok"), "quality": ~F.col("quality_ok"), "minimum": n < least}
    failed = sum(c.cast("int") for c in flags.values())
    only_tree = flags["tree"] & (failed == 1)
    names = ["one", "two", "three", "four"]
    tests = {f"{k}_failed": c for k, c in flags.items()} | {f"failed_{w}": failed == k + 1 for k, w in enumerate(names)} | {"only_tree": only_tree, "filtered": ~only_tree}
    per = reads.groupBy(good.alias("good"), F.when(good, F.col(sequence)).alias("key")).agg(F.sum(n).alias("n"), *[F.sum(F.when(c & ~good, n)).alias(k) for k, c in tests.items()])
    # A sequence of too few reads fails the last criterion alone.
    few = F.when(F.col("good") & (F.col("n") <= least), F.col("n"))
    whole = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    sums = {k: whole(k) + whole(few) if k in ("minimum_failed", "failed_one", "filtered") else whole(k) for k in tests}
    total = whole("n")
    return per.agg(total.alias("total"), (total - sums["filtered"]).alias("analysed"), F.lit(least).cast("long").alias("least"), *[c.alias(k) for k, c in sums.items()])
