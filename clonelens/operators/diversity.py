"""Diversity of cluster sizes and k-mer counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.distances import kmers
from .numbering import numbered


def gini(sizes: DataFrame, size: str = "n") -> DataFrame:
    """One row: the Gini coefficient of ``size``. Equal sizes are counted first, so ranks need one row per distinct size."""
    by = sizes.groupBy(F.col(size).cast("double").alias("x")).agg(F.count("*").alias("m"))
    before = Window.orderBy("x").rowsBetween(Window.unboundedPreceding, -1)
    by = by.withColumn("before", F.coalesce(F.sum("m").over(before), F.lit(0)))
    # Ranks before+1 .. before+m of equal sizes sum to m * before + m (m + 1) / 2.
    ranks = F.col("x") * (F.col("m") * F.col("before") + F.col("m") * (F.col("m") + 1) / 2)
    n, total = F.sum("m"), F.sum(F.col("x") * F.col("m"))
    return by.agg((2 * F.sum(ranks) / (n * total) - (n + 1) / n).alias("gini"))


def lorenz(sizes: DataFrame, size: str = "n") -> DataFrame:
    """(rank, share): cumulative share of ascending sizes, from rank 0 with share 0; one row a cluster."""
    rows = numbered(sizes.select("cluster_id", F.col(size).alias("x")), [F.col("x"), F.col("cluster_id")], "rank", running="x")
    total = sizes.agg(F.sum(size).alias("total"))
    rows = rows.crossJoin(F.broadcast(total)).select(F.col("rank").cast("int").alias("rank"), (F.col("x_sum") / F.col("total")).alias("share"))
    return rows.unionByName(total.where("total is not null").select(F.lit(0).alias("rank"), F.lit(0.0).alias("share")))


def distribution(sizes: DataFrame, size: str = "n", line: float = 0.05) -> DataFrame:
    """(cluster_id, n, share, above): share of all, and whether it is above ``line``."""
    share = F.col(size) / F.col("total")
    rows = sizes.crossJoin(F.broadcast(sizes.agg(F.sum(size).alias("total"))))
    return rows.select("cluster_id", F.col(size).alias("n"), share.alias("share"), (share > line).alias("above"))


def uniformity_by_size(sizes: DataFrame, uniformity: DataFrame) -> DataFrame:
    return sizes.join(uniformity, "cluster_id", "left").select("cluster_id", "n", F.coalesce("uniformity", F.lit(0.0)).alias("uniformity"))


def density_index(nearest: DataFrame) -> DataFrame:
    """One row: per cluster n times the summed relative deviation of least distances from their mean, over all members.

    ``density_index`` takes deviations by sign, so that they cancel and it is 0 but for rounding; ``spread`` takes their sizes."""
    mean = F.avg("nearest").over(Window.partitionBy("cluster_id"))
    dev = nearest.select("cluster_id", F.when(mean != 0, (F.col("nearest") - mean) / mean).otherwise(0.0).alias("d"))
    per = dev.groupBy("cluster_id").agg((F.count("*") * F.sum("d")).alias("x"), (F.count("*") * F.sum(F.abs("d"))).alias("y"), F.count("*").alias("n"))
    return per.agg((F.sum("x") / F.sum("n")).alias("density_index"), (F.sum("y") / F.sum("n")).alias("spread"))


def kmer_counts(df: DataFrame, column: str, k: int) -> DataFrame:
    return df.select(F.explode(kmers(column, k)).alias("kmer")).groupBy("kmer").agg(F.count("*").alias("n"))
