"""Clone, sub-clone and clonotype hierarchy with abundances, ranks, shares and display attributes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .numbering import numbered


def attach(clusters: DataFrame, reads: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(reads with cluster_id, cluster rows whose id is unknown)."""
    return clusters.join(reads, "sequence_id"), clusters.join(reads.select("sequence_id"), "sequence_id", "left_anti")


def subclones(rows: DataFrame) -> DataFrame:
    """A row per (cluster_id, v, j, CDR3): reads, clonotypes, first order."""
    out = rows.groupBy("cluster_id", "v_call", "j_call", "cdr3_aa")
    return out.agg(F.sum("occurrence").cast("long").alias("reads"), F.countDistinct("whole_seq").alias("clonotypes"), F.min("ordinal").alias("first_ordinal"))


def clonotypes(rows: DataFrame) -> DataFrame:
    """Rank of each read inside its sub-clone and its share of it, most abundant first, earlier read first among equal."""
    key = ["cluster_id", "v_call", "j_call", "cdr3_aa"]
    w = Window.partitionBy(*key)
    return rows.withColumn("rank", F.row_number().over(w.orderBy(F.col("occurrence").desc(), "ordinal"))).withColumn("share", F.col("occurrence") / F.sum("occurrence").over(w) * 100)


def ranked(subs: DataFrame, analysed: Column | None = None) -> DataFrame:
    """Sub-clones with clone reads, ranks of clone and sub-clone, shares of clone and repertoire, and display names."""
    per = Window.partitionBy("cluster_id")
    total = subs.agg(F.sum("reads").alias("total"))
    clones = subs.groupBy("cluster_id").agg(F.sum("reads").alias("clone_reads"), F.min("first_ordinal").alias("clone_first"))
    clones = numbered(clones, [F.col("clone_reads").desc(), F.col("clone_first"), F.col("cluster_id")], "clone_rank")
    s = subs.join(clones.withColumn("clone_rank", F.col("clone_rank").cast("int")), "cluster_id").crossJoin(F.broadcast(total))
    k = F.row_number().over(per.orderBy(F.col("reads").desc(), "first_ordinal"))
    s = s.withColumn("subclone_rank", k).withColumn("of_clone", F.col("reads") / F.col("clone_reads") * 100)
    s = s.withColumn("of_repertoire", F.col("reads") / (F.col("total") if analysed is None else analysed) * 100)
    return s.withColumn("clone_name", F.concat(F.lit("C"), "clone_rank")).withColumn("name", F.concat("clone_name", F.lit("-"), "subclone_rank")).withColumn("internal", F.concat_ws("_", "cluster_id", (F.col("subclone_rank") - 1).cast("string"))).drop("total", "clone_first")


def representative(rows: DataFrame, by: list[str]) -> DataFrame:
    """One row per ``by``: the most abundant with both sequences, else the most abundant; earlier first among equal."""
    both = F.coalesce((F.col("whole_seq") != "") & (F.col("germline_seq") != ""), F.lit(False))
    w = Window.partitionBy(*by).orderBy(both.desc(), F.col("occurrence").desc(), "ordinal")
    return rows.withColumn("_k", F.row_number().over(w)).where("_k = 1").drop("_k")


def top(ranks: DataFrame, clones: int | None = 5, subs: int | None = 200) -> DataFrame:
    keep = F.lit(True)
    if clones is not None:
        keep = keep & (F.col("clone_rank") <= clones)
    if subs is not None:
        keep = keep & (F.col("subclone_rank") <= subs)
    return ranks.where(keep)


def germline_choice(rows: DataFrame, by: list[str]) -> DataFrame:
    """The row whose germline roots the clone: best v, j, d identity, then reads; one with a germline if there is any, else the last."""
    has = F.coalesce(F.col("germline_seq") != "", F.lit(False))
    best = [F.col("v_identity").desc(), F.col("j_identity").desc(), F.col("d_identity").desc(), F.col("occurrence").desc(), F.col("ordinal")]
    last = [F.col("v_identity").asc(), F.col("j_identity").asc(), F.col("d_identity").asc(), F.col("occurrence").asc(), F.col("ordinal").desc()]
    n = rows.withColumn("_has", has).withColumn("_any", F.max(has).over(Window.partitionBy(*by)))
    n = n.withColumn("_up", F.row_number().over(Window.partitionBy(*by, "_has").orderBy(*best))).withColumn("_down", F.row_number().over(Window.partitionBy(*by).orderBy(*last)))
    return n.where(F.when(F.col("_any"), F.col("_has") & (F.col("_up") == 1)).otherwise(F.col("_down") == 1)).drop("_has", "_any", "_up", "_down")


def clone_style(rank0: Column, colours: int, styles: int = 3) -> dict[str, Column]:
    """Fill, stroke and style numbers of the clone of 0-based rank: fills up, strokes down, then styles."""
    return {"fill": rank0 % colours, "stroke": colours - 1 - F.floor(rank0 / colours) % colours, "style": F.floor(rank0 / (colours * colours)) % styles}


def subclone_style(rank0: Column, clone_fill: Column, colours: int, styles: int = 3) -> dict[str, Column]:
    """Fills down; strokes up from the clone's fill, then styles."""
    q = clone_fill + F.floor(rank0 / colours)
    return {"fill": colours - 1 - rank0 % colours, "stroke": q % colours, "style": F.floor(q / colours) % styles}


def cluster_lines(members: DataFrame) -> DataFrame:
    """(cluster_id, line): the ids of a cluster, by place, blank-separated."""
    ids = F.array_sort(F.collect_list(F.struct("pos", "sequence_id")))
    return members.groupBy("cluster_id").agg(F.array_join(F.transform(ids, lambda x: x["sequence_id"]), " ").alias("line"))
