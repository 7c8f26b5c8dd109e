"""Annotated-read tables (tab-separated, header, no quoting) as typed DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import validators as v
from ..operators.numbering import numbered
from ..operators.quality import merge_lines, missing_columns

# The columns of the input format, by what they are needed for.
CLUSTER = ["sequence_id", "sequence", "productive", "v_call", "j_call", "cdr3_aa", "v_sequence_alignment", "j_sequence_alignment", "v_sequence_alignment_aa", "j_sequence_alignment_aa"]
GERMLINE = ["v_germline_alignment", "np1", "d_germline_alignment", "np2", "j_germline_alignment"]
REGIONS = ["fwr1", "cdr1", "fwr2", "cdr2", "fwr3", "cdr3", "fwr4"]
INTEGERS = [f"{g}_sequence_{e}" for g in "vdj" for e in ("start", "end")] + [f"cdr{i}_{e}" for i in (1, 2, 3) for e in ("start", "end")] + [f"fwr{i}_{e}" for i in (1, 2, 3, 4) for e in ("start", "end")]
FLOATS = ["v_identity", "d_identity", "j_identity"]
NUCLEOTIDES = ["sequence", "sequence_alignment", "germline_alignment", "junction", *REGIONS, "np1", "np2", *[f"{g}_{k}_alignment" for g in "vdj" for k in ("sequence", "germline")]]
AMINO_ACIDS = ["cdr3_aa", *[f"{g}_sequence_alignment_aa" for g in "vdj"]]
TREE = ["np1", "np2", *FLOATS, *[c for c in INTEGERS if c[0] in "vdj"], *[f"cdr{i}_{e}" for i in (1, 2, 3) for e in ("start", "end")], *[f"{g}_germline_alignment" for g in "vdj"]]
# What a row needs filled, apart from its id.
CLUSTER_NEEDS = [c for c in CLUSTER if c not in ("sequence_id", "sequence")]
TREE_NEEDS = [c for c in TREE if c not in ("np1", "np2")]


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """All columns as text, with ``ordinal`` in file order."""
    df = spark.read.option("sep", "\t").option("header", True).option("quote", "").option("nullValue", "\x00").csv(path)
    kind, lack = missing_columns(df.columns, CLUSTER, TREE)
    if kind == "cluster":
        raise ValueError(f"columns needed for clustering are missing: {', '.join(lack)}")
    return df.withColumn("ordinal", F.monotonically_increasing_id())


def typed(df: DataFrame) -> DataFrame:
    """Text columns checked and cast; columns that the table lacks are null; sequences and germline put together."""
    has = set(df.columns)
    raw = lambda c: F.col(c) if c in has else F.lit(None).cast("string")
    cols = [v.nucleotides(raw(c)).alias(c) for c in NUCLEOTIDES] + [v.amino_acids(raw(c)).alias(c) for c in AMINO_ACIDS]
    cols += [v.integer(raw(c)).alias(c) for c in INTEGERS] + [v.floating(raw(c)).alias(c) for c in FLOATS]
    cols += [v.boolean(raw("productive")).alias("productive"), v.gene(raw("v_call"), "IGHV").alias("v_call"), v.gene(raw("j_call"), "IGHJ").alias("j_call")]
    out = df.select("sequence_id", "old_ids", "occurrence", "ordinal", *cols)
    return out.withColumn("whole_seq", v.joined(REGIONS)).withColumn("germline_seq", v.joined(GERMLINE, gaps=False))


def read_airr(spark: SparkSession, path: str) -> DataFrame:
    """The table with equal lines merged, ids seq1, seq2, ... by first line, and typed columns."""
    merged = merge_lines(read_lines(spark, path), "sequence_id", "ordinal")
    merged = numbered(merged, [F.col("ordinal")]).withColumn("sequence_id", F.concat(F.lit("seq"), F.col("number").cast("string"))).drop("number")
    return typed(merged)


def labels(reads: DataFrame, alleles: bool = False) -> DataFrame:
    """Columns that clustering reads: genes without allele, CDR3 with ``#`` as dot, gap-free V and J sequences."""
    call = (lambda c: F.col(c)) if alleles else v.strip_allele
    return reads.select(
        "sequence_id", "ordinal", "productive", call("v_call").alias("v_call"), call("j_call").alias("j_call"), v.normalise_cdr3("cdr3_aa").alias("cdr3_aa"),
        v.strip_gaps("j_sequence_alignment").alias("j_nt"), v.strip_gaps("v_sequence_alignment").alias("v_nt"), v.strip_gaps("j_sequence_alignment_aa").alias("j_aa"), v.strip_gaps("v_sequence_alignment_aa").alias("v_aa"), "occurrence", "whole_seq", "germline_seq",
    )


def write_tsv(df: DataFrame, path: str) -> None:
    """Tab-separated with header; arrays become ``;``-joined text. Fails if ``path`` exists."""
    flat = [F.array_join(c, ";").alias(c) if t.startswith("array") else F.col(c) for c, t in df.dtypes]
    df.select(*flat).write.option("sep", "\t").option("header", True).option("quote", "").csv(path)
