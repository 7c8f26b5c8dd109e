"""The whole analysis: reads to clones, clones to lineage trees, and the outputs."""

from __future__ import annotations

import io
import json
import zipfile
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import validators as v
from ..operators import cluster, export, lineage, quality, refine, rollup
from ..operators.checkpoints import checkpointed
from ..sources import airr, fasta


@dataclass
class Settings:
    threshold: float = 1
    kind: str = "number"
    clones: int | None = 5
    subclones: int | None = 200
    alleles: bool = False
    identity: float = 70.0
    merge_singletons: bool = False
    trim: bool = False
    by_abundance: bool = True
    star: bool | None = None  # None: progressive alignment where the sub-clones have a limit
    distances: refine.Distances = refine.Distances()


@dataclass
class Result:
    accepted: DataFrame
    rejected: DataFrame
    statistics: DataFrame
    unique_ids: DataFrame
    clusters: DataFrame
    ranks: DataFrame
    clonotypes: DataFrame
    trees: DataFrame
    subclones: DataFrame  # of the first clones, with the germline of their clone
    every: DataFrame  # all sub-clones with what is shown of them


def there(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists in the store that it names."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def analyse(reads: DataFrame, s: Settings | None = None) -> Result:
    """``reads`` as ``airr.read_airr`` gives them."""
    s = s or Settings()
    flagged = checkpointed(reads.select("*", *[c.alias(k) for k, c in quality.completeness(airr.CLUSTER_NEEDS, airr.TREE_NEEDS).items()]))
    total = flagged.agg(F.coalesce(F.sum("occurrence"), F.lit(0))).first()[0]
    least = quality.minimum_reads(total, s.threshold, s.kind)
    accepted, rejected = quality.split_reads(flagged, least)
    accepted = checkpointed(accepted)
    labels = checkpointed(airr.labels(accepted, s.alleles))
    clusters = cluster.cluster_reads(labels, s.identity)
    reps = refine.representatives(labels).join(clusters, "sequence_id").select("cluster_id", F.col("sequence_id").alias("id"), "pos", "ordinal", "v_call", "cdr3_aa", "j_nt", "v_nt", "v_aa", "j_aa")
    refined = checkpointed(refine.expand(refine.refine(reps, merge_singletons=s.merge_singletons, kinds=s.distances), labels))
    identities = accepted.select("sequence_id", *[F.coalesce(c, F.lit(0.0)).alias(c) for c in airr.FLOATS], *airr.INTEGERS)
    rows, _ = rollup.attach(refined, labels.join(identities, "sequence_id"))
    key = ["cluster_id", "v_call", "j_call", "cdr3_aa"]
    ranks = checkpointed(rollup.ranked(rollup.subclones(rows)))
    one = rollup.representative(rows, key)
    names = {n: f"{n.rsplit('_', 1)[0]}_sequence_{n.rsplit('_', 1)[1]}" if n[0] in "vdj" else n for n in v.REGION_NAMES}
    positions = F.array(*v.running_maximum([v.region_offset(names[n], names["v_start"]) for n in v.REGION_NAMES]))
    clonotypes = rollup.clonotypes(rows)
    facts = one.select(*key, "sequence_id", export.productive_label("productive").alias("productive"), "whole_seq", "germline_seq", *airr.FLOATS, positions.alias("positions"))
    subs = checkpointed(export.display(ranks).join(facts, key).join(export.unique_reads(clonotypes), key))
    top = rollup.top(subs, s.clones, s.subclones)
    chosen = rollup.germline_choice(top.withColumn("occurrence", F.col("reads")).withColumn("ordinal", F.col("first_ordinal")), ["cluster_id"]).select("cluster_id", F.col("germline_seq").alias("germline"))
    top = checkpointed(top.join(chosen, "cluster_id"))
    unique = quality.unique_sequences(flagged.where("cluster_ok and quality_ok")).where(F.size("dup_ids") > 0)
    return Result(accepted, rejected, quality.filter_statistics(flagged, least), unique, refined, ranks, clonotypes, lineage.lineages(top, s.trim, by_abundance=s.by_abundance, star=s.subclones is None if s.star is None else s.star), top, subs)


def write(result: Result, path: str, name: str) -> None:
    """Tables as Parquet or tab-separated text, trees as JSON lines, sequences as FASTA, below ``path``, which must not exist."""
    airr.write_tsv(result.rejected, f"{path}/{name}_unannotated_seq")
    airr.write_tsv(result.unique_ids.select("ref_id", "dup_ids"), f"{path}/{name}_unique_seq_id_matching")
    result.statistics.write.json(f"{path}/{name}_log")
    export.name_map(result.ranks).orderBy("clone_rank").select("line").write.text(f"{path}/{name}_matching_names")
    result.clonotypes.write.parquet(f"{path}/{name}_clonotypes")
    trees = checkpointed(result.trees)
    trees.write.partitionBy("complexity").parquet(f"{path}/{name}_tree_edges")
    export.newick_trees(trees).write.partitionBy("complexity").json(f"{path}/{name}_newick")
    export.tree_json(trees, result.subclones).write.partitionBy("complexity").json(f"{path}/{name}_trees")
    export.clone_json(result.every).write.parquet(f"{path}/{name}_repertoire")
    last = trees.where("complexity = 'simplification2' and not silent").select(F.concat(F.lit("C"), "clone_rank").alias("clone"), F.col("child").alias("name"), F.col("aligned").alias("sequence"), "abundance")
    last.where(F.col("name") != lineage.GERMLINE).select("clone", fasta.lines().alias("value")).write.partitionBy("clone").text(f"{path}/{name}_subclones_fasta")
    last.where(F.col("name") == lineage.GERMLINE).select("clone", F.concat(F.lit(">HAUS\n"), "sequence").alias("value")).write.partitionBy("clone").text(f"{path}/{name}_HAUS_fasta")


def bundle(result: Result, target: str, name: str) -> None:
    """A zip on the driver's disk: repertoire and tree JSON, FASTA and the statistics; trees are of the first clones only."""
    statistics = result.statistics.first().asDict()
    trees = checkpointed(result.trees)
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        entry = lambda n: io.TextIOWrapper(z.open(f"{name}_{n}", "w"), "utf-8")
        with entry("repertoire.json") as out:
            export.write_repertoire(export.clone_json(result.every), statistics, out)
        with entry("log.json") as out:
            json.dump(statistics, out, indent=4)
        for kind in ("all", "simplification1", "simplification2"):
            with entry(f"tree_{kind}.json") as out:
                for k, r in enumerate(export.tree_json(trees.where(F.col("complexity") == kind), result.subclones).orderBy("clone_rank").toLocalIterator()):
                    out.write(("," if k else "[") + r.json)
                out.write("]" if trees.count() else "[]")
        last = trees.where("complexity = 'simplification2' and not silent").withColumn("root", F.col("child") == lineage.GERMLINE)
        held, at = None, None
        for r in last.orderBy("clone_rank", "root", "child").toLocalIterator():
            kind, head = ("HAUS_sequence", "HAUS") if r.root else ("subclones_sequences", f"{r.child}@{r.abundance}")
            file = f"C{r.clone_rank}_{kind}.fasta"
            if at != file:
                if held:
                    held.close()
                held, at = entry(file), file
            held.write(f">{head}\n{r.aligned}\n")
        if held:
            held.close()


def run(spark: SparkSession, source: str, path: str, settings: Settings | None = None, name: str = "analysis") -> Result:
    """Analyse ``source`` and write below ``path``. The input must be there and the output folder not, which is checked first."""
    if not there(spark, source):
        raise FileNotFoundError(source)
    if there(spark, path):
        raise FileExistsError(path)
    result = analyse(airr.read_airr(spark, source), settings)
    write(result, path, name)
    return result
