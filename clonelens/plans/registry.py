"""Queries of the repertoire operators over the fixture views, each with the SQL that gives the same rows where SQL can."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import distances as d
from ..functions import validators as v
from ..operators import blocking, cluster, contract, diversity, export, lineage, median, quality, refine, rollup, spanning, treeops, vectors
from ..operators.checkpoints import checkpoint_folder
from ..operators.numbering import numbered
from ..sources import airr, fasta
from . import fixtures as fx

WITH1 = f"with f1 as ({fx.F1})"
WITH2 = f"with f1 as ({fx.F1}), f2 as ({fx.F2})"
WITH3 = f"with recursive f3 as ({fx.F3})"
_QUERIES: dict = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(fn):
        _QUERIES[fn.__name__] = fn
        if sql:
            _SQL[fn.__name__] = sql
        return fn

    return add


def queries() -> dict:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def r6(c):
    return F.round(v._c(c), 6)


# --- sources, projections, filters -------------------------------------------------------------------------------------


@query(f"select line, string_agg(cast(event_id as varchar), ';' order by event_id) as old_ids, count(*)::int as occurrence, min(event_id) as event_id from ({fx.F4}) group by line")
def collapse_lines(spark, sf):
    rows = fx.f4(spark, sf).withColumn("ordinal", F.col("event_id"))
    out = quality.merge_lines(rows, "event_id", "ordinal")
    return out.select("line", F.array_join(F.col("old_ids").cast("array<string>"), ";").alias("old_ids"), "occurrence", F.col("ordinal").alias("event_id"))


AIRR = f"{WITH1}, l as (select sequence_id, whole_seq as sequence, case when ordinal % 4 = 0 then 'F' else 'T' end as productive, concat(v_call, '*01') as v_call, concat(j_call, '*02') as j_call, cdr3_aa, substr(whole_seq, 1, 30) as v_sequence_alignment, substr(whole_seq, 40, 20) as j_sequence_alignment, 'ACD' as v_sequence_alignment_aa, 'WYV' as j_sequence_alignment_aa from f1)"


@query(f"{AIRR} select v_call, j_call, productive = 'T' as productive, cdr3_aa, upper(sequence) as sequence, count(*)::int as occurrence, count(*)::int as ids from l group by all")
def airr_file(spark, sf):
    """A tab-separated file of reads, written in parts and read back: equal lines merged, columns checked and typed."""
    lines = fx.view(spark, sf, AIRR.split("l as (", 1)[1][:-1], f1=fx.f1(spark, sf))
    path = f"{checkpoint_folder(spark).rstrip('/')}/airr-{uuid.uuid4().hex}"
    airr.write_tsv(lines, path)
    return airr.read_airr(spark, path).select("v_call", "j_call", "productive", "cdr3_aa", F.upper("sequence").alias("sequence"), F.col("occurrence").cast("int").alias("occurrence"), F.size("old_ids").alias("ids"))


@query(f"{WITH1} select sequence_id, row_number() over (order by ordinal) as number, concat('seq', cast(row_number() over (order by ordinal) as varchar)) as new_id from f1")
def read_ids(spark, sf):
    return numbered(fx.f1(spark, sf), [F.col("ordinal")]).select("sequence_id", "number", F.concat(F.lit("seq"), F.col("number").cast("string")).alias("new_id"))


@query(f"{WITH2} select sequence_id, replace(list_filter(string_split(v_raw, ' '), lambda x: upper(x[1:4]) = 'IGHV')[1], ',', '') as v_call from f2")
def gene_call_parse(spark, sf):
    return fx.f2(spark, sf).select("sequence_id", v.gene("v_raw", "IGHV").alias("v_call"))


@query(
    f"""{WITH2} select sequence_id,
 case when regexp_matches(v_start_raw, '^\\s*[+-]?[0-9]+(_[0-9]+)*\\s*$') then try_cast(replace(trim(v_start_raw), '_', '') as int) end as v_start,
 case when regexp_matches(v_identity_raw, '^\\s*[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?\\s*$') then try_cast(trim(v_identity_raw) as double) end as v_identity,
 case when lower(trim(productive_raw)) in ('t', 'true') then true when lower(trim(productive_raw)) in ('f', 'false') then false end as productive,
 case when regexp_matches(lower(seq_raw), '^[actgn.\\-]*$') then lower(seq_raw) end as nt, case when regexp_matches(upper(cdr3_raw), '^[ACDEFGHIKLMNPQRSTVWYX*\\-#.]*$') then upper(cdr3_raw) end as aa from f2"""
)
def validate_types(spark, sf):
    return fx.f2(spark, sf).select(
        "sequence_id", v.integer("v_start_raw").alias("v_start"), v.floating("v_identity_raw").alias("v_identity"), v.boolean("productive_raw").alias("productive"), v.nucleotides("seq_raw").alias("nt"), v.amino_acids("cdr3_raw").alias("aa")
    )


@query(f"{WITH2} select sequence_id, split_part(v_raw, '*', 1) as gene, replace('a..b' || sequence_id, '.', '') as gapless, translate('#' || cdr3_raw, '#', '.') as cdr3, concat(coalesce(v_raw, ''), coalesce(seq_raw, '')) as whole from f2")
def strip_allele(spark, sf):
    rows = fx.f2(spark, sf)
    return rows.select("sequence_id", v.strip_allele("v_raw").alias("gene"), v.strip_gaps(F.concat(F.lit("a..b"), "sequence_id")).alias("gapless"), v.normalise_cdr3(F.concat(F.lit("#"), "cdr3_raw")).alias("cdr3"), v.joined(["v_raw", "seq_raw"]).alias("whole"))


def _flagged(spark, sf) -> DataFrame:
    rows = fx.f2(spark, sf).select(
        "sequence_id", "ordinal", "occurrence", v.gene("v_raw", "IGHV").alias("v_call"), "j_call", F.col("cdr3_raw").alias("cdr3_aa"), v.nucleotides("seq_raw").alias("whole_seq"), v.floating("v_identity_raw").alias("v_identity"), v.integer("v_start_raw").alias("v_start")
    )
    return rows.select("*", *[c.alias(k) for k, c in quality.completeness(["v_call", "j_call", "cdr3_aa"], ["v_identity", "v_start"]).items()])


FLAGS = f"""{WITH2}, raw as (
 select sequence_id, ordinal, occurrence, replace(list_filter(string_split(v_raw, ' '), lambda x: upper(x[1:4]) = 'IGHV')[1], ',', '') as v_call, j_call, cdr3_raw as cdr3_aa,
  case when regexp_matches(lower(seq_raw), '^[actgn.\\-]*$') then lower(seq_raw) end as whole_seq,
  regexp_matches(v_identity_raw, '^[0-9]+$') and regexp_matches(v_start_raw, '^[0-9]+$') as tree_full from f2),
flags as (select *, (coalesce(v_call, '') <> '' and coalesce(j_call, '') <> '' and coalesce(cdr3_aa, '') <> '') as cluster_ok,
  (coalesce(whole_seq, '') <> '' and not contains(whole_seq, 'n')) as quality_ok from raw),
f as (select *, cluster_ok or tree_full as tree_ok from flags)"""


@query(f"{FLAGS} select sequence_id, cluster_ok, tree_ok, quality_ok from f")
def completeness_filter(spark, sf):
    return _flagged(spark, sf).select("sequence_id", "cluster_ok", "tree_ok", "quality_ok")


@query(f"{FLAGS} select sequence_id, case when not cluster_ok and not quality_ok then 'Missing annotation and poor quality sequence' when not cluster_ok then 'Missing annotation' when not quality_ok then 'Poor quality sequence' end as criteria from f")
def reject_reasons(spark, sf):
    return _flagged(spark, sf).select("sequence_id", quality.reject_reason().alias("criteria"))


@query(f"{WITH1}, t as (select sum(occurrence) as total from f1) select k, case k when 'p' then cast(round_even(0.5 * total / 100, 0) as bigint) when 'n' then case when 3 < total / 2 then 3 else 1 end else cast(floor(round_even(0.005 * total, 0) / 100) as bigint) end as least from t, (values ('p'), ('n'), ('x')) s(k)")
def min_reads_threshold(spark, sf):
    total = fx.f1(spark, sf).agg(F.sum("occurrence").alias("total"))
    pick = lambda t, k: quality.minimum_reads_column(F.col("total"), t, k)
    kinds = F.array(F.struct(F.lit("p").alias("k"), pick(0.5, "percentage").alias("least")), F.struct(F.lit("n").alias("k"), pick(3, "number").alias("least")), F.struct(F.lit("x").alias("k"), pick(0, "other").alias("least")))
    return total.select(F.explode(kinds).alias("x")).select("x.k", "x.least")


STATS_LEAST = 4
SPLIT = f"""{FLAGS}, good as (select *, row_number() over (partition by whole_seq order by ordinal) as k, sum(occurrence) over (partition by whole_seq) as n from f where cluster_ok and quality_ok),
rej as (select cluster_ok, tree_ok, quality_ok, occurrence >= {STATS_LEAST} as minimum_ok, occurrence from f where not (cluster_ok and quality_ok)
 union all select cluster_ok, tree_ok, quality_ok, false, n from good where k = 1 and n <= {STATS_LEAST}),
x as (select *, (not cluster_ok)::int + (not tree_ok)::int + (not quality_ok)::int + (not minimum_ok)::int as failed from rej)"""


@query(
    f"""{SPLIT}, s as (select coalesce(sum(occurrence) filter (not cluster_ok), 0)::bigint as cluster_failed, coalesce(sum(occurrence) filter (not tree_ok), 0)::bigint as tree_failed,
 coalesce(sum(occurrence) filter (not quality_ok), 0)::bigint as quality_failed, coalesce(sum(occurrence) filter (not minimum_ok), 0)::bigint as minimum_failed,
 coalesce(sum(occurrence) filter (failed = 1), 0)::bigint as failed_one, coalesce(sum(occurrence) filter (failed = 2), 0)::bigint as failed_two, coalesce(sum(occurrence) filter (failed = 3), 0)::bigint as failed_three,
 coalesce(sum(occurrence) filter (failed = 4), 0)::bigint as failed_four, coalesce(sum(occurrence) filter (not tree_ok and failed = 1), 0)::bigint as only_tree, coalesce(sum(occurrence) filter (not (not tree_ok and failed = 1)), 0)::bigint as filtered from x)
select (select sum(occurrence)::bigint from f) as total, (select sum(occurrence)::bigint from f) - filtered as analysed, {STATS_LEAST}::bigint as least, s.* from s"""
)
def filter_stats(spark, sf):
    return quality.filter_statistics(_flagged(spark, sf), STATS_LEAST)


@query(f"{SPLIT} select sequence_id, n::bigint as occurrence from good where k = 1 and n > {STATS_LEAST}")
def abundance_filter(spark, sf):
    return quality.split_reads(_flagged(spark, sf), STATS_LEAST)[0].select("sequence_id", "occurrence")


@query(f"{WITH1} select whole_seq, arg_min(sequence_id, ordinal) as ref_id, array_to_string(list_sort(list(ordinal))[2:], ';') as dups, sum(occurrence)::bigint as occurrence from f1 group by whole_seq")
def unique_sequences(spark, sf):
    out = quality.unique_sequences(fx.f1(spark, sf))
    return out.select("whole_seq", "ref_id", F.array_join(F.transform("dup_ids", lambda x: F.replace(x, F.lit("seq"))), ";").alias("dups"), "occurrence")


@query("select p_partkey, coalesce(case when p_size % 5 <> 0 then p_size end, 1) - coalesce(case when p_size % 7 <> 0 then 3 end, 1) + 1 as o, greatest(1, p_size % 9) as m1, greatest(1, p_size % 9, p_size % 7) as m2, greatest(1, p_size % 9, p_size % 7, p_size % 11) as m3, coalesce(case when p_size % 5 <> 0 then p_size end, 1) as b1, coalesce(case when p_size % 3 <> 0 then p_size % 7 end, case when p_size % 5 <> 0 then p_size end, 1) as b2 from part")
def region_offsets(spark, sf):
    part = spark.read.parquet(f"{sf}/part.parquet")
    some = F.when(F.col("p_size") % 5 != 0, F.col("p_size"))
    m = v.running_maximum([F.col("p_size") % k for k in (9, 7, 11)])
    b = v.back_filled([some, F.when(F.col("p_size") % 3 != 0, F.col("p_size") % 7)])
    return part.select("p_partkey", v.region_offset(some, F.when(F.col("p_size") % 7 != 0, 3)).alias("o"), *[x.alias(f"m{i}") for i, x in enumerate(m, 1)], *[x.alias(f"b{i}") for i, x in enumerate(b, 1)])


@query(f"with f1 as ({fx.F1}), f5 as ({fx.F5}), c as (select sequence_id, p1, p2, aligned, unnest(generate_series(1, length(aligned))) as i from f5), n as (select sequence_id, p1, p2, i, row_number() over (partition by sequence_id order by i) as k from c where aligned[i] <> '-') select sequence_id, max(i) filter (k = p1)::int as c1, max(i) filter (k = p2)::int as c2 from n group by sequence_id")
def aligned_regions(spark, sf):
    at = d.aligned_columns("aligned", F.array("p1", "p2"))
    return fx.f5(spark, sf).select("sequence_id", F.get(at, F.lit(0)).cast("int").alias("c1"), F.get(at, F.lit(1)).cast("int").alias("c2"))


@query("select p_partkey, format('{:g}', p_retailprice) as general, case when p_size / 5000 < 0.01 then format('{:.2e}', p_size / 5000) else cast(round(p_size / 5000, 2) as varchar) end as share from part")
def number_formats(spark, sf):
    part = spark.read.parquet(f"{sf}/part.parquet")
    return part.select("p_partkey", v.general_format("p_retailprice").alias("general"), v.share_format(F.col("p_size") / 5000).alias("share"))


@query(f"{WITH1} select whole_seq as sequence, arg_min(sequence_id, ordinal) as id, sum(occurrence)::bigint as abundance, count(*) as n from f1 group by whole_seq")
def fasta_fold_sequences(spark, sf):
    rows = fx.f1(spark, sf).select(F.concat("sequence_id", F.lit("@"), "occurrence", F.lit("\n"), F.substring("whole_seq", 1, 30), F.lit("\n"), F.substring("whole_seq", 31, 99)).alias("value"), "ordinal")
    out = fasta.fold_sequences(fasta.parse_records(rows))
    return out.select("sequence", "id", "abundance", F.size("ids").cast("long").alias("n"))


@query(f"{WITH1} select concat('f', cast(family as varchar)) as id, arg_min(whole_seq, ordinal) as sequence, sum(occurrence)::bigint as abundance from f1 group by family")
def fasta_fold_ids(spark, sf):
    rows = fx.f1(spark, sf).select(F.concat(F.lit("f"), "family", F.lit("@"), "occurrence", F.lit("\n"), "whole_seq", F.lit("\n")).alias("value"), "ordinal")
    return fasta.fold_ids(fasta.parse_records(rows)).select("id", "sequence", "abundance")


@query(f"{WITH1} select '>' || sequence_id || '@' || occurrence || chr(10) || whole_seq as record from f1")
def fasta_lines(spark, sf):
    return fx.f1(spark, sf).select(fasta.lines("sequence_id", "whole_seq", "occurrence").alias("record"))


# --- blocking and candidate pairs --------------------------------------------------------------------------------------


@query(f"{WITH1} select v_call, j_call, count(*) as n, sum(occurrence)::bigint as reads, min(ordinal) as first_ordinal from f1 group by all")
def vj_blocks(spark, sf):
    return blocking.gene_blocks(fx.f1(spark, sf))


@query(f"{WITH1} select v_call, j_call, length(cdr3_aa)::int as len, cdr3_aa, arg_min(sequence_id, ordinal) as rep_id, count(*) as n, sum(occurrence)::bigint as reads, min(ordinal) as ordinal from f1 group by v_call, j_call, cdr3_aa")
def distinct_cdr3(spark, sf):
    return blocking.distinct_cdr3(fx.f1(spark, sf))


DISTINCT = f"{WITH1}, c as (select v_call, j_call, length(cdr3_aa)::int as len, cdr3_aa, min(ordinal) as ordinal from f1 group by v_call, j_call, cdr3_aa)"


@query(f"{DISTINCT} select cdr3_aa, v_call, j_call, ((row_number() over (partition by v_call, j_call, len order by ordinal) - 1) // 20)::bigint as chunk from c")
def cdr3_chunks(spark, sf):
    return blocking.chunked(blocking.distinct_cdr3(fx.f1(spark, sf)), 20).select("cdr3_aa", "v_call", "j_call", "chunk")


@query(f"{DISTINCT} select a.v_call, a.j_call, a.cdr3_aa as a, b.cdr3_aa as b from c a join c b on a.v_call = b.v_call and a.j_call = b.j_call and abs(a.len - b.len) <= case when a.j_call = 'IGHJ6' then 1 else 0 end and a.ordinal < b.ordinal")
def length_band_pairs(spark, sf):
    return blocking.length_band_pairs(blocking.distinct_cdr3(fx.f1(spark, sf))).select("v_call", "j_call", "a", "b")


PAIRS = f"{DISTINCT}, p as (select a.cdr3_aa as a, b.cdr3_aa as b, a.v_call, a.j_call from c a join c b on a.v_call = b.v_call and a.j_call = b.j_call and abs(a.len - b.len) <= case when a.j_call = 'IGHJ6' then 1 else 0 end and a.ordinal < b.ordinal)"


def _pairs(spark, sf) -> DataFrame:
    return length_band_pairs(spark, sf)


@query(f"{PAIRS} select v_call, j_call, a, b, hamming(a, b)::int as dist, round((length(a) - hamming(a, b)) / length(a) * 100, 6) as percent from p where length(a) = length(b)")
def hamming_pairs(spark, sf):
    p = _pairs(spark, sf).where(F.length("a") == F.length("b"))
    return p.select("v_call", "j_call", "a", "b", d.hamming("a", "b").cast("int").alias("dist"), r6(d.equal_length_similarity("a", "b")).alias("percent"))


@query(f"{PAIRS}, m as (select max(length(cdr3_aa)) as longest from f1) select v_call, j_call, a, b, levenshtein(a, b)::int as lev, round(levenshtein(a, b) / longest, 6) as share from p, m")
def levenshtein_pairs(spark, sf):
    longest = blocking.longest(fx.f1(spark, sf)).select(F.col("cdr3").alias("longest"))
    return _pairs(spark, sf).crossJoin(F.broadcast(longest)).select("v_call", "j_call", "a", "b", F.levenshtein("a", "b").alias("lev"), r6(d.normalised_levenshtein("a", "b", F.col("longest"))).alias("share"))


MIXED = """case when length({a}) = length({b}) then (length({a}) - hamming({a}, {b})) / length({a}) * 100.0 else greatest(
 round_even((least(length({a}), length({b})) - hamming(left({a}, least(length({a}), length({b}))), left({b}, least(length({a}), length({b}))))) / least(length({a}), length({b})) * 100, 0),
 round_even((least(length({a}), length({b})) - hamming(right({a}, least(length({a}), length({b}))), right({b}, least(length({a}), length({b}))))) / least(length({a}), length({b})) * 100, 0),
 round_even((1 - levenshtein({a}, {b}) / ((length({a}) + length({b})) / 2)) * 100, 0)) end"""


@query(f"{PAIRS} select v_call, j_call, a, b, round({MIXED.format(a='a', b='b')}, 6) as score from p")
def mixed_similarity(spark, sf):
    return _pairs(spark, sf).select("v_call", "j_call", "a", "b", r6(d.mixed_similarity("a", "b")).alias("score"))


@query(f"{WITH1}, k as (select unnest(generate_series(1, length(cdr3_aa) - 2)) as i, cdr3_aa from f1 where length(cdr3_aa) >= 3) select substr(cdr3_aa, i, 3) as kmer, count(*) as n from k group by 1")
def kmer_counts(spark, sf):
    return diversity.kmer_counts(fx.f1(spark, sf), "cdr3_aa", 3)


@query(f"{PAIRS}, k as (select *, list_distinct(list_transform(generate_series(1, length(a) - 2), lambda i: substr(a, i, 3))) as ka, list_distinct(list_transform(generate_series(1, length(b) - 2), lambda i: substr(b, i, 3))) as kb from p) select v_call, j_call, a, b, round(1 - len(list_intersect(ka, kb)) / (least(length(a), length(b)) - 2), 6) as dist from k")
def kmer_distance(spark, sf):
    return _pairs(spark, sf).select("v_call", "j_call", "a", "b", r6(d.kmer_distance("a", "b", 3)).alias("dist"))


@query(f"{WITH1}, m as (select max(length(cdr3_aa)) as longest from f1), r as (select *, substr(whole_seq, 40, 20 + (occurrence % 2)::bigint) as j_nt from f1) select a.ordinal as a, b.ordinal as b, round(((a.v_call <> b.v_call)::int + levenshtein(a.cdr3_aa, b.cdr3_aa) / longest + (1 - ({MIXED.format(a='a.j_nt', b='b.j_nt')}) / 100)) / 3, 6) as dist from r a join r b on a.j_call = b.j_call and a.ordinal < b.ordinal, m")
def combined_distance(spark, sf):
    reads = fx.f1(spark, sf).withColumn("j_nt", F.substring("whole_seq", F.lit(40), 20 + F.col("occurrence") % 2))
    return refine.read_pairs(reads, blocking.longest(reads), 6)


@query("select a.vec_id as a, b.vec_id as b, round(sqrt(list_sum(list_transform(list_zip(a.embedding, b.embedding), lambda z: (z[1]::double - z[2]::double) * (z[1]::double - z[2]::double))) / len(a.embedding)), 6) as dist from embeddings a join embeddings b on a.label = b.label and a.vec_id < b.vec_id")
def embedding_distance(spark, sf):
    return vectors.pair_distances(spark.read.parquet(f"{sf}/embeddings.parquet"), "label", "vec_id", "embedding")


VECTORS = ", ".join(f"('{c}', {k}, {x!r})" for c, row in d.amino_acid_vectors().items() for k, x in enumerate(row))


@query(
    f"""{PAIRS}, vec(letter, k, x) as (values {VECTORS}), l as (select cdr3_aa, unnest(generate_series(1, length(cdr3_aa))) as i from (select distinct cdr3_aa from f1)),
sums as (select cdr3_aa, (length(cdr3_aa) - i + 1) % 6 as r, k, sum(x) as x from l join vec on vec.letter = substr(cdr3_aa, i, 1) group by all),
grid as (select * from (select distinct cdr3_aa from f1), (select unnest(generate_series(0, 5)) as r), (select unnest(generate_series(0, 15)) as k)),
e as (select cdr3_aa, list(coalesce(x, 0) order by r, k) as e from grid left join sums using (cdr3_aa, r, k) group by cdr3_aa)
select v_call, j_call, a, b, round(sqrt(list_sum(list_transform(list_zip(p1.e, p2.e), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) / 96), 5) as dist from p join e p1 on p1.cdr3_aa = a join e p2 on p2.cdr3_aa = b"""
)
def cyclic_embedding(spark, sf):
    reads = fx.f1(spark, sf)
    embedded = reads.select("cdr3_aa").distinct().select("cdr3_aa", d.cyclic_embedding("cdr3_aa", d.amino_acid_vectors()).alias("e"))
    side = lambda s: embedded.select(F.col("cdr3_aa").alias(s), F.col("e").alias(f"e_{s}"))
    pairs = _pairs(spark, sf).join(side("a"), "a").join(side("b"), "b")
    return pairs.select("v_call", "j_call", "a", "b", F.round(d.scaled_euclidean("e_a", "e_b"), 5).alias("dist"))


# --- clusters ----------------------------------------------------------------------------------------------------------


def _members(spark, sf) -> DataFrame:
    """The families' representatives as clusters."""
    reps = refine.representatives(fx.f1(spark, sf))
    return reps.select(F.col("family").alias("cluster_id"), F.col("sequence_id").alias("id"), "ordinal", F.col("ordinal").alias("pos"), "v_call", "j_call", "cdr3_aa", F.substring("whole_seq", 40, 20).alias("j_nt"))


REPS = f"{WITH1}, reps as (select family as cluster_id, sequence_id as id, ordinal, v_call, j_call, cdr3_aa from f1 qualify row_number() over (partition by v_call, j_call, cdr3_aa order by ordinal) = 1)"


@query(f"{REPS}, c as (select cluster_id, length(cdr3_aa)::int as len, unnest(generate_series(1, length(cdr3_aa))) as pos, cdr3_aa from reps), n as (select cluster_id, len, pos, substr(cdr3_aa, pos, 1) as letter, count(*) as n from c group by all), b as (select cluster_id, len, pos, letter from n qualify row_number() over (partition by cluster_id, len, pos order by n desc, instr('ACDEFGHIKLMNPQRSTVWY*.X-', letter)) = 1) select cluster_id, len, string_agg(letter, '' order by pos) as consensus from b group by cluster_id, len")
def consensus_positional(spark, sf):
    return cluster.consensus_columns(_members(spark, sf).withColumn("len", F.length("cdr3_aa")), ["cluster_id", "len"], "cdr3_aa")


MEDOIDS = f"{REPS}, s as (select a.cluster_id, a.ordinal, a.cdr3_aa, sum(levenshtein(a.cdr3_aa, b.cdr3_aa)) as s from reps a join reps b using (cluster_id) group by all), med as (select cluster_id, cdr3_aa as medoid from s qualify row_number() over (partition by cluster_id order by s, ordinal) = 1)"


@query(f"{MEDOIDS} select cluster_id, medoid from med")
def set_medoid(spark, sf):
    return refine.set_medoid(_members(spark, sf))


@query(f"{MEDOIDS} select cluster_id, count(*)::bigint as size, true as no_worse from reps group by cluster_id")
def median_strings(spark, sf):
    """Whether each family's median string has a sum of edit distances no larger than its medoid's."""
    m = _members(spark, sf)
    both = median.medians(m).join(refine.set_medoid(m), "cluster_id")
    sums = m.join(both, "cluster_id").groupBy("cluster_id", "size").agg(F.sum(F.levenshtein("cdr3_aa", "centroid")).alias("own"), F.sum(F.levenshtein("cdr3_aa", "medoid")).alias("other"))
    return sums.select("cluster_id", "size", (F.col("own") <= F.col("other")).alias("no_worse"))


@query(f"{MEDOIDS} select a.cluster_id, b.cluster_id as neighbour, levenshtein(a.medoid, b.medoid)::int as dist from med a join med b on a.cluster_id <> b.cluster_id qualify row_number() over (partition by a.cluster_id order by levenshtein(a.medoid, b.medoid), b.cluster_id) = 1")
def nearest_centroid(spark, sf):
    return refine.nearest_centroids(refine.set_medoid(_members(spark, sf)).withColumnRenamed("medoid", "centroid"))


NEAR = "near as (select a.cluster_id as c, b.cluster_id as neighbour from med a join med b on a.cluster_id <> b.cluster_id qualify row_number() over (partition by a.cluster_id order by levenshtein(a.medoid, b.medoid), b.cluster_id) = 1)"
DIST = "((a.v_call <> b.v_call)::int + levenshtein(a.cdr3_aa, b.cdr3_aa) / 17)"


def _distance():
    return d.binary("a.v_call", "b.v_call") + d.normalised_levenshtein("a.cdr3_aa", "b.cdr3_aa", F.lit(17))


INTRA = f"{REPS}, intra as (select a.cluster_id, a.id, coalesce(avg({DIST}) filter (a.id <> b.id), 0) as ai, coalesce(min({DIST}) filter (a.id <> b.id), 0) as nearest from reps a join reps b using (cluster_id) group by all)"


@query(f"{INTRA} select cluster_id, id, round(ai, 6) as ai, round(nearest, 6) as nearest from intra")
def intra_distance(spark, sf):
    return refine.intra_distances(_members(spark, sf), _distance()).select("cluster_id", "id", r6("ai").alias("ai"), r6("nearest").alias("nearest"))


@query(f"{INTRA} select cluster_id, round(avg(nearest), 6) as uniformity from intra group by cluster_id")
def uniformity(spark, sf):
    return refine.uniformity(refine.intra_distances(_members(spark, sf), _distance())).select("cluster_id", r6("uniformity").alias("uniformity"))


@query(f"{INTRA}, m as (select *, avg(nearest) over (partition by cluster_id) as mean from intra), p as (select count(*) * sum(case when mean <> 0 then (nearest - mean) / mean else 0 end) as x, count(*) * sum(case when mean <> 0 then abs(nearest - mean) / mean else 0 end) as y, count(*) as n from m group by cluster_id) select round(abs(sum(x) / sum(n)), 6) as density_index, round(sum(y) / sum(n), 6) as spread from p")
def density_index(spark, sf):
    nearest = refine.intra_distances(_members(spark, sf), _distance())
    return diversity.density_index(nearest).select(r6(F.abs("density_index")).alias("density_index"), r6("spread").alias("spread"))


INTER = f"{MEDOIDS}, {NEAR}, {INTRA.removeprefix(REPS + ', ')}, inter as (select a.cluster_id, a.id, a.ordinal, b.cluster_id as neighbour, {DIST} as bi, length(a.cdr3_aa) = length(b.cdr3_aa) as same_length from reps a join near on near.c = a.cluster_id join reps b on b.cluster_id = near.neighbour qualify row_number() over (partition by a.id order by {DIST}, b.ordinal) = 1)"


def _inter(m):
    near = refine.nearest_centroids(refine.set_medoid(m).withColumnRenamed("medoid", "centroid"))
    return refine.inter_distances(m, near, _distance())


@query(f"{INTER} select id, neighbour, round(bi, 6) as bi, same_length from inter")
def inter_distance(spark, sf):
    return _inter(_members(spark, sf)).select("id", "neighbour", r6("bi").alias("bi"), "same_length")


# Every seventh read stands in the next family's cluster.
MISPLACED = INTER.replace("select family as cluster_id, sequence_id as id", "select (family + (ordinal % 7 = 0)::int) % 40 as cluster_id, sequence_id as id")


@query(f"{MISPLACED} select i.cluster_id, neighbour, count(*) as n, min(ordinal) as first from inter i join intra a using (cluster_id, id) where bi < ai and same_length group by 1, 2")
def inconsistency_counts(spark, sf):
    m = _members(spark, sf).withColumn("cluster_id", (F.col("cluster_id") + (F.col("ordinal") % 7 == 0).cast("int")) % 40)
    return refine.inconsistencies(refine.intra_distances(m, _distance()), _inter(m))


@query(f"{WITH1} select r.sequence_id as rep_id, s.sequence_id, s.family as cluster_id from f1 s join (select * from f1 qualify row_number() over (partition by v_call, j_call, cdr3_aa order by ordinal) = 1) r using (v_call, j_call, cdr3_aa)")
def duplicates_expansion(spark, sf):
    reads = fx.f1(spark, sf)
    refined = refine.representatives(reads).select(F.col("sequence_id").alias("id"), F.col("sequence_id").alias("cluster_id"))
    out = refine.expand(refined, reads).select(F.col("cluster_id").alias("rep_id"), "sequence_id")
    return out.join(reads.select("sequence_id", F.col("family").alias("cluster_id")), "sequence_id")


@query(f"{WITH1} select family as cluster_id, string_agg(sequence_id, ' ' order by ordinal) as line from f1 group by family")
def cluster_lines(spark, sf):
    return rollup.cluster_lines(fx.f1(spark, sf).select(F.col("family").alias("cluster_id"), "sequence_id", F.col("ordinal").alias("pos")))


@query(f"{WITH1}, c as (select family as cluster_id, case when ordinal % 50 = 0 then concat('no', sequence_id) else sequence_id end as sequence_id from f1) select cluster_id, c.sequence_id, f1.sequence_id is not null as known from c left join f1 using (sequence_id)")
def cluster_read_join(spark, sf):
    reads = fx.f1(spark, sf)
    ids = F.when(F.col("ordinal") % 50 == 0, F.concat(F.lit("no"), "sequence_id")).otherwise(F.col("sequence_id"))
    known, unknown = rollup.attach(reads.select(F.col("family").alias("cluster_id"), ids.alias("sequence_id")), reads)
    return known.select("cluster_id", "sequence_id", F.lit(True).alias("known")).unionByName(unknown.select("cluster_id", "sequence_id", F.lit(False).alias("known")))


@query(f"{WITH1}, r as (select distinct v_call, j_call, cdr3_aa from f1) select max(length(cdr3_aa))::int as cdr3, max(length(v_call))::int as v, max(length(j_call))::int as j from r")
def longest_lengths(spark, sf):
    return blocking.longest(fx.f1(spark, sf))


@query()
def greedy_clusters(spark, sf):
    return cluster.cluster_reads(fx.f1(spark, sf))


@query()
def refined_clusters(spark, sf):
    reads = fx.f1(spark, sf).withColumn("j_nt", F.substring("whole_seq", 40, 20))
    clusters = cluster.cluster_reads(reads)
    reps = refine.representatives(reads).join(clusters, "sequence_id").select("cluster_id", F.col("sequence_id").alias("id"), "pos", "ordinal", "v_call", "cdr3_aa", "j_nt")
    return refine.expand(refine.refine(reps), reads)


# --- roll-up, ranking, shares ------------------------------------------------------------------------------------------


def _clones(spark, sf) -> DataFrame:
    return fx.f1(spark, sf).withColumn("cluster_id", F.col("family"))


SUBS = f"{WITH1}, subs as (select family as cluster_id, v_call, j_call, cdr3_aa, sum(occurrence)::bigint as reads, count(distinct whole_seq) as clonotypes, min(ordinal) as first_ordinal from f1 group by all)"


@query(f"{SUBS} select * from subs")
def subclone_rollup(spark, sf):
    return rollup.subclones(_clones(spark, sf))


RANKS = f"""{SUBS}, c as (select cluster_id, sum(reads)::bigint as clone_reads, row_number() over (order by sum(reads) desc, min(first_ordinal), cluster_id) as clone_rank from subs group by cluster_id),
ranks as (select s.*, clone_reads, clone_rank, row_number() over (partition by cluster_id order by reads desc, first_ordinal) as subclone_rank from subs s join c using (cluster_id))"""


@query(f"{RANKS} select clone_rank::int as clone_rank, subclone_rank::int as subclone_rank, 'C' || clone_rank || '-' || subclone_rank as name, cluster_id || '_' || (subclone_rank - 1) as internal, cdr3_aa, reads, clone_reads, round(reads / clone_reads * 100, 6) as of_clone, round(reads / (select sum(reads) from subs) * 100, 6) as of_repertoire from ranks")
def clone_rank(spark, sf):
    r = rollup.ranked(rollup.subclones(_clones(spark, sf)))
    return r.select("clone_rank", "subclone_rank", "name", "internal", "cdr3_aa", "reads", "clone_reads", r6("of_clone").alias("of_clone"), r6("of_repertoire").alias("of_repertoire"))


@query(f"{RANKS} select clone_rank::int as clone_rank, subclone_rank::int as subclone_rank, cdr3_aa, reads from ranks where clone_rank <= 5 and subclone_rank <= 8")
def top_k_subclones(spark, sf):
    return rollup.top(rollup.ranked(rollup.subclones(_clones(spark, sf))), 5, 8).select("clone_rank", "subclone_rank", "cdr3_aa", "reads")


@query(f"{RANKS}, m as (select cluster_id, clone_rank, string_agg(cluster_id || '_' || (subclone_rank - 1) || ':C' || clone_rank || '-' || subclone_rank, ' ' order by subclone_rank) as x, count(*) as n from ranks group by all) select cluster_id, clone_rank::int as clone_rank, cluster_id || ':C' || clone_rank || case when n > 1 then chr(9) || x else '' end as line from m")
def name_mapping(spark, sf):
    return export.name_map(rollup.ranked(rollup.subclones(_clones(spark, sf))))


@query(f"{WITH1} select sequence_id, row_number() over (partition by family, v_call, j_call, cdr3_aa order by occurrence desc, ordinal)::int as rank, round(occurrence / sum(occurrence) over (partition by family, v_call, j_call, cdr3_aa) * 100, 6) as share from f1")
def abundance_share(spark, sf):
    return rollup.clonotypes(_clones(spark, sf)).select("sequence_id", "rank", r6("share").alias("share"))


@query(f"{WITH1}, g as (select *, case when ordinal % 3 = 0 then '' else germline_seq end as germ from f1) select family as cluster_id, cdr3_aa, v_call, j_call, sequence_id from g qualify row_number() over (partition by family, v_call, j_call, cdr3_aa order by (whole_seq <> '' and germ <> '') desc, occurrence desc, ordinal) = 1")
def representative_clonotype(spark, sf):
    rows = _clones(spark, sf).withColumn("germline_seq", F.when(F.col("ordinal") % 3 == 0, "").otherwise(F.col("germline_seq")))
    return rollup.representative(rows, ["cluster_id", "v_call", "j_call", "cdr3_aa"]).select("cluster_id", "cdr3_aa", "v_call", "j_call", "sequence_id")


GERM = f"{WITH1}, g as (select *, 90.0 + ordinal % 7 as v_identity, 80.0 + ordinal % 5 as j_identity, 70.0 + ordinal % 3 as d_identity, case when ordinal % 4 <> 0 or family % 8 = 0 then '' else germline_seq end as germ from f1)"


@query(f"{GERM}, r as (select *, max(germ <> '') over (partition by family) as any_, row_number() over (partition by family, germ <> '' order by v_identity desc, j_identity desc, d_identity desc, occurrence desc, ordinal) as up, row_number() over (partition by family order by v_identity, j_identity, d_identity, occurrence, ordinal desc) as down from g) select family as cluster_id, sequence_id from r where case when any_ then germ <> '' and up = 1 else down = 1 end")
def haus_choice(spark, sf):
    o = F.col("ordinal")
    rows = _clones(spark, sf).withColumns({"v_identity": 90.0 + o % 7, "j_identity": 80.0 + o % 5, "d_identity": 70.0 + o % 3, "germline_seq": F.when((o % 4 != 0) | (F.col("family") % 8 == 0), "").otherwise(F.col("germline_seq"))})
    return rollup.germline_choice(rows, ["cluster_id"]).select("cluster_id", "sequence_id")


@query("select p_partkey, (p_partkey % 151)::bigint as fill, (150 - (p_partkey // 151) % 151)::bigint as stroke, ((p_partkey // 22801) % 3)::bigint as style, (150 - p_partkey % 151)::bigint as sub_fill, ((p_size + p_partkey // 151) % 151)::bigint as sub_stroke, (((p_size + p_partkey // 151) // 151) % 3)::bigint as sub_style from part")
def style_cycle(spark, sf):
    part = spark.read.parquet(f"{sf}/part.parquet")
    a, b = rollup.clone_style(F.col("p_partkey"), 151), rollup.subclone_style(F.col("p_partkey"), F.col("p_size"), 151)
    return part.select("p_partkey", *[c.cast("long").alias(k) for k, c in a.items()], *[c.cast("long").alias(f"sub_{k}") for k, c in b.items()])


# --- diversity ---------------------------------------------------------------------------------------------------------


def _sizes(spark, sf) -> DataFrame:
    return fx.f1(spark, sf).groupBy(F.col("family").alias("cluster_id")).agg(F.sum("occurrence").alias("n"))


SIZES = f"{WITH1}, sizes as (select family as cluster_id, sum(occurrence)::bigint as n from f1 group by family)"


@query(f"{SIZES}, r as (select n, row_number() over (order by n) as k from sizes) select round(2 * sum(k * n) / (count(*) * sum(n)) - (count(*) + 1) / count(*), 6) as gini from r")
def gini(spark, sf):
    return diversity.gini(_sizes(spark, sf)).select(r6("gini").alias("gini"))


@query(f"{SIZES}, r as (select row_number() over (order by n, cluster_id)::int as rank, sum(n) over (order by n, cluster_id rows unbounded preceding) / sum(n) over () as share from sizes) select rank, round(share, 6) as share from r union all select 0, 0.0")
def lorenz(spark, sf):
    return diversity.lorenz(_sizes(spark, sf)).select("rank", r6("share").alias("share"))


@query(f"{SIZES} select cluster_id, n, round(n / sum(n) over (), 6) as share, n / sum(n) over () > 0.025 as above from sizes")
def cluster_distribution(spark, sf):
    return diversity.distribution(_sizes(spark, sf), line=0.025).withColumn("share", r6("share"))


@query(f"{INTRA}, sizes as (select family as cluster_id, sum(occurrence)::bigint as n from f1 group by family), u as (select cluster_id, avg(nearest) as u from intra group by 1) select cluster_id, n, round(coalesce(u, 0), 6) as uniformity from sizes left join u using (cluster_id)")
def uniformity_by_size(spark, sf):
    u = refine.uniformity(refine.intra_distances(_members(spark, sf), _distance()))
    return diversity.uniformity_by_size(_sizes(spark, sf), u).select("cluster_id", "n", r6("uniformity").alias("uniformity"))


# --- trees -------------------------------------------------------------------------------------------------------------

WAYS = f"{WITH3}, up as (select child as node, parent as ancestor, 1 as steps, dist::bigint as length from f3 where parent is not null union all select u.node, f3.parent, u.steps + 1, u.length + f3.dist from up u join f3 on u.ancestor = f3.child where f3.parent is not null)"


@query(f"{WAYS} select node, ancestor, steps::int as steps, length::bigint as length from up")
def path_to_root(spark, sf):
    return treeops.ancestors(fx.f3(spark, sf)).select("node", "ancestor", "steps", "length")


@query(f"{WAYS} select node, max(steps)::int as depth from up group by node")
def tree_depth(spark, sf):
    return treeops.depths(fx.f3(spark, sf)).select("node", "depth")


@query(f"{WAYS}, a as (select node, ancestor, steps from up union all select child, child, 0 from f3), p as (select child as a, (child * 7 + 3) % (select count(*) from f3) as b from f3) select p.a, p.b, arg_min(x.ancestor, x.steps) as lca from p join a x on x.node = p.a join a y on y.node = p.b and y.ancestor = x.ancestor group by all")
def lowest_common_ancestor(spark, sf):
    edges = fx.f3(spark, sf)
    nodes = edges.agg(F.count("*").alias("nodes"))
    pairs = edges.crossJoin(F.broadcast(nodes)).select("tree", F.col("child").alias("a"), ((F.col("child") * 7 + 3) % F.col("nodes")).alias("b"))
    return treeops.lowest_common(edges, pairs).select("a", "b", "lca")


@query(f"{WAYS}, l as (select node, ancestor, length, steps from up where node % 4 <> 1 and ancestor % 4 <> 1), m as (select node, arg_min(length, steps) as l from l group by node) select sum(l)::bigint as cost, (select sum(dist)::bigint from f3 where parent is not null) as plain from m")
def tree_cost(spark, sf):
    edges = fx.f3(spark, sf).withColumn("silent", F.col("child") % 4 == 1)
    return treeops.cost(edges, "silent").join(treeops.cost(edges).withColumnRenamed("cost", "plain"), "tree").select("cost", "plain")


@query(
    f"""{WAYS}, a as (select child as node from f3 where child % 4 = 0 or parent is null union select ancestor from up where node % 4 = 0), k as (select f3.parent as node, count(*) as n from f3 join a on f3.child = a.node where f3.parent is not null group by 1),
s as (select f3.child as node from f3 join a on f3.child = a.node join k using (node) where n = 1 and f3.child % 4 <> 0 and f3.parent is not null)
select u.node as child, arg_min(u.ancestor, u.steps) as parent, min(u.length)::bigint as dist from up u join a using (node) where u.node not in (select node from s) and u.ancestor not in (select node from s) group by 1"""
)
def tidy_tree(spark, sf):
    """The tree without idle silent nodes: three of four nodes are silent, leaves as well."""
    edges = fx.f3(spark, sf).withColumn("silent", F.col("child") % 4 != 0)
    return contract.without_idle(edges).where("parent is not null").select("child", "parent", "dist")


@query(f"{WITH3}, l as (select child as label from f3 where child % 9 <> 0), s as (select case when child % 13 = 0 then child + 1 else child end as label, count(*) as n from f3 group by 1) select label, coalesce(n, 0) as n from l full join s using (label) where coalesce(n, 0) <> 1")
def tree_consistency(spark, sf):
    edges = fx.f3(spark, sf)
    seen = edges.withColumn("child", F.when(F.col("child") % 13 == 0, F.col("child") + 1).otherwise(F.col("child")))
    return treeops.inconsistent_labels(seen, edges.where("child % 9 != 0").select("tree", F.col("child").alias("label"))).select("label", "n")


def _top_subclones(spark, sf) -> DataFrame:
    rows = _clones(spark, sf)
    ranks = rollup.top(rollup.ranked(rollup.subclones(rows)))
    key = ["cluster_id", "v_call", "j_call", "cdr3_aa"]
    seqs = rollup.representative(rows, key).select(*key, "whole_seq", "germline_seq")
    germ = F.first_value("germline_seq").over(Window.partitionBy("cluster_id").orderBy("subclone_rank"))
    return ranks.join(seqs, key).withColumn("germline", germ)


@query()
def lineage_trees(spark, sf):
    return lineage.lineages(_top_subclones(spark, sf))


@query(f"{RANKS}, n as (select clone_rank, count(*) as n, sum(reads) / (select sum(reads) from subs) * 100 as ab from ranks group by 1) select clone_rank::int as clone_rank, 'C' || clone_rank as name, v_call, j_call, round(ab, 6) as ab_rep, clone_reads as reads, tree_type from ranks join n using (clone_rank), (values ('all'), ('simplification1')) t(tree_type) where subclone_rank = 1 and n > 1 and clone_rank <= 5")
def clone_tree_types(spark, sf):
    out = export.clone_summary(rollup.ranked(rollup.subclones(_clones(spark, sf))), ["all", "simplification1"])
    return out.withColumn("ab_rep", r6("ab_rep"))


@query()
def newick_trees(spark, sf):
    return export.newick_trees(lineage.lineages(_top_subclones(spark, sf)))


NODES = f"""{RANKS.replace('with f1', 'with recursive f1', 1)}, one as (select family as cluster_id, v_call, j_call, cdr3_aa, upper(whole_seq) as seq, upper(germline_seq) as germ from f1 qualify row_number() over (partition by family, v_call, j_call, cdr3_aa order by occurrence desc, ordinal) = 1),
top as (select r.*, seq, germ from ranks r join one using (cluster_id, v_call, j_call, cdr3_aa) where clone_rank <= 5 and subclone_rank <= 200 qualify count(*) over (partition by clone_rank) > 1),
nodes as (select clone_rank, subclone_rank as i, seq from top union all select clone_rank, 0, germ from top where subclone_rank = 1),
d as (select a.clone_rank, a.i as a, b.i as b, hamming(a.seq, b.seq)::bigint as w from nodes a join nodes b using (clone_rank)),
steps as (select distinct clone_rank, w as t from d),
reach as (select s.clone_rank, t, i as a, i as b from steps s join nodes using (clone_rank) union select r.clone_rank, r.t, r.a, d.b from reach r join d on d.clone_rank = r.clone_rank and d.a = r.b and d.w <= r.t),
parts as (select clone_rank, t, count(distinct root) as k from (select clone_rank, t, a, min(b) as root from reach group by all) group by all),
spans as (select *, lead(t) over (partition by clone_rank order by t) - t as step from parts)"""


@query(f"{NODES} select clone_rank::int as clone_rank, (select count(*) from nodes n where n.clone_rank = s.clone_rank) as nodes, sum((k - 1) * coalesce(step, 0))::bigint as weight from spans s group by clone_rank")
def lineage_weights(spark, sf):
    """Nodes with reads and summed length of each clone's tree; the SQL has it from the connected parts below each distance."""
    trees = lineage.lineages(_top_subclones(spark, sf)).where("complexity = 'all'")
    return trees.groupBy("clone_rank").agg(F.sum((~F.col("silent")).cast("long")).alias("nodes"), F.sum("dist").cast("long").alias("weight"))


TREES = f"{RANKS}, shown as (select * from ranks where clone_rank <= 5 and subclone_rank <= 200 qualify count(*) over (partition by clone_rank) > 1)"


@query(f"{TREES} select clone_rank::int as clone_rank, name, 1::bigint as times, reads as abundance, true as hangs, 0::bigint as lean from (select *, 'C' || clone_rank || '-' || subclone_rank as name from shown)")
def lineage_nodes(spark, sf):
    """Each sub-clone of the trees: how often it stands there, with what reads, whether its parent does too, and how many silent
    nodes of its tree have fewer than two children."""
    trees = lineage.lineages(_top_subclones(spark, sf)).where("complexity = 'all'")
    kids = trees.groupBy("clone_rank", F.col("parent").alias("child")).agg(F.count("*").alias("kids"))
    nodes = trees.join(kids, ["clone_rank", "child"], "left").fillna(0, ["kids"])
    lean = nodes.groupBy("clone_rank").agg(F.count_if(F.col("silent") & (F.col("kids") < 2)).alias("lean"))
    ups = trees.select("clone_rank", F.col("child").alias("parent"), F.lit(True).alias("known")).distinct()
    own = nodes.where("not silent and parent is not null").join(ups, ["clone_rank", "parent"], "left").join(lean, "clone_rank")
    return own.groupBy("clone_rank", F.col("child").alias("name"), "lean").agg(F.count("*").alias("times"), F.sum("abundance").alias("abundance"), F.every(F.coalesce("known", F.lit(False))).alias("hangs"))


@query(f"{NODES} select clone_rank::int as clone_rank, (select count(*) from nodes n where n.clone_rank = s.clone_rank) as nodes, sum((k - 1) * coalesce(step, 0))::bigint as weight from spans s group by clone_rank")
def newick_lengths(spark, sf):
    """Nodes with reads and summed branch lengths, read back from the Newick texts; the SQL is that of the spanning trees."""
    texts = export.newick_trees(lineage.lineages(_top_subclones(spark, sf))).where("complexity = 'all'")
    labels = texts.select("clone_rank", F.explode(F.regexp_extract_all("newick", F.lit("([^(),:;]+)(:[0-9.e+]+)?"), F.lit(0))).alias("label"))
    parts = labels.withColumn("p", F.split("label", ":")).select("clone_rank", F.get("p", F.lit(0)).alias("name"), F.get("p", F.lit(1)).cast("double").alias("length"))
    named = F.col("length").isNull() | F.col("name").rlike("^C[0-9]+-[0-9]+$")
    return parts.groupBy("clone_rank").agg(F.count_if(named).alias("nodes"), F.sum("length").cast("long").alias("weight"))


FOREST = NODES.replace("where clone_rank <= 5 and subclone_rank <= 200 qualify", "qualify")


@query(f"{FOREST} select clone_rank::bigint as clone_rank, (select count(*) - 1 from nodes n where n.clone_rank = s.clone_rank)::bigint as edges, sum((k - 1) * coalesce(step, 0))::bigint as weight from spans s group by clone_rank")
def spanning_weights(spark, sf):
    """Edges and length of the spanning trees of all clones over all their sub-clones and germlines, in blocks."""
    rows = _clones(spark, sf)
    key = ["cluster_id", "v_call", "j_call", "cdr3_aa"]
    seqs = rollup.representative(rows, key).select(*key, "whole_seq", "germline_seq")
    subs = rollup.ranked(rollup.subclones(rows)).join(seqs, key)
    named = subs.select(F.col("clone_rank").cast("long").alias("clone"), F.col("subclone_rank").cast("long").alias("node"), F.upper("whole_seq").alias("text"), F.col("reads").cast("long").alias("abundance"))
    germ = subs.where("subclone_rank = 1").select(F.col("clone_rank").cast("long").alias("clone"), F.lit(0).cast("long").alias("node"), F.upper("germline_seq").alias("text"), F.lit(1).cast("long").alias("abundance"))
    large = subs.groupBy(F.col("clone_rank").cast("long").alias("clone")).count().where("count > 1").select("clone")
    edges = spanning.spanning_forest(named.unionByName(germ).join(large, "clone", "left_semi"), block=8)
    return edges.groupBy(F.col("clone").alias("clone_rank")).agg(F.count("*").alias("edges"), F.sum("dist").alias("weight"))


def _shown(spark, sf) -> DataFrame:
    """Ranked sub-clones with all that the nested outputs show of them."""
    rows = _clones(spark, sf)
    key, o = ["cluster_id", "v_call", "j_call", "cdr3_aa"], F.col("ordinal")
    facts = rollup.representative(rows, key).select(
        *key, "sequence_id", export.productive_label(F.when(o % 3 == 0, True).when(o % 3 == 1, False)).alias("productive"), "whole_seq", "germline_seq",
        (90.0 + o % 7).alias("v_identity"), (70.0 + o % 3).alias("d_identity"), (80.0 + o % 5).alias("j_identity"), F.transform(F.sequence(F.lit(0), F.lit(11)), lambda k: 1 + 5 * k).alias("positions"),
    )
    return export.display(rollup.ranked(rollup.subclones(rows))).join(facts, key).join(export.unique_reads(rollup.clonotypes(rows)), key)


@query()
def tree_json(spark, sf):
    return export.tree_json(lineage.lineages(_top_subclones(spark, sf)), rollup.top(_shown(spark, sf)))


@query(f"{TREES} select clone_rank::int as clone_rank, 'C' || clone_rank || '-' || subclone_rank as name, round(reads / clone_reads * 100, 6) as share, reads from shown")
def tree_json_nodes(spark, sf):
    """The sub-clones of the full trees with their share and reads, read back from the JSON."""
    texts = export.tree_json(lineage.lineages(_top_subclones(spark, sf)), rollup.top(_shown(spark, sf))).where("complexity = 'all'")
    part = lambda k: F.regexp_extract_all("json", F.lit('"name": "(C[0-9]+-[0-9]+)", "value": ([0-9.e+-]+), "reads": ([0-9]+)'), F.lit(k))
    rows = texts.select("clone_rank", F.explode(F.arrays_zip(part(1).alias("name"), part(2).alias("share"), part(3).alias("reads"))).alias("x"))
    return rows.select("clone_rank", "x.name", r6(F.col("x.share").cast("double")).alias("share"), F.col("x.reads").cast("long").alias("reads"))


_FACTS = "cdr3 string, functionality string, seq string, v_identity double, region struct<CDR3: array<int>>, uniq_seq array<struct<seq_id: string, reads: long, percentage: double, rank: int>>, sequence string, color string, stroke string, style string"


@query(
    f"""{RANKS}, one as (select family as cluster_id, v_call, j_call, cdr3_aa, sequence_id, whole_seq, ordinal, occurrence from f1 qualify row_number() over (partition by family, v_call, j_call, cdr3_aa order by occurrence desc, ordinal) = 1),
col(values_) as (select ['#' || x for x in string_split('{' '.join(export.COLOURS)}', ' ')]),
n as (select cluster_id, count(*) as n, sum(reads) / (select sum(reads) from subs) * 100 as value from ranks group by 1),
u as (select family as cluster_id, v_call, j_call, cdr3_aa, count(*) as reads_listed, max(occurrence) as most, sum(occurrence)::bigint as listed from f1 group by all)
select clone_rank::int as clone_rank, 'C' || clone_rank as clone, round(value, 6) as value, clone_reads, ranks.v_call as "idV", case when n > 1 then 'C' || clone_rank || '-' || subclone_rank end as name,
 case when n > 1 then round(reads / clone_reads * 100, 6) end as share, cdr3_aa as cdr3, case ordinal % 3 when 0 then 'productive' when 1 then 'unproductive' else '/' end as functionality, sequence_id as seq, round(90.0 + ordinal % 7, 6)::double as v_identity,
 26 as cdr3_start, 51 as cdr3_end, whole_seq as sequence, reads_listed, listed, values_[(case when n > 1 then 150 - (subclone_rank - 1) % 151 else (clone_rank - 1) % 151 end) + 1] as color,
 values_[(case when n > 1 then ((clone_rank - 1) % 151 + (subclone_rank - 1) // 151) % 151 else 150 - ((clone_rank - 1) // 151) % 151 end) + 1] as stroke
 from ranks join n using (cluster_id) join one using (cluster_id, v_call, j_call, cdr3_aa) join u using (cluster_id, v_call, j_call, cdr3_aa), col"""
)
def repertoire_json(spark, sf):
    """The nested clones, read back: a row per child, or per clone without children."""
    schema = f"name string, value double, reads long, idV string, {_FACTS}, children array<struct<name: string, value: double, reads: long, {_FACTS}>>"
    p = export.clone_json(_shown(spark, sf)).select("clone_rank", F.from_json("json", schema).alias("p")).select("clone_rank", "p", F.explode_outer("p.children").alias("c"))
    told = lambda name: F.coalesce(F.col(f"c.{name}"), F.when(F.col("c").isNull(), F.col(f"p.{name}")))
    return p.select(
        "clone_rank", F.col("p.name").alias("clone"), r6(F.col("p.value")).alias("value"), F.col("p.reads").alias("clone_reads"), "p.idV", F.col("c.name").alias("name"), r6(F.col("c.value")).alias("share"),
        *[told(k).alias(k) for k in ("cdr3", "functionality", "seq", "v_identity", "sequence", "color", "stroke")], told("region")["CDR3"][0].alias("cdr3_start"), told("region")["CDR3"][1].alias("cdr3_end"),
        F.size(told("uniq_seq")).cast("long").alias("reads_listed"), F.aggregate(told("uniq_seq"), F.lit(0).cast("long"), lambda n, x: n + x["reads"]).alias("listed"),
    )
