"""Deterministic repertoire views over the test tables: one SQL text that both engines run unchanged."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# a clean repertoire, 40 founder families with point mutations.
F1 = """
with base as (
 select p_partkey as k, p_partkey % 40 as f, p_size as z, 8 + (p_partkey % 40) % 10 as n,
        translate(md5(concat('c', cast(p_partkey % 40 as string))), '0123456789abcdef', 'ACDEFGHIKLMNPQRS') as aa,
        translate(concat(md5(concat('n', cast(p_partkey % 40 as string))), md5(concat('m', cast(p_partkey % 40 as string)))), '0123456789abcdef', 'acgtacgtacgtacgt') as germ
 from part),
mut as (
 select k, f, z, n, germ,
        case when z % 4 = 0 then substr(aa, 1, n)
             else concat(substr(aa, 1, z % n), substr('ACDEFGHIKLMNPQRSTVWY', 1 + z % 20, 1), substr(aa, z % n + 2, n - z % n - 1)) end as c3
 from base)
select concat('seq', cast(k as string)) as sequence_id, k as ordinal,
       concat('IGHV', cast(1 + f % 5 as string), '-', cast(1 + f % 3 as string)) as v_call,
       concat('IGHJ', cast(1 + f % 6 as string)) as j_call,
       case when z % 7 = 0 then substr(c3, 1, n - 1) else c3 end as cdr3_aa,
       case when z % 3 = 0 then germ
            else concat(substr(germ, 1, z), substr('acgt', 1 + z % 4, 1), substr(germ, z + 2, 64 - z - 1)) end as whole_seq,
       germ as germline_seq, 1 + z % 5 as occurrence, f as family
from mut
"""

# dirty reads over F1.
F2 = """
select concat('r', cast(p_partkey as string)) as sequence_id, p_partkey as ordinal, f.whole_seq as clean_seq, f.j_call as j_call,
 case when p_partkey % 41 = 0 then '' when p_partkey % 17 = 0 then concat('Homsap ', f.v_call, '*03 F, or Homsap IGHV9-9*01 F') else concat(f.v_call, '*01') end as v_raw,
 case when p_partkey % 3 = 0 then ' True' when p_partkey % 3 = 1 then 'f' when p_partkey % 7 = 0 then 'maybe' else 'T' end as productive_raw,
 case when p_partkey % 43 = 0 then 'x' else cast(90 + p_size % 10 as string) end as v_identity_raw,
 case when p_partkey % 29 = 0 then '12.0' when p_partkey % 31 = 0 then '' else cast(10 + p_size % 7 as string) end as v_start_raw,
 case when p_partkey % 37 = 0 then concat(substr(f.whole_seq,1,10),'n',substr(f.whole_seq,12,53)) when p_partkey % 53 = 0 then concat(f.whole_seq,'q') else upper(f.whole_seq) end as seq_raw,
 case when p_partkey % 47 = 0 then '' else f.cdr3_aa end as cdr3_raw, 1 + p_size % 5 as occurrence
from part join f1 f on f.sequence_id = concat('seq', cast(p_partkey as string))
"""

# a 3-ary tree of all parts.
F3 = """
select 't' as tree, case when p_partkey = 0 then null else cast(round((p_partkey - 1 - (p_partkey - 1) % 3) / cast(3 as double)) as bigint) end as parent,
       p_partkey as child, 1 + p_size % 4 as dist
from part
"""

# lines to collapse.
F4 = "select concat(event_type, '|', cast(user_id % 20 as string)) as line, event_id from events"

# gapped alignments over F1.
F5 = """
select sequence_id, concat(substr(whole_seq,1,5), case when occurrence % 2 = 0 then '--' else '' end, substr(whole_seq,6,20), case when occurrence % 3 = 0 then '-' else '' end, substr(whole_seq,26,39)) as aligned,
       1 + occurrence as p1, 7 + occurrence as p2
from f1
"""


def view(spark: SparkSession, sf_dir: str, text: str, **extra: DataFrame) -> DataFrame:
    """``text`` over the table files it names and the frames in ``extra``."""
    import re

    frames = dict(extra)
    for name in ("part", "events"):
        if re.search(rf"\bfrom {name}\b", text):
            frames[name] = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    for name in frames:
        text = re.sub(rf"\b(from|join) {name}\b", rf"\1 {{{name}}}", text)
    return spark.sql(text, **frames)


def f1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, F1)


def f2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, F2, f1=f1(spark, sf_dir))


def f3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, F3)


def f4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, F4)


def f5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, F5, f1=f1(spark, sf_dir))
