"""Secret scans over an incremental blob ledger, in DataFrame operations only.

Every version of every path is content-addressed by SHA-256. The ledger is three tables: the versions (scan, path, blob)
of all scans ever made, the (blob, rule, rule version) pairs that were scanned, and their findings. A scan hashes the
versions it is given, reads the texts of only those blobs that have a pair not yet in the ledger, each distinct blob
once, and appends to the ledger. Findings are then joined back to the paths of one scan or of all scans.

Positions come from native functions: splitting at a pattern gives the gaps before its matches, extracting all gives the
matches, and a running sum over both lengths inside a blob gives code-point offsets.

Defined results: a null text is the empty text; a null path is a path of its own; repeated rows give a row each, their
text being scanned once; an empty table gives no rows; other columns are ignored; a rule whose version, pattern, group or
least length changes is scanned again.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialize, shared_path, table, text_of

SALTS = 16
SENT_BLOBS = 50_000


@dataclass(frozen=True)
class Rule:
    """Leftmost, non-overlapping matches of ``pattern``; those whose ``group`` has fewer than ``least`` characters are dropped."""

    name: str
    version: int
    pattern: str
    group: int = 0
    least: int = 0

    @property
    def key(self) -> str:
        """The version in the ledger: a changed rule is another one even where its number stays."""
        return f"{self.version}.{zlib.crc32(repr((self.pattern, self.group, self.least)).encode()):08x}"


# A shorter run of hex digits, or of capitals and digits after AKIA, holds no long one: the bounds can stand in the pattern.
RULES = (
    Rule("assign", 1, r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", 1, r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", 1, r"[0-9a-f]{24,}"),
)

PAIRS = "blob string, rule string, version string"
FINDINGS = PAIRS + ", start long, end long"


class Ledger:
    """Versions, scanned pairs and findings as Parquet tables below ``path``; each scan appends. ``path_type`` is the type of paths."""

    def __init__(self, spark: SparkSession, path: str, path_type: str = "string"):
        self.spark, self.path, self.path_type = spark, path, path_type

    def _read(self, name: str, schema: str) -> DataFrame:
        fs_path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        there = fs_path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(fs_path)
        return self.spark.read.schema(schema).parquet(f"{self.path}/{name}") if there else self.spark.createDataFrame([], schema)

    def versions(self, scan: int | None = None) -> DataFrame:
        """(scan, path, blob): a row for every row of every scan, or of one."""
        every = self._read("versions", f"scan long, path {self.path_type}, blob string")
        return every if scan is None else every.where(F.col("scan") == scan)

    def scans(self) -> int:
        """The number of scans so far."""
        return self.versions().agg(F.coalesce(F.max("scan"), F.lit(0))).first()[0]

    def pairs(self) -> DataFrame:
        return self._read("pairs", PAIRS)

    def findings(self, rules=RULES) -> DataFrame:
        """Findings of the given rule versions, each once, also where a scan was cut short and repeated."""
        known = [(F.col("rule") == r.name) & (F.col("version") == r.key) for r in rules]
        chosen = known[0]
        for k in known[1:]:
            chosen = chosen | k
        return self._read("findings", FINDINGS).where(chosen).distinct()

    def append(self, findings: DataFrame, pairs: DataFrame) -> None:
        """Findings first: pairs count as scanned only once their findings are there."""
        findings.write.mode("append").parquet(f"{self.path}/findings")
        pairs.write.mode("append").parquet(f"{self.path}/pairs")


def _matches(rule: Rule) -> Column:
    """Array of structs, one per match: place among the rule's matches, length of the gap before it, of it, of the tested group."""
    p, n = F.lit(rule.pattern), lambda a: F.transform(a, lambda x: F.char_length(x).cast("long"))
    gaps, found = n(F.split("text", rule.pattern, -1)), n(F.regexp_extract_all("text", p, F.lit(0)))
    tested = n(F.regexp_extract_all("text", p, F.lit(rule.group))) if rule.group else found
    zipped = F.arrays_zip(gaps.alias("gap"), found.alias("size"), tested.alias("tested"))
    rows = F.transform(F.filter(zipped, lambda x: x["size"].isNotNull()), lambda x, i: F.struct(F.lit(rule.name).alias("rule"), F.lit(rule.key).alias("version"), i.alias("at"), x["gap"].alias("gap"), x["size"].alias("size"), (x["tested"] >= rule.least).alias("kept")))
    return F.when(F.array_contains("rules", F.lit(rule.name)) & F.col("text").rlike(rule.pattern), rows)


def scan_blobs(texts: DataFrame, rules=RULES) -> DataFrame:
    """(blob, rules, text) -> FINDINGS rows."""
    found = texts.select("blob", F.explode(F.flatten(F.array_compact(F.array(*[_matches(r) for r in rules])))).alias("m")).select("blob", "m.*").dropDuplicates(["blob", "rule", "at"])
    upto = Window.partitionBy("blob", "rule").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.col("size")).over(upto)
    return found.withColumn("end", end).where("kept").select("blob", "rule", "version", (F.col("end") - F.col("size")).alias("start"), "end")


def update(versions: DataFrame, ledger: Ledger, rules=RULES, path_col: str = "doc_id", text_col: str = "text", sent_blobs: int = SENT_BLOBS) -> int:
    """Scan what ``ledger`` has not seen of ``versions``; returns the number of this scan.

    Copies of a text meet on the map side, so a blob that very many rows hold is dealt as a row a task. Blobs to scan are
    sent to all tasks where they are at most ``sent_blobs`` (64 bytes each), so that known texts are not dealt at all."""
    named = versions.select(F.col(path_col).cast(ledger.path_type).alias("path"), text_of(text_col).alias("text")).withColumn("blob", F.sha2("text", 256))
    scan = ledger.scans() + 1
    named.select(F.lit(scan).cast("long").alias("scan"), "path", "blob").write.mode("append").parquet(f"{ledger.path}/versions")
    blobs = ledger.versions(scan).select("blob").distinct()
    wanted = blobs.select("blob", F.explode(F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(r.key).alias("version")) for r in rules])).alias("r")).select("blob", "r.*")
    unseen = wanted.join(ledger.pairs().distinct(), ["blob", "rule", "version"], "left_anti")
    todo = materialize(unseen.groupBy("blob").agg(F.collect_set("rule").alias("rules")), "unseen")
    if todo.count() <= sent_blobs:
        named = named.join(F.broadcast(todo.select("blob")), "blob", "left_semi")
    texts = named.groupBy("blob").agg(F.first("text").alias("text")).join(todo.hint("shuffle_hash"), "blob")
    of = {r.name: r.key for r in rules}
    key_of = F.element_at(F.create_map(*[F.lit(x) for kv in of.items() for x in kv]), F.col("rule")).alias("version")
    ledger.append(scan_blobs(texts.select("blob", "rules", "text"), rules), todo.select("blob", F.explode("rules").alias("rule")).select("blob", "rule", key_of))
    return scan


def report(refs: DataFrame, findings: DataFrame, rules=RULES) -> DataFrame:
    """Per version of ``refs`` (path, blob, spans, n_<rule>...): findings of its blob joined back, salted over SALTS keys as many paths may share one."""
    order = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(r.name), F.lit(i))])
    span = F.struct("start", F.element_at(order, F.col("rule")).alias("k"), F.col("rule"), F.col("end"))
    text = lambda s: F.concat_ws(":", s["rule"], s["start"].cast("string"), s["end"].cast("string"))
    per = findings.groupBy("blob").agg(F.array_sort(F.collect_list(span)).alias("list"), *[F.count(F.when(F.col("rule") == r.name, 1)).alias(f"n_{r.name}") for r in rules])
    per = per.select("blob", F.array_join(F.transform("list", text), ",").alias("spans"), *[f"n_{r.name}" for r in rules], F.explode(F.expr(f"sequence(0L, {SALTS - 1}L)")).alias("salt"))
    salted = refs.withColumn("salt", F.pmod(F.xxhash64("path"), F.lit(SALTS)))
    joined = salted.join(per, ["blob", "salt"], "left")
    return joined.select("path", "blob", F.coalesce("spans", F.lit("")).alias("spans"), *[F.coalesce(f"n_{r.name}", F.lit(0).cast("long")).alias(f"n_{r.name}") for r in rules])


def op2_secrets(spark, sf_dir: str) -> DataFrame:
    ledger = Ledger(spark, shared_path(spark, "ledger"), "long")
    scan = update(table(spark, sf_dir, "documents"), ledger)
    out = report(ledger.versions(scan), ledger.findings())
    return out.select(F.col("path").alias("doc_id"), "n_assign", "n_access", "n_hex", F.sha2("spans", 256).alias("base_sha256"), "spans")


def _sql() -> str:
    import re

    either = lambda m: "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in m)
    parts = []
    for k, r in enumerate(RULES):
        # The SQL engine folds more than A-Z under (?i), so letters are spelt in both cases.
        p = re.sub(r"\(\?i:\((.*?)\)\)", lambda m: "(" + either(m[1]) + ")", r.pattern).replace("'", "''")
        parts.append(f"""
  SELECT doc_id, {k} AS k, '{r.name}' AS rule, list_transform(string_split_regex(text, '{p}'), lambda x: length(x)) AS gaps,
         regexp_extract_all(text, '{p}', 0) AS found, regexp_extract_all(text, '{p}', {r.group}) AS tested, {r.least} AS least FROM t""")
    return f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
raw AS ({" UNION ALL ".join(parts)}),
one AS (SELECT doc_id, k, rule, least, gaps, found, tested, unnest(generate_series(1, len(found))) AS i FROM raw),
sums AS (
  SELECT doc_id, k, rule, length(tested[i]) >= least AS kept, length(found[i]) AS size,
         sum(gaps[i] + length(found[i])) OVER (PARTITION BY doc_id, k ORDER BY i) AS stop FROM one),
spans AS (SELECT doc_id, k, rule, (stop - size)::BIGINT AS start, stop::BIGINT AS stop FROM sums WHERE kept),
per AS (
  SELECT doc_id, count(*) FILTER (rule = 'assign') AS n_assign, count(*) FILTER (rule = 'access') AS n_access, count(*) FILTER (rule = 'hex') AS n_hex,
         string_agg(rule || ':' || start || ':' || stop, ',' ORDER BY start, k) AS spans FROM spans GROUP BY doc_id)
SELECT t.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM t LEFT JOIN per USING (doc_id)
"""


OP2_SQL = _sql()
