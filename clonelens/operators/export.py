"""Nested JSON, name maps and bundles of a finished analysis."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import validators as v
from . import rollup

# Fill and stroke colours in the order of use, stroke styles, and colours of nodes without reads.
COLOURS = """
F7DC6F A3E4D7 D98880 7DCEA0 EB984E D7BDE2 F3B3EF AED6F1 800000 FF00FF 00FFFF 00FF00 000000 F5F5DC 00BFFF CD5C5C 00FA9A
CD853F 483D8B FFFFF0 00CED1 BC8F8F 9ACD32 A9A9A9 BA55D3 F5F5F5 000080 FFEBCD 9932CC DA70D6 F0FFFF FFFFE0 9400D3 BDB76B
98FB98 FFE4C4 5F9EA0 708090 FFFAFA 808000 FFE4E1 8B4513 F0FFF0 778899 FFE4B5 663399 F5FFFA 008B8B FFA500 6495ED DB7093
00FF7F FFDEAD 191970 F8F8FF 6A5ACD FFB6C1 87CEEB FF8C00 228B22 FAF0E6 556B2F F5DEB3 87CEFA FFDAB9 7B68EE FAFAD2 C0C0C0
F0F8FF DC143C 20B2AA F0E68C D2691E FDF5E6 7CFC00 F4A460 ADD8E6 FFA07A 2E8B57 FA8072 800080 FFEFD5 AFEEEE FF4500 32CD32
FF1493 D3D3D3 FFF0F5 0000CD 40E0D0 DDA0DD 8B0000 FFF5EE 3CB371 DEB887 DCDCDC FFF8DC 8A2BE2 EE82EE B0C4DE FF6347 66CDAA
FFFACD 4169E1 EEE8AA 8FBC8F E9967A B0E0E6 4B0082 48D1CC 8B008B E6E6FA A52A2A E0FFFF B8860B 9370DB FAEBD7 6B8E23 FF7F50
808080 ADFF2F A0522D 7FFFD4 FF69B4 90EE90 4682B4 696969 7FFF00 FF0000 1E90FF FFFAF0 2F4F4F C71585 008080 D2B48C D8BFD8
F08080 00008B DAA520 006400 B22222 FFD700 8000FF FFC0CB 008000 FF8000 0000FF FE2712 7CBB00 FFFF00 0080FF
""".split()
STYLES = ["none", "5,5", "1,5"]
GREY, WHITE = "#808080", "#FFFFFF"
# Places of the start and end of each region in ``validators.REGION_NAMES``.
REGIONS = {"V": (0, 6), "D": (7, 8), "J": (9, 11), "CDR1": (1, 2), "CDR2": (3, 4), "CDR3": (5, 10)}


def name_map(ranks: DataFrame) -> DataFrame:
    """(cluster_id, line): ``cluster:Cn`` and, for clones of several sub-clones, ``cluster_k:Cn-m`` blank-separated after a tab."""
    items = F.array_sort(F.collect_list(F.struct("subclone_rank", F.concat("internal", F.lit(":"), "name").alias("x"))))
    out = ranks.groupBy("cluster_id", "clone_rank", "clone_name").agg(items.alias("items"))
    rest = F.when(F.size("items") > 1, F.concat(F.lit("\t"), F.array_join(F.transform("items", lambda r: r["x"]), " "))).otherwise("")
    return out.select("cluster_id", "clone_rank", F.concat(F.col("cluster_id").cast("string"), F.lit(":"), "clone_name", rest).alias("line"))


def display(ranks: DataFrame) -> DataFrame:
    """``ranks`` with color, stroke and style of each sub-clone, and clone_color, clone_stroke and clone_style."""
    n = len(COLOURS)
    pick = lambda values, k, lead="": F.element_at(F.array(*[F.lit(lead + v) for v in values]), (k + 1).cast("int"))
    own = rollup.clone_style(F.col("clone_rank") - 1, n, len(STYLES))
    sub = rollup.subclone_style(F.col("subclone_rank") - 1, own["fill"], n, len(STYLES))
    named = lambda kind, lead: {f"{lead}color": pick(COLOURS, kind["fill"], "#"), f"{lead}stroke": pick(COLOURS, kind["stroke"], "#"), f"{lead}style": pick(STYLES, kind["style"])}
    return ranks.withColumns(named(own, "clone_") | named(sub, ""))


def unique_reads(clonotypes: DataFrame) -> DataFrame:
    """(cluster_id, v_call, j_call, cdr3_aa, uniq_seq): the reads of each sub-clone by rank, from 0, with their percentage."""
    reads = F.array_sort(F.collect_list(F.struct((F.col("rank") - 1).alias("rank"), F.col("sequence_id").alias("seq_id"), F.col("occurrence").alias("reads"), F.col("share").alias("percentage"))))
    shown = F.transform(reads, lambda x: F.struct(x["seq_id"].alias("seq_id"), x["reads"].alias("reads"), x["percentage"].alias("percentage"), x["rank"].alias("rank")))
    return clonotypes.groupBy("cluster_id", "v_call", "j_call", "cdr3_aa").agg(shown.alias("uniq_seq"))


def _region(positions: str) -> Column:
    at = lambda k: F.get(positions, F.lit(k))
    return F.struct(*[F.array(at(i), at(j)).alias(name) for name, (i, j) in REGIONS.items()])


def _facts(sequences: bool = True) -> list:
    """What is told of a sub-clone beside its name and abundance."""
    whole = [F.col("whole_seq").alias("sequence"), F.col("germline_seq").alias("germline")] if sequences else []
    known = [F.col("productive").alias("functionality"), F.col("cdr3_aa").alias("cdr3"), F.col("sequence_id").alias("seq"), "v_identity", "d_identity", "j_identity"]
    return [*known, _region("positions").alias("region"), "uniq_seq", *whole, "color", "stroke", "style"]


def _subclone() -> Column:
    return F.struct("name", F.col("of_clone").alias("value"), "reads", v.share_format("of_clone").alias("ab"), v.share_format("of_repertoire").alias("ab_rep"), *_facts())


def clone_json(subs: DataFrame) -> DataFrame:
    """(clone_rank, json) of ranked sub-clones with ``display``, uniq_seq and the columns of ``_facts``: a clone of one
    sub-clone is flat, others have ``children``."""
    subs = subs.withColumn("own", _subclone())
    kids = F.array_sort(F.collect_list(F.struct("subclone_rank", F.struct("own", "v_call", "j_call", "clone_color", "clone_stroke", "clone_style").alias("x"))))
    out = subs.groupBy("clone_rank", "clone_name", "clone_reads").agg(kids.alias("kids"), F.sum("of_repertoire").alias("value"))
    first = F.get("kids", F.lit(0))["x"]
    head = [F.col("clone_name").alias("name"), F.col("value"), F.col("clone_reads").alias("reads"), v.share_format("value").alias("ab"), first["v_call"].alias("idV"), first["j_call"].alias("idJ")]
    look = [first[f"clone_{c}"].alias(c) for c in ("color", "stroke", "style")]
    told = lambda *names: [first["own"][c].alias(c) for c in names]
    flat = F.struct(*head, *told("cdr3", "functionality", "seq", "v_identity", "d_identity", "j_identity", "region", "uniq_seq", "sequence", "germline"), *look)
    nested = F.struct(*head, *told("cdr3", "functionality"), *look, F.transform("kids", lambda k: k["x"]["own"]).alias("children"))
    return out.select("clone_rank", F.when(F.size("kids") == 1, F.to_json(flat)).otherwise(F.to_json(nested)).alias("json"))


def repertoire_head(reads: dict) -> dict:
    """The root of the whole repertoire's tree, without its children."""
    return {"name": "repertoire", "value": 100, "reads": reads, "color": GREY, "stroke": GREY, "style": "none"}


def write_repertoire(clones: DataFrame, reads: dict, out) -> None:
    """The whole repertoire to the text file ``out``, one clone of ``clones`` (clone_rank, json) in the driver at a time."""
    out.write(json.dumps(repertoire_head(reads), indent=4)[:-2] + ',\n    "children": [\n')
    for k, r in enumerate(clones.orderBy("clone_rank").toLocalIterator()):
        out.write((",\n" if k else "") + r.json)
    out.write("\n    ]\n}\n")


def tree_json(edges: DataFrame, subs: DataFrame) -> DataFrame:
    """edges of ``lineage.lineages`` and sub-clones as for ``clone_json`` -> (clone_rank, complexity, json) decorated trees.

    A silent node is white with a broken stroke, value and length 1. A named node has its sub-clone's facts, its aligned
    sequence, regions by aligned column, and as length the distance from the named node above, as the spanning tree has it,
    less the silent nodes between; the germline stands at the root with the regions of the first sub-clone that has them."""
    told = F.to_json(F.struct("name", F.col("of_clone").alias("value"), "reads", v.share_format("of_clone").alias("ab"), v.share_format("of_repertoire").alias("ab_rep"), *_facts(False)))
    info = subs.select("clone_rank", F.col("name").alias("child"), told.alias("own"), F.to_json("positions").alias("places"))
    rooted = subs.groupBy("clone_rank").agg(F.min_by("positions", "subclone_rank").alias("p")).select("clone_rank", F.to_json("p").alias("root_places"))
    joined = edges.join(info, ["clone_rank", "child"], "left").join(rooted, "clone_rank", "left")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        kids: dict[str, list] = {}
        rows = {r.child: r for r in pdf.itertuples(index=False)}
        for r in pdf.itertuples(index=False):
            kids.setdefault(r.parent, []).append(r.child)
        root = kids[None][0]
        done: dict[str, dict] = {}
        order, stack = [], [(root, 0)]
        while stack:
            x, between = stack.pop()
            order.append((x, between))
            silent = bool(rows[x].silent)
            stack += [(k, between + 1 if silent else 0) for k in reversed(kids.get(x, []))]
        for x, between in reversed(order):
            r = rows[x]
            lone = lambda name: [{"seq_id": name, "percentage": "100", "rank": "0"}]
            places = lambda text, r=r: {f"{n}_region" if len(n) == 1 else n: p for n, p in regions_in(r.aligned, json.loads(text)).items()} if text else None
            if x == root:
                node = {"name": "HAUS", "value": 1, "color": GREY, "stroke": GREY, "style": "none", "seq": root, "uniq_seq": lone(root), "aligned_seq": r.aligned, "region": places(r.root_places)}
            elif r.silent:
                node = {"name": x, "value": 1, "seq": x, "color": WHITE, "stroke": GREY, "style": "2,2", "length": 1, "uniq_seq": lone(x)}
            else:
                own = json.loads(r.own) if r.own else {"name": x, "reads": int(r.abundance)}
                node = own | {"aligned_seq": r.aligned, "region": places(r.places), "length": str(float(r.dist) - between)}
            if kids.get(x):
                node["children"] = [done.pop(k) for k in kids[x]]
            done[x] = node
        top = pdf.iloc[0]
        return pd.DataFrame({"clone_rank": [int(top.clone_rank)], "complexity": [top.complexity], "json": [json.dumps(done[root])]})

    fixed = joined.select("clone_rank", "complexity", "parent", "child", "dist", "silent", "abundance", "aligned", *[F.coalesce(c, F.lit("")).alias(c) for c in ("own", "places", "root_places")])
    return fixed.groupBy("clone_rank", "complexity").applyInPandas(lambda p: run(p.astype(object).where(p.notna(), None)), "clone_rank int, complexity string, json string")


def regions_in(aligned: str, positions: list) -> dict[str, list[int]]:
    """The aligned columns (from 1) where each region starts and ends. A missing position takes the one before it; one past
    the end is the last residue's column."""
    columns = [k for k, c in enumerate(aligned, 1) if c != "-"]
    known, last = [], 1
    for p in positions:
        last = last if p is None else int(p)
        known.append(columns[min(max(last, 1), len(columns)) - 1] if columns else 1)
    return {name: [known[i], known[j]] for name, (i, j) in REGIONS.items()}


def clone_summary(ranks: DataFrame, kinds: list[str], clones: int | None = 5) -> DataFrame:
    """(clone_rank, name, v_call, j_call, ab_rep, reads, tree_type): each of the first clones that has a tree, by tree type."""
    n = ranks.groupBy("clone_rank").agg(F.count("*").alias("n"), F.sum("of_repertoire").alias("ab_rep"))
    rows = ranks.where("subclone_rank = 1").join(n, "clone_rank").where("n > 1")
    if clones is not None:
        rows = rows.where(F.col("clone_rank") <= clones)
    return rows.select("clone_rank", F.col("clone_name").alias("name"), "v_call", "j_call", "ab_rep", F.col("clone_reads").alias("reads"), F.explode(F.array(*[F.lit(k) for k in kinds])).alias("tree_type"))


def newick_trees(edges: DataFrame) -> DataFrame:
    """(clone_rank, complexity, newick) of lineage edges."""
    from ..sources.newick import dumps

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        kids: dict[str, list[str]] = {}
        for p, c in zip(pdf.parent, pdf.child, strict=True):
            if isinstance(p, str):
                kids.setdefault(p, []).append(c)
        root = pdf.child[[not isinstance(p, str) for p in pdf.parent]].iloc[0]
        lengths = dict(zip(pdf.child, pdf.dist, strict=True))
        lengths.pop(root)
        return pd.DataFrame({"clone_rank": [int(pdf.clone_rank.iloc[0])], "complexity": [pdf.complexity.iloc[0]], "newick": [dumps(root, kids, lengths)]})

    return edges.select("clone_rank", "complexity", "parent", "child", "dist").groupBy("clone_rank", "complexity").applyInPandas(run, "clone_rank int, complexity string, newick string")


def productive_label(c) -> Column:
    c = v._c(c)
    return F.when(c, "productive").when(~c, "unproductive").otherwise("/")
