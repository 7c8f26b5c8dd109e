"""Seeds of chunks meeting each other: candidates by an index of segments, decisions in rounds over the links."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import distances as d
from .checkpoints import checkpointed


def _pieces(text: Column, most: Column) -> Column:
    """(segment, its start, its letters) of ``text`` cut into ``most`` + 1 segments of like length, some perhaps empty."""
    n = F.length(text)
    start = lambda i: F.floor(i * n / (most + 1)).cast("int")
    return F.transform(F.sequence(F.lit(0), most), lambda i: F.struct(i.alias("i"), start(i).alias("at"), F.substring(text, start(i) + 1, start(i + 1) - start(i)).alias("s")))


def equal_keys(text: Column, threshold: float) -> Column:
    """Keys of which two texts of one length with ``threshold`` percent of equal letters share one: as many segments as
    letters may differ, and one."""
    n = F.length(text)
    most = F.least(n, F.floor(n * (100 - threshold) / 100 + 1e-6).cast("int"))
    return F.transform(_pieces(text, most), lambda p: F.struct(n.alias("n"), p["i"].alias("i"), p["s"].alias("s")))


def edits(n: Column, tolerance: int, threshold: float) -> Column:
    """Edits within which a text lies of one of ``n`` letters that it is like: the letters that may differ over the shorter
    one, half a percent being lost to rounding, and the letters by which the lengths differ."""
    return F.floor((n + tolerance) * (100.5 - threshold) / 100 + 1e-6).cast("int") + tolerance


def stored_keys(text: Column, tolerance: int, threshold: float) -> Column:
    n = F.length(text)
    return F.transform(_pieces(text, edits(n, tolerance, threshold)), lambda p: F.struct(n.alias("n"), p["i"].alias("i"), p["s"].alias("s")))


def probing_keys(text: Column, tolerance: int, threshold: float) -> Column:
    """Keys of which a text shares one of ``stored_keys`` with each text like it whose length differs by ``tolerance`` at
    most and is not the same: one segment is left whole, moved by no more letters than there are edits."""
    n = F.length(text)

    def of_length(m: Column) -> Column:
        most = edits(m, tolerance, threshold)
        start = lambda i: F.floor(i * m / (most + 1)).cast("int")

        def of_segment(i: Column) -> Column:
            size = start(i + 1) - start(i)
            low, high = F.greatest(F.lit(0), start(i) - most), F.least(n - size, start(i) + most)
            at = F.when(low <= high, F.sequence(low, F.greatest(low, high))).otherwise(F.array().cast("array<int>"))
            return F.transform(at, lambda k: F.struct(m.alias("n"), i.alias("i"), F.substring(text, k + 1, size).alias("s")))

        return F.flatten(F.transform(F.sequence(F.lit(0), most), of_segment))

    others = F.filter(F.sequence(F.greatest(F.lit(0), n - tolerance), n + tolerance), lambda m: m != n)
    return F.array_distinct(F.flatten(F.transform(others, of_length)))


def links(seeds: DataFrame, threshold: float, tolerant: str, tolerance: int = 1) -> DataFrame:
    """seeds (number, v_call, j_call, len, first, chunk, text) -> (late, early, score): seeds of one (v, j) and of two blocks
    (first, chunk) that are alike by ``threshold`` percent, in the order of their numbers."""
    side = lambda name, rows, keys: rows.select("v_call", "j_call", *[F.col(c).alias(f"{name}_{c}") for c in ("number", "first", "chunk", "text")], F.explode(keys).alias("key"))
    text, loose = F.col("text"), seeds.where(F.col("j_call") == tolerant)
    same = side("a", seeds, equal_keys(text, threshold)).join(side("b", seeds, equal_keys(text, threshold)), ["v_call", "j_call", "key"])
    other = side("a", loose, probing_keys(text, tolerance, threshold)).join(side("b", loose, stored_keys(text, tolerance, threshold)), ["v_call", "j_call", "key"])
    met = same.unionByName(other).where("a_number > b_number and (a_first <> b_first or a_chunk <> b_chunk)")
    alike = F.when(F.col("a_text") == F.col("b_text"), 100.0).when((F.col("a_text") == "") | (F.col("b_text") == ""), 0.0).otherwise(d.mixed_similarity("a_text", "b_text"))
    scored = met.select(F.col("a_number").alias("late"), F.col("b_number").alias("early"), alike.alias("score"))
    return scored.where(F.col("score") >= threshold).distinct()


def heads(met: DataFrame) -> DataFrame:
    """(number): the ends of ``links`` that a pass in the order of numbers leaves without an earlier head among their links.

    A seed without an undecided earlier one is a head; those linked to it are none. The earliest undecided seed is always
    decided, and a round decides all that depend on no other, so there are as many rounds as such a chain is long."""
    open_, found = checkpointed(met.select("late", "early")), []
    ends = checkpointed(open_.select(F.explode(F.array("late", "early")).alias("number")).distinct())
    while not ends.isEmpty():
        now = checkpointed(ends.join(open_.select(F.col("late").alias("number")).distinct(), "number", "left_anti"))
        found.append(now)
        fallen = open_.join(now.withColumnRenamed("number", "early"), "early", "left_semi").select(F.col("late").alias("number"))
        ends = checkpointed(ends.join(now.unionByName(fallen).distinct(), "number", "left_anti"))
        left = ends.withColumnRenamed("number", "late")
        open_ = checkpointed(open_.join(left, "late", "left_semi").join(left.withColumnRenamed("late", "early"), "early", "left_semi"))
    return reduce(DataFrame.unionByName, found) if found else ends


def owners(seeds: DataFrame, threshold: float, tolerant: str) -> DataFrame:
    """(number, head): the seed whose cluster each seed belongs to, itself where it opens one.

    A seed joins the earlier head that it is most like, the last of equal ones, if one of another block is alike by
    ``threshold`` percent."""
    met = checkpointed(links(seeds, threshold, tolerant))
    first = checkpointed(heads(met))
    to_head = met.join(first.withColumnRenamed("number", "early"), "early", "left_semi").join(first.withColumnRenamed("number", "late"), "late", "left_anti")
    best = to_head.groupBy(F.col("late").alias("number")).agg(F.max(F.struct("score", "early"))["early"].alias("head"))
    return seeds.select("number").join(best, "number", "left").select("number", F.coalesce("head", "number").alias("head"))
