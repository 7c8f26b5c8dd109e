"""Phrases whose words occur together more often than their parts would: level-wise mining with exact counts and scores.

Texts are lower-cased (A-Z), cut into pieces at SEPARATORS and into words at blanks and tabs. Level 1 counts the words of
each language; the frequent ones get ids, and texts become arrays of ids in which 0 parts pieces and stands for any word
that is not frequent. Level k counts a k-gram only where the frequent (k-1)-grams of its first and of its last words both
stand, as the pair of their ids, which names the k-gram; the frequent pairs get ids, the arrays are rewritten with them,
and what no longer has a neighbour is dropped. Each level's table holds its phrases with the counts of all their first and
last words, joined on from the table below, so cuts are scored from the tables alone.

The table of frequent grams is sent to all tasks in blocks of BLOCK_ROWS rows and BLOCK_BYTES bytes of words at most: where
it has more, the arrays take one more pass for each block. Counts are summed in tasks before they are shuffled. A batch of
rows is worked off in runs of rows of about PART_IDS ids or PART_BYTES bytes of text, so that what a task holds besides the
batch itself does not grow with it.

Defined results: a null text is empty; a null language is `und`; repeated rows count again; ties of score and count are
ordered by the phrase's bytes; an empty table gives no rows; columns other than the named ones are ignored. Words and texts
may be of any length. Scores are computed in decimals of 38 digits; counts up to 10^15 cannot pass them.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import give_back, materialize, partitions, table

MIN_COUNT, LONGEST, COVERED, BEST = 100, 5, 100, 2000
SEPARATORS = ".,;:!?\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLOCK_ROWS, BLOCK_BYTES = 1_000_000, 32 << 20
HELD = 300_000  # distinct words that a counting task holds
ROW_IDS = 4096  # ids of a row of the arrays, or more where no 0 parts them
PART_IDS, PART_BYTES = 1 << 20, 4 << 20  # ids or bytes of a run of rows, or one row's where it has more
SALTS = 64
# What remains as white space for split() after this table is the line feed, blank and tab.
_MAP = bytes.maketrans((UPPER + SEPARATORS).encode(), LOWER.encode() + b"\n" * len(SEPARATORS))


def _lines(text: str):
    return text.encode().translate(_MAP).split(b"\n")


def _languages(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def _runs(batch, column: str):
    """``batch`` in runs of whole rows, each of about PART_IDS ids or PART_BYTES bytes in ``column``."""
    import pyarrow.compute as pc

    values = batch.column(column)
    texts = column == "text"
    sizes = (pc.binary_length(values) if texts else pc.list_value_length(values)).to_numpy(zero_copy_only=False)
    run = np.cumsum(sizes, dtype=np.int64) // (PART_BYTES if texts else PART_IDS)
    begin = 0
    for end in [*(np.flatnonzero(np.diff(run)) + 1).tolist(), batch.num_rows]:
        yield batch.slice(begin, end - begin)
        begin = end


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, word, n) of ``docs`` (lang, text), and a row without word for all words of a language."""

    def run(batches):
        import pyarrow as pa

        held: dict[str, Counter] = {}

        def flush():
            for lang, c in held.items():
                words, counts = [None, *(w.decode() for w in c)], [sum(c.values()), *c.values()]
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(words), pa.string()), pa.array(words, pa.string()), pa.array(counts, pa.int64())], ["lang", "word", "n"])
            held.clear()

        for b in batches:
            for lang, text in zip(b.column("lang").to_pylist(), b.column("text"), strict=True):
                c = held.setdefault(lang, Counter())
                for line in _lines(text.as_py()):
                    c.update(line.split())
                if len(c) > HELD or len(held) > 1000:
                    yield from flush()
        yield from flush()
        give_back()

    return docs.mapInArrow(run, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


class Words:
    """A block of the first level: ids of (language, word)."""

    def __init__(self, rows):
        self.ids: dict[str, dict[bytes, int]] = {}
        for lang, word, i in zip(*(rows.column(c).to_pylist() for c in ("lang", "word", "id")), strict=True):
            self.ids.setdefault(lang, {})[word.encode()] = i

    def fill(self, batch) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words of the batch, 0 after each piece and for words of other blocks, and the ends of rows."""
        flat, ends, none = [], [0], {}
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
            get = self.ids.get(lang, none).get
            for line in _lines(text.as_py()):
                flat.extend([get(w, 0) for w in line.split()])
                flat.append(0)
            ends.append(len(flat))
        return np.array(flat, np.int64), np.array(ends, np.int64)


class Pairs:
    """A block of a further level: ids of pairs of neighbouring ids."""

    def __init__(self, rows):
        a, b, ids = (rows.column(c).to_numpy() for c in ("a", "b", "id"))
        self.a, self.b = np.unique(a), np.unique(b)
        key = np.searchsorted(self.a, a) * len(self.b) + np.searchsorted(self.b, b)
        order = np.argsort(key)
        self.key, self.ids = key[order], ids[order]

    @staticmethod
    def _place(known: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(known, x), max(len(known) - 1, 0))
        return at, known[at] == x

    def fill(self, batch) -> tuple[np.ndarray, np.ndarray]:
        lists = batch.column("prev")
        x = lists.flatten().to_numpy()
        found = np.zeros(len(x), np.int64)
        at = neighbours(x)
        if len(at) and len(self.key):
            a, is_a = self._place(self.a, x[at])
            b, is_b = self._place(self.b, x[at + 1])
            place, is_key = self._place(self.key, a * len(self.b) + b)
            found[at] = np.where(is_a & is_b & is_key, self.ids[place], 0)
        return found, np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())]).astype(np.int64)


def neighbours(x: np.ndarray) -> np.ndarray:
    """Places i where x[i] and x[i + 1] are ids."""
    return np.flatnonzero((x[:-1] != 0) & (x[1:] != 0))


def squeezed(x: np.ndarray) -> np.ndarray:
    """``x`` without ids that have no neighbour and with one 0 after each run."""
    if not len(x):
        return x
    there = np.concatenate([[False], x != 0, [False]])
    x = np.where(there[:-2] | there[2:], x, 0)
    before = np.concatenate([[0], x[:-1]])
    return x[(x != 0) | (before != 0)]


def _lists(x: np.ndarray, size: int):
    """Arrow lists of about ``size`` values of ``x``, each ending with a 0."""
    import pyarrow as pa

    zeros = np.flatnonzero(x == 0) + 1
    if not len(zeros):
        return pa.array([], pa.list_(pa.int64()))
    ends = zeros[np.searchsorted(zeros, np.arange(size, len(x) + size, size)).clip(max=len(zeros) - 1)]
    ends = np.unique(np.concatenate([[0], ends, zeros[-1:]]))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x[: ends[-1]], pa.int64()))


def _pass(rows: DataFrame, block, first: bool, last: bool) -> DataFrame:
    """``rows`` with the ids of one block filled in; after the last block only the squeezed ids are left."""
    keep = [c for c in rows.columns if c != "ids"]
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    first_level = "text" in keep
    schema = "prev array<long>" if last else ", ".join(f"{c} {kinds[c]}" for c in keep) + ", ids array<long>"

    def run(batches):
        import pyarrow as pa

        for b in (part for whole in batches for part in _runs(whole, "text" if first_level else "prev")):
            found, ends = block.value.fill(b)
            if not first:
                found = np.where(found == 0, b.column("ids").flatten().to_numpy(), found)
            if last:
                lists = _lists(squeezed(found), ROW_IDS)
                yield pa.RecordBatch.from_arrays([lists], ["prev"])
            else:
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(found, pa.int64()))
                yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), lists], [*keep, "ids"])
        give_back()

    return rows.mapInArrow(run, schema)


def coded(rows: DataFrame, level: DataFrame, kind, columns: list[str], block_rows: int, block_bytes: int) -> DataFrame:
    """Arrays of the ids of ``level``'s grams in ``rows``, which are texts or arrays of the level below."""
    spark = rows.sparkSession
    size = F.sum(F.octet_length(F.col("word"))) if "word" in columns else F.lit(0)
    n, n_bytes = level.agg(F.count("*"), size).first()
    # Blocks by hash are about equal in size: half the bound leaves room.
    blocks = max(1, -(-2 * n // block_rows), -(-2 * (n_bytes or 0) // block_bytes)) if n > block_rows or (n_bytes or 0) > block_bytes else 1
    for i in range(blocks):
        some = level.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == i) if blocks > 1 else level
        sent = spark.sparkContext.broadcast(kind(some.select(*columns).toArrow()))
        rows = materialize(_pass(rows, sent, i == 0, i == blocks - 1), "collocations-coded")
        sent.unpersist()
    return rows


def pair_counts(rows: DataFrame) -> DataFrame:
    """(a, b, n) of neighbouring ids in ``rows`` (prev)."""

    def run(batches):
        import pyarrow as pa

        for part in (part for whole in batches for part in _runs(whole, "prev")):
            x = part.column("prev").flatten().to_numpy()
            at = neighbours(x)
            a, ia = np.unique(x[at], return_inverse=True)
            b, ib = np.unique(x[at + 1], return_inverse=True)
            key, n = np.unique(ia * max(len(b), 1) + ib, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(a[key // max(len(b), 1)], pa.int64()), pa.array(b[key % max(len(b), 1)], pa.int64()), pa.array(n, pa.int64())], ["a", "b", "n"])
        give_back()

    return rows.mapInArrow(run, "a long, b long, n long").groupBy("a", "b").agg(F.sum("n").alias("f"))


ID = F.monotonically_increasing_id


def levels(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", min_count: int = MIN_COUNT, longest: int = LONGEST, block_rows: int = BLOCK_ROWS, block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, list[DataFrame]]:
    """(lang, n) of all words, and for each length the table (id, a, b, lang, words, f, heads, tails) of its frequent
    phrases; heads and tails hold the counts of the first and of the last 1, 2, ... words, a and b the ids of all words
    but the last and but the first."""
    texts = _languages(docs, text_col, lang_col)
    counts = materialize(word_counts(texts).where(F.col("word").isNull() | (F.col("n") >= min_count)), "collocations-words")
    totals = counts.where("word is null").select("lang", "n")
    none, no_counts = F.lit(0).cast("long"), F.array().cast("array<long>")
    first = counts.where("word is not null").select((ID() + 1).alias("id"), none.alias("a"), none.alias("b"), "lang", F.array("word").alias("words"), F.col("n").alias("f"), no_counts.alias("heads"), no_counts.alias("tails"))
    found = [materialize(first, "collocations-level")]
    rows = coded(texts, found[0].withColumn("word", F.col("words")[0]), Words, ["lang", "word", "id"], block_rows, block_bytes)
    for k in range(2, longest + 1):
        some = pair_counts(rows).where(F.col("f") >= min_count)
        below = found[-1]
        low = below.select(F.col("id").alias("a"), "lang", F.col("words").alias("start"), F.concat("heads", F.array("f")).alias("heads"))
        high = below.select(F.col("id").alias("b"), F.element_at("words", -1).alias("end"), F.concat("tails", F.array("f")).alias("tails"))
        level = some.join(low, "a").join(high, "b").select((ID() + 1).alias("id"), "a", "b", "lang", F.concat("start", F.array("end")).alias("words"), "f", "heads", "tails")
        found.append(materialize(level, "collocations-level"))
        if k < longest:
            rows = coded(rows, found[-1], Pairs, ["a", "b", "id"], block_rows, block_bytes)
    return totals, found


def cut_scores(k: int) -> Column:
    """(score, k, l, r) of the lowest cut of a phrase of ``k`` words, the smallest k of equal ones."""
    wide = lambda c: c.cast("decimal(19,0)")

    def cut(i: int) -> Column:
        left, right = F.col("heads")[i - 1], F.col("tails")[k - i - 1]
        above, below = wide(F.col("f") * 1000) * wide(F.col("n")), wide(left) * wide(right)
        return F.struct(F.call_function("div", above, below).alias("score"), F.lit(i).alias("k"), left.alias("l"), right.alias("r"))

    return F.array_min(F.array(*[cut(i) for i in range(1, k)]))


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", min_count: int = MIN_COUNT, longest: int = LONGEST, covered: int = COVERED, best: int = BEST, block_rows: int = BLOCK_ROWS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Rows (lang, rank, phrase, a, l, r, n, score): the ``best`` phrases of each language of 2 to ``longest`` words.

    A phrase is dropped where a longer one of at least ``covered`` percent of its count holds it. The longer it gets the
    rarer, so the phrases that are one word longer decide this."""
    totals, found = levels(docs, text_col, lang_col, min_count, longest, block_rows, block_bytes)
    parts = []
    for k, level in enumerate(found[1:], 2):
        rows = level
        if k < longest:
            longer = found[k]
            holders = longer.select(F.col("a").alias("id"), F.col("f").alias("held")).unionByName(longer.select(F.col("b").alias("id"), F.col("f").alias("held")))
            rows = level.join(holders.groupBy("id").agg(F.max("held").alias("held")), "id", "left").where(f"held is null or 100 * held < {covered} * f")
        rows = rows.join(totals, "lang").withColumn("cut", cut_scores(k))
        parts.append(rows.select("lang", F.array_join("words", " ").alias("phrase"), F.col("f").alias("a"), F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score")))
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    # The best of each portion of a language first, so that a language is ranked from SALTS * best rows at most.
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    salted = every.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    few = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("rank") <= best)
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= best)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op11_collocations(spark, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


OP11_SQL = f"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
p AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda w: w <> '') AS ws FROM d),
g AS (SELECT lang, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: ws[i:i + k - 1])) AS g FROM p, range(1, {LONGEST + 1}) AS t(k)),
n AS (SELECT lang, count(*) AS n FROM g WHERE k = 1 GROUP BY lang),
f AS (SELECT lang, k, g, count(*) AS a FROM g GROUP BY lang, k, g HAVING count(*) >= {MIN_COUNT}),
subs AS (SELECT lang, unnest(flatten(list_transform(range(2, k), lambda m: list_transform(range(1, k - m + 2), lambda i: g[i:i + m - 1])))) AS g, a FROM f WHERE k > 2),
held AS (SELECT lang, g, max(a) AS held FROM subs GROUP BY lang, g),
c AS (SELECT f.* FROM f LEFT JOIN held USING (lang, g) WHERE k > 1 AND (held IS NULL OR 100 * held < {COVERED} * a)),
cuts AS (SELECT lang, g, k, a, unnest(range(1, k)) AS j FROM c),
s AS (
  SELECT cuts.lang, cuts.g, cuts.a, j, l.a AS l, r.a AS r, n, (1000::HUGEINT * cuts.a * n) // (l.a::HUGEINT * r.a) AS score
  FROM cuts JOIN n USING (lang) JOIN f l ON l.lang = cuts.lang AND l.g = cuts.g[1:j] JOIN f r ON r.lang = cuts.lang AND r.g = cuts.g[j + 1:cuts.k]),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, j) = 1),
o AS (SELECT lang, array_to_string(g, ' ') AS phrase, a, l, r, n, score FROM b)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score::BIGINT AS score
FROM o QUALIFY rank <= {BEST}
"""
