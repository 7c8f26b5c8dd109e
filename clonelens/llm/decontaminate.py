"""Benchmark decontamination by Wu-Manber multi-pattern search.

Patterns are the windows of WINDOW consecutive words of each benchmark item (an item of fewer words is one window).
Texts are searched as bytes of lower-cased words parted by one byte. Per class of pattern lengths there is a shift
table over hashed blocks of up to 8 bytes: a block that no pattern prefix holds lets the search skip to past it; at
shift 0, a table of (suffix block, prefix block) hashes selects patterns, and a direct comparison confirms. NumPy moves
many text lanes at once. Items are sent in blocks of ITEM_BYTES, one at a time: what the driver and a task hold has a fixed
bound, and each further block is one more pass over the texts, written between passes.

Defined results: a null or wordless text has no words and no hits; items without words are ignored; a null item id
reads as the empty string; repeated rows give a row each; empty tables give no rows or no hits; ``leaks_of`` passes
all other columns through, whatever their names.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, table, text_of
from .words import Canonical, buffers, chunks

WINDOW = 10
ITEM_BYTES = 8 << 20
LANE = 512
TABLE_BITS = 20
_K = np.uint64(0x9E3779B97F4A7C15)


class _Class:
    """Shift and bucket tables for patterns of similar length."""

    def __init__(self, patterns: list[bytes]):
        self.patterns = patterns
        self.m = m = min(map(len, patterns))
        self.b = b = min(8, m)
        self.mask = np.uint64((1 << (8 * b)) - 1)
        heads = np.zeros((len(patterns), m + 8), np.uint8)
        heads[:, :m] = np.frombuffer(b"".join(p[:m] for p in patterns), np.uint8).reshape(-1, m)
        flat = heads.ravel()
        rows = np.arange(len(patterns)) * (m + 8)
        self.bits = np.uint64(64 - TABLE_BITS)
        self.shift = np.full(1 << TABLE_BITS, min(255, m - b + 1), np.uint8)
        for j in range(max(0, m - b - 254), m - b + 1):
            self.shift[(self.block(flat, rows + j) * _K) >> self.bits] = m - b - j
        keys = self.key(flat, rows)
        order = np.argsort(keys, kind="stable")
        self.order, self.keys = order, keys[order]

    def block(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        view = np.ndarray((len(data) - 7,), "<u8", data, 0, (1,))
        return view[at] & self.mask

    def key(self, data, at):
        return self.block(data, at + self.m - self.b) * _K ^ (self.block(data, at) + np.uint64(7)) * np.uint64(0xD6E8FEB86659FD93)

    def search(self, data: np.ndarray, raw: bytes):
        """(position, pattern) of all occurrences; ``data`` ends with 8 spare bytes, which ``raw`` lacks."""
        last = len(raw) - self.m + 1
        if last <= 0:
            return
        p = np.arange(0, last, LANE)
        end = np.minimum(p + LANE, last)
        found = []
        while len(p):
            s = self.shift[(self.block(data, p + (self.m - self.b)) * _K) >> self.bits]
            hit = s == 0
            if hit.any():
                found.append(p[hit])
            p = p + np.maximum(s, 1)
            stay = p < end
            p, end = p[stay], end[stay]
        if not found:
            return
        at = np.concatenate(found)
        at = at[(at == 0) | (data[at - 1] <= 32)]
        keys = self.key(data, at)
        i = np.searchsorted(self.keys, keys)
        same = (i < len(self.keys)) & (self.keys[np.minimum(i, len(self.keys) - 1)] == keys)
        for pos, k, key in zip(at[same].tolist(), i[same].tolist(), keys[same].tolist(), strict=True):
            while k < len(self.keys) and int(self.keys[k]) == key:
                j = self.order[k]
                pattern = self.patterns[j]
                end = pos + len(pattern)
                if raw.startswith(pattern, pos) and (end >= len(raw) or raw[end] <= 32):
                    yield pos, pattern
                k += 1


class Matcher:
    def __init__(self, items: list[tuple[str, str]], window: int = WINDOW):
        owners: dict[bytes, list[str]] = {}
        for item, text in items:
            data = np.frombuffer(text.encode(), np.uint8)
            words = Canonical(data, np.array([0, len(data)]), 0, 1).bytes.tobytes()[1:].replace(b"\x01", b" ").split()
            for w in {b" ".join(words[i : i + window]) for i in range(max(1, len(words) - window + 1))} if words else ():
                owners.setdefault(w, []).append(item)
        self.owners = owners
        self.words = {w: w.count(b" ") + 1 for w in owners}
        by: dict[int, list[bytes]] = {}
        for w in owners:
            by.setdefault(min(5, len(w).bit_length()), []).append(w)
        self.classes = [_Class(x) for x in by.values()]

    def rows(self, data, offsets):
        """Per row: n_words, hit word ranges (start, end), item ids."""
        for a, b in chunks(offsets):
            c = Canonical(data, offsets, a, b)
            raw = c.bytes.tobytes()
            padded = np.append(c.bytes, np.zeros(8, np.uint8))
            hits: dict[int, tuple[list, set]] = {}
            for k in self.classes:
                for pos, pattern in k.search(padded, raw):
                    row = int(np.searchsorted(c.rows, pos, "right")) - 1
                    ranges, items = hits.setdefault(row, ([], set()))
                    start = int(c.before[pos]) - 1 - int(c.first_word[row])
                    ranges.append((start, start + self.words[pattern]))
                    items.update(self.owners[pattern])
            for i, n in enumerate(c.n_words.tolist()):
                yield n, *hits.get(i, ((), ()))


def merged(ranges) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(x) for x in out]


def item_blocks(items: DataFrame, id_col: str, text_col: str, size: int = ITEM_BYTES):
    block, n = [], 0
    for row in items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")), text_of(text_col)).toLocalIterator():
        block.append((row[0], row[1]))
        n += len(row[1].encode())
        if n >= size:
            yield block
            block, n = [], 0
    if block:
        yield block


def leaks_of(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, item_bytes: int = ITEM_BYTES) -> DataFrame:
    """Rows (doc, n_words, hits, items): ``doc`` is the whole row, hits its merged hit word ranges, items the ids with occurring windows."""
    spark = docs.sparkSession
    df = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.lit(0).cast("long").alias("n_words"), F.expr("cast(array() as array<struct<start:bigint,end:bigint>>)").alias("hits"), F.expr("cast(array() as array<string>)").alias("items"))
    blocks = item_blocks(items, item_id, item_text, item_bytes)
    block = next(blocks, [])
    while block is not None:
        sent = spark.sparkContext.broadcast(block)

        def run(batches, sent=sent):
            import pyarrow as pa
            import pyarrow.compute as pc

            matcher = Matcher(sent.value, window)
            for b in batches:
                old = list(zip(b.column("hits").to_pylist(), b.column("items").to_pylist(), strict=True))
                words, hits, ids = [], [], []
                for (n, ranges, found), (old_hits, old_items) in zip(matcher.rows(*buffers(pc.struct_field(b.column("doc"), [text_col]))), old, strict=True):
                    words.append(n)
                    spans = merged([*ranges, *((x["start"], x["end"]) for x in old_hits)]) if ranges or old_hits else []
                    hits.append([{"start": s, "end": e} for s, e in spans])
                    ids.append(sorted({*found, *old_items}))
                new = {"n_words": pa.array(words, pa.int64()), "hits": pa.array(hits, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), "items": pa.array(ids, pa.list_(pa.string()))}
                yield pa.RecordBatch.from_arrays([new.get(x, b.column(x)) for x in b.schema.names], b.schema.names)

        df = df.mapInArrow(run, df.schema)
        block = next(blocks, None)
        if block is not None:
            df = materialize(df, "searched")
            sent.unpersist()
    return df


def find_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Rows (id, n_words, hits, items) of ``leaks_of``."""
    named = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    return leaks_of(named, items, **options).select("doc.id", "n_words", "hits", "items")


def op6_decontamination(spark, sf_dir: str) -> DataFrame:
    found = find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"])
    ids = F.array_sort(F.array_distinct("items"))
    return found.select(
        F.col("id").alias("doc_id"), "n_words", n_hit.alias("n_hit"), F.size(ids).cast("long").alias("n_items"), F.sha2(F.concat_ws(",", ids), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated")
    )


WORD_LIST = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP6_SQL = f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, {WORD_LIST} AS w FROM documents),
b AS (SELECT coalesce(item_id::VARCHAR, '') AS item_id, {WORD_LIST} AS w FROM benchmark),
bi AS (SELECT item_id, w, least(len(w), {WINDOW}) AS k, unnest(generate_series(1, greatest(1, len(w) - {WINDOW - 1}))) AS i FROM b WHERE len(w) > 0),
pats AS (SELECT DISTINCT item_id, k, array_to_string(w[i : i + k - 1], ' ') AS p FROM bi),
di AS (SELECT r, k, w, unnest(generate_series(1, len(w) - k + 1)) AS i FROM d, (SELECT DISTINCT k FROM pats)),
found AS (SELECT r, i, di.k, item_id FROM di JOIN pats ON pats.k = di.k AND pats.p = array_to_string(w[i : i + di.k - 1], ' ')),
hit AS (SELECT r, count(DISTINCT x) AS n_hit FROM (SELECT r, unnest(generate_series(i, i + k - 1)) AS x FROM found) GROUP BY r),
ids AS (SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items FROM (SELECT DISTINCT r, item_id FROM found) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN ids USING (r)
"""
