"""N-gram Jaccard join with Bayesian candidate pruning.

A document is the set of its NGRAM-word shingles (one shingle of all its words if it has fewer). Documents of equal sets
are one copy class, carried on by one member. The join between classes runs in these steps:

1. MinHash values of every class; BANDS bands of ROWS values are hashed to bucket keys, so that a pair at the threshold
   shares a bucket but for about 5e-8 of cases.
2. In each bucket, pairs are compared on 8-bit MinHash values, STEP more at a time, and dropped as soon as the posterior
   probability (uniform prior on similarity) of reaching the threshold falls below TOLERANCE. Surviving pairs only tie
   their documents together: a spanning forest leaves the task, never the pairs. A bucket above BUCKET members is tied
   together whole by a join to its smallest member, which only widens what is verified.
3. Ties are closed to candidate components, a pair's members always being in one.
4. Components are cut into blocks of about BLOCK classes, and of about BLOCK_SHINGLES shingles where texts are long; each
   pair of blocks of a component is verified once: pruning on full MinHash values, then intersection of the whole sets of
   64-bit shingle hashes. A task returns link counts per class and a spanning forest of the links, so no group is ever
   written out as all its pairs.
5. Links are closed to the final classes.

Result, a row per document: class_id (smallest id of its connected near-duplicates), copy_id (smallest id of its equal
set), n_links (documents at or above the threshold, copies included), n_shingles.

Defined results: null, empty and wordless texts have no shingles and no links, and are alone in their class; repeated
rows link to each other; texts under one id are compared like any others; rows with a null id are members of their
class like any others, and a class of such rows only has a null class_id; an empty table gives no rows; other columns are
ignored.

Ids may be null or repeat, so inside the join a class of copies is named by its node, the smallest row number among its
members, and texts are found again by ``row_hash``.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import give_back, materialize, table, text_of
from .decontaminate import WORD_LIST
from .words import Canonical, buffers, chunks, mix64, word_hashes

NGRAM = 5
THRESHOLD = 0.8
BANDS, ROWS = 32, 4
HASHES = BANDS * ROWS
STEP = 16
TOLERANCE = 1e-5
BUCKET = 4096
BLOCK = 256
BLOCK_SHINGLES = 1 << 20
SALTS = 32

_rng = np.random.default_rng(20)
_MUL = _rng.integers(0, 1 << 63, HASHES, np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _rng.integers(0, 1 << 63, HASHES, np.uint64)
_SHINGLE = _rng.integers(0, 1 << 63, NGRAM, np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(column):
    """Sorted distinct 64-bit shingle hashes of every row of an Arrow string column."""
    data, offsets = buffers(column)
    for a, b in chunks(offsets):
        c = Canonical(data, offsets, a, b)
        h = word_hashes(c)
        n = max(0, len(h) - NGRAM + 1)
        s = np.zeros(n, np.uint64)
        for k in range(NGRAM):
            s += h[k : k + n] * _SHINGLE[k]
        s = mix64(s)
        for first, words in zip(c.first_word.tolist(), c.n_words.tolist(), strict=True):
            if words >= NGRAM:
                yield np.unique(s[first : first + words - NGRAM + 1])
            elif words:
                short = (h[first : first + words] * _SHINGLE[:words]).sum(keepdims=True)
                yield mix64(short + np.uint64(words))
            else:
                yield s[:0]


def minhashes(sets: list[np.ndarray]) -> np.ndarray:
    """HASHES values of 32 bits for every (non-empty) set."""
    out = np.empty((len(sets), HASHES), np.uint32)
    if not sets:
        return out
    starts = np.cumsum([0, *map(len, sets[:-1])])
    flat = np.concatenate(sets)
    shift = np.uint64(32)
    for k in range(HASHES):
        out[:, k] = np.minimum.reduceat((flat * _MUL[k] + _ADD[k]) >> shift, starts)
    return out


@functools.cache
def fewest_equal(bits: int, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> list[int]:
    """For 0, STEP, 2 * STEP... compared values of ``bits`` bits: the fewest equal ones with which a pair stays a candidate."""
    s = (np.arange(4000) + 0.5) / 4000
    p = s + (1 - s) / 2.0**bits
    out = [0]
    for n in range(STEP, HASHES + 1, STEP):
        for m in range(n + 1):
            log = m * np.log(p) + (n - m) * np.log1p(-p)
            like = np.exp(log - log.max())
            if like[s >= threshold].sum() >= tolerance * like.sum():
                out.append(m)
                break
    return out


def survivors(a: np.ndarray, b: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of rows of ``a`` and ``b`` that no round of comparing STEP more values drops."""
    least = fewest_equal(bits)
    equal = np.zeros((len(a), len(b)), np.uint8)
    for k in range(STEP):
        equal += a[:, k][:, None] == b[:, k][None, :]
    i, j = np.nonzero(equal >= least[1])
    n = equal[i, j].astype(np.int64)
    for r in range(1, HASHES // STEP):
        if not len(i):
            break
        cut = slice(r * STEP, (r + 1) * STEP)
        keep = np.zeros(len(i), bool)
        for c in range(0, len(i), 1 << 16):
            q = slice(c, c + (1 << 16))
            n[q] += (a[i[q], cut] == b[j[q], cut]).sum(1)
            keep[q] = n[q] >= least[r + 1]
        i, j, n = i[keep], j[keep], n[keep]
    return i, j


class Forest:
    """Union-find over 0..n-1 that keeps the edges which joined two trees."""

    def __init__(self, n: int):
        self.up = list(range(n))
        self.edges: list[tuple[int, int]] = []

    def root(self, x: int) -> int:
        up = self.up
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def join(self, pairs) -> None:
        for x, y in pairs:
            a, b = self.root(x), self.root(y)
            if a != b:
                self.up[max(a, b)] = min(a, b)
                self.edges.append((x, y))


def _key(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def row_hash(id_col: str, text_col: str):
    """Hash of a row's id and text."""
    return F.xxhash64(F.col(id_col).cast("long"), text_of(text_col))


def signatures(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, hash, set_key, n_shingles, low, bands): ``row_hash``, a 16-byte key of the shingle set, 8-bit MinHash values, and band keys of 8 bytes."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), row_hash(id_col, text_col).alias("hash"), text_of(text_col).alias("text"))

    def run(batches):
        import pyarrow as pa

        for b in batches:
            for start, sets in _portions(b.column("text")):
                full = [k for k, s in enumerate(sets) if len(s)]
                mh = minhashes([sets[k] for k in full])
                low, keys = mh.astype(np.uint8), band_keys(mh)
                none = [None] * len(sets)
                key, lows, bands = none[:], none[:], none[:]
                for r, k in enumerate(full):
                    key[k], lows[k], bands[k] = _key(sets[k]), low[r].tobytes(), keys[r].tolist()
                cols = [*[b.column(c).slice(start, len(sets)) for c in ("id", "hash")], pa.array(key, pa.binary()), pa.array([len(s) for s in sets], pa.int64()), pa.array(lows, pa.binary()), pa.array(bands, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(cols, ["id", "hash", "set_key", "n_shingles", "low", "bands"])
        give_back()

    return rows.mapInArrow(run, "id long, hash long, set_key binary, n_shingles long, low binary, bands array<long>")


def _portions(column, size: int = 1 << 18):
    """(first row, shingle sets) of runs of rows with about ``size`` shingles."""
    start, some, n = 0, [], 0
    for s in shingle_sets(column):
        some.append(s)
        n += len(s)
        if n >= size:
            yield start, some
            start, some, n = start + len(some), [], 0
    if some:
        yield start, some


def band_keys(mh: np.ndarray) -> np.ndarray:
    x = mh.reshape(len(mh), BANDS, ROWS).astype(np.uint64)
    key = np.broadcast_to(np.arange(BANDS, dtype=np.uint64) + np.uint64(1), x.shape[:2])
    for r in range(ROWS):
        key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + x[:, :, r])
    return key.view(np.int64)


def bucket_ties(members: DataFrame) -> DataFrame:
    """(key, id, low) -> (a, b) ties: spanning forests of the pairs that pruning leaves in each bucket.

    Rows come sorted by bucket, so one bucket, of at most BUCKET members, is held at a time."""

    def run(batches):
        import pyarrow as pa

        def pack(edges):
            return pa.RecordBatch.from_arrays([pa.array([e[0] for e in edges], pa.int64()), pa.array([e[1] for e in edges], pa.int64())], ["a", "b"])

        def close(ids, lows):
            if len(ids) < 2:
                return []
            m = np.frombuffer(b"".join(lows), np.uint8).reshape(len(ids), HASHES)
            f = Forest(len(ids))
            for x in range(0, len(ids), 512):
                for y in range(x, len(ids), 512):
                    i, j = survivors(m[x : x + 512], m[y : y + 512], 8)
                    if x == y:
                        keep = i < j
                        i, j = i[keep], j[keep]
                    f.join(zip((i + x).tolist(), (j + y).tolist(), strict=True))
            return [(ids[p], ids[q]) for p, q in f.edges]

        key, ids, lows, out = None, [], [], []
        for b in batches:
            for k, i, low in zip(b.column("key").to_pylist(), b.column("id").to_pylist(), b.column("low").to_pylist(), strict=True):
                if k != key:
                    out += close(ids, lows)
                    key, ids, lows = k, [], []
                ids.append(i)
                lows.append(low)
                if len(out) > 20_000:
                    yield pack(out)
                    out = []
        yield pack(out + close(ids, lows))

    return members.repartition("key").sortWithinPartitions("key", "id").mapInArrow(run, "a long, b long")


def lookup(rows: DataFrame, key: str, spread: str, found: DataFrame, how: str = "inner") -> DataFrame:
    """``rows`` with the columns of ``found``, which has one row a ``key``, where one key may hold most of ``rows``.

    Rows are dealt by key and a salt of ``spread``; each salt of a key that occurs takes the key's row of ``found``, so a
    task gets a key's SALTS-th part and ``found`` grows to SALTS rows a key at most, never beyond the rows themselves. The
    hint keeps Spark from sending ``rows`` to the tasks of ``found``, where a task would put out all rows of its keys."""
    rows = rows.withColumn("salt", F.pmod(F.xxhash64(spread), F.lit(SALTS)).cast("int"))
    wanted = rows.select(key, "salt").distinct().join(found, key)
    return rows.join(wanted.hint("merge"), [key, "salt"], how).drop("salt")


def components(edges: DataFrame) -> DataFrame:
    """Undirected (a, b) -> (id, label): the smallest id of each connected component, by minimum labels and pointer jumps.

    Every round takes the smallest label among a node and its neighbours and then replaces labels by their labels' labels.
    A node with very many edges and a label of very many nodes are dealt by ``lookup``; minima are reduced on the map side.
    """
    both = materialize(edges.where("a != b").select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e")).select("e.a", "e.b").distinct(), "edges")
    labels = materialize(both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "labels")
    while True:
        near = lookup(both, "b", "a", labels.select(F.col("id").alias("b"), F.col("label").alias("theirs"))).groupBy("a").agg(F.min("theirs").alias("near"))
        step = labels.join(near, labels.id == near.a).select("id", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jump = labels.select(F.col("id").alias("label"), F.col("label").alias("j_label"))
        step = lookup(step, "label", "id", jump, "left").select("id", "old", F.least("label", F.coalesce("j_label", "label")).alias("label"))
        step = materialize(step, "labels")
        changed = not step.where("old != label").isEmpty()
        labels = step.select("id", "label")
        if not changed:
            return labels


def _verify(texts_rows: DataFrame) -> DataFrame:
    """(component, p, q, side, id, set_key, n_copies, text) with both sides of a block pair together -> (id, other, n): links by class, and edges of their forest."""

    def run(key, table):
        import pyarrow as pa

        p, q = key[1].as_py(), key[2].as_py()
        side = table.column("side").to_numpy()
        ids, weight = table.column("id").to_numpy(), table.column("n_copies").to_numpy()
        sets = list(shingle_sets(pa.concat_arrays(table.column("text").chunks)))
        # Of rows of one hash, one whose set is the node's own.
        known, right = set(), np.zeros(len(sets), bool)
        for k, (name, wanted) in enumerate(zip(zip(ids.tolist(), side.tolist(), strict=True), table.column("set_key").to_pylist(), strict=True)):
            right[k] = name not in known and _key(sets[k]) == wanted
            known |= {name} if right[k] else set()
        mh = np.zeros((len(sets), HASHES), np.uint32)
        mh[right] = minhashes([sets[k] for k in np.flatnonzero(right)])
        one = np.flatnonzero(right & (side == 0))
        two = np.flatnonzero(right & (side == 1)) if p != q else one
        i, j = survivors(mh[one], mh[two], 32)
        if p == q:
            i, j = i[i < j], j[i < j]
        x, y = one[i], two[j]
        links = np.zeros(len(ids), np.int64)
        f = Forest(len(ids))
        for a, b in zip(x.tolist(), y.tolist(), strict=True):
            s, t = sets[a], sets[b]
            if min(len(s), len(t)) < THRESHOLD * max(len(s), len(t)):
                continue
            both = len(np.intersect1d(s, t, assume_unique=True))
            if both >= THRESHOLD * (len(s) + len(t) - both) - 1e-9:
                links[a] += weight[b]
                links[b] += weight[a]
                f.join([(a, b)])
        have = np.flatnonzero(links)
        rows = [(int(ids[k]), None, int(links[k])) for k in have] + [(int(ids[a]), int(ids[b]), 0) for a, b in f.edges]
        cols = list(zip(*rows, strict=True)) if rows else [[], [], []]
        return pa.table([pa.array(c, pa.int64()) for c in cols], names=["id", "other", "n"])

    return texts_rows.groupBy("component", "p", "q").applyInArrow(run, "id long, other long, n long")


def classed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per document: id, hash (``row_hash``), label (a number of its class, null without words), class_id, copy_id, n_links, n_shingles."""
    sig = materialize(signatures(docs, id_col, text_col).withColumn("row", F.monotonically_increasing_id()), "signatures")
    # Copies meet in a reduction on the map side; one member of each set, the node, goes on.
    sets = materialize(sig.where("set_key is not null").groupBy("set_key").agg(F.min("id").alias("copy_id"), F.min("row").alias("node"), F.count("*").alias("n_copies")), "sets")
    keys = sig.join(sets.select("node"), F.col("row") == F.col("node")).select("node", F.explode("bands").alias("key"))
    # Most buckets hold one document: only those of two or more take MinHash values along.
    counts = keys.groupBy("key").agg(F.count("*").alias("n"), F.min("node").alias("first")).where("n > 1")
    shared = materialize(keys.join(counts, "key").select("node", "key", "n", "first"), "shared")
    small, large = shared.where(F.col("n") <= BUCKET), shared.where((F.col("n") > BUCKET) & (F.col("node") != F.col("first")))
    members = small.join(sig.select("row", "low"), F.col("node") == F.col("row")).select("key", F.col("node").alias("id"), "low")
    ties = materialize(bucket_ties(members).unionByName(large.select(F.col("first").alias("a"), F.col("node").alias("b"))), "ties")
    found = components(ties)
    placed = found.join(sets.drop("copy_id"), F.col("id") == F.col("node")).join(sig.select("row", "hash", "n_shingles"), F.col("id") == F.col("row"))
    placed = materialize(placed.select("node", "hash", "label", "set_key", "n_copies", "n_shingles"), "nodes")
    need = F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES)).cast("long")
    counts = placed.groupBy("label").agg((need - 1).alias("blocks"))
    placed = lookup(placed, "label", "node", counts).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks") + 1))
    # Block b meets the blocks q >= b as the first side and the blocks p < b as the second.
    spots = F.concat(
        F.transform(F.sequence("block", "blocks"), lambda q: F.struct(F.col("block").alias("p"), q.alias("q"), F.lit(0).alias("side"))),
        F.transform(F.filter(F.sequence(F.lit(0).cast("long"), "block"), lambda p: p < F.col("block")), lambda p: F.struct(p.alias("p"), F.col("block").alias("q"), F.lit(1).alias("side"))),
    )
    placed = materialize(placed.select("node", F.col("hash").alias("p_hash"), "label", "set_key", "n_copies", spots.alias("spots")), "blocks")
    texts = docs.select(row_hash(id_col, text_col).alias("hash"), text_of(text_col).alias("text"))
    # Repeated rows have one hash and one text: the text goes on once.
    texts = texts.join(placed.hint("merge"), F.col("hash") == F.col("p_hash")).drop("p_hash").distinct()
    texts = texts.select(F.col("node").alias("id"), "text", "label", "set_key", "n_copies", F.explode("spots").alias("s"))
    verified = materialize(_verify(texts.select(F.col("label").alias("component"), "s.p", "s.q", "s.side", "id", "set_key", "n_copies", "text")), "links")
    links = verified.where("other is null").groupBy(F.col("id").alias("l_node")).agg(F.sum("n").alias("links"))
    labels = components(verified.where("other is not null").select(F.col("id").alias("a"), F.col("other").alias("b")))
    named = labels.join(sets, F.col("id") == F.col("node")).groupBy("label").agg(F.min("copy_id").alias("least"))
    labels = lookup(labels, "label", "id", named).select(F.col("id").alias("c_node"), "label", "least")
    per = sets.join(links, F.col("node") == F.col("l_node"), "left").join(labels, F.col("node") == F.col("c_node"), "left")
    per = per.select(
        F.col("set_key").alias("k"), F.coalesce("label", "node").alias("label"), "copy_id", F.coalesce("least", "copy_id").alias("class_id"),
        (F.col("n_copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.explode(F.expr("sequence(0L, 15L)")).alias("salt"),
    )
    rows = sig.select("id", "hash", "set_key", "n_shingles", F.pmod(F.xxhash64("row"), F.lit(16)).alias("r_salt"))
    out = rows.join(per, (F.col("set_key") == F.col("k")) & (F.col("r_salt") == F.col("salt")), "left")
    return out.select("id", "hash", "label", F.coalesce("class_id", "id").alias("class_id"), F.coalesce("copy_id", "id").alias("copy_id"), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), "n_shingles")


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per document: id, class_id, copy_id, n_links, n_shingles."""
    return classed(docs, id_col, text_col).drop("hash", "label")


def op5_ngram_join(spark, sf_dir: str) -> DataFrame:
    return join(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


OP5_SQL = f"""
WITH RECURSIVE d AS (SELECT doc_id, row_number() OVER () AS r, {WORD_LIST} AS w FROM documents),
di AS (SELECT r, w, unnest(generate_series(1, greatest(1, len(w) - {NGRAM - 1}))) AS i FROM d WHERE len(w) > 0),
s AS (SELECT DISTINCT r, array_to_string(w[i : i + {NGRAM - 1}], ' ') AS g FROM di),
n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
both_ AS (SELECT x.r AS a, y.r AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.r <> y.r GROUP BY ALL),
link AS (SELECT a, b, c = p.n AND c = q.n AS same FROM both_ JOIN n p ON p.r = a JOIN n q ON q.r = b WHERE c >= {THRESHOLD} * (p.n + q.n - c) - 1e-9),
reach AS (SELECT r AS a, r AS b FROM n UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
class AS (SELECT reach.a AS r, min(d.doc_id) AS class_id FROM reach JOIN d ON d.r = reach.b GROUP BY 1),
copy AS (SELECT link.a AS r, min(d.doc_id) AS copy_id FROM link JOIN d ON d.r = link.b WHERE same GROUP BY 1),
deg AS (SELECT a AS r, count(*) AS n_links FROM link GROUP BY 1)
SELECT doc_id, coalesce(class_id, doc_id) AS class_id, least(coalesce(copy_id, doc_id), doc_id) AS copy_id, coalesce(n_links, 0) AS n_links, coalesce(n.n, 0) AS n_shingles
FROM d LEFT JOIN n USING (r) LEFT JOIN class USING (r) LEFT JOIN copy USING (r) LEFT JOIN deg USING (r)
"""
