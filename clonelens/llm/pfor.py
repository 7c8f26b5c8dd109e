"""Token ids in patched frame-of-reference blocks.

Texts are dealt by id ranges and sorted, so files follow ascending id. A task tokenises its texts (words that come again
are looked up, not encoded again) and writes segments of about SEGMENT_IDS ids. A segment is one binary image, held as a
row of a Parquet table in the shared folder, so any store that Spark writes can hold it:

    magic b"PFR1", u32 rows, u64 ids, u32 blocks, u32 exceptions, u8 is the last id of each row an end id
    i64 row ids, u8 row id is null, u32 ids of each row
    u32 minimum of each block, u8 width of each block, u8 number of exceptions of each block
    u32 block starts: index of each block's first 8-byte word in the packed part
    u8 exception positions, u32 exception values
    packed part: 2 * width little-endian words of 8 bytes a block, value i at bit i * width

A block has BLOCK values less its minimum; the width is that of the given percentile; larger values are exceptions.

Defined results: a null or empty text has only the end id; null ids come first; rows of one id are ordered by a hash of
their text; an empty table gives no segment and no row; other columns are ignored.
"""

from __future__ import annotations

import re
import struct
import zlib
from itertools import chain, islice, repeat

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import give_back, shared_path, table, tasks_for, text_of
from .words import buffers, chunks

BLOCK = 128
PERCENTILE = 0.98
SEGMENT_IDS = 1 << 20
ENCODE_BYTES = 4 << 20
TASK_BYTES = 64 << 20
END_ID = 0
MEMO = 250_000  # words that a task remembers
KEPT = 50_000  # of these, words that its process remembers afterwards
_BITS = np.frexp(np.arange(1 << 16, dtype=np.float64))[1].astype(np.uint8)
_HEAD = struct.Struct("<4sIQIIB")


def pack(ids: np.ndarray, percentile: float = PERCENTILE):
    """(mins, widths, exception counts, starts, exception positions, exception values, packed words) of ``ids``."""
    n = -(-len(ids) // BLOCK)
    v = np.empty(n * BLOCK, np.uint32)
    v[: len(ids)] = ids
    v[len(ids) :] = ids[-1] if len(ids) else 0
    v = v.reshape(n, BLOCK)
    mins = v.min(1, initial=(1 << 32) - 1)
    d = v - mins[:, None]
    k = min(BLOCK - 1, int(percentile * BLOCK))
    # Bit lengths are few, so their counts in each block give the percentile without sorting.
    lengths = _BITS[d] if n and d.max() < len(_BITS) else np.frexp(d.astype(np.float64))[1].astype(np.uint8)
    counts = np.bincount((np.arange(n)[:, None] * 33 + lengths).ravel(), minlength=33 * n).reshape(n, 33)
    widths = (np.cumsum(counts, axis=1) <= k).sum(1).astype(np.uint8)
    limits = ((np.uint64(1) << widths.astype(np.uint64)) - np.uint64(1)).astype(np.uint32)
    where, positions = np.divmod(np.flatnonzero(d > limits[:, None]), BLOCK)
    values = v[where, positions]
    d[where, positions] = 0
    starts = np.concatenate([[0], np.cumsum(2 * widths.astype(np.int64))])
    words = np.zeros(starts[-1], np.uint64)
    for w in np.unique(widths).tolist():
        if not w:
            continue
        rows = np.flatnonzero(widths == w)
        t = np.ascontiguousarray(d[rows].T).astype(np.uint64)
        p = np.zeros((2 * w, len(rows)), np.uint64)
        for i in range(BLOCK):
            word, off = divmod(i * w, 64)
            p[word] |= t[i] << np.uint64(off)
            if off + w > 64:
                p[word + 1] |= t[i] >> np.uint64(64 - off)
        words[starts[rows][:, None] + np.arange(2 * w)] = p.T
    return mins.astype(np.uint32), widths, np.bincount(where, minlength=n).astype(np.uint8), starts[:-1].astype(np.uint32), positions.astype(np.uint8), values, words


def write_segment(row_ids: list, lengths: np.ndarray, ids: np.ndarray, percentile: float = PERCENTILE) -> bytes:
    mins, widths, counts, starts, positions, values, words = pack(ids, percentile)
    nulls = np.array([x is None for x in row_ids], np.uint8)
    keys = np.array([0 if x is None else x for x in row_ids], np.int64)
    head = _HEAD.pack(b"PFR1", len(row_ids), len(ids), len(mins), len(values), 1)
    return b"".join([head, *(a.astype(a.dtype.newbyteorder("<"), copy=False).tobytes() for a in (keys, nulls, lengths.astype(np.uint32), mins, widths, counts, starts, positions, values, words))])


class Segment:
    """A segment read back: row_ids, lengths, block(i) and ids()."""

    def __init__(self, data: bytes):
        magic, rows, self.n, blocks, exceptions, _ = _HEAD.unpack_from(data)
        if magic != b"PFR1":
            raise ValueError("not a segment")
        at = _HEAD.size

        def take(kind, n):
            nonlocal at
            a = np.frombuffer(data, kind, n, at)
            at += a.nbytes
            return a

        keys, nulls, self.lengths = take("<i8", rows), take("u1", rows), take("<u4", rows)
        self.row_ids = [None if z else k for k, z in zip(keys.tolist(), nulls.tolist(), strict=True)]
        self.mins, self.widths, self.counts, self.starts = take("<u4", blocks), take("u1", blocks), take("u1", blocks), take("<u4", blocks)
        self.positions, self.values = take("u1", exceptions), take("<u4", exceptions)
        self.words = take("<u8", (len(data) - at) // 8)
        self.exception_starts = np.concatenate([[0], np.cumsum(self.counts, dtype=np.int64)])

    def _blocks(self, rows: np.ndarray) -> np.ndarray:
        out = np.empty((len(rows), BLOCK), np.uint32)
        widths = self.widths[rows]
        for w in np.unique(widths).tolist():
            at = np.flatnonzero(widths == w)
            some = rows[at]
            t = np.zeros((BLOCK, len(some)), np.uint64)
            if w:
                p = np.ascontiguousarray(self.words[self.starts[some].astype(np.int64)[:, None] + np.arange(2 * w)].T)
                mask = np.uint64((1 << w) - 1)
                for i in range(BLOCK):
                    word, off = divmod(i * w, 64)
                    t[i] = p[word] >> np.uint64(off)
                    if off + w > 64:
                        t[i] |= p[word + 1] << np.uint64(64 - off)
                    t[i] &= mask
            out[at] = (t.T + self.mins[some].astype(np.uint64)[:, None]).astype(np.uint32)
        return out

    def block(self, i: int) -> np.ndarray:
        out = self._blocks(np.array([i]))[0]
        a, b = self.exception_starts[i : i + 2]
        out[self.positions[a:b]] = self.values[a:b]
        return out[: self.n - i * BLOCK]

    def ids(self) -> np.ndarray:
        out = self._blocks(np.arange(len(self.mins)))
        out[np.repeat(np.arange(len(self.mins)), self.counts), self.positions] = self.values
        return out.ravel()[: self.n]


BARE = "\n\n"  # marks a piece without a blank before it; no plain text holds it
WHOLE = "\n\n\x00"  # stands for a text that is encoded as a whole
_ODD = "^$|^ | $|\n$|^\n|  | \n|\n |\n\n|[\t\r\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
# Letters that every version of Unicode since 3.0 knows, by ranges: Latin, Greek, Cyrillic, Hebrew, Arabic, kana, CJK, Hangul.
_LETTER = "A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\u021f\u0391-\u03a1\u03a3-\u03ce\u0400-\u0481\u05d0-\u05ea\u0621-\u063a\u0641-\u064a\u3041-\u3094\u30a1-\u30fa\u4e00-\u9fa5\uac00-\ud7a3"
_WORD = f"^(?P<line>\n{{0,2}})(?P<word>[{_LETTER}]+)(?P<signs>[!-/:-@\\[-`{{-~]*)$"


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: visible Latin-1 characters themselves, others counted up from 256."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = (b for b in range(256) if b not in own)
    return {b: chr(256 + k) for k, b in enumerate(others)}


_BYTE_LETTERS = _byte_letters()


class Encoder:
    """Byte-level BPE of whole texts through the tokenizers library, with a table of words met before.

    The library's pre-tokenizer always starts a piece at a blank before a non-blank, at a single line end and at a run of
    signs after letters, and merges stay inside pieces. So a text whose white space is single blanks and line ends between
    words equals the sequence of its words' encodings; any other text is encoded as a whole, and so is every text where
    the tokenizer is of another kind. Pieces that are letters alone go straight to the library's model.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, models, pre_tokenizers

        self.tok = tok = Tokenizer.from_file(path)
        self.special = [t.content for t in tok.get_added_tokens_decoder().values()]
        pre = tok.pre_tokenizer
        self.by_words = isinstance(tok.model, models.BPE) and isinstance(pre, pre_tokenizers.ByteLevel) and not pre.add_prefix_space and tok.normalizer is None
        self.memo: dict[str, int] = {"": 0}
        self.flat, self.start, self.length = np.array([END_ID], np.uint32), np.array([0]), np.array([1])

    def _letters(self, words: list[str], lead: str) -> list[list[int]]:
        """Ids of pieces of letters, each after ``lead``."""
        tokenize = self.tok.model.tokenize
        mapped = [lead + (w if w.isascii() else w.encode().decode("latin-1").translate(_BYTE_LETTERS)) for w in words]
        return [[t.id for t in tokenize(w)] for w in mapped]

    def _whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tok.encode_batch(texts, add_special_tokens=False)] if texts else []

    def _enter(self, names: list[str], ids: np.ndarray, lengths: np.ndarray) -> None:
        known = len(self.memo)
        self.memo.update(zip(names, range(known, known + len(names)), strict=True))
        self.start = np.concatenate([self.start, len(self.flat) + np.cumsum(lengths) - lengths])
        self.length = np.concatenate([self.length, lengths])
        self.flat = np.concatenate([self.flat, ids])

    def _add(self, names: list[str], lists: list[list[int]]) -> None:
        lengths = np.fromiter(map(len, lists), np.int64, len(lists))
        self._enter(names, np.fromiter(chain.from_iterable(lists), np.uint32, int(lengths.sum())), lengths)

    def _find(self, names: list[str]) -> np.ndarray:
        return np.fromiter(map(self.memo.get, names, repeat(-1)), np.int64, len(names))

    def _learn(self, new) -> None:
        """Enter the words of the Arrow array ``new``, none of which is known."""
        import pyarrow.compute as pc

        parts = pc.extract_regex(new, _WORD)
        other = new.filter(pc.invert(pc.is_valid(parts))).to_numpy(zero_copy_only=False).tolist()
        self._add(other, self._whole([x[2:] if x[:2] == BARE else x if x[:1] == "\n" else " " + x for x in other]))
        new, parts = new.filter(pc.is_valid(parts)), parts.filter(pc.is_valid(parts))
        names, lines, words, signs = (x.to_numpy(zero_copy_only=False) for x in (new, *(pc.struct_field(parts, [k]) for k in ("line", "word", "signs"))))
        bare, lined, signed = lines != "", lines == "\n", signs != ""
        # The words themselves, then line ends and runs of signs, then what is put together from these.
        for is_bare, mark, lead in ((False, "", "\u0120"), (True, BARE, "")):
            todo = [w for w in dict.fromkeys(words[bare == is_bare].tolist()) if mark + w not in self.memo]
            self._add([mark + w for w in todo], self._letters(todo, lead))
        runs = [x for x in ["\n", *dict.fromkeys(signs[signed].tolist())] if BARE + x not in self.memo]
        self._add([BARE + x for x in runs], self._whole(runs))
        for has_line, has_sign in ((False, True), (True, False), (True, True)):
            at = np.flatnonzero((lined == has_line) & (signed == has_sign))
            if not len(at):
                continue
            pieces = [self._find([(BARE if b else "") + w for w, b in zip(words[at].tolist(), bare[at].tolist(), strict=True)])]
            if has_line:
                pieces.insert(0, np.full(len(at), self.memo[BARE + "\n"]))
            if has_sign:
                pieces.append(self._find([BARE + x for x in signs[at].tolist()]))
            index = np.stack(pieces, 1)
            ids, total = self._gather(self.start[index.ravel()], self.length[index.ravel()]), self.length[index].sum(1)
            self._enter(names[at].tolist(), ids, total)

    def _gather(self, start, length):
        ends = np.cumsum(length)
        return self.flat[np.repeat(start - ends + length, length) + np.arange(ends[-1] if len(ends) else 0)]

    def keep(self, n: int) -> None:
        """Forget all but the ``n`` first words, which are mostly the frequent ones."""
        if len(self.memo) <= n:
            return
        self.memo = dict(islice(self.memo.items(), n))
        self.flat = self._gather(self.start[:n], self.length[:n])
        self.length = self.length[:n]
        self.start = np.cumsum(self.length) - self.length

    def encode(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """All ids of an Arrow array of texts, each text's followed by END_ID, and the number of ids of each text."""
        import pyarrow as pa
        import pyarrow.compute as pc

        if len(self.memo) > MEMO:
            self.keep(MEMO // 2)
        odd = pc.match_substring_regex(texts, _ODD if self.by_words else "")
        for s in self.special:
            odd = pc.or_(odd, pc.match_substring(texts, s))
        at = np.flatnonzero(odd.to_numpy(zero_copy_only=False))
        whole = texts.take(pa.array(at)).to_pylist()
        marked = pc.binary_join_element_wise(BARE, pc.replace_substring(texts, "\n", " \n"), " ", "")
        if whole:
            marked = pc.replace_with_mask(marked, odd, pa.array([f"{WHOLE}{i} " for i in range(len(whole))], marked.type))
        pieces = pc.split_pattern(marked, " ")
        counts = pc.list_value_length(pieces).to_numpy().astype(np.int64)
        coded = pieces.flatten().dictionary_encode()
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        index = self._find(words)
        names = [f"{WHOLE}{i}" for i in range(len(whole))]
        new = np.flatnonzero((index < 0) & ~pc.starts_with(coded.dictionary, WHOLE).to_numpy(zero_copy_only=False))
        if len(new):
            self._learn(coded.dictionary.take(pa.array(new)))
        known = len(self.memo), len(self.flat)
        self._add(names, self._whole(whole))
        at = np.flatnonzero(index < 0)
        index[at] = self._find([words[i] for i in at.tolist()])
        index = index[coded.indices.to_numpy()]
        lengths = self.length[index]
        ids = self._gather(self.start[index], lengths)
        per = np.add.reduceat(lengths, np.cumsum(counts) - counts) if len(counts) else np.zeros(0, np.int64)
        # Whole texts are not kept.
        for x in names:
            del self.memo[x]
        self.start, self.length, self.flat = self.start[: known[0]], self.length[: known[0]], self.flat[: known[1]]
        return ids, per


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


SEGMENTS = "part int, seq int, n_rows long, n_ids long, data binary"


def write_ids(docs: DataFrame, path: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", percentile: float = PERCENTILE, segment_ids: int = SEGMENT_IDS) -> None:
    """Write the segments of ``docs`` below ``path``."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"))
    # Equal rows may stand in any order, so the last key parts even an id that very many of them have.
    order = [F.col("id").asc_nulls_first(), F.col("tie"), F.col("row")]
    rows = rows.withColumn("tie", F.xxhash64("text")).withColumn("row", F.monotonically_increasing_id())
    rows = rows.repartitionByRange(tasks_for(docs, TASK_BYTES), *order).sortWithinPartitions(*order).select("id", "text")

    def run(batches):
        import os

        import pyarrow as pa
        from pyspark import TaskContext

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        enc, part, seq = encoder(tokenizer), TaskContext.get().partitionId(), 0
        keys, lengths, ids, n = [], [], [], 0

        def segment():
            data = write_segment(keys, np.concatenate(lengths), np.concatenate(ids), percentile)
            cols = ([part], [seq], [len(keys)], [n], [data])
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], [x.split()[0] for x in SEGMENTS.split(", ")])

        for b in batches:
            col, names = b.column("text"), b.column("id").to_pylist()
            for a, e in chunks(buffers(col)[1], ENCODE_BYTES):
                some, per = enc.encode(col.slice(a, e - a))
                keys += names[a:e]
                lengths.append(per)
                ids.append(some)
                n += len(some)
                if n >= segment_ids:
                    yield segment()
                    keys, lengths, ids, n, seq = [], [], [], 0, seq + 1
        if keys:
            yield segment()
        keys, lengths, ids = [], [], []
        enc.keep(KEPT)
        give_back()

    rows.mapInArrow(run, SEGMENTS).write.option("compression", "none").parquet(path)


def read_ids(spark, path: str, values: bool = False) -> DataFrame:
    """Rows (id, start, n_tokens, ids_crc32[, ids]) of the segments below ``path``; ``start`` counts the ids of all rows before."""
    segments = spark.read.schema(SEGMENTS).parquet(path)
    sizes = segments.select("part", "seq", "n_ids")
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n"))
    parts = parts.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    inside = F.coalesce(F.sum("n_ids").over(Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bases = sizes.withColumn("inside", inside).join(parts, "part").select("part", "seq", (F.col("base") + F.col("inside")).cast("long").alias("base"))
    extra = ", ids array<long>" if values else ""

    def run(batches):
        import pyarrow as pa

        for b in batches:
            for part, seq, data in zip(b.column("part").to_pylist(), b.column("seq").to_pylist(), b.column("data"), strict=True):
                s = Segment(data.as_buffer().to_pybytes())
                ids = np.ascontiguousarray(s.ids().astype("<u4", copy=False))
                ends = np.cumsum(s.lengths, dtype=np.int64)
                starts = ends - s.lengths
                raw = memoryview(ids).cast("B")
                crc = [zlib.crc32(raw[4 * a : 4 * e]) for a, e in zip(starts.tolist(), ends.tolist(), strict=True)]
                n = len(crc)
                cols = [pa.array(s.row_ids, pa.int64()), pa.array([part] * n, pa.int32()), pa.array([seq] * n, pa.int32()), pa.array(starts), pa.array(s.lengths.astype(np.int64)), pa.array(crc, pa.int64())]
                names = ["id", "p", "q", "at", "n_tokens", "ids_crc32"]
                if values:
                    cols.append(pa.array([ids[a:e].astype(np.int64) for a, e in zip(starts, ends, strict=True)], pa.list_(pa.int64())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names)

    rows = segments.select("part", "seq", "data").mapInArrow(run, f"id long, p int, q int, at long, n_tokens long, ids_crc32 long{extra}")
    joined = rows.join(bases, (F.col("p") == F.col("part")) & (F.col("q") == F.col("seq")))
    return joined.select("id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32", *(["ids"] if values else []))


def token_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def encode_table(spark, docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    path = shared_path(spark, "pfor")
    write_ids(docs, path, tokenizer or token_file())
    return read_ids(spark, path).withColumnRenamed("id", "doc_id")


def op3_token_blocks(spark, sf_dir: str) -> DataFrame:
    return encode_table(spark, table(spark, sf_dir, "documents"))
