"""Byte-level BPE encoding and decoding through a sentencepiece model made from a vocabulary of ranks.

A rank file (base64 token, blank, rank) is serialised as a sentencepiece BPE model, nothing is trained: each byte is
written as one letter (U+0100 + byte), so a token is a piece of letters; its score is its negative rank, so the machine
merges the pair of lowest rank first and of equal ranks the leftmost; the normaliser is the identity. Texts are cut into
pre-tokens by a pattern and each is encoded for itself; one that is a token as a whole has that token's id, as a byte-level
encoder gives it. The different ones of many texts go to the machine in lines, each ended by a piece that nothing merges with.
Decoding maps ids to pieces and their letters back to bytes.

Defined results: a null or empty text has no ids and decodes to no bytes; special tokens are ordinary text; repeated rows
are encoded each for itself; a null id stays null; an empty table gives no rows; columns other than the named ones are
ignored. A long text is encoded in portions of PORTION pre-tokens, and cut into them in windows of BATCH_BYTES.
"""

from __future__ import annotations

import base64
import struct
from itertools import chain, islice

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import give_back, table, text_of
from .pretokens import BYTE_PATTERN, starts, windows
from .words import buffers, chunks

PORTION = 100_000
MEMO_WORDS, MEMO_CHARS = 200_000, 4 << 20  # what an encoder remembers of the words it has seen
BATCH_BYTES = 4 << 20
LINE_BYTES = 4 << 10  # about what the machine encodes in one call
LETTER = 0x100  # byte b is written as the letter U+0100 + b
END = "\u0200"  # ends a pre-token
_LETTERS = {b: chr(LETTER + b) for b in range(256)}


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def letters(data: bytes) -> str:
    return data.decode("latin-1").translate(_LETTERS)


def bytes_of(piece: str) -> bytes:
    return bytes(ord(c) - LETTER for c in piece)


def lines(words: list[bytes]) -> list[bytes]:
    """The letters of ``words`` in UTF-8, END after each, in lines of about LINE_BYTES."""
    data = np.frombuffer(b"".join(words), np.uint8)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1)
    out = np.empty((len(data) + len(words), 2), np.uint8)
    out[ends - 1] = np.frombuffer(END.encode(), np.uint8)
    at = np.arange(len(data)) + np.repeat(np.arange(len(words)), lengths)
    out[at, 0] = 0xC0 | LETTER >> 6 | data >> 6
    out[at, 1] = 0x80 | data & 63
    bounds = np.concatenate([[0], ends])
    return [out[bounds[a] : bounds[b]].tobytes() for a, b in chunks(2 * bounds, LINE_BYTES)]


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes([*out, n])


def _nested(field: int, data: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(data)) + data


def serialise(ranks: dict[bytes, int]) -> bytes:
    """The sentencepiece model (protocol buffer) of ``ranks``: the piece of rank r has id r and score -r; END follows, part of no
    other piece; the unknown piece, which the format asks for, comes last and is never met, as all 256 bytes are pieces."""
    if sorted(ranks.values()) != list(range(len(ranks))):
        raise ValueError("ranks must count from 0 without gaps")
    if any(bytes([b]) not in ranks for b in range(256)):
        raise ValueError("each single byte must be a token")
    if len(ranks) >= 1 << 24:
        raise ValueError("scores are 32-bit floats and hold ranks below 2^24")
    normal, unknown = 1, 2  # kinds of piece
    rows = [(letters(t), -float(r), normal) for t, r in sorted(ranks.items(), key=lambda x: x[1])]
    rows += [(END, -float(len(ranks)), normal), ("<unk>", 0.0, unknown)]
    pieces = b"".join(_nested(1, _nested(1, p.encode()) + b"\x15" + struct.pack("<f", score) + b"\x18" + _varint(kind)) for p, score, kind in rows)
    bpe = b"\x18\x02"  # trainer_spec.model_type = BPE
    plain = _nested(1, b"identity") + b"\x18\x00\x20\x00\x28\x00"  # no dummy prefix, blanks neither removed nor escaped
    return pieces + _nested(2, bpe) + _nested(3, plain)


class Coder:
    """Encodes texts to ids and decodes ids to bytes."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import pyarrow as pa
        import regex
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_proto=serialise(ranks))
        self.split = regex.compile(pattern)
        self.at_once = pattern == BYTE_PATTERN
        self.ranks = ranks
        self.table = pa.array([bytes_of(self.model.id_to_piece(i)) for i in range(len(ranks))], pa.binary())
        self.forget()

    def forget(self) -> None:
        self.memo = self.ranks.copy()  # place of each word seen; a token as a whole is at its rank
        self.chars = 0
        n = len(self.ranks)
        self.flat, self.start, self.length = np.arange(n, dtype=np.int32), np.arange(n), np.ones(n, np.int64)

    def _learn(self, new: list[bytes]) -> None:
        ids = np.concatenate(self.model.encode(lines(new), return_type="numpy", num_threads=1))
        ended = ids == len(self.ranks)
        lengths = np.diff(np.flatnonzero(ended), prepend=-1) - 1
        self.memo.update(zip(new, range(len(self.memo), len(self.memo) + len(new)), strict=True))
        self.start = np.concatenate([self.start, len(self.flat) + np.cumsum(lengths) - lengths])
        self.length = np.concatenate([self.length, lengths])
        self.flat = np.concatenate([self.flat, ids[~ended]])
        self.chars += sum(map(len, new))

    def _words(self, words) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words (an Arrow array of bytes) in order, and the number of ids of each."""
        if len(self.memo) - len(self.ranks) > MEMO_WORDS or self.chars > MEMO_CHARS:
            self.forget()
        coded = words.dictionary_encode()
        different = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        if new := [w for w in different if w not in self.memo]:
            self._learn(new)
        place = np.fromiter(map(self.memo.__getitem__, different), np.int64, len(different))
        at = place[coded.indices.to_numpy()]
        length = self.length[at]
        shift = self.start[at] - np.cumsum(length) + length
        return self.flat[np.repeat(shift, length) + np.arange(int(length.sum()))], length

    def _cut(self, data: np.ndarray, offsets: np.ndarray):
        """Pre-tokens of the texts that fill ``data``, as an Arrow array of bytes, and the number of them up to each offset."""
        import pyarrow as pa

        at = starts(data, offsets)
        bounds = np.append(at, len(data)).astype(np.int32)
        words = pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(bounds), pa.py_buffer(data)])
        return words, np.searchsorted(at, offsets)

    def encode_many(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (a list or an Arrow array) in order, and the number of ids of each. Their words are held at once."""
        import pyarrow as pa

        if self.at_once:
            data, o = buffers(pa.array(texts, pa.string()) if isinstance(texts, list) else texts)
            words, upto = self._cut(data[o[0] : o[-1]], o - o[0])
        else:
            found = [self.split.findall(t or "") for t in (texts if isinstance(texts, list) else texts.to_pylist())]
            words, upto = pa.array(chain.from_iterable(found), pa.binary()), np.cumsum([0, *map(len, found)])
        ids, length = self._words(words)
        return ids, np.diff(np.concatenate([[0], np.cumsum(length)])[upto])

    def _portions(self, text: str):
        import pyarrow as pa

        if self.at_once:
            data = np.frombuffer(text.encode(), np.uint8)
            for a, b in windows(data, BATCH_BYTES):
                words, (_, n) = self._cut(data[a:b], np.array([0, b - a]))
                yield from (words.slice(i, PORTION) for i in range(0, n, PORTION))
        else:
            found = (m.group() for m in self.split.finditer(text))
            while words := list(islice(found, PORTION)):
                yield pa.array(words, pa.binary())

    def encode(self, text: str) -> np.ndarray:
        """Ids of one text of any length, in portions."""
        return np.concatenate([np.zeros(0, np.int32), *(self._words(words)[0] for words in self._portions(text))])

    def decode_many(self, lists):
        """Bytes of the ids of each row (Arrow lists); null stays null."""
        import pyarrow as pa
        import pyarrow.compute as pc

        ids = lists.flatten()
        if ids.null_count:
            raise ValueError("a null among the ids of a row")
        pieces = self.table.take(ids)
        ends = np.concatenate([[0], np.cumsum(lists.value_lengths().fill_null(0).to_numpy().astype(np.int64))])
        bounds = np.frombuffer(pieces.buffers()[1], np.int32)[pieces.offset :][ends]
        out = pa.Array.from_buffers(pa.binary(), len(lists), [None, pa.py_buffer(bounds), pieces.buffers()[2]])
        return pc.if_else(lists.is_valid(), out, pa.scalar(None, pa.binary())) if lists.null_count else out

    def decode(self, ids) -> bytes:
        import pyarrow as pa

        return self.decode_many(pa.array([ids], pa.list_(pa.int32())))[0].as_py()


_CODERS: dict[tuple[str, str], Coder] = {}


def coder(path: str, pattern: str) -> Coder:
    """The coder of a process, made once."""
    if (path, pattern) not in _CODERS:
        _CODERS[path, pattern] = Coder(read_ranks(path), pattern)
    return _CODERS[path, pattern]


def defaults(ranks: str | None, pattern: str | None) -> tuple[str, str]:
    import public_tokenizers

    return ranks or public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), pattern or public_tokenizers.PATTERN


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks: str | None = None, pattern: str | None = None) -> DataFrame:
    """Rows (id, ids): the token ids of each text."""
    which = defaults(ranks, pattern)
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))

    def run(batches):
        import pyarrow as pa

        c = coder(*which)
        for b in batches:
            texts, names = b.column("text"), b.column("id")
            for lo, hi in chunks(buffers(texts)[1], BATCH_BYTES):
                some = texts.slice(lo, hi - lo)
                if len(some) > 1:
                    ids, counts = c.encode_many(some)
                else:
                    ids = c.encode(some[0].as_py())
                    counts = [len(ids)]
                lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *counts]), pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([names.slice(lo, hi - lo), lists], ["id", "ids"])
        c.forget()
        give_back()

    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, ids array<int>")


def decode(tokens: DataFrame, ids_col: str = "ids", ranks: str | None = None, pattern: str | None = None) -> DataFrame:
    """``tokens`` (columns id and ``ids_col``) with ``data``, the bytes of the ids; null ids stay null."""
    which = defaults(ranks, pattern)
    rows = tokens.select("id", F.col(ids_col).alias("ids"))

    def run(batches):
        import pyarrow as pa

        c = coder(*which)
        for b in batches:
            lists = b.column("ids")
            for lo, hi in chunks(4 * np.concatenate([[0], np.cumsum(lists.value_lengths().fill_null(0).to_numpy().astype(np.int64))]), BATCH_BYTES):
                some = lists.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([b.column("id").slice(lo, hi - lo), some, c.decode_many(some)], ["id", "ids", "data"])
        give_back()

    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, ids array<int>, data binary")


def op13_byte_bpe(spark, sf_dir: str) -> DataFrame:
    both = decode(encode(table(spark, sf_dir, "documents")))
    joined = F.array_join(F.col("ids").cast("array<string>"), ",")
    return both.select(F.col("id").alias("doc_id"), F.size("ids").cast("long").alias("n_tokens"), F.sha2(joined, 256).alias("ids_sha256"), F.sha2("data", 256).alias("decoded_sha256"))
