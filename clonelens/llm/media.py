"""Media columns: Netpbm and BMP images to numpy arrays, area resizing by integral images, NPY tiles, difference hashes.

``decode`` reads P1 to P6 (plain and raw; samples above 255 stay of 16 bits) and uncompressed BMP of 1, 4, 8, 16, 24 and
32 bits, with bit fields and with the short header of 12 bytes. ``tiles``
stores an array as NPY tiles of at most TILE_ROWS rows, lossless; ``join_tiles`` puts them together. ``resize`` averages
exact (fractional) areas by the integral image, of which it holds one strip at a time. ``dhash`` compares neighbours of a 9 x 8 grey reduction.

Defined results: a null or empty text is one row of 64 zero bytes; equal texts give equal values; undecodable bytes
raise ValueError; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import io
import re
import struct
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, table, text_of

WIDTH = 64
TILE_ROWS = 4096
STRIP_ROWS = 8192


def _netpbm(data: bytes) -> np.ndarray:
    kind = data[1] - 48
    fields, at = [], 2
    need = 2 if kind in (1, 4) else 3
    token = re.compile(rb"(?:\s+|#[^\n\r]*[\n\r])*([0-9]+)")
    while len(fields) < need:
        m = token.match(data, at)
        if not m:
            raise ValueError("broken Netpbm header")
        fields.append(int(m[1]))
        at = m.end()
    w, h, top = (*fields, 1)[:3]
    channels = 3 if kind in (3, 6) else 1
    n = w * h * channels
    if kind == 1:
        out = np.array([x == 48 for x in data[at:] if x in (48, 49)][:n], np.uint8) * 255
    elif kind in (2, 3):
        out = np.array(data[at:].split()[:n], np.int64)
    elif kind == 4:
        row = -(-w // 8)
        bits = np.unpackbits(np.frombuffer(data, np.uint8, h * row, at + 1).reshape(h, row), axis=1)[:, :w]
        out = (1 - bits).ravel() * np.uint8(255)
    else:
        out = np.frombuffer(data, ">u2" if top > 255 else np.uint8, n, at + 1)
    if len(out) != n:
        raise ValueError("Netpbm data are cut off")
    if not 0 < top < 1 << 16:
        raise ValueError("unsupported Netpbm depth")
    most, kept = (65535, np.uint16) if top > 255 else (255, np.uint8)
    if kind not in (1, 4) and top != most:
        out = (out.astype(np.float64) * most / top + 0.5).astype(kept)
    return out.astype(kept, copy=False).reshape((h, w, 3) if channels == 3 else (h, w))


def _field(words: np.ndarray, mask: int) -> np.ndarray:
    """The bits of ``mask`` in each word, spread over 0 to 255."""
    if not mask:
        return np.zeros(words.shape, np.uint8)
    low = (mask & -mask).bit_length() - 1
    most = mask >> low
    return (((words & np.uint32(mask)) >> np.uint32(low)).astype(np.float64) * 255 / most + 0.5).astype(np.uint8)


def _bmp(data: bytes) -> np.ndarray:
    if len(data) < 26:
        raise ValueError("broken BMP header")
    start, size = struct.unpack_from("<10xII", data)
    if size == 12:
        (w, h, _, bits), packed, cell = struct.unpack_from("<HHHH", data, 18), 0, 3
    elif size >= 40 and len(data) >= 54:
        (w, h, _, bits, packed), cell = struct.unpack_from("<iiHHI", data, 18), 4
    else:
        raise ValueError("broken BMP header")
    if packed not in (0, 3) or bits not in (1, 4, 8, 16, 24, 32) or (packed == 3 and bits not in (16, 32)):
        raise ValueError("unsupported BMP")
    stride, flip, h = (w * bits + 31) // 32 * 4, h > 0, abs(h)
    if w <= 0 or len(data) < start + stride * h:
        raise ValueError("BMP data are cut off")
    raw = np.frombuffer(data, np.uint8, stride * h, start).reshape(h, stride)
    if packed == 3 or bits == 16:
        # Without masks 16 bits are 5 a channel.
        masks = struct.unpack_from("<III", data, 54) if packed == 3 else (0x7C00, 0x3E0, 0x1F)
        words = raw[:, : w * bits // 8].copy().view("<u2" if bits == 16 else "<u4").astype(np.uint32)
        out = np.stack([_field(words, m) for m in masks], 2)
    elif bits >= 24:
        out = raw[:, : w * bits // 8].reshape(h, w, bits // 8)[:, :, 2::-1]
    else:
        colours = (struct.unpack_from("<I", data, 46)[0] if cell == 4 else 0) or 1 << bits
        palette = np.frombuffer(data, np.uint8, colours * cell, 14 + size).reshape(-1, cell)[:, 2::-1]
        if bits == 8:
            index = raw[:, :w]
        else:
            b = np.unpackbits(raw, axis=1).reshape(h, -1, bits)
            index = (b * (1 << np.arange(bits - 1, -1, -1))).sum(2)[:, :w]
        out = palette[index]
    return np.ascontiguousarray(out[::-1] if flip else out)


def decode(data: bytes) -> np.ndarray:
    """Array of shape (h, w) or (h, w, 3), uint8, or uint16 for Netpbm samples above 255."""
    if data[:1] == b"P" and data[1:2] in b"123456" and len(data) > 2:
        return _netpbm(data)
    if data[:2] == b"BM":
        return _bmp(data)
    raise ValueError("neither Netpbm nor BMP")


def resize(image: np.ndarray, height: int, width: int) -> np.ndarray:
    """Mean of each target cell's exact area, as float64; grey images only or channel by channel."""
    if image.ndim == 3:
        return np.stack([resize(image[:, :, c], height, width) for c in range(image.shape[2])], 2)
    h, w = image.shape

    def at(edges, size):
        low = np.minimum(np.floor(edges).astype(np.int64), size - 1)
        return low, edges - low

    ys, fy = at(np.arange(height + 1) * (h / height), h)
    xs, fx = at(np.arange(width + 1) * (w / width), w)
    # Rows 0 to h of the integral image that are asked for, strip by strip; the sums of all rows above go along.
    wanted = np.unique(np.concatenate([ys, ys + 1]))
    rows, above = np.zeros((len(wanted), w + 1), np.int64), np.zeros(w, np.int64)
    for a in range(0, h, STRIP_ROWS):
        strip = np.cumsum(image[a : a + STRIP_ROWS], axis=0, dtype=np.int64) + above
        here = np.flatnonzero((wanted > a) & (wanted <= a + len(strip)))
        rows[here, 1:] = np.cumsum(strip[wanted[here] - a - 1], axis=1)
        above = strip[-1]
    first, second = np.searchsorted(wanted, ys), np.searchsorted(wanted, ys + 1)
    part = rows[first] + (rows[second] - rows[first]) * fy[:, None]
    grid = part[:, xs] + (part[:, xs + 1] - part[:, xs]) * fx[None, :]
    return (grid[1:, 1:] - grid[:-1, 1:] - grid[1:, :-1] + grid[:-1, :-1]) * (height * width / (h * w))


def dhash(image: np.ndarray) -> str:
    """64 bits as hex: whether each of 8 x 8 cells of the 9 x 8 grey reduction is darker than its right neighbour."""
    small = resize(image, 8, 9)
    small = np.round(small.mean(2) if small.ndim == 3 else small, 6)
    return np.packbits(small[:, :-1] < small[:, 1:]).tobytes().hex()


def _npy(a: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.lib.format.write_array(out, np.ascontiguousarray(a), allow_pickle=False)
    return out.getvalue()


def tiles(image: np.ndarray, rows: int = TILE_ROWS) -> list[bytes]:
    return [_npy(image[i : i + rows]) for i in range(0, max(1, len(image)), rows)]


def join_tiles(parts: list[bytes]) -> np.ndarray:
    arrays = [np.lib.format.read_array(io.BytesIO(p), allow_pickle=False) for p in parts]
    return arrays[0] if len(arrays) == 1 else np.concatenate(arrays)


def payload_image(payload: bytes) -> bytes:
    """A raw grey Netpbm image of WIDTH columns whose samples are ``payload``, whose length is a multiple of WIDTH."""
    return b"P5\n%d %d\n255\n" % (WIDTH, len(payload) // WIDTH) + payload


def store(images: DataFrame, image_col: str = "image", rows: int = TILE_ROWS) -> DataFrame:
    """The other columns with ``tiles`` (array<binary>): each image decoded and stored as NPY tiles."""
    from pyspark.sql import types as T

    keep = [f for f in images.schema if f.name != image_col]
    schema = T.StructType([*keep, T.StructField("tiles", T.ArrayType(T.BinaryType()))])

    def run(batches):
        import pyarrow as pa

        for b in batches:
            cells = [None if x is None else tiles(decode(x), rows) for x in (c.as_py() for c in b.column(image_col))]
            others = [b.column(f.name) for f in keep]
            yield pa.RecordBatch.from_arrays([*others, pa.array(cells, pa.list_(pa.binary()))], [*(f.name for f in keep), "tiles"])

    return images.mapInArrow(run, schema)


def payloads(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, image): each whole text as UTF-8, zero-padded to a positive multiple of WIDTH, under a P5 header."""
    raw = F.encode(text_of(text_col), "UTF-8")
    n = F.octet_length(raw)
    padded = F.greatest(F.lit(WIDTH), F.ceil(n / WIDTH) * WIDTH).cast("int")
    head = F.concat(F.lit(f"P5\n{WIDTH} "), (padded / WIDTH).cast("int").cast("string"), F.lit("\n255\n")).cast("binary")
    return docs.select(F.col(id_col).alias("id"), n.cast("long").alias("n_bytes"), F.concat(head, F.rpad(raw, padded, F.lit(b"\x00"))).alias("image"))


FEATURES = "payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def features(stored: DataFrame) -> DataFrame:
    """(id, n_bytes, FEATURES) from the stored tiles alone."""

    def run(batches):
        import pyarrow as pa

        for b in batches:
            rows = []
            for parts in b.column("tiles"):
                parts = parts.as_py()
                image = join_tiles(parts)
                data = image.tobytes()
                media = hashlib.sha256()
                for p in parts:
                    media.update(p)
                rows.append((len(data), hashlib.sha256(data).hexdigest(), zlib.crc32(data[-64:]), sum(map(len, parts)), media.hexdigest(), dhash(image)))
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 6
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            names = [x.split()[0] for x in FEATURES.split(", ")]
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("n_bytes"), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))], ["id", "n_bytes", *names])

    kind = stored.schema["id"].dataType.simpleString()
    return stored.mapInArrow(run, f"id {kind}, n_bytes long, {FEATURES}")


def op10_media(spark, sf_dir: str) -> DataFrame:
    stored = materialize(store(payloads(table(spark, sf_dir, "documents"))), "media")
    return features(stored).withColumnRenamed("id", "doc_id")
