import hashlib
import struct
import zlib

import numpy as np
import pytest
from cases import edge_docs, no_docs
from hypothesis import given, settings
from hypothesis import strategies as st

from clonelens.llm import media as m


def brute_resize(a, h, w):
    out = np.zeros((h, w))
    ys, xs = np.linspace(0, a.shape[0], h + 1), np.linspace(0, a.shape[1], w + 1)
    for i in range(h):
        for j in range(w):
            wy = np.clip(np.minimum(ys[i + 1], np.arange(a.shape[0]) + 1) - np.maximum(ys[i], np.arange(a.shape[0])), 0, None)
            wx = np.clip(np.minimum(xs[j + 1], np.arange(a.shape[1]) + 1) - np.maximum(xs[j], np.arange(a.shape[1])), 0, None)
            out[i, j] = (a * np.outer(wy, wx)).sum() / (wy.sum() * wx.sum())
    return out


@given(st.integers(1, 20), st.integers(1, 20), st.integers(0, 99))
@settings(max_examples=60, deadline=None)
def test_resize(h, w, seed):
    a = np.random.default_rng(seed).integers(0, 256, (h, w), np.uint8)
    assert np.allclose(m.resize(a, 8, 9), brute_resize(a, 8, 9))


def test_netpbm():
    assert m.decode(b"P1\n# c\n3 2\n1 0 1\n0 1 0\n").tolist() == [[0, 255, 0], [255, 0, 255]]
    assert m.decode(b"P2 2 1 15\n0 15\n").tolist() == [[0, 255]]
    assert m.decode(b"P3 1 1 255 1 2 3").tolist() == [[[1, 2, 3]]]
    assert m.decode(b"P4\n9 1\n\xff\x00").tolist() == [[0] * 8 + [255]]
    assert m.decode(b"P5\n2 2\n255\n\n\x00 \xff").tolist() == [[10, 0], [32, 255]]
    deep = m.decode(b"P5 2 1 65535\n\xff\xff\x01\x02")
    assert deep.dtype == np.uint16 and deep.tolist() == [[65535, 258]]
    assert (m.join_tiles(m.tiles(deep)) == deep).all()
    assert m.decode(b"P6 1 2 255\n\x01\x02\x03\x04\x05\x06").tolist() == [[[1, 2, 3]], [[4, 5, 6]]]
    for bad in (b"", b"GIF89a", b"P5 4 4 255\n\x00"):
        with pytest.raises(ValueError):
            m.decode(bad)


def bmp(w, h, bits, rows, palette=b""):
    start = 54 + len(palette)
    return struct.pack("<2sIHHIIiiHHIIiiII", b"BM", start + len(rows), 0, 0, start, 40, w, h, 1, bits, 0, len(rows), 0, 0, len(palette) // 4, 0) + palette + rows


def test_bmp():
    assert m.decode(bmp(1, 2, 24, b"\x03\x02\x01\x00\x06\x05\x04\x00")).tolist() == [[[4, 5, 6]], [[1, 2, 3]]]
    assert m.decode(bmp(1, -1, 32, b"\x03\x02\x01\x09")).tolist() == [[[1, 2, 3]]]
    palette = b"\x00\x00\x00\x00\xff\xff\xff\x00"
    assert m.decode(bmp(2, 1, 8, b"\x01\x00\x00\x00", palette))[:, :, 0].tolist() == [[255, 0]]
    assert m.decode(bmp(9, 1, 1, b"\x80\x80\x00\x00", palette))[:, :, 0].tolist() == [[255] + [0] * 7 + [255]]
    assert m.decode(bmp(3, 1, 4, b"\x10\x10\x00\x00", palette))[:, :, 0].tolist() == [[255, 0, 255]]


def test_bmp_bit_fields_and_short_header():
    def fields(bits, masks, pixels):
        return struct.pack("<2sIHHIIiiHHIIiiII", b"BM", 66 + len(pixels), 0, 0, 66, 40, 1, 1, 1, bits, 3, len(pixels), 0, 0, 0, 0) + struct.pack("<III", *masks) + pixels

    assert m.decode(fields(32, (0xFF, 0xFF00, 0xFF0000), b"\x01\x02\x03\x00")).tolist() == [[[1, 2, 3]]]
    assert m.decode(fields(16, (0xF800, 0x7E0, 0x1F), struct.pack("<HH", 0xF800 | 0x1F, 0))).tolist() == [[[255, 0, 255]]]
    assert m.decode(bmp(1, 1, 16, struct.pack("<HH", 0x7C00, 0))).tolist() == [[[255, 0, 0]]]
    short = struct.pack("<2sIHHIIHHHH", b"BM", 32, 0, 0, 26, 12, 1, 1, 1, 24) + b"\x03\x02\x01\x00"
    assert m.decode(short).tolist() == [[[1, 2, 3]]]
    palette = struct.pack("<2sIHHIIHHHH", b"BM", 36, 0, 0, 32, 12, 2, 1, 1, 1) + b"\x00\x00\x00\x09\x08\x07" + b"\x40\x00\x00\x00"
    assert m.decode(palette).tolist() == [[[0, 0, 0], [7, 8, 9]]]
    for bad in (short[:20], bmp(9, 9, 24, b"\x00"), fields(24, (1, 2, 4), b"\x00" * 4)):
        with pytest.raises(ValueError):
            m.decode(bad)


def test_dhash_equals_brute(monkeypatch):
    rng = np.random.default_rng(3)
    for shape in ((1, 64), (5, 64), (300, 64), (20, 30, 3)):
        a = rng.integers(0, 256, shape, np.uint8)
        small = brute_resize(a, 8, 9) if a.ndim == 2 else np.mean([brute_resize(a[:, :, k], 8, 9) for k in range(3)], 0)
        bits = [small[i, j] < small[i, j + 1] for i in range(8) for j in range(8)]
        assert m.dhash(a) == f"{int(''.join(str(int(x)) for x in bits), 2):016x}"
    whole = m.resize(a, 8, 9)
    monkeypatch.setattr(m, "STRIP_ROWS", 3)
    assert (m.resize(a, 8, 9) == whole).all()


def test_query(spark):
    from clonelens.llm import queries

    small = "/root/testdata/sf0.001"
    texts = {r.doc_id: (r.text or "").encode() for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    rows = queries.queries()["op10_media"](spark, small).collect()
    assert len(rows) == len(texts)
    for r in rows:
        raw = texts[r.doc_id]
        pad = raw + b"\x00" * (max(64, -(-len(raw) // 64) * 64) - len(raw))
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(pad), hashlib.sha256(pad).hexdigest(), zlib.crc32(pad[-64:]))
        assert r.feature == m.dhash(np.frombuffer(pad, np.uint8).reshape(-1, 64))


def test_tiles():
    a = np.arange(64 * 10, dtype=np.int64).astype(np.uint8).reshape(10, 64)
    parts = m.tiles(a, 4)
    assert len(parts) == 3 and (m.join_tiles(parts) == a).all()


def test_query_rows(spark):
    docs = edge_docs(spark, [(50, "é" * 300_000, "", "", 0), (51, "x" * 64, "", "", 0), (52, "\x00", "", "", 0)])
    got = {}
    for r in m.features(m.store(m.payloads(docs))).collect():
        got.setdefault(r.id, []).append(r)
    assert sum(map(len, got.values())) == docs.count()
    for d in docs.collect():
        raw = (d.text or "").encode()
        pad = raw + b"\x00" * (max(64, -(-len(raw) // 64) * 64) - len(raw))
        for r in got[d.doc_id]:
            assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(pad), hashlib.sha256(pad).hexdigest(), zlib.crc32(pad[-64:]))
            assert r.media_bytes > r.payload_bytes and len(r.media_sha256) == 64 and len(r.feature) == 16
    assert got[3][0][1:] == got[4][0][1:] == got[4][1][1:]
    assert m.features(m.store(m.payloads(no_docs(spark)))).count() == 0
