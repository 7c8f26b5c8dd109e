import hashlib

from cases import edge_docs, no_docs

from clonelens.llm import sharding, warc


def brute_shards(rows, limit):
    def split(some, bits):
        if sum(n for _, n, _ in some) <= limit or len(bits) == 60:
            return {i: bits for i, _, _ in some}
        return split([r for r in some if r[2][len(bits)] == "0"], bits + "0") | split([r for r in some if r[2][len(bits)] == "1"], bits + "1")

    return split([(i, n, bin(int(hashlib.md5(str(i).encode()).hexdigest()[:15], 16))[2:].zfill(60)) for i, n in rows], "")


def test_directory(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, len(r.text.encode())) for r in docs.collect()]
    for limit in (10**9, 200_000, 40_000):
        got = sharding.shard(docs, limit=limit).collect()
        assert {r.id: r.shard for r in got} == brute_shards(rows, limit)
        assert all(r.shard_bytes <= limit or r.shard_docs == 1 for r in got)


def test_one_key_over_the_limit(spark):
    docs = spark.createDataFrame([(7, "x" * 100)] * 25 + [(8, "y" * 1000), (9, "z")], "doc_id long, text string")
    got = sharding.shard(docs, limit=300).collect()
    assert len(got) == 27
    by = {}
    for r in got:
        by.setdefault(r.shard, []).append(r)
    assert all(sum(r.n_bytes for r in s) <= 300 or len(s) == 1 for s in by.values())
    assert all(r.shard_bytes == sum(x.n_bytes for x in by[r.shard]) and r.shard_docs == len(by[r.shard]) for r in got)
    assert sum(r.id == 7 for r in got) == 25


def test_shard_edges(spark, tmp_path):
    docs = edge_docs(spark)
    assert sharding.shard(docs, limit=2000).count() == docs.count()
    assert sharding.shard(no_docs(spark)).count() == 0
    sharding.write_shards(docs, str(tmp_path / "x"), limit=2000)
    assert spark.read.parquet(str(tmp_path / "x")).count() == docs.count()


def test_written_shards_hold_every_row_once(spark, tmp_path):
    """An id that spans overflow pages, a null id, a column with the folders' name, and an empty table."""
    rows = [(7, "x" * 100, k) for k in range(25)] + [(8, "y" * 1000, 1), (9, "z", 1), (None, "n" * 50, 2), (None, "n" * 50, 2), (7, "x" * 100, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __shard int")
    name = sharding.write_shards(docs, str(tmp_path / "x"), limit=300)
    back = spark.read.option("partitionOverwriteMode", "static").parquet(str(tmp_path / "x"))
    assert sorted(map(tuple, back.select(*docs.columns).collect()), key=str) == sorted(rows, key=str)
    by = {}
    for r in back.collect():
        by.setdefault(r[name], []).append(len(r.text))
    assert all(sum(n) <= 300 or len(n) == 1 for n in by.values())
    sharding.write_shards(no_docs(spark), str(tmp_path / "y"))
    assert not list((tmp_path / "y").glob("*.parquet"))


def test_queries_equal_sql(spark):
    from sqlcheck import equals_sql

    equals_sql(spark, "op8_sharding")
    equals_sql(spark, "op9_warc")


PAGES = "page_id long, url string, html string, digest string, kind int"


def test_archives_round_trip(spark, tmp_path):
    long = "WARC/1.1\r\n\r\n\r\n" * 100 + "é\x00"
    rows = [(1, "http://a", long), (2, None, long), (3, "http://c\r\nX: y", long), (4, "u", "short"), (5, "u", "short"), (6, "u", None), (7, "u", ""), (None, "u", "null id"), (8, "u", long), (8, "u", long), (None, "v", long), (None, None, "only null ids " * 99), (None, "v", "only null ids " * 99)]
    pages = spark.createDataFrame([(*r, "d", 1) for r in rows], PAGES)
    warc.write_warc(warc.mark_revisits(pages), str(tmp_path / "w"))
    got = warc.assemble(warc.read_warc(spark, str(tmp_path / "w"))).collect()
    assert len(got) == len(rows) and all(r.request and r.metadata for r in got)
    records = {r.record_id for r in warc.read_warc(spark, str(tmp_path / "w"), payload=False).collect()}
    html_of = {hashlib.sha1((h or "").encode()).hexdigest(): (h or "").encode() for _, _, h in rows}
    assert sorted((str(r.page_id), r.response.payload_digest) for r in got) == sorted((str(i), hashlib.sha1((h or "").encode()).hexdigest()) for i, _, h in rows)
    for r in got:
        x = r.response
        html = html_of[x.payload_digest]
        assert x.payload_bytes == len(html)
        if r.page_id == 8 and x.kind == "revisit":
            assert x.refers_to in records and x.refers_to.startswith("<urn:capture:response:8:")
        elif r.page_id in (1, 2, 3) or (r.page_id is None and html == long.encode()):
            assert x.kind == "revisit" and x.refers_to in records and x.refers_to.startswith("<urn:capture:response:8:")
        else:
            assert x.kind == "response" and bytes(x.payload) == html and x.refers_to is None
    # Of two rows of the largest id one answers, the other revisits it.
    assert sorted(r.response.kind for r in got if r.page_id == 8) == ["response", "revisit"]


def test_pages(spark, tmp_path):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    pages = pages.unionByName(pages.selectExpr("page_id + 100000 as page_id", "url", "html").limit(60))
    warc.write_warc(warc.mark_revisits(pages, archive_bytes=100_000), str(tmp_path / "w"))
    got = {r.page_id: r.response for r in warc.assemble(warc.read_warc(spark, str(tmp_path / "w"), payload=False)).collect()}
    newest = {}
    rows = [(r.page_id, r.html.encode()) for r in pages.collect()]
    for i, h in rows:
        newest[h] = max(i, newest.get(h, i))
    assert len(got) == len(rows) and len(list((tmp_path / "w").glob("*.gz"))) > 3
    for i, h in rows:
        old = len(h) >= 1000 and i < newest[h]
        assert (got[i].kind, got[i].refers_to) == (("revisit", f"<urn:capture:response:{newest[h]}:{hashlib.sha1(h).hexdigest()}>") if old else ("response", None))


def test_no_pages(spark, tmp_path):
    pages = spark.createDataFrame([], PAGES)
    warc.write_warc(warc.mark_revisits(pages), str(tmp_path / "w"))
    assert warc.assemble(warc.read_warc(spark, str(tmp_path / "w"))).count() == 0


def test_one_row_over_the_limit_is_not_split_on(spark):
    """Three rows of which one is over the limit: the directory stops where it stands alone."""
    docs = spark.createDataFrame([(1, "x" * 5000), (2, "y" * 10), (3, "z" * 10)], "doc_id long, text string")
    got = {r.id: r for r in sharding.shard(docs, limit=1000).collect()}
    assert max(r.depth for r in got.values()) < 8
    assert got[1].shard_docs == 1 and got[1].shard_bytes == 5000 and all(got[i].shard_bytes <= 1000 for i in (2, 3))


def test_captures_keep_their_own_requests(spark, tmp_path):
    """Rows of one page id and payload: one answers, the others revisit it, and each has its own url's request."""
    long = "p" * 1500
    rows = [(5, "u5", long), (5, "u6", long), (5, "u6", long), (3, "u3", long), (8, "a", "short"), (8, "b", "short")]
    pages = spark.createDataFrame([(*r, "d", 1) for r in rows], PAGES)
    warc.write_warc(warc.mark_revisits(pages), str(tmp_path / "w"))
    got = warc.assemble(warc.read_warc(spark, str(tmp_path / "w"))).collect()
    assert len(got) == len(rows) and len({r.response.record_id for r in got}) == len(rows)
    for r in got:
        assert r.request.uri == r.uri == r.metadata.uri
    large = [r.response for r in got if r.response.payload_bytes > 1000]
    answers = [r for r in large if r.kind == "response"]
    assert len(answers) == 1 and {r.refers_to for r in large if r.kind == "revisit"} == {answers[0].record_id}
    assert all(r.response.kind == "response" for r in got if r.page_id == 8)
