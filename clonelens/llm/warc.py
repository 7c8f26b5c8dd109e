"""WARC: archives of request, response or revisit, and metadata records, and their assembly into captures.

Archives are plain WARC/1.1, written by Spark's text writer into any store (a record ends with the two line ends that
are the writer's separator) and compressed whole by gzip. They are read by Spark's binaryFile source and parsed by
Content-Length, so payloads may hold any text. ``assemble`` joins the records of a transaction through WARC-Concurrent-To
and gives one nested row per capture; payloads stay out of that join, only their sizes and digests enter it.

Every row has records of its own, named by the row. Of equal payloads one response is chosen, of the largest page id and of
those of the largest url; its record id is made of page id and digest alone, so that revisits can name it.

Defined results: a null html is the empty payload; equal payloads below MIN_REVISIT bytes are all responses; a row with a
null id revisits the largest id of its payload, and is a response where all ids are null; repeated page ids give a
capture each; an empty table gives no archive and no row; other columns are ignored; a null url or id is written as an
empty field and read back as null.
"""

from __future__ import annotations

import re
import zlib

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialize, shared_path, table, text_of

MIN_REVISIT = 1000
ARCHIVE_BYTES = 16 << 20
EOL = "\r\n"
END = "\r\n\r\n"
RECORDS = "kind string, record_id string, concurrent_to string, uri string, refers_to string, page_id long, payload_bytes long, payload_digest string, payload binary"


def mark_revisits(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_bytes: int = MIN_REVISIT, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Rows (page_id, url, html, payload_bytes, digest, refers_to, chosen): of equal payloads a row of the largest id is ``chosen`` to answer, the others refer to it.

    Only digests and ids are grouped; a digest's group is reduced on the map side, and digests of two rows or more go
    back to the ids salted over 16 keys, so that a digest that many rows share is spread. The texts are dealt once, by
    id, to as many tasks as archives of ``archive_bytes`` are wanted."""
    base = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), text_of(html_col).alias("html"))
    base = base.select("*", F.octet_length("html").cast("long").alias("payload_bytes"), F.sha1(F.encode("html", "UTF-8")).alias("digest"))
    # One key a page, url and payload; the url's hash spreads rows without id.
    row = F.xxhash64("page_id", "url")
    base = base.withColumn("key", F.concat_ws(":", F.coalesce(F.col("page_id").cast("string"), F.lit("-")), "digest", row.cast("string")))
    small = materialize(base.select("page_id", "url", "payload_bytes", "digest", "key", F.pmod(row, F.lit(16)).alias("salt")), "digests")
    n = max(1, -(-int(small.agg(F.sum("payload_bytes")).first()[0] or 0) // archive_bytes))
    large = small.where(F.col("payload_bytes") >= min_bytes)
    keys = large.groupBy("digest").agg(F.max(F.struct("page_id", "url", "key")).alias("chosen"), F.count("*").alias("n")).where("n > 1 and chosen.page_id is not null")
    keys = keys.select("digest", "chosen", F.explode(F.expr("sequence(0L, 15L)")).alias("salt"))
    tied = large.join(keys, ["digest", "salt"]).select(F.col("key").alias("old_key"), F.col("chosen.page_id").alias("newest"), (F.col("key") == F.col("chosen.key")).alias("answers")).distinct()
    # Written first, so that the plan below knows its size and deals the texts once only.
    tied = materialize(tied, "tied").repartition(n, "old_key")
    joined = base.repartition(n, "key").join(tied, F.col("key") == F.col("old_key"), "left")
    # Of rows that are equal throughout the first answers.
    first = F.row_number().over(Window.partitionBy("key").orderBy("url")) == 1
    joined = joined.withColumn("chosen", F.coalesce(F.col("answers") & first, F.lit(False)))
    return joined.select("page_id", "url", "html", "payload_bytes", "digest", F.when(~F.col("chosen"), F.col("newest")).alias("refers_to"), "chosen")


def _head(kind: str, ident, fields: list, length) -> F.Column:
    parts = [F.lit(f"WARC/1.1{EOL}WARC-Type: {kind}{EOL}WARC-Record-ID: "), ident, F.lit(EOL)]
    for name, value in fields:
        parts += [F.lit(f"{name}: "), value, F.lit(EOL)]
    return F.concat(*parts, F.lit("Content-Length: "), length.cast("string"), F.lit(END))


def write_warc(marked: DataFrame, path: str, date: str = "2000-01-01T00:00:00Z") -> None:
    """Write a request, a response or revisit, and a metadata record for every row, an archive for each task."""
    page = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    urn = lambda kind: F.concat(F.lit(f"<urn:capture:{kind}:"), page, F.lit(":"), F.col("no"), F.lit(">"))
    response_of = lambda ident: F.concat(F.lit("<urn:capture:response:"), ident, F.lit(":"), F.col("digest"), F.lit(">"))
    url = F.regexp_replace(F.coalesce("url", F.lit("")), r"[\r\n]", " ")
    revisit = F.col("refers_to").isNotNull()
    date_field = ("WARC-Date", F.lit(date))
    own = F.when(revisit, urn("revisit")).when(F.col("chosen"), response_of(page))
    own = F.coalesce(own, F.concat(F.lit("<urn:capture:response:"), page, F.lit(":"), F.col("digest"), F.lit(":"), F.col("no"), F.lit(">")))
    common = [("WARC-Target-URI", url), date_field, ("Page-ID", page)]
    digest = [("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))), ("Payload-Length", F.col("payload_bytes").cast("string"))]
    http = F.lit(f"HTTP/1.1 200 OK{EOL}Content-Type: text/html; charset=utf-8{END}")
    request = F.concat(F.lit("GET "), url, F.lit(f" HTTP/1.1{END}"))
    meta = F.concat(F.lit("n_chars: "), F.char_length("html").cast("string"), F.lit(EOL))
    refers = [("WARC-Refers-To", response_of(F.col("refers_to").cast("string"))), ("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))]
    response = F.when(
        revisit, F.concat(_head("revisit", own, common + digest + refers, F.octet_length(http)), http)
    ).otherwise(F.concat(_head("response", own, common + digest, F.octet_length(http) + F.col("payload_bytes")), http, F.col("html")))
    to = [("WARC-Concurrent-To", own)]
    records = F.concat(
        _head("request", urn("request"), common + to, F.octet_length(request)), request, F.lit(END), response, F.lit(END), _head("metadata", urn("metadata"), common + to, F.octet_length(meta)), meta
    )
    # ``no`` tells rows of one page id apart.
    rows = marked.withColumn("no", F.concat(F.lit("r"), F.monotonically_increasing_id().cast("string")))
    rows.select(records.alias("value")).write.option("lineSep", END).option("compression", "gzip").text(path)


_FIELD = re.compile(rb"([^:\r\n]+): ([^\r\n]*)\r\n")


def parse_warc(data: bytes):
    """(fields, block) of every record in ``data``, by Content-Length."""
    at = 0
    while True:
        at = data.find(b"WARC/1.1\r\n", at)
        if at < 0:
            return
        end = data.index(b"\r\n\r\n", at)
        fields = dict(_FIELD.findall(data, at + 10, end + 2))
        length = int(fields[b"Content-Length"])
        block = data[end + 4 : end + 4 + length]
        if len(block) != length:
            raise ValueError(f"record at {at} is cut off: {len(block)} of {length} bytes")
        yield fields, block
        at = end + 4 + length


def _read(payload: bool):
    def run(batches):
        import hashlib

        import pyarrow as pa

        names = [x.split()[0] for x in RECORDS.split(", ")]
        types = [{"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[x.split()[1]] for x in RECORDS.split(", ")]
        schema = pa.schema(list(zip(names, types, strict=True)))

        def batch(rows):
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], types[i]) for i in range(len(names))], schema=schema)

        for some in batches:
            for content in some.column("content"):
                data = content.as_py()
                rows, size = [], 0
                for f, block in parse_warc(zlib.decompress(data, 47) if data[:2] == b"\x1f\x8b" else data):
                    get = lambda k, f=f: f.get(k, b"").decode("utf-8") or None
                    kind, body, n, digest = f[b"WARC-Type"].decode(), None, None, None
                    if kind in ("response", "revisit"):
                        body = block[block.index(b"\r\n\r\n") + 4 :]
                        if kind == "response":
                            n, digest = len(body), hashlib.sha1(body).hexdigest()
                            if f"sha1:{digest}" != get(b"WARC-Payload-Digest"):
                                raise ValueError(f"digest of {get(b'WARC-Record-ID')} differs")
                        else:
                            n, digest = int(f[b"Payload-Length"]), get(b"WARC-Payload-Digest").removeprefix("sha1:")
                    elif kind == "metadata":
                        body = block
                    keep = body if payload or kind == "metadata" else None
                    refers = get(b"WARC-Refers-To")
                    page = get(b"Page-ID")
                    rows.append((kind, get(b"WARC-Record-ID"), get(b"WARC-Concurrent-To"), get(b"WARC-Target-URI"), refers, page and int(page), n, digest, keep))
                    size += len(keep or b"")
                    if len(rows) >= 2000 or size > 8 << 20:
                        yield batch(rows)
                        rows, size = [], 0
                if rows:
                    yield batch(rows)

    return run


def read_warc(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """One row per record of the archives below ``path``; without ``payload`` the column is null for responses."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    return files.mapInArrow(_read(payload), RECORDS)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: the response or revisit with the request and the metadata that name it in concurrent_to."""
    side = records.where(F.col("kind").isin("request", "metadata") & F.col("concurrent_to").isNotNull()).select("kind", "record_id", F.col("concurrent_to").alias("of"), "uri", "payload")
    pick = lambda kind: F.min(F.when(F.col("kind") == kind, F.struct("record_id", "uri", F.col("payload").cast("string").alias("text")))).alias(kind)
    sides = side.groupBy("of").agg(pick("request"), pick("metadata"))
    main = records.where(F.col("kind").isin("response", "revisit"))
    joined = main.join(sides, main.record_id == sides.of, "left")
    return joined.select("page_id", "uri", F.struct("record_id", "kind", "payload_bytes", "payload_digest", "refers_to", "payload").alias("response"), "request", "metadata")


def op9_warc(spark, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "warc")
    write_warc(mark_revisits(table(spark, sf_dir, "pages")), path)
    r = F.col("response")
    refers = F.regexp_extract(r["refers_to"], r"<urn:capture:response:(-?\d+):", 1).try_cast("long")
    return assemble(read_warc(spark, path, payload=False)).select("page_id", r["payload_bytes"].alias("payload_bytes"), r["payload_digest"].alias("payload_digest"), r["kind"].alias("record_type"), refers.alias("refers_to"))


OP9_SQL = f"""
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
g AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS newest, row_number() OVER (PARTITION BY payload_digest ORDER BY page_id DESC NULLS LAST) AS place FROM p),
r AS (SELECT *, payload_bytes >= {MIN_REVISIT} AND newest IS NOT NULL AND place > 1 AS again FROM g)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN again THEN newest END AS refers_to FROM r
"""
