"""WARC archives: write page captures, read records back, assemble transactions.

Writing is DataFrame code: a capture becomes a response (or revisit), a request and a
metadata record, the latter two tied to it by WARC-Concurrent-To. Spark's text sink ends
each row with CRLF CRLF, which is just how a WARC record ends; files are gzipped and
committed by Spark, so lost tasks are safe. Reading follows Content-Length, never the
separators. ``assemble`` joins the records of a capture through their concurrent-to ids.

Defined cases: null html is an empty payload; null page_id or url is left out of the
archive and reads back as null; line breaks in a url become %0D and %0A; pages alike in
all columns give captures alike; of pages with equal payloads the smallest page_id is the
response (a null page_id only where all are null) and rows that share it are all
responses; an empty table gives no record. Other columns are ignored. A request or
metadata record without its response gives a row with a null response; of several
requests (or metadata records) of one capture the one with the smallest record id is
nested, and the numbers are counted.
"""

from __future__ import annotations

import base64
import hashlib
import zlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from telcolake.llm.common import BATCH_ROWS, cut, remove, written

# Names and layouts of the WARC 1.1 format, RFC 4648 base32 alphabet.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
END = "\r\n"
HTTP_OK = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "

RECORDS_PER_FILE = 30_000
MIN_PAYLOAD_BYTES = 0


def sha1_base32(data: Column) -> Column:
    """Bare upper-case base32 of the SHA-1 of a string's bytes: five hex digits give four characters."""
    digest = F.sha1(data.cast("binary"))
    parts = []
    for i in range(8):
        bits = F.conv(F.substring(digest, 1 + 5 * i, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            parts.append(F.substring(F.lit(BASE32), F.shiftright(bits, shift).bitwiseAND(31) + 1, F.lit(1)))
    return F.concat(*parts)


def _line(name: str, value: Column) -> Column:
    """A header line, or nothing for a null value."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(END)), F.lit(""))


def _record(kind: Column, record_id: Column, headers: list[Column], block: Column) -> Column:
    return F.concat(
        F.lit(VERSION + END),
        _line("WARC-Type", kind),
        _line("WARC-Record-ID", record_id),
        *headers,
        _line("Content-Length", F.octet_length(block).cast("string")),
        F.lit(END),
        block,
    )


def _urn(kind: str, *parts: Column) -> Column:
    h = F.md5(F.concat_ws("\n", F.lit(kind), *[F.coalesce(p.cast("string"), F.lit("-")) for p in parts]))
    pieces = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *pieces), F.lit(">"))


def write_archives(pages: DataFrame, path: str, date: str = "2026-01-01T00:00:00Z", min_payload_bytes: int = MIN_PAYLOAD_BYTES) -> None:
    """Write pages (page_id, url, html) as gzipped WARC files below ``path``.

    The first page of each repeated payload is found from digests alone; the join back is
    on the digest, whose hot values adaptive execution splits.
    """
    html = F.coalesce("html", F.lit(""))
    url = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), url.alias("url"), html.alias("html"), F.octet_length(html).alias("n"), sha1_base32(html).alias("digest"))
    copies = rows.filter(F.col("n") >= min_payload_bytes).groupBy("digest").agg(F.min("page_id").alias("first"), F.min_by("url", "page_id").alias("first_url"), F.count("*").alias("copies"))
    firsts, firsts_path = written(copies.filter("copies > 1 and first is not null").select("digest", "first", "first_url"), "warc-firsts")

    joined = rows.join(firsts, "digest", "left")
    revisit = F.coalesce(~F.col("page_id").eqNullSafe(F.col("first")) & F.col("first").isNotNull() & (F.col("n") >= min_payload_bytes), F.lit(False))
    own = _urn("response", F.col("page_id"), F.col("url"), F.col("digest"))
    target, when = _line("WARC-Target-URI", F.col("url")), _line("WARC-Date", F.lit(date))
    digest = _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest"))
    http = F.concat(F.lit(HTTP_OK), F.col("n").cast("string"), F.lit(END + END))
    response = _record(
        F.when(revisit, "revisit").otherwise("response"),
        own,
        [
            target,
            when,
            digest,
            _line("WARC-Profile", F.when(revisit, REVISIT_PROFILE)),
            _line("WARC-Refers-To", F.when(revisit, _urn("response", F.col("first"), F.col("first_url"), F.col("digest")))),
            _line("Content-Type", F.lit("application/http; msgtype=response")),
        ],
        F.concat(http, F.when(revisit, "").otherwise(F.col("html"))),
    )
    linked = [target, when, _line("WARC-Concurrent-To", own)]
    parts = [F.col("page_id"), F.col("url"), F.col("digest")]
    request = _record(F.lit("request"), _urn("request", *parts), [*linked, _line("Content-Type", F.lit("application/http; msgtype=request"))], F.concat(F.lit("GET "), F.coalesce("url", F.lit("/")), F.lit(" HTTP/1.1\r\n\r\n")))
    metadata = _record(F.lit("metadata"), _urn("metadata", *parts), [*linked, _line("Content-Type", F.lit("application/warc-fields"))], F.concat(_line("page-id", F.col("page_id").cast("string")), _line("payload-bytes", F.col("n").cast("string"))))
    records = joined.select(F.explode(F.array(response, request, metadata)).alias("value"))
    records.write.option("lineSep", END + END).option("maxRecordsPerFile", RECORDS_PER_FILE).option("compression", "gzip").text(path)
    remove(pages.sparkSession, firsts_path)


_HEADER_FIELDS = ("WARC-Type", "WARC-Record-ID", "WARC-Concurrent-To", "WARC-Refers-To", "WARC-Target-URI", "WARC-Date", "WARC-Payload-Digest")
RECORD_SCHEMA = "type string, record_id string, concurrent_to string, refers_to string, target_uri string, date string, header_digest string, fields map<string,string>, payload_bytes long, payload_digest string, payload binary"


def parse_records(content: bytes):
    """(headers, block) of each record of one file, plain or gzipped; record-wise gzip as well."""
    if content[:2] == b"\x1f\x8b":
        parts = []
        while content:
            unzip = zlib.decompressobj(31)
            parts.append(unzip.decompress(content))
            content = unzip.unused_data
        content = b"".join(parts)
    view, at = memoryview(content), 0
    while True:
        while content[at : at + 2] == b"\r\n":
            at += 2
        if at >= len(content):
            return
        end = content.index(b"\r\n\r\n", at)
        lines = bytes(view[at:end]).decode("utf-8", "replace").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"not a WARC record at byte {at}")
        headers = dict(line.split(": ", 1) for line in lines[1:] if ": " in line)
        size = int(headers["Content-Length"])
        yield headers, bytes(view[end + 4 : end + 4 + size])
        at = end + 4 + size


def read_records(spark: SparkSession, path: str, keep_payload: bool = True) -> DataFrame:
    """One row per record; payloads are what follows the HTTP headers, their digests are computed anew."""
    types = pa.schema([(n, t) for n, t in zip([c.split()[0] for c in RECORD_SCHEMA.split(", ")], [pa.string()] * 7 + [pa.map_(pa.string(), pa.string()), pa.int64(), pa.string(), pa.binary()])])

    def parse(parts):
        for batch in parts:
            for content in batch.column(0):
                out = []
                for headers, block in parse_records(content.as_py()):
                    row = [headers.get(name) for name in _HEADER_FIELDS]
                    kind, fields, payload = row[0], [], None
                    if kind == "response":
                        payload = block.split(b"\r\n\r\n", 1)[1] if b"\r\n\r\n" in block else block
                    elif kind == "metadata":
                        fields = [tuple(x.split(": ", 1)) for x in block.decode("utf-8", "replace").split("\r\n") if ": " in x]
                    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode() if payload is not None else None
                    out.append((*row, fields, None if payload is None else len(payload), digest, payload if keep_payload else None))
                    if len(out) >= BATCH_ROWS:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types.types)], schema=types)
                        out = []
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types.types)], schema=types)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(parse, RECORD_SCHEMA)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: capture_id, response, request, metadata, n_requests, n_metadata.

    Requests and metadata name the response they belong to; metadata may name the request
    instead. The linked records are reduced to one per capture before the join, so a
    capture id that very many records name is aggregated, not gathered.
    """
    columns = ["record_id", "target_uri", "date", "fields"]

    def linked(kind: str, rows: DataFrame) -> DataFrame:
        return rows.groupBy("capture_id").agg(F.min_by(F.struct(*columns), "record_id").alias(kind), F.count("*").alias(f"n_{kind}"))

    owner = F.coalesce("concurrent_to", "record_id")
    requests = records.filter("type = 'request'").withColumn("capture_id", owner)
    via = requests.groupBy(F.col("record_id").alias("concurrent_to")).agg(F.min("capture_id").alias("via"))
    metadata = records.filter("type = 'metadata'").join(via, "concurrent_to", "left").withColumn("capture_id", F.coalesce("via", owner))
    responses = records.filter("type in ('response', 'revisit')").select(F.col("record_id").alias("capture_id"), F.struct("type", "record_id", "refers_to", "target_uri", "date", "header_digest", "payload_bytes", "payload_digest", "payload").alias("response"))
    joined = responses.join(linked("request", requests), "capture_id", "full").join(linked("metadata", metadata), "capture_id", "full")
    return joined.select("capture_id", "response", "request", "metadata", F.coalesce("n_request", F.lit(0)).alias("n_requests"), F.coalesce("n_metadata", F.lit(0)).alias("n_metadata"))


def page_digests(spark: SparkSession, path: str) -> DataFrame:
    """Per archived page: page_id, payload_bytes, payload_digest, record_type, refers_to (a page_id).

    Revisits hold no payload: size and digest come from the response they refer to. One
    response may serve a third of all pages, so revisits join it on their own, from
    written tables, and adaptive execution splits the hot id.
    """
    r = F.col("response")
    captures = assemble(read_records(spark, path, keep_payload=False)).select("capture_id", F.col("metadata.fields")["page-id"].cast("long").alias("page_id"), r["type"].alias("record_type"), r["refers_to"].alias("refers_to_id"), r["payload_bytes"].alias("payload_bytes"), r["payload_digest"].alias("payload_digest"))
    flat, flat_path = written(captures, "warc-captures")
    responses = flat.filter("record_type = 'response'")
    known = responses.groupBy(F.col("capture_id").alias("refers_to_id")).agg(F.min("page_id").alias("refers_to"), F.min("payload_bytes").alias("payload_bytes"), F.min("payload_digest").alias("payload_digest"))
    known, known_path = written(known, "warc-responses")
    revisits = flat.filter("record_type = 'revisit'").drop("payload_bytes", "payload_digest").join(known, "refers_to_id", "left")
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    out = cut(responses.withColumn("refers_to", F.lit(None).cast("long")).select(columns).unionByName(revisits.select(columns)))
    for each in (flat_path, known_path):
        remove(spark, each)
    return out
