"""WARC archives: write captures, read records, assemble transactions.

``write_archive`` turns each row into three records: a request and a metadata
record that name, in WARC-Concurrent-To, the response (or revisit) record of the
capture.  Spark's text writer writes them: a record is one value, the two line
breaks that end a record are the line separator, so the files are valid WARC
(whole-file gzip), written on the executors through the commit protocol to any
file system that Spark knows.

Rows of equal payloads of at least ``revisit_from`` bytes: the one of the largest
id is the response, the others are revisits that refer to it and hold no payload.
The choice is made on narrow rows (id, digest); payloads move once, by capture.

``read_records`` parses the files by Content-Length.  ``assemble`` brings the
records that name one response together and emits one nested row per capture;
``resolve_revisits`` adds the payload facts of the response that a revisit names.

Defined cases: a null payload is empty; rows equal in id, url and payload are
captures of their own, told apart by an ordinal, all responses if their id is the
largest; a null id is smaller than any other and stays null; line breaks in a
url are percent-encoded, a null url has no header; requests or metadata that
name a response that is not in the archives form a capture without response;
further columns, whatever their names, are not read."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkmill.llm.store import stored

REVISIT_FROM = 1000
DATE = "2024-01-01T00:00:00Z"
RECORDS_PER_FILE = 6000
_END = "\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _record_id(key: Column) -> Column:
    """A urn:uuid of 32 hex digits."""
    cut = [F.substring(key, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def _headers(*pairs: tuple[str, Column]) -> Column:
    """Lines ``name: value``; a null value leaves its line out."""
    return F.concat(F.lit("WARC/1.1\r\n"), *[F.coalesce(F.concat(F.lit(f"{k}: "), v, F.lit("\r\n")), F.lit("")) for k, v in pairs], F.lit("\r\n"))


def _captures(pages: DataFrame, id_col: str, url_col: str, payload_col: str) -> DataFrame:
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"),
                        F.regexp_replace(F.regexp_replace(F.col(url_col), "\r", "%0D"), "\n", "%0A").alias("url"), payload.alias("payload"))
    rows = rows.withColumns({"bytes": F.octet_length("payload").cast("long"), "digest": F.sha1("payload")})
    key = F.md5(F.concat_ws("\n", F.coalesce(F.col("page_id").cast("string"), F.lit("null")), F.coalesce("url", F.lit("")), "digest"))
    return rows.withColumn("capture", key)


def _revisits(rows: DataFrame, revisit_from: int) -> DataFrame:
    """(capture, response_capture) of the rows that revisit another's payload."""
    lean = rows.select("capture", "page_id", "bytes", "digest").filter(F.col("bytes") >= revisit_from)
    groups = (lean.groupBy("digest").agg(F.max(F.struct("page_id", "capture")).alias("lead"), F.count(F.lit(1)).alias("n"))
              .filter("n > 1").select(F.col("digest").alias("g_digest"), "lead"))
    groups = stored(groups, "payload-groups")  # a plain table: AQE can split a hot digest in the join
    return (lean.join(groups, lean.digest == groups.g_digest)
            .filter(~F.col("page_id").eqNullSafe(F.col("lead.page_id")))
            .groupBy("capture").agg(F.first("lead.capture").alias("response_capture")))


def records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
            revisit_from: int = REVISIT_FROM, date: str = DATE) -> DataFrame:
    """One row per WARC record: (value), header and block without the closing line breaks."""
    rows = _captures(pages, id_col, url_col, payload_col)
    marks = _revisits(rows, revisit_from).select(F.col("capture").alias("m_capture"), "response_capture")
    rows = rows.join(marks, rows.capture == marks.m_capture, "left").drop("m_capture")
    rows = rows.withColumn("n", F.row_number().over(Window.partitionBy("capture").orderBy("capture")))
    ident = lambda kind: _record_id(F.md5(F.concat_ws("/", F.lit(kind), "capture", F.col("n").cast("string"))))
    lead = _record_id(F.md5(F.concat_ws("/", F.lit("response"), "response_capture", F.lit("1"))))
    is_revisit = F.col("response_capture").isNotNull()
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("bytes").cast("string"), F.lit(_END))
    block = F.when(is_revisit, http).otherwise(F.concat(http, F.col("payload").cast("string")))
    length = (F.octet_length(http) + F.when(is_revisit, 0).otherwise(F.col("bytes"))).cast("string")
    response = F.concat(_headers(
        ("WARC-Type", F.when(is_revisit, "revisit").otherwise("response")), ("WARC-Record-ID", ident("response")), ("WARC-Date", F.lit(date)),
        ("WARC-Target-URI", F.col("url")), ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
        ("WARC-Profile", F.when(is_revisit, F.lit(_PROFILE))), ("WARC-Refers-To", F.when(is_revisit, lead)),
        ("Content-Type", F.lit("application/http; msgtype=response")), ("Content-Length", length)), block)
    get = F.concat(F.lit("GET "), F.coalesce("url", F.lit("/")), F.lit(f" HTTP/1.1{_END}"))
    request = F.concat(_headers(
        ("WARC-Type", F.lit("request")), ("WARC-Record-ID", ident("request")), ("WARC-Date", F.lit(date)), ("WARC-Target-URI", F.col("url")),
        ("WARC-Concurrent-To", ident("response")), ("Content-Type", F.lit("application/http; msgtype=request")),
        ("Content-Length", F.octet_length(get).cast("string"))), get)
    fields = F.coalesce(F.concat(F.lit("page-id: "), F.col("page_id").cast("string"), F.lit("\r\n")), F.lit(""))
    metadata = F.concat(_headers(
        ("WARC-Type", F.lit("metadata")), ("WARC-Record-ID", ident("metadata")), ("WARC-Date", F.lit(date)), ("WARC-Target-URI", F.col("url")),
        ("WARC-Concurrent-To", ident("response")), ("Content-Type", F.lit("application/warc-fields")),
        ("Content-Length", F.octet_length(fields).cast("string"))), fields)
    return rows.select(F.explode(F.array(request, response, metadata)).alias("value"))


def write_archive(pages: DataFrame, path: str, records_per_file: int = RECORDS_PER_FILE, **options) -> None:
    (records(pages, **options).write.option("lineSep", _END).option("compression", "gzip")
     .option("maxRecordsPerFile", records_per_file).text(path))


_RECORD = ("type string, record_id string, concurrent_to string, refers_to string, uri string, date string, content_type string, "
           "header_digest string, payload_bytes long, payload_digest string, block binary")
_NAMES = [x.split()[0] for x in _RECORD.split(", ")]


def parse(raw: bytes) -> Iterator[tuple[dict[str, str], memoryview]]:
    """(headers, block) of each record of a file, gzipped (one or more members) or plain."""
    if raw[:2] == b"\x1f\x8b":
        parts = []
        while raw:
            member = zlib.decompressobj(wbits=31)
            parts.append(member.decompress(raw))
            raw = member.unused_data
        raw = b"".join(parts)
    at, view = 0, memoryview(raw)
    while at < len(raw):
        end = raw.index(b"\r\n\r\n", at)
        lines = raw[at:end].split(b"\r\n")
        if not lines[0].startswith(b"WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        headers = {k.strip().lower().decode(): v.strip().decode("utf-8", "replace") for k, _, v in (x.partition(b":") for x in lines[1:])}
        size = int(headers["content-length"])
        yield headers, view[end + 4:end + 4 + size]
        at = end + 4 + size
        if raw[at:at + 4] != b"\r\n\r\n":
            raise ValueError(f"record does not end at byte {at}")
        at += 4


def _read(payloads: bool):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw in batch.column("content"):
                out, held = [], 0
                for h, block in parse(raw.as_py()):
                    kind = h.get("warc-type")
                    body = block
                    if kind in ("response", "revisit"):
                        cut = re.search(b"\r\n\r\n", block)
                        body = block[cut.end():] if cut else block[:0]
                    keep = bytes(body) if payloads or kind not in ("response", "revisit") else None
                    out.append((kind, h.get("warc-record-id"), h.get("warc-concurrent-to"), h.get("warc-refers-to"), h.get("warc-target-uri"),
                                h.get("warc-date"), h.get("content-type"), h.get("warc-payload-digest", "").removeprefix("sha1:") or None,
                                len(body), hashlib.sha1(body).hexdigest(), keep))
                    held += len(keep or b"") + 500
                    if held > 4 << 20:
                        yield _batch(out)
                        out, held = [], 0
                yield _batch(out)

    return rows


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[] for _ in _NAMES]
    kinds = [pa.binary() if n == "block" else pa.int64() if n == "payload_bytes" else pa.string() for n in _NAMES]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=_NAMES)


def read_records(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """One row per record of all archives below ``path``.  ``payloads`` False leaves
    the bodies of responses out; their length and SHA-1 are of the body read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*part-*").load(path).select("content")
    return files.mapInArrow(_read(payloads), _RECORD)


def assemble(recs: DataFrame) -> DataFrame:
    """One nested row per capture: (capture_id, page_id, response, requests, metadata)."""
    key = F.coalesce(F.when(F.col("type").isin("request", "metadata"), F.col("concurrent_to")), F.col("record_id"))
    response = F.struct("record_id", "type", "uri", "date", "refers_to", "header_digest", "payload_bytes", "payload_digest", "block")
    request = F.struct("record_id", "uri", "date", F.col("block").cast("string").alias("head"))
    metadata = F.struct("record_id", "date", F.col("block").cast("string").alias("fields"))
    grouped = recs.withColumn("capture_id", key).groupBy("capture_id").agg(
        F.get(F.collect_list(F.when(F.col("type").isin("response", "revisit"), response)), 0).alias("response"),
        F.collect_list(F.when(F.col("type") == "request", request)).alias("requests"),
        F.collect_list(F.when(F.col("type") == "metadata", metadata)).alias("metadata"))
    page = F.regexp_extract(F.array_join(F.col("metadata.fields"), "\r\n"), r"(?:^|\n)page-id: (-?\d+)\r\n", 1)
    return grouped.withColumn("page_id", F.nullif(page, F.lit("")).cast("long"))


def resolve_revisits(captures: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) per capture
    with a response; a revisit has the facts of the response that it names."""
    own = captures.filter(F.col("response").isNotNull()).select(
        "page_id", F.col("response.type").alias("record_type"), F.col("response.refers_to").alias("target"),
        F.col("response.payload_bytes").alias("bytes"), F.col("response.payload_digest").alias("digest"))
    named = captures.filter(F.col("response.type") == "response").select(
        F.col("response.record_id").alias("r_id"), F.col("page_id").alias("r_page"),
        F.col("response.payload_bytes").alias("r_bytes"), F.col("response.payload_digest").alias("r_digest"))
    is_revisit = F.col("record_type") == "revisit"
    plain = own.filter(~is_revisit).select("page_id", F.col("bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"),
                                           "record_type", F.lit(None).cast("long").alias("refers_to"))
    again = own.filter(is_revisit).join(named, F.col("target") == F.col("r_id"), "left").select(
        "page_id", F.col("r_bytes").alias("payload_bytes"), F.col("r_digest").alias("payload_digest"), "record_type", F.col("r_page").alias("refers_to"))
    return plain.unionByName(again)
