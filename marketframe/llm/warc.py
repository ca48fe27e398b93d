"""Web archives: writing pages as WARC records, reading archives back, assembling transactions.

Every page becomes a request, a response and a metadata record; the request and the metadata name the response in
``WARC-Concurrent-To``.  Of pages with equal payloads only those with the smallest page_id keep theirs, the others
are revisit records that carry its digest.  Records are written by Spark's text writer, whose line separator is the
blank line that ends a record; files are compressed.  Pages are written in classes of size, and a file of a class holds
as many captures as keep it within a bound of bytes; equal payloads are of one class.

Archives are read as whole files (``binaryFile``) and parsed by content length, a record at a time.  ``assemble``
joins request, response and metadata through the concurrent-to identifiers to one nested row per capture.

Defined results: a null html is an empty payload; a null page_id never is the one that others refer to unless there is
no other; pages that share the smallest page_id of their payload are all responses; a null url has no target URI, and
blanks and control characters of a url are percent-encoded; a capture without request or metadata has a null there,
and records that name no known response are left out of the captures; an empty table gives an empty archive.
"""

import gzip
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

VERSION = "WARC/1.1"
#: Bytes of payload in a file, at most, unless one page alone has more.
FILE_BYTES = 64 << 20
#: Pages are written by size: those of up to so many bytes, and larger ones one to a file.
SIZES = (16 << 10, 256 << 10, 4 << 20)
#: Payload bytes sent to Spark at a time when reading, about.
BATCH_BYTES = 8 << 20
#: Payloads of fewer bytes are always kept.
LEAST_REVISIT_BYTES = 0
# RFC 4648, fixed values
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
CONV32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RECORD = (
    "record_type string, record_id string, concurrent_to string, target_uri string, payload_digest string, "
    "fields string, payload binary"
)


def base32_sha1(data: Column) -> Column:
    """The SHA-1 of binary data in upper-case base32: five hexadecimal digits are four base32 digits."""
    digits = F.sha1(data)
    groups = [F.lpad(F.conv(F.substring(digits, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*groups), CONV32, BASE32)


def payloads(pages: DataFrame) -> DataFrame:
    """``page_id, url, html, payload_digest, record_type, original_url``."""
    html = F.coalesce("html", F.lit(""))
    hashed = pages.select(
        "page_id", "url", html.alias("html"), base32_sha1(html.cast("binary")).alias("payload_digest")
    )
    first = F.min(F.struct(F.col("page_id").isNull().alias("none"), "page_id", "url")).alias("first")
    # only payloads that occur more than once; sums are combined before the shuffle
    repeated = hashed.groupBy("payload_digest").agg(first, F.count("*").alias("n")).filter("n > 1").drop("n")
    joined = hashed.join(repeated, "payload_digest", "left")
    again = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first.page_id"))
    large = F.octet_length("html") >= LEAST_REVISIT_BYTES
    kind = F.when(again & large, "revisit").otherwise("response")
    return joined.select(
        "page_id", "url", "html", "payload_digest", kind.alias("record_type"), F.col("first.url").alias("original_url")
    )


def _uri(url: Column) -> Column:
    for char, code in ((" ", "%20"), ("\t", "%09"), ("\n", "%0A"), ("\x0b", "%0B"), ("\x0c", "%0C"), ("\r", "%0D")):
        url = F.replace(url, F.lit(char), F.lit(code))
    return url


def _record(headers: list[tuple[str, Column]], block: Column) -> Column:
    """A record without the blank line at its end; headers that are null are left out."""
    lines = [F.lit(VERSION), *[F.concat(F.lit(f"{name}: "), value) for name, value in headers]]
    length = F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string"))
    return F.concat(F.concat_ws("\r\n", *lines, length), F.lit("\r\n\r\n"), block)


def _urn(name: str) -> Column:
    return F.concat(F.lit("<urn:uuid:"), F.col(name), F.lit(">"))


def write_archives(
    pages: DataFrame, path: str, date: str = "2000-01-01T00:00:00Z", file_bytes: int = FILE_BYTES, sizes: tuple[int, ...] = SIZES
) -> None:
    """Write pages (``page_id, url, html``) as compressed archives below ``path``, a folder per class of size."""
    size = F.coalesce(F.octet_length("html"), F.lit(0))
    for least, most in zip((-1, *sizes), (*sizes, None), strict=True):
        part = pages.filter((size > least) & (size <= most) if most is not None else size > least)
        _write_class(part, f"{path}/over-{max(least, 0)}", date, max(1, file_bytes // most) if most else 1)


def _write_class(pages: DataFrame, path: str, date: str, captures_per_file: int) -> None:
    # the identifiers only have to differ: a task that is repeated writes its whole file anew
    captures = payloads(pages).withColumns({f"_{k}": F.uuid() for k in ("response", "request", "metadata")})
    uri, day = _uri(F.col("url")), F.lit(date)
    revisit = F.col("record_type") == "revisit"
    common = lambda kind, id_: [
        ("WARC-Type", kind), ("WARC-Record-ID", _urn(id_)), ("WARC-Date", day), ("WARC-Target-URI", uri)
    ]
    size = F.octet_length("html").cast("string")
    head = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), size, F.lit("\r\n\r\n")
    )
    response = _record(
        [
            *common(F.col("record_type"), "_response"),
            ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
            ("WARC-Profile", F.when(revisit, PROFILE)),
            ("WARC-Refers-To-Target-URI", F.when(revisit, _uri(F.col("original_url")))),
            ("Content-Type", F.lit("application/http; msgtype=response")),
        ],
        F.when(revisit, head).otherwise(F.concat(head, F.col("html"))),
    )
    concurrent = ("WARC-Concurrent-To", _urn("_response"))
    request = _record(
        [*common(F.lit("request"), "_request"), concurrent, ("Content-Type", F.lit("application/http; msgtype=request"))],
        F.concat(F.lit("GET "), F.coalesce(uri, F.lit("/")), F.lit(" HTTP/1.1\r\n\r\n")),
    )
    metadata = _record(
        [*common(F.lit("metadata"), "_metadata"), concurrent, ("Content-Type", F.lit("application/warc-fields"))],
        F.coalesce(F.concat(F.lit("page_id: "), F.col("page_id").cast("string"), F.lit("\r\n")), F.lit("")),
    )
    records = captures.select(F.explode(F.array(request, response, metadata)).alias("value"))
    records.write.option("lineSep", "\r\n\r\n").option("compression", "gzip").option(
        "maxRecordsPerFile", 3 * captures_per_file
    ).text(path)


def parse(stream) -> Iterator[tuple]:
    """The records of one archive, as tuples of ``RECORD``."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a record: {line[:40]!r}")
        headers = {}
        while (line := stream.readline().rstrip(b"\r\n")):
            name, _, value = line.decode("utf-8", "replace").partition(":")
            headers[name.strip().lower()] = value.strip()
        size = int(headers["content-length"])
        block = stream.read(size)
        if len(block) < size:
            raise ValueError("a record is cut off")
        kind = headers["warc-type"]
        fields, _, payload = (block, b"", None) if kind == "metadata" else block.partition(b"\r\n\r\n")
        yield (
            kind,
            headers.get("warc-record-id"),
            headers.get("warc-concurrent-to"),
            headers.get("warc-target-uri"),
            headers.get("warc-payload-digest", "").removeprefix("sha1:") or None,
            fields.decode("utf-8", "replace"),
            payload if kind == "response" else None,
        )


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """All records below ``path``, with the columns of ``RECORD``; ``payload`` of responses only."""
    names = [c.split()[0] for c in RECORD.split(", ")]
    types = [pa.string()] * 6 + [pa.binary()]

    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for files in batches:
            for content in files.column("content"):
                rows, held = [], 0
                for row in parse(gzip.GzipFile(fileobj=io.BytesIO(content.as_buffer()))):
                    rows.append(row)
                    held += len(row[-1] or b"") + 500
                    if held > BATCH_BYTES:
                        yield batch(rows)
                        rows, held = [], 0
                if rows:
                    yield batch(rows)

    files = spark.read.format("binaryFile").options(pathGlobFilter="*.gz", recursiveFileLookup=True).load(path).select("content")
    return files.mapInArrow(read, RECORD)


def assemble(records: DataFrame) -> DataFrame:
    """One row per capture: the structs ``response``, ``request`` and ``metadata`` with all columns of ``records``."""
    whole = F.struct(*records.columns)
    captures = records.filter("record_type in ('response', 'revisit')").select("record_id", whole.alias("response"))
    out = captures
    for kind in ("request", "metadata"):
        part = records.filter(F.col("record_type") == kind).select(F.col("concurrent_to").alias("record_id"), whole.alias(kind))
        out = out.join(part, "record_id", "left")
    return out.drop("record_id")


def resolve(captures: DataFrame) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` of captures that have ``payload_bytes``.

    The digest of a response is that of the payload as read; a revisit takes its figures from the response with its
    digest.
    """
    found = captures.select(
        F.regexp_extract(F.col("metadata.fields"), r"page_id: (-?\d+)", 1).try_cast("long").alias("page_id"),
        "response.payload_digest", "response.record_type", "response.payload_bytes",
    )
    originals = (
        found.filter("record_type = 'response'")
        .groupBy("payload_digest")
        .agg(F.min("page_id").alias("_original"), F.max("payload_bytes").alias("_bytes"))
    )
    revisit = F.col("record_type") == "revisit"
    return found.join(originals, "payload_digest", "left").select(
        "page_id",
        F.when(revisit, F.col("_bytes")).otherwise(F.col("payload_bytes")).cast("long").alias("payload_bytes"),
        "payload_digest",
        "record_type",
        F.when(revisit, F.col("_original")).alias("refers_to"),
    )


def read_payload_figures(records: DataFrame) -> DataFrame:
    """The records with ``payload_bytes`` and the digest of what was read in place of the payload."""
    digest = F.when(F.col("record_type") == "response", base32_sha1(F.col("payload"))).otherwise(F.col("payload_digest"))
    return records.withColumn("payload_digest", digest).withColumn("payload_bytes", F.length("payload")).drop("payload")


#: A row per page; the digest, for which DuckDB has no base32, is spelled out of the hexadecimal digits.
ORACLE = """
WITH hashed AS (
    SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages),
first AS (
    SELECT hex, min(page_id) AS original FROM hashed GROUP BY hex)
SELECT page_id, payload_bytes,
       list_reduce(list_transform(range(0, 32), lambda i: 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[
           1 + ((('0x' || hex[5 * (i // 4) + 1 : 5 * (i // 4) + 5])::INTEGER >> (15 - 5 * (i % 4))) & 31)::INTEGER]),
           lambda a, b: a || b) AS payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM original THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS NOT DISTINCT FROM original THEN NULL ELSE original END AS refers_to
FROM hashed JOIN first USING (hex)
"""
