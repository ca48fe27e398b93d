import base64
import hashlib
import io

import pytest

from marketframe.llm import warc
from marketframe.session import scratch_path

SCHEMA = "page_id long, url string, html string, payload string"


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def archived(spark, rows):
    path = scratch_path(spark, "warc-test")
    warc.write_archives(spark.createDataFrame([(*r, "x") for r in rows], SCHEMA), path)
    return warc.read_records(spark, path)


def resolved(records):
    return warc.resolve(warc.assemble(warc.read_payload_figures(records)))


PAGES = [
    (3, "http://a/x?y=1 2", "<p>é</p>"),
    (1, "http://b/", "one\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\n"),
    (2, None, "<p>é</p>"),
    (5, "http://c/\r\nWARC-Type: x", None),
    (7, "http://d/", ""),
    (9, "http://e/", "\n"),
    (None, "http://f/", "<p>é</p>"),
    (None, None, "lonely"),
    (11, "http://g/", "twice"),
    (11, "http://g/", "twice"),
    (12, "http://g/", "twice"),
    (13, "http://long/", "x" * 3_000_000),
]


def test_round_trip(spark):
    got = sorted(map(tuple, resolved(archived(spark, PAGES)).collect()), key=str)
    want = []
    for page, _, html in PAGES:
        same = [p for p, _, h in PAGES if (h or "") == (html or "") and p is not None]
        first = min(same, default=None)
        again = page != first
        want.append((page, len((html or "").encode()), digest(html), "revisit" if again else "response", first if again else None))
    assert got == sorted(want, key=str)


def test_payloads_and_links(spark):
    records = archived(spark, PAGES)
    captures = warc.assemble(records).collect()
    assert len(captures) == len(PAGES) and records.count() == 3 * len(PAGES)
    for c in captures:
        assert c.request.concurrent_to == c.response.record_id == c.metadata.concurrent_to
        assert (c.response.payload is None) == (c.response.record_type == "revisit")
        if c.response.payload is not None:
            assert digest(bytes(c.response.payload).decode()) == c.response.payload_digest
    assert {c.response.target_uri for c in captures} >= {"http://a/x?y=1%202", "http://c/%0D%0AWARC-Type:%20x", None}
    assert len({r.record_id for r in records.select("record_id").collect()}) == 3 * len(PAGES)


def test_files_are_bounded_by_bytes(spark):
    """One page of 20 MB among small ones, and bounds lowered: no file holds more than its bound or one capture."""
    import random
    from collections import Counter

    rng = random.Random(3)
    pages = [(i, f"http://{i}/", "y" * rng.randrange(3_000)) for i in range(300)] + [(1000, "http://big/", "z" * 20_000_000)]
    path = scratch_path(spark, "warc-test")
    frame = spark.createDataFrame([(*r, "x") for r in pages], SCHEMA).coalesce(1)
    warc.write_archives(frame, path, file_bytes=8_000, sizes=(500, 2_000))
    files = spark.read.format("binaryFile").options(pathGlobFilter="*.gz", recursiveFileLookup=True).load(path)
    import gzip

    seen = Counter()
    for name, content in ((r.path, bytes(r.content)) for r in files.collect()):
        payloads = [r for r in warc.parse(io.BytesIO(gzip.decompress(content))) if r[0] in ("response", "revisit")]
        held = sum(len(r[-1] or b"") for r in payloads)
        assert held <= 8_000 or len(payloads) == 1
        seen[name.split("/")[-2]] += len(payloads)
    assert sum(seen.values()) == 301 and set(seen) == {"over-0", "over-500", "over-2000"}
    got = {r.page_id: r.payload_bytes for r in resolved(warc.read_records(spark, path)).collect()}
    assert got == {i: len(html) for i, _, html in pages}


def test_captures_without_their_records(spark):
    records = archived(spark, PAGES[:2]).filter("record_type = 'response'")
    assert [(c.request, c.metadata) for c in warc.assemble(records).collect()] == [(None, None)] * 2
    assert [r.page_id for r in resolved(records).collect()] == [None, None]


def test_empty_table(spark):
    assert resolved(archived(spark, [])).collect() == []


def test_broken_archives_fail():
    with pytest.raises(ValueError, match="cut off"):
        list(warc.parse(io.BytesIO(b"WARC/1.1\r\nWARC-Type: metadata\r\nContent-Length: 9\r\n\r\nabc")))
    with pytest.raises(ValueError, match="not a record"):
        list(warc.parse(io.BytesIO(b"HTTP/1.1 200 OK\r\n\r\n")))
