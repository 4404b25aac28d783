"""Archives: exact round trips and plain Python digests."""

from __future__ import annotations

import base64
import gzip
import hashlib

import pytest

from unitmesh.llm import archives
from unitmesh.llm.warc import convert_arc, page_records, pages_through_archives, read_warc
from unitmesh.session import scratch_path

SCHEMA = "page_id long, url string, html string, record_type string"


def slow(pages, min_bytes=0):
    best = {}
    for i, _, h in pages:
        h = h or ""
        best[h] = max(best.get(h, -1), -1 if i is None else i)
    out, used = [], set()
    for i, _, h in pages:
        data = (h or "").encode()
        first = len(data) < min_bytes or (best[h or ""] == (-1 if i is None else i) and (h or "") not in used)
        if first and len(data) >= min_bytes:
            used.add(h or "")
        keeper = best[h or ""]
        out.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "response" if first else "revisit",
                    None if first or keeper == -1 else keeper))
    return sorted(out, key=str)


def result(df):
    return sorted((tuple(r) for r in df.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=str)


def test_pages_round_trip(spark):
    pages = [(r["page_id"], r["url"], r["html"]) for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()]
    pages += [(10_000 + i, "http://copy", pages[0][2]) for i in range(200)]
    df = spark.createDataFrame([(*p, "x") for p in pages], SCHEMA).repartition(4)
    assert result(pages_through_archives(df)) == slow(pages)


def test_edges(spark):
    pages = [(1, "http://a b/\nc", None), (2, None, ""), (3, "", "WARC/1.0\r\n\r\nHTTP/1.1 200\r\n\r\n"), (4, "http://x", "é\r\n\r\n\n"),
             (5, "http://x", "x" * 3_000_000), (None, "http://n", "alone"), (6, "u", "tiny"), (7, "u", "tiny"), (7, "u", "tiny"), (8, "u", "\x00")]
    df = spark.createDataFrame([(*p, "x") for p in pages], SCHEMA).repartition(3)
    assert result(pages_through_archives(df)) == slow(pages)
    got = result(pages_through_archives(df, min_bytes=5))
    assert sum(r[3] == "revisit" for r in got) == 0
    assert result(pages_through_archives(spark.createDataFrame([], SCHEMA))) == []


def arc(version, *records):
    lines = [archives.arc_version_block(version, "t.arc", "19990101000000")]
    for url, block in records:
        lines.append(archives.arc_line(version, url, "10.0.0.1", "19990203040506", "text/html", len(block), "t.arc") + block)
    return b"\n".join(lines) + b"\n"


def test_both_arc_versions_and_gzip():
    http = b"HTTP/1.0 200 OK\r\nX-Page-Id: 5\r\n\r\nbody\n\n2 0 x"
    for version in (1, 2):
        data = arc(version, ("http://a/ b", http), ("dns:a", b"a. 1 IN A 10.0.0.1"))
        for content in (data, gzip.compress(data), gzip.compress(data[:60]) + gzip.compress(data[60:])):
            a, b = archives.read_arc(content)
            assert (a.url, a.ip, a.date, a.payload(), a.page_id()) == ("http://a/ b", "10.0.0.1", "19990203040506", b"body\n\n2 0 x", 5)
            assert (b.is_http(), b.payload(), b.page_id()) == (False, b"a. 1 IN A 10.0.0.1", None)
    assert [r.url for r in archives.read_arc(arc(1, ("u", b"")) + arc(2, ("v", b"")))] == ["u", "v"]
    assert archives.warc_date("1999") == "1999-01-01T00:00:00Z" and archives.warc_date("19990203040506") == "1999-02-03T04:05:06Z"


def test_wrong_archives_raise():
    good = arc(1, ("u", b"12345"))
    for bad in (good[:-4], good.replace(b" 5\n", b" x\n"), good[good.index(b"u "):], good.replace(b"1 0 unitmesh", b"7 0 unitmesh")):
        with pytest.raises(ValueError):
            list(archives.read_arc(bad))


def test_converter_reads_foreign_archives(spark):
    """A version 1 archive with DNS records, written as one binary file by Spark's text sink."""
    path, out = scratch_path(spark, "foreign"), scratch_path(spark, "foreign-warc")
    text = arc(1, ("http://u", b"HTTP/1.0 200 OK\r\n\r\nsame"), ("dns:u", b"same"), ("http://v", b"HTTP/1.0 200 OK\r\n\r\nother")).decode()
    spark.createDataFrame([(text,)], "value string").write.text(path)
    convert_arc(spark, path, out)
    records = read_warc(spark, out)
    assert sorted(r["record_type"] for r in records.collect()) == ["resource", "response", "revisit"] or sorted(
        r["record_type"] for r in records.collect()) == ["response", "response", "revisit"]
    assert page_records(records).count() == 3
