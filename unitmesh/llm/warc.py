"""Legacy archive conversion: ARC archives to WARC archives, and reading them back.

Archives are files that Spark reads and writes itself (binary file source, text sink
with the format's record separator, gzip), so they may lie in any store Spark knows.
A task streams its archives record by record. To find repeated payloads only (record,
digest, length) rows are aggregated; a payload that a third of all records share is
one row per task before the shuffle. Payloads move once, by their own record's name,
to meet the decision to write them as a revisit; the join has one row per record.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from unitmesh.llm import archives
from unitmesh.llm.common import arrow_rows, ready, written
from unitmesh.session import scratch_path

ARCHIVE_ROWS = 4  # archives per Arrow batch
RECORD_ROWS = 32
_BATCH_BYTES = 8_000_000
_RECORD = "_name string, _page long, _url string, _ip string, _date string, _type string, _block binary, _digest string, _bytes long"
_READ = "page_id long, record_id string, record_type string, refers_to_id string, payload_bytes long, payload_digest string"


def _names(ddl: str) -> list[str]:
    return [part.split()[0] for part in ddl.split(", ")]


def _batched(rows, names, types, size):
    """Record batches of rows (tuples), cut by bytes so that memory stays bounded."""
    held, weight = [], 0
    for row in rows:
        held.append(row)
        weight += size(row) + 200
        if weight > _BATCH_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names=names)
            held, weight = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names=names)


def _archives(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", "content")


def _parse_arc(whole: bool):
    """Records of ARC archives; without their blocks unless ``whole``."""
    def run(batches):
        def rows():
            for batch in batches:
                for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    for r in archives.read_arc(content):
                        payload = r.payload()
                        yield (f"{path}#{r.offset}", r.page_id(), r.url, r.ip, r.date, r.content_type,
                               r.block if whole else None, archives.digest(payload), len(payload))
        s, n = pa.string(), pa.int64()
        yield from _batched(rows(), _names(_RECORD), [s, n, s, s, s, s, pa.binary(), s, n], lambda r: len(r[6] or b""))
    return run


def _convert(batches):
    """WARC records of joined ARC records, after one warcinfo record for the archive."""
    def rows():
        info = b"software: unitmesh\r\nformat: WARC File Format 1.0\r\n"
        where = TaskContext.get()
        first = archives.warc_record("warcinfo", [
            ("WARC-Record-ID", archives.record_id(f"warcinfo {where.stageId()} {where.partitionId()}")),
            ("WARC-Date", archives.warc_date("19700101")), ("Content-Type", "application/warc-fields")], info)
        for batch in batches:
            for r in batch.to_pylist():
                if first:
                    yield (first,)
                    first = None
                arc = archives.ArcRecord(0, r["_url"], r["_ip"], r["_date"], r["_type"], r["_block"])
                yield (archives.converted(arc, r["_name"], r["_keeper"]),)
    yield from _batched(rows(), ["_record"], [pa.binary()], lambda r: len(r[0]))


def _parse_warc(batches):
    """One row per response, resource or revisit; full payloads are checked against their digest."""
    def rows():
        for batch in batches:
            for content in batch.column(1).to_pylist():
                for r in archives.read_warc(content):
                    if r.kind == "warcinfo":
                        continue
                    said = r.headers["warc-payload-digest"].removeprefix("sha1:")
                    if r.kind == "revisit":
                        n = int(r.headers["x-payload-length"])
                    else:
                        payload = r.payload()
                        n = len(payload)
                        if archives.digest(payload) != said:
                            raise ValueError(f"payload digest of {r.headers['warc-record-id']} differs")
                    yield (archives.page_id_of(r.block.partition(b"\r\n\r\n")[0]), r.headers["warc-record-id"], r.kind,
                           r.headers.get("warc-refers-to"), n, said)
    s, n = pa.string(), pa.int64()
    yield from _batched(rows(), _names(_READ), [n, s, s, s, n, s], lambda r: 100)


def write_records(records: DataFrame, path: str, separator: str) -> str:
    """Archives of a one-column table of records (binary), each ended by ``separator``."""
    (records.select(F.col(records.columns[0]).cast("string").alias("value"))
     .write.mode("overwrite").option("lineSep", separator).option("compression", "gzip").text(path))
    return path


def convert_arc(spark: SparkSession, arc_path: str, warc_path: str, min_bytes: int = 0) -> str:
    """Write the WARC archives of the ARC archives (versions 1 and 2, gzipped or not)
    below ``arc_path``.

    Of records with equal payloads of at least ``min_bytes`` bytes, the one with the
    largest page id (a null one is smallest; ties: the largest record name) is written in
    full, the others as revisits of it. Records whose page id is missing, empty payloads and
    non-HTTP records (written as resources) are converted like any other. A record that
    is not as long as declared, or an archive without version block, raises ValueError.
    """
    ready(spark)
    with arrow_rows(spark, ARCHIVE_ROWS):
        found = written(_archives(spark, arc_path).mapInArrow(_parse_arc(False), _RECORD)
                        .select("_name", "_page", "_digest", "_bytes"), "arc-digests")
        key = F.struct(F.coalesce("_page", F.lit(-(2 ** 63))).alias("p"), F.col("_name").alias("n"))
        groups = written(found.where(F.col("_bytes") >= min_bytes).groupBy("_digest")
                         .agg(F.max(key).alias("_best"), F.count(F.lit(1)).alias("_n")).where("_n > 1")
                         .select("_digest", F.col("_best.n").alias("_keeper")), "arc-repeated")
        revisits = written(
            found.where(F.col("_bytes") >= min_bytes).join(groups, "_digest").where(F.col("_name") != F.col("_keeper"))
            .select(F.col("_name").alias("_of"), "_keeper"), "arc-revisits")
        # The archives are parsed again rather than kept as a table of records.
        records = _archives(spark, arc_path).mapInArrow(_parse_arc(True), _RECORD).select(
            "_name", "_url", "_ip", "_date", "_type", "_block")
        joined = records.join(revisits, F.col("_name") == F.col("_of"), "left").drop("_of")
        return write_records(joined.mapInArrow(_convert, "_record binary"), warc_path, "\r\n\r\n")


def read_warc(spark: SparkSession, warc_path: str) -> DataFrame:
    """(``page_id``, ``record_id``, ``record_type``, ``refers_to_id``, ``payload_bytes``,
    ``payload_digest``) of the records of WARC archives, checked against their digests."""
    ready(spark)
    with arrow_rows(spark, ARCHIVE_ROWS):
        return written(_archives(spark, warc_path).mapInArrow(_parse_warc, _READ), "warc-records")


def page_records(records: DataFrame) -> DataFrame:
    """The read records with ``refers_to``: the page id of the record a revisit refers to."""
    targets = records.where("record_type <> 'revisit'").select(
        F.col("record_id").alias("_target"), F.col("page_id").alias("refers_to"))
    return records.join(targets, F.col("refers_to_id") == F.col("_target"), "left").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


# ------------------------------------------------------------------ stand-in input
def write_arc_input(pages: DataFrame, path: str, date: str = "20240630120000") -> str:
    """ARC archives of a pages table (page_id, url, html): odd tasks write version 1, even
    ones version 2. A null html is an empty body; a null url or one with white space is
    written in a form that ARC header lines allow; the page id is an HTTP header, left
    out if null. An empty table gives archives without records."""
    def run(batches):
        number = TaskContext.get().partitionId()
        version, name = 1 + number % 2, f"pages-{number:05d}.arc"

        def rows():
            yield (archives.arc_version_block(version, name, date),)
            for batch in batches:
                for r in batch.to_pylist():
                    body = (r["html"] or "").encode()
                    url = "".join(r["url"].split()) if r["url"] and r["url"].split() else "about:blank"
                    own = "" if r["page_id"] is None else f"X-Page-Id: {r['page_id']}\r\n"
                    block = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{own}"
                             f"Content-Length: {len(body)}\r\n\r\n").encode() + body
                    yield (archives.arc_line(version, url, "192.0.2.1", date, "text/html", len(block), name) + block,)
        yield from _batched(rows(), ["_record"], [pa.binary()], lambda r: len(r[0]))

    with arrow_rows(pages.sparkSession, RECORD_ROWS):
        return write_records(pages.select("page_id", "url", "html").mapInArrow(run, "_record binary"), path, "\n")


def pages_through_archives(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Pages written as ARC archives, converted to WARC archives and read back: (page_id,
    ``payload_bytes``, ``payload_digest``, ``record_type``, ``refers_to``) per page. See
    :func:`write_arc_input` and :func:`convert_arc` for nulls, ties and repeated rows; an
    empty table gives an empty table, extra columns are not read."""
    spark = pages.sparkSession
    ready(spark)
    arc = write_arc_input(pages, scratch_path(spark, "arc"))
    warc = convert_arc(spark, arc, scratch_path(spark, "warc"), min_bytes)
    return page_records(read_warc(spark, warc))
