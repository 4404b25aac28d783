"""Record formats: legacy ARC records (versions 1 and 2) and WARC records, as bytes.

Small per-record helpers; the Spark jobs in ``warc.py`` call them inside tasks.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

# The field names of an ARC URL-record line, by version.
ARC_FIELDS = {
    1: ["URL", "IP-address", "Archive-date", "Content-type", "Archive-length"],
    2: ["URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset",
        "Filename", "Archive-length"],
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
_HEAD_END = b"\r\n\r\n"


def digest(data: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(name: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>"


@dataclass
class ArcRecord:
    offset: int  # in the uncompressed archive
    url: str
    ip: str
    date: str
    content_type: str
    block: bytes

    def is_http(self) -> bool:
        return self.block.startswith(b"HTTP/") and _HEAD_END in self.block

    def head(self) -> bytes:
        """The HTTP head with its empty line; empty for other protocols."""
        return self.block[:self.block.index(_HEAD_END) + 4] if self.is_http() else b""

    def payload(self) -> bytes:
        return self.block[len(self.head()):]

    def page_id(self) -> int | None:
        return page_id_of(self.head())


def page_id_of(head: bytes) -> int | None:
    value = headers_of(head).get("x-page-id", "")
    return int(value) if value.lstrip("-").isdigit() else None


def headers_of(head: bytes) -> dict[str, str]:
    """Header lines by lower-case name (the first line is skipped)."""
    out = {}
    for line in head.split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if colon:
            out[name.strip().lower().decode("utf-8", "replace")] = value.strip().decode("utf-8", "replace")
    return out


def opened(content: bytes) -> io.BufferedIOBase:
    """A stream over an archive, compressed (any number of gzip members) or not."""
    raw = io.BytesIO(content)
    return gzip.GzipFile(fileobj=raw) if content[:2] == b"\x1f\x8b" else raw


def arc_version_block(version: int, name: str, date: str) -> bytes:
    """The version block an archive begins with, without the newline after it."""
    body = f"{version} 0 unitmesh\n{' '.join(ARC_FIELDS[version])}\n".encode()
    return arc_line(version, f"filedesc://{name}", "0.0.0.0", date, "text/plain", len(body), name) + body


def arc_line(version: int, url: str, ip: str, date: str, content_type: str, length: int, name: str = "-") -> bytes:
    middle = "" if version == 1 else f"200 - - 0 {name} "
    return f"{url} {ip} {date} {content_type} {middle}{length}\n".encode()


def read_arc(content: bytes) -> Iterator[ArcRecord]:
    """The records of an ARC archive. A version block sets how the header lines after it
    are read; declared lengths, not markers, tell where a record ends."""
    stream, at, version = opened(content), 0, None
    while line := stream.readline():
        start, at = at, at + len(line)
        if line.strip(b"\r\n") == b"":
            continue
        text = line.rstrip(b"\r\n").decode("utf-8", "replace")
        described = text.startswith("filedesc://")
        fields = len(ARC_FIELDS[version]) if version and not described else 0
        # A URL may hold spaces, so the other fields are taken from the right.
        parts = text.rsplit(" ", fields - 1) if fields else text.split(" ")
        if not parts[-1].isdigit() or (fields and len(parts) != fields):
            raise ValueError(f"no ARC header line at offset {start}: {text[:200]!r}")
        length = int(parts[-1])
        block = stream.read(length)
        if len(block) != length:
            raise ValueError(f"ARC record at offset {start} declares {length} bytes, {len(block)} are there")
        at += length
        if described:
            version = int(block.split(b" ", 1)[0])
            if version not in ARC_FIELDS:
                raise ValueError(f"unknown ARC version {version}")
            continue
        if version is None:
            raise ValueError("the archive has no version block")
        yield ArcRecord(start, parts[0], parts[1], parts[2], parts[3], block)


def warc_date(date: str) -> str:
    """WARC date of a 14-digit ARC date (shorter ones are filled up)."""
    d = (date + "00000101000000"[len(date):])[:14] if date.isdigit() else "19700101000000"
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def warc_record(kind: str, fields: list[tuple[str, str]], block: bytes) -> bytes:
    """A WARC record without the two line ends after its block."""
    lines = [("WARC-Type", kind), *fields, ("Content-Length", str(len(block)))]
    return b"WARC/1.0\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines).encode() + b"\r\n" + block


def converted(arc: ArcRecord, name: str, refers_to: str | None) -> bytes:
    """The WARC record of an ARC record called ``name``: a response (a resource for other
    protocols), or a revisit of the record called ``refers_to``, whose block is the HTTP
    head alone."""
    payload, head = arc.payload(), arc.head()
    fields = [("WARC-Record-ID", record_id(name)), ("WARC-Date", warc_date(arc.date)),
              ("WARC-Target-URI", arc.url), ("WARC-IP-Address", arc.ip),
              ("WARC-Payload-Digest", "sha1:" + digest(payload))]
    kind, block = ("response" if head else "resource"), arc.block
    if refers_to is not None:
        kind, block = "revisit", head
        fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", record_id(refers_to)),
                   ("X-Payload-Length", str(len(payload)))]
    fields += [("WARC-Block-Digest", "sha1:" + digest(block)),
               ("Content-Type", "application/http; msgtype=response" if head else arc.content_type)]
    return warc_record(kind, fields, block)


@dataclass
class WarcRecord:
    headers: dict[str, str]
    block: bytes

    @property
    def kind(self) -> str:
        return self.headers["warc-type"]

    def payload(self) -> bytes:
        if self.kind == "response":
            return self.block.partition(_HEAD_END)[2]
        return self.block


def read_warc(content: bytes) -> Iterator[WarcRecord]:
    """The records of a WARC archive; declared lengths tell where a record ends. Block
    digests are checked."""
    stream = opened(content)
    while line := stream.readline():
        if line.strip(b"\r\n") == b"":
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record starts with {line[:80]!r}")
        head = line
        while (line := stream.readline()) not in (b"\r\n", b""):
            head += line
        headers = headers_of(head)
        block = stream.read(int(headers["content-length"]))
        if len(block) != int(headers["content-length"]):
            raise ValueError("the last WARC record is cut off")
        if (want := headers.get("warc-block-digest")) and want != "sha1:" + digest(block):
            raise ValueError(f"block digest of {headers.get('warc-record-id')} differs")
        yield WarcRecord(headers, block)
