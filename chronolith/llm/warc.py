"""Legacy web archives (ARC, versions 1 and 2) converted to WARC records.

The converter reads the version block of an ARC file, then each record's
space-separated header line in the order that version declares, then exactly
the declared number of bytes. From these it makes WARC records: identifiers,
timestamps, types and SHA-1 digests are synthesised deterministically, so a
repeated task writes the same bytes.
"""

from __future__ import annotations

import base64
import hashlib
import io
import zlib
from collections.abc import Iterable, Iterator
from datetime import datetime, timezone
from typing import NamedTuple
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronolith.llm.common import join_groups, stage, text_of

# fixed values: header fields of the two versions of the format
ARC_FIELDS = {
    1: ("URL", "IP-address", "Archive-date", "Content-type", "Archive-length"),
    2: ("URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset", "Filename", "Archive-length"),
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
KEY_HEADER = "X-Row-Key"
#: Payload bytes gathered into one archive before it is written.
ARCHIVE_BYTES = 8 << 20
#: Groups of equal pages that are broadcast at most; beyond it pages are shuffled.
BROADCAST_ROWS = 200_000


class ArcRecord(NamedTuple):
    """One ARC record: its header fields by name, its offset and its content."""

    fields: dict[str, str]
    offset: int
    content: bytes


class WarcRecord(NamedTuple):
    headers: dict[str, str]
    block: bytes


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def http_message(payload: bytes, key: int | None, content_type: str = "text/html; charset=UTF-8") -> bytes:
    """A stored HTTP response; the key of the source row rides in a header."""
    row = "" if key is None else f"{KEY_HEADER}: {key}\r\n"
    return f"HTTP/1.1 200 OK\r\nContent-Type: {content_type}\r\nContent-Length: {len(payload)}\r\n{row}\r\n".encode() + payload


def split_http(block: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """Headers (lower-case names), the header part, and the payload of a response."""
    end = block.find(b"\r\n\r\n")
    if end < 0:
        raise ValueError("an HTTP message without the end of its header")
    lines = block[:end].decode("latin-1").split("\r\n")
    headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    return headers, block[: end + 4], block[end + 4 :]


def write_arc(version: int, name: str, date: str, entries: Iterable[tuple[str, bytes]]) -> bytes:
    """An ARC file of ``(url, content)`` entries in the given version."""
    fields = ARC_FIELDS[version]
    about = f"{version} 0 chronolith\n{' '.join(fields)}\n\n".encode()
    out = io.BytesIO()

    def put(url: str, mime: str, content: bytes) -> None:
        known = {"URL": url, "IP-address": "0.0.0.0", "Archive-date": date, "Content-type": mime, "Result-code": "200", "Checksum": hashlib.md5(content).hexdigest(), "Location": "-", "Offset": str(out.tell()), "Filename": name, "Archive-length": str(len(content))}
        out.write(" ".join(known[f] for f in fields).encode() + b"\n" + content + b"\n")

    put(f"filedesc://{name}", "text/plain", about)
    for url, content in entries:
        put(url, "text/html", content)
    return out.getvalue()


def read_arc(data: bytes) -> Iterator[ArcRecord]:
    """Records of an ARC file, the version block first.

    The version block's second line declares the fields of header lines and
    their order; without one they are those of its version. Raises ValueError
    where a header line has other fields, a record is shorter than its declared
    length, or its offset or checksum (MD5), where given, are others.
    """
    at, fields = 0, None
    while at < len(data):
        if data[at : at + 1] == b"\n":
            at += 1
            continue
        end = data.find(b"\n", at)
        if end < 0:
            raise ValueError(f"a header line without its end at byte {at}")
        parts = data[at:end].decode("utf-8").split(" ")
        if fields is None:
            if not parts[0].startswith("filedesc://"):
                raise ValueError("the file does not begin with a version block")
            length = int(parts[-1])
            about = data[end + 1 : end + 1 + length]
            version = int(about.split(b" ", 1)[0])
            if version not in ARC_FIELDS:
                raise ValueError(f"ARC version {version} is not known")
            declared = about.split(b"\n", 2)[1].decode("utf-8").split() if b"\n" in about else []
            fields = tuple(declared) or ARC_FIELDS[version]
            if set(fields) != set(ARC_FIELDS[version]) or fields[-1] != "Archive-length":
                raise ValueError(f"the version block declares the fields {' '.join(fields)}")
        if len(parts) != len(fields):
            raise ValueError(f"a header line of {len(parts)} fields at byte {at}; its version has {len(fields)}")
        named = dict(zip(fields, parts, strict=True))
        length = int(named["Archive-length"])
        content = data[end + 1 : end + 1 + length]
        if len(content) != length:
            raise ValueError(f"the record at byte {at} ends before its declared length")
        if named.get("Offset", "-") not in ("-", str(at)):
            raise ValueError(f"the record at byte {at} gives {named['Offset']} as its offset")
        if named.get("Checksum", "-") not in ("-", hashlib.md5(content).hexdigest()):
            raise ValueError(f"the record at byte {at} misses its checksum")
        yield ArcRecord(named, at, content)
        at = end + 1 + length


def record_id(key: int | None, salt: bytes) -> str:
    """A UUID (custom layout) that holds a row key in its outer bits and a hash
    in its middle ones, so the key can be read back from the identifier."""
    bits = (key or 0) & (2**64 - 1)
    h = int.from_bytes(hashlib.sha1(salt + str(key).encode()).digest()[:8], "big")
    high = (bits >> 32) << 32 | (h & 0xFFFF) << 16 | 0x8000 | (h >> 16 & 0xFFF)
    low = 0x8000_0000_0000_0000 | (h >> 28 & 0x3FFF_FFFF) << 32 | bits & 0xFFFF_FFFF
    x = f"{high:016x}{low:016x}"
    return f"<urn:uuid:{x[:8]}-{x[8:12]}-{x[12:16]}-{x[16:20]}-{x[20:]}>"


def key_of(identifier: str) -> int:
    """The row key in an identifier of :func:`record_id`."""
    x = identifier.strip("<>").removeprefix("urn:uuid:").replace("-", "")
    bits = int(x[:8], 16) << 32 | int(x[24:], 16)
    return bits - 2**64 if bits >= 2**63 else bits


def warc_date(date: str) -> str:
    """14 digits (or a prefix of at least 8) as a WARC timestamp."""
    full = date + "00000000000000"[len(date) :]
    return datetime.strptime(full, "%Y%m%d%H%M%S").replace(tzinfo=timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")


def convert(record: ArcRecord, refers_to: int | None = None) -> WarcRecord:
    """The WARC record equivalent to an ARC record.

    The version block becomes ``warcinfo``, a stored HTTP message ``response``
    and anything else ``resource``. With ``refers_to``, a response is written
    as a ``revisit`` of that row: its block keeps the HTTP header only.
    """
    f = record.fields
    headers = {"WARC-Date": warc_date(f["Archive-date"])}
    url = f["URL"]
    salt = f"{url}\n{f['Archive-date']}\n".encode()
    if url.startswith("filedesc://"):
        headers = {"WARC-Type": "warcinfo", "WARC-Record-ID": record_id(None, salt), **headers, "WARC-Filename": url.removeprefix("filedesc://"), "Content-Type": "application/warc-fields"}
        block = b"format: ARC\r\nversion: " + record.content.split(b" ", 1)[0] + b"\r\n"
    elif record.content.startswith(b"HTTP/"):
        http, head, payload = split_http(record.content)
        key = int(http[KEY_HEADER.lower()]) if KEY_HEADER.lower() in http else None
        block = record.content if refers_to is None else head
        headers = {"WARC-Type": "response" if refers_to is None else "revisit", "WARC-Record-ID": record_id(key, b"row"), **headers, "WARC-Target-URI": url, "WARC-IP-Address": f["IP-address"], "WARC-Payload-Digest": f"sha1:{base32_sha1(payload)}", "Content-Type": "application/http; msgtype=response"}
        if refers_to is not None:
            headers |= {"WARC-Profile": REVISIT_PROFILE, "WARC-Refers-To": record_id(refers_to, b"row")}
    else:
        block = record.content
        headers = {"WARC-Type": "resource", "WARC-Record-ID": record_id(None, salt), **headers, "WARC-Target-URI": url, "WARC-Payload-Digest": f"sha1:{base32_sha1(block)}", "Content-Type": f["Content-type"]}
    headers |= {"WARC-Block-Digest": f"sha1:{base32_sha1(block)}", "Content-Length": str(len(block))}
    return WarcRecord(headers, block)


def write_warc(records: Iterable[WarcRecord]) -> bytes:
    """A WARC file with one gzip member for each record."""
    out = io.BytesIO()
    for r in records:
        text = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in r.headers.items()) + "\r\n"
        gz = zlib.compressobj(1, zlib.DEFLATED, 31)
        out.write(gz.compress(text.encode() + r.block + b"\r\n\r\n") + gz.flush())
    return out.getvalue()


def read_warc(data: bytes) -> Iterator[WarcRecord]:
    """Records of a WARC file; a block that misses its digest raises ValueError."""
    while data:
        gz = zlib.decompressobj(31)
        raw = gz.decompress(data)
        if not gz.eof:
            raise ValueError("a WARC record is cut off")
        data = gz.unused_data
        end = raw.index(b"\r\n\r\n")
        lines = raw[:end].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError("a record does not begin with the WARC version")
        headers = {k: v for k, _, v in (x.partition(": ") for x in lines[1:])}
        block = raw[end + 4 : end + 4 + int(headers["Content-Length"])]
        if f"sha1:{base32_sha1(block)}" != headers["WARC-Block-Digest"]:
            raise ValueError(f"the block of {headers['WARC-Record-ID']} misses its digest")
        yield WarcRecord(headers, block)


def _clean_url(url: str | None, key: int | None) -> str:
    return quote(url, safe=":/?#[]@!$&'()*+,;=%-._~") if url else f"urn:row:{key}"


def _archives(batches: Iterable[pa.RecordBatch], date: str) -> Iterator[pa.RecordBatch]:
    kept: list[tuple[int | None, str, bytes, int | None]] = []
    held = 0

    def flush() -> pa.RecordBatch:
        made = []
        for version in (1, 2):
            rows = [x for x in kept if (x[0] or 0) % 2 == version - 1]
            if not rows:
                continue
            name = f"part-{rows[0][0]}-v{version}.arc"
            arc = write_arc(version, name, date, ((url, http_message(payload, key)) for key, url, payload, _ in rows))
            refers = [None, *(x[3] for x in rows)]
            made.append((name.replace(".arc", ".warc.gz"), len(rows), write_warc(convert(r, to) for r, to in zip(read_arc(arc), refers, strict=True))))
        return pa.RecordBatch.from_arrays([pa.array([x[0] for x in made], pa.string()), pa.array([x[1] for x in made], pa.int32()), pa.array([x[2] for x in made], pa.binary())], names=["archive", "records", "data"])

    for batch in batches:
        for row in batch.to_pylist():
            payload = (row["html"] or "").encode()
            kept.append((row["page_id"], _clean_url(row["url"], row["page_id"]), payload, row["refers_to"]))
            held += len(payload)
            if held >= ARCHIVE_BYTES:
                yield flush()
                kept, held = [], 0
    if kept:
        yield flush()


def _pages(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "record_id", "warc_date", "url"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()]
    for batch in batches:
        for data in batch.column("data"):
            rows = []
            for r in read_warc(data.as_py() or b""):
                kind = r.headers["WARC-Type"]
                if kind not in ("response", "revisit"):
                    continue
                http, _, payload = split_http(r.block)
                digest = r.headers["WARC-Payload-Digest"].removeprefix("sha1:")
                if kind == "response" and base32_sha1(payload) != digest:
                    raise ValueError(f"the payload of {r.headers['WARC-Record-ID']} misses its digest")
                key = http.get(KEY_HEADER.lower())
                refers = r.headers.get("WARC-Refers-To")
                rows.append((None if key is None else int(key), int(http["content-length"]), digest, kind, None if refers is None else key_of(refers), r.headers["WARC-Record-ID"], r.headers["WARC-Date"], r.headers["WARC-Target-URI"]))
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in rows], t) for i, t in enumerate(types)], names=names)


def to_archives(pages: DataFrame, date: str = "20240101000000", least_bytes: int = 0, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Pages as WARC archives converted from ARC: archive, records, data.

    Payloads are equal when their SHA-256 digests are. Of pages with equal payloads of at least ``least_bytes`` bytes the smallest
    id is a response, the others revisit it. Null html counts as empty; null
    urls get a urn; null ids never become the response of others where any id
    is known; rows that repeat an id with its payload are all responses. An
    empty table gives no archives; other columns are ignored.
    """
    html = text_of(html_col)
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), html.alias("html"), F.sha2(F.encode(html, "UTF-8"), 256).alias("digest"), F.octet_length(html).alias("bytes"))
    groups = rows.filter(F.col("bytes") >= least_bytes).groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("copies"))
    first = stage(groups.filter("copies > 1"), "warc-first")
    few = first.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    if few:  # pages are not shuffled
        joined = rows.join(F.broadcast(first), "digest", "left")
    else:
        keyed = join_groups(rows, first, "digest", "copies")
        joined = keyed.unionByName(rows.join(first, "digest", "left_anti").withColumns({"first": F.lit(None).cast("long"), "copies": F.lit(1).cast("long")}))
    ready = joined.select("page_id", "url", "html", F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to"))
    return ready.mapInArrow(lambda batches: _archives(batches, date), "archive string, records int, data binary")


def read_archives(archives: DataFrame) -> DataFrame:
    """A row for each response or revisit record of WARC archives.

    Records of other types are passed over; archives that repeat give their rows
    again; null data has none; no archives give an empty result. An archive that
    is cut off or whose blocks or payloads miss their digests raises ValueError.
    """
    return archives.select("data").mapInArrow(_pages, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, record_id string, warc_date string, url string")


def archive_round_trip(pages: DataFrame) -> DataFrame:
    """Write the archives of ``pages`` to the shared folder and read them back."""
    return read_archives(stage(to_archives(pages), "warc"))
