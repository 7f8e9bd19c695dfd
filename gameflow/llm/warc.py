"""WARC archives: a writer with revisit records and a reader that salvages damaged files.

Spark partitions the pages; each task packs records into gzip members and the members into
archives of bounded size, which Spark's own writer commits to any file system. The reader takes
an archive per row. Where a check fails it looks for the next valid member or version line, goes
on there, and reports the bytes in between.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gameflow.llm.store import stored
from gameflow.session import scratch_path

MIN_REVISIT_BYTES = 1000
ARCHIVE_BYTES = 4 << 20
#: Date of all records: archives of the same pages are the same bytes.
RECORD_DATE = "2024-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MAGIC = b"\x1f\x8b\x08"
END = b"\r\n\r\n"
#: Where a record may begin again: a gzip member or a version line.
RESUME = re.compile(rb"\x1f\x8b\x08|WARC/\d\.\d\r?\n")
VERSION = re.compile(rb"WARC/\d\.\d\r?\n")

RECORD_SCHEMA = (
    "kind string, archive string, offset bigint, length bigint, inner_offset bigint, inner_length bigint, reason string, record_type string, record_id string, "
    "target_uri string, refers_to string, payload_digest string, payload_bytes bigint, payload binary"
)


# Writing


def with_revisits(pages: DataFrame) -> DataFrame:
    """``pages(page_id, url, html)`` with ``payload_digest`` and, for repeats, ``refers_to``.

    Of the rows whose payloads of at least ``MIN_REVISIT_BYTES`` are equal, those with the
    largest page_id stay responses. Equal payloads are counted per digest before the shuffle,
    and only digests that occur more than once are joined back.
    """
    digested = pages.select(
        F.col("page_id").cast("long"), F.col("url").cast("string"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    ).withColumn("payload_digest", F.sha1(F.col("html").cast("binary")))
    originals = (
        digested.where(F.octet_length("html") >= MIN_REVISIT_BYTES).groupBy("payload_digest")
        .agg(F.max("page_id").alias("original"), F.count("*").alias("n")).where("n > 1")
        .select(F.col("payload_digest").alias("__digest"), "original")
    )
    originals = stored(pages.sparkSession, originals, "warc-originals")
    return digested.join(originals, F.col("payload_digest") == F.col("__digest"), "left").withColumn(
        "refers_to", F.when(~F.col("page_id").eqNullSafe(F.col("original")), F.col("original"))
    ).drop("__digest", "original")


def _record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = [
        "WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {RECORD_DATE}",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    head.append("WARC-Payload-Digest: sha1:" + base64.b32encode(bytes.fromhex(digest)).decode())
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {REVISIT_PROFILE}"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + END + block + END


def _member(record: bytes) -> bytes:
    packer = zlib.compressobj(4, zlib.DEFLATED, 31)
    return packer.compress(record) + packer.flush()


def write_archives(pages: DataFrame, path: str) -> None:
    """Writes pages as archives below ``path``, one gzip member per record.

    An archive is one row of bytes for Spark's text writer, which ends it with a newline.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        members: list[bytes] = []
        size = 0
        for batch in batches:
            columns = [batch.column(c) for c in ("page_id", "url", "html", "payload_digest", "refers_to")]
            for i in range(batch.num_rows):
                page_id, url, html, digest, refers_to = (c[i].as_py() for c in columns)
                members.append(_member(_record(page_id, url, html.encode(), digest, refers_to)))
                size += len(members[-1])
                if size >= ARCHIVE_BYTES:
                    yield pa.RecordBatch.from_pydict({"value": [b"".join(members)]})
                    members, size = [], 0
        if members:
            yield pa.RecordBatch.from_pydict({"value": [b"".join(members)]})

    packed = with_revisits(pages).mapInArrow(pack, "value binary")
    packed.select(F.col("value").cast("string")).write.option("maxRecordsPerFile", 1).text(path)


# Reading


def _headers(lines: bytes) -> dict[str, str]:
    pairs = (line.partition(b":") for line in lines.splitlines())
    return {k.strip().lower().decode("latin-1"): v.strip().decode("utf-8", "replace") for k, _, v in pairs}


def _parse(data: bytes, at: int) -> tuple[dict | str, int]:
    """The record at a version line and its end; on a failed check the reason and where to look on."""
    version = VERSION.match(data, at)
    head_end = data.find(END, at)
    if not version or head_end < 0:
        return "header", at + 1
    headers = _headers(data[version.end():head_end])
    length = headers.get("content-length", "")
    start = head_end + 4
    if not length.isdigit() or "warc-type" not in headers:
        return "header", at + 1
    end = start + int(length)
    if end > len(data):
        return "truncated", at + 1
    if data[end:end + 4] != END[:len(data) - end][:4]:
        return "length", at + 1
    block = data[start:end]
    http_length, payload = None, block
    if headers.get("content-type", "").startswith("application/http"):
        http, _, payload = block.partition(END)
        http_length = _headers(http).get("content-length")
    kind = headers["warc-type"]
    declared, verified = headers.get("warc-payload-digest", ""), False
    digest = hashlib.sha1(payload).hexdigest()
    if declared.startswith("sha1:"):
        try:
            stated = base64.b32decode(declared[5:]).hex() if len(declared) == 37 else declared[5:].lower()
        except ValueError:
            return "digest", min(end + 4, len(data))
        if kind != "revisit" and stated != digest:
            return "digest", min(end + 4, len(data))
        digest, verified = stated, kind != "revisit" and "warc-record-id" in headers
    size = len(payload)
    if kind == "revisit":
        payload, size = None, int(http_length) if http_length and http_length.isdigit() else None
    return {
        "record_type": kind, "record_id": headers.get("warc-record-id"), "target_uri": headers.get("warc-target-uri"),
        "refers_to": headers.get("warc-refers-to"), "payload_digest": digest, "payload_bytes": size, "payload": payload,
        "verified": verified,
    }, min(end + 4, len(data))


def _unpack(data: bytes, at: int) -> tuple[bytes, int, bool]:
    """The content of the gzip member at ``at``, its end, and whether it is whole.

    Of a damaged or cut member it is the content before the damage, and the place of that.
    """
    unpacker = zlib.decompressobj(31)
    parts, place = [], at
    while not unpacker.eof and place < len(data):
        before = unpacker.copy()
        try:
            parts.append(unpacker.decompress(data[place:place + 65536]))
            place += 65536
        except zlib.error:
            try:  # byte by byte up to the damage
                while True:
                    parts.append(before.decompress(data[place:place + 1]))
                    place += 1
            except zlib.error:
                return b"".join(parts), place, False
    if not unpacker.eof:
        return b"".join(parts), len(data), False
    return b"".join(parts), min(place, len(data)) - len(unpacker.unused_data), True


def _scan(data: bytes, whole: bool) -> Iterator[dict]:
    """Records of a member's content and the gaps between them, with their places in it.

    If the member is not ``whole``, its checksum vouches for nothing, and a record counts only if
    its payload meets a stated digest.
    """
    at = gap = 0
    reason = ""
    while at < len(data):
        if not reason and data[at] in b"\r\n":
            at += 1
            continue
        record, end = _parse(data, at)
        if isinstance(record, dict) and (whole or record["verified"]):
            if reason:
                yield {"kind": "gap", "inner_offset": gap, "inner_length": at - gap, "reason": reason}
            yield {"kind": "record", "inner_offset": at, "inner_length": end - at, "reason": None} | record
            at, reason = end, ""
            continue
        if not reason:
            gap, reason = at, record if isinstance(record, str) else "unverified"
        resume = VERSION.search(data, max(end, at + 1))
        at = resume.start() if resume else len(data)
    if reason:
        yield {"kind": "gap", "inner_offset": gap, "inner_length": len(data) - gap, "reason": reason}


def salvage(data: bytes) -> Iterator[dict]:
    """Records of an archive in order, and the gaps (``kind`` gap) where none could be read.

    ``offset`` and ``length`` are bytes of the archive; rows from within a gzip member carry the
    member's, and ``inner_offset`` and ``inner_length`` tell the place in its content. A gap ends
    where a record is valid again, so what looks like a beginning but fails its checks stays inside
    the gap. Line ends between records are padding. Nothing of a record that fails is returned.

    A member whose checksum holds loses only the records in it that fail, each a gap of that member.
    A damaged or cut member is part of a gap; records before the damage that meet their digests are
    returned, with the bytes up to the damage, ahead of the gap they lie in.
    """
    at = gap = damage = 0
    reason = ""
    saved: set[tuple[str | None, str]] = set()

    def closed(end: int) -> Iterator[dict]:
        if reason:
            yield {"kind": "gap", "offset": gap, "length": end - gap, "reason": reason}

    while at < len(data):
        found, end, problem = [], at + 1, "garbage"
        if data.startswith(MAGIC, at):
            inside, end, whole = _unpack(data, at)
            found = [{"offset": at, "length": end - at} | row for row in _scan(inside, whole)]
            problem = found[0]["reason"] if whole and found else "gzip"
            if not whole:
                kept = [r for r in found if r["kind"] == "record"]
                yield from kept
                # Uncompressed blocks show their version lines, where the same records must not count again.
                saved |= {(r["record_id"], r["payload_digest"]) for r in kept}
                found, damage, end = [], max(damage, end), at + 1
            elif all(r["kind"] == "gap" for r in found):
                found = []
        elif data.startswith(b"WARC/", at):
            record, end = _parse(data, at)
            if isinstance(record, str):
                problem = record
            elif at >= damage or (record["record_id"], record["payload_digest"]) not in saved:
                found = [{"kind": "record", "offset": at, "length": end - at, "reason": None} | record]
        elif not reason and data[at] in b"\r\n":
            at += 1
            continue
        if found:
            yield from closed(at)
            yield from found
            at, reason = end, ""
            continue
        if not reason:
            gap, reason = at, problem
        resume = RESUME.search(data, max(end, at + 1))
        at = resume.start() if resume else len(data)
    yield from closed(len(data))


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Records and gaps of all archives below ``path``, gzip members or plain, whole or damaged.

    An archive is read whole by its task, so it must fit into that task's memory; Spark's binary
    source ends at 2 GB. ``payloads=False`` leaves the payload bytes out.
    """
    names = [f.split()[0] for f in RECORD_SCHEMA.split(", ")]
    types = {n: pa.int64() for n in ("offset", "length", "inner_offset", "inner_length")} | {"payload_bytes": pa.int64(), "payload": pa.binary()}

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive, content in zip(batch.column(0), batch.column(1), strict=True):
                found, size = [], 0
                for row in salvage(content.as_py()):
                    if not payloads:
                        row["payload"] = None
                    found.append(row | {"archive": archive.as_py()})
                    size += len(row.get("payload") or b"") + 500
                    if size > 4 << 20:
                        yield packed(found)
                        found, size = [], 0
                if found:
                    yield packed(found)

    def packed(found: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([r.get(n) for r in found], types.get(n, pa.string())) for n in names], names=names
        )

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(rows, RECORD_SCHEMA)


def page_number(urn: str) -> F.Column:
    """The page_id inside a record id that ``write_archives`` made."""
    return F.expr(f"try_cast(regexp_extract({urn}, '<urn:page:(-?[0-9]+)>', 1) as bigint)")


def archive_round_trip(pages: DataFrame) -> DataFrame:
    """Writes ``pages(page_id, url, html)`` as archives and returns one row per record read back.

    A null html is an empty payload; null urls are left out of the record; repeated rows give a
    record each, and equal rows that share the largest page_id are all responses. A null page_id
    never counts as the largest. An empty table writes no record. Other columns are not used.
    """
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_archives(pages, path)
    return read_archives(spark, path, payloads=False).where("kind = 'record'").select(
        page_number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        page_number("refers_to").alias("refers_to"),
    )
