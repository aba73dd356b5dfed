"""Operator 12: legacy archives (ARC) converted to WARC, and WARC read back.

An ARC file begins with a version block, whose second line holds the version and
whose third names the fields of the header lines that follow; a record is such a
line, as many bytes as its last field declares, and a line end.  Version 1 lines
have five fields, version 2 lines ten (with result code, checksum and offset).

The converter reads records by these declared lengths alone, whatever their bytes
look like, and writes for each a WARC 1.1 record:

* identifier: a UUID made from the archive's own name and the record's offset, so
  a rerun gives the same one;
* timestamp: the fourteen digits of the ARC line as an ISO date;
* type: ``response`` if the body is an HTTP message, ``resource`` otherwise, the
  version block becomes ``warcinfo``; of records with equal payloads (of
  ``min_bytes`` at least) the one with the smallest key is kept and the others
  become ``revisit`` records without payload that refer to it;
* digests: SHA-1 in base32, of the block and of the payload.

A first pass over the archives takes digests only and finds the payloads that come
up twice (a grouped minimum, combined before the shuffle); a second pass converts.
Only the short list of such payloads is joined to the records, and Spark chooses
how from the list's written size; records themselves are shuffled only if it is
large, and a payload that a third of all records share is then split like any
skewed join key.

Files are written and read by Spark alone (text writer, binaryFile reader), so any
store that it reaches will do.  A file holds up to ``ARCHIVE_BYTES`` and one record
more, so that a reader's memory is bounded; it is compressed as a whole (gzip), the
members of a file aren't cut by record.

Cases: a null or empty html is an empty payload (records with empty payloads are
equal); a null id comes after all others and reads back as null; rows with equal id
and payload are one response and revisits to it; a null or empty url is written
as ``-``, blanks and control characters in it are percent-encoded; payloads may hold
any bytes, also what looks like a header; a record longer than ``ARCHIVE_BYTES`` gets a
file of its own; an empty table gives no file and an empty result; other columns of
the table aren't archived.  A broken line, length or digest raises ``ValueError``.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphcluster.llm.common import Table, enter, ship
from graphcluster.session import scratch_dir

ARCHIVE_BYTES = 8 << 20      #: bytes of records in a file, before compression
CAPTURED = "20240101000000"  #: archive date of pages, which carry none
MIN_BYTES = 0                #: shortest payload that is replaced by a revisit

# The field names of the two header lines, as their format has them.
FIELDS = {1: "URL IP-address Archive-date Content-type Archive-length",
          2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length"}
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

KEY_HEADER = "X-Page-Id"     #: HTTP header that carries a page's id through both formats
SAFE = "".join(map(chr, range(0x21, 0x7F)))


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


# ---------------------------------------------------------------------------
# ARC

def arc_line(version: int, url: str, date: str, mime: str, body: bytes, code: str, offset: int, name: str) -> bytes:
    """The header line of a record."""
    if version == 1:
        parts = [url, "0.0.0.0", date, mime, len(body)]
    else:
        parts = [url, "0.0.0.0", date, mime, code, hashlib.md5(body).hexdigest(), "-", offset, name, len(body)]
    return " ".join(map(str, parts)).encode() + b"\n"


def arc_head(version: int, name: str, date: str) -> bytes:
    """The version block that a file begins with."""
    body = f"{version} 0 graphcluster\n{FIELDS[version]}\n".encode()
    return arc_line(version, f"filedesc://{name}", date, "text/plain", body, "200", 0, name) + body + b"\n"


def http_message(page_id: int | None, payload: bytes) -> bytes:
    key = f"{KEY_HEADER}: {page_id}\r\n" if page_id is not None else ""
    return (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{key}"
            f"Content-Length: {len(payload)}\r\n\r\n").encode() + payload


def _arc_files(version: int | None, date: str):
    """One row per archive: its whole content but for the last line end."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter(__name__)
        part, count, held = TaskContext.get().partitionId(), 0, bytearray()
        kind = version or 1 + part % 2
        name = ""
        for b in batches:
            for page_id, url, html in zip(*(b.column(c) for c in ("page_id", "url", "html"))):
                if not held:
                    name = f"pages-{part:06d}-{count:06d}.arc"
                    held += arc_head(kind, name, date)
                body = http_message(page_id.as_py(), html.as_buffer().to_pybytes() if html.is_valid else b"")
                where = quote(url.as_py() or "-", safe=SAFE)
                held += arc_line(kind, where, date, "text/html", body, "200", len(held), name) + body + b"\n"
                if len(held) >= ARCHIVE_BYTES:
                    yield pa.RecordBatch.from_pydict({"value": pa.array([bytes(held[:-1])], pa.binary())})
                    count, held = count + 1, bytearray()
        if held:
            yield pa.RecordBatch.from_pydict({"value": pa.array([bytes(held[:-1])], pa.binary())})
    return run


def _save(files: DataFrame, folder: str, line_end: str) -> None:
    """Each row as a file; the writer adds the last line end."""
    (files.select(F.col("value").cast("string").alias("value")).write.mode("overwrite")
     .option("lineSep", line_end).option("maxRecordsPerFile", 1).option("compression", "gzip")
     .option("zlib.compress.level", "BEST_SPEED").text(folder))


def write_arc(pages: DataFrame, folder: str, version: int | None = None, date: str = CAPTURED,
              key: str = "page_id", url: str = "url", html: str = "html") -> None:
    """Archive pages as ARC files of a version (None: odd partitions 2, even ones 1)."""
    if version not in (None, *FIELDS):
        raise ValueError(f"version must be one of {[*FIELDS]}, got {version!r}")
    ship(pages.sparkSession)
    rows = pages.select(F.col(key).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"),
                        F.col(html).cast("string").alias("html"))
    _save(rows.mapInArrow(_arc_files(version, date), "value binary"), folder, "\n")


def arc_records(data: bytes) -> Iterator[tuple[dict[str, str], int, bytes]]:
    """The records of an ARC file, its version block first: fields, offset, body."""
    at, names = 0, None
    while at < len(data):
        if data[at] in b"\r\n":
            at += 1
            continue
        end = data.find(b"\n", at)
        parts = data[at:end].decode("utf-8", "replace").rstrip("\r").split(" ") if end >= 0 else []
        if not parts or not parts[-1].isdigit():
            raise ValueError(f"ARC: no header line at byte {at}")
        begin, size = end + 1, int(parts[-1])
        body = data[begin:begin + size]
        if len(body) < size:
            raise ValueError(f"ARC: the record at byte {at} declares {size} bytes and has {len(body)}")
        if names is None:  # the version block tells the fields of all other lines
            told = body.decode("utf-8", "replace").splitlines()
            if not parts[0].startswith("filedesc:") or len(told) < 2 or told[0].split(" ")[0] not in ("1", "2"):
                raise ValueError("ARC: no version block of version 1 or 2")
            names = told[1].split(" ")
        if len(parts) != len(names):
            raise ValueError(f"ARC: {len(parts)} fields at byte {at}, the version has {len(names)}")
        fields = dict(zip(names, parts))
        sum_ = fields.get("Checksum", "-")
        if sum_ != "-" and hashlib.md5(body).hexdigest() != sum_:
            raise ValueError(f"ARC: wrong checksum of the record at byte {at}")
        yield fields, at, body
        at = begin + size


def http_parts(body: bytes) -> tuple[bytes, bytes] | None:
    """Head (with the blank line) and payload of an HTTP message; None if it isn't one."""
    if not body.startswith(b"HTTP/"):
        return None
    end = body.find(b"\r\n\r\n")
    return (body, b"") if end < 0 else (body[:end + 4], body[end + 4:])


def header(head: bytes, name: str) -> str | None:
    found = re.search(rb"(?im)^" + re.escape(name.encode()) + rb":[ \t]*(.*?)[ \t]*\r?$", head)
    return found[1].decode("utf-8", "replace") if found else None


def _key(head: bytes) -> int | None:
    told = header(head, KEY_HEADER)
    return int(told) if told is not None else None


def _unpack(content: pa.Scalar) -> bytes:
    return gzip.decompress(content.as_buffer())


def _archive_name(fields: dict[str, str]) -> str:
    return fields["URL"].removeprefix("filedesc://")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each HTTP record: digest, bytes, key and identifier."""
    enter(__name__)
    for b in batches:
        for content in b.column(0):
            rows, archive = [], ""
            for n, (fields, at, body) in enumerate(arc_records(_unpack(content))):
                parts = http_parts(body)
                if n == 0:
                    archive = _archive_name(fields)
                elif parts:
                    rows.append((base32_sha1(parts[1]), len(parts[1]), _key(parts[0]), record_id(archive, at)))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.int64(), pa.int64(), pa.string()))],
                    names=["digest", "bytes", "page_id", "record"])


# ---------------------------------------------------------------------------
# WARC

def record_id(archive: str, offset: int) -> str:
    return f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{archive}#{offset}')}"


def iso_date(digits: str) -> str:
    """An ARC date (fourteen digits, or the first of them) as a WARC date."""
    if not re.fullmatch(r"\d{4,14}", digits) or len(digits) % 2:
        raise ValueError(f"ARC: {digits!r} is no date")
    full = digits + "00000101000000"[len(digits):]
    return f"{full[:4]}-{full[4:6]}-{full[6:8]}T{full[8:10]}:{full[10:12]}:{full[12:14]}Z"


def warc_record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    lines = [f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", len(block))] if v is not None]
    return b"WARC/1.1\r\n" + "".join(lines).encode() + b"\r\n" + block + b"\r\n\r\n"


def convert(archive: str, offset: int, fields: dict[str, str], body: bytes,
            first: tuple[int | None, str] | None) -> bytes:
    """The WARC record of an ARC record; ``first`` is the key and identifier of the
    response that holds its payload, if another one does."""
    own, parts = record_id(archive, offset), http_parts(body)
    common = [("WARC-Record-ID", f"<{own}>"), ("WARC-Date", iso_date(fields["Archive-date"]))]
    if offset == 0 and fields["URL"].startswith("filedesc:"):
        block = f"software: graphcluster\r\nformat: WARC File Format 1.1\r\nisPartOf: {archive}\r\n".encode()
        return warc_record([("WARC-Type", "warcinfo"), *common, ("WARC-Filename", archive),
                            ("Content-Type", "application/warc-fields")], block)
    common += [("WARC-Target-URI", fields["URL"]), ("WARC-IP-Address", fields["IP-address"])]
    if parts is None:
        return warc_record([("WARC-Type", "resource"), *common, ("Content-Type", fields["Content-type"]),
                            ("WARC-Block-Digest", f"sha1:{base32_sha1(body)}"),
                            ("WARC-Payload-Digest", f"sha1:{base32_sha1(body)}")], body)
    head, payload = parts
    digest = ("WARC-Payload-Digest", f"sha1:{base32_sha1(payload)}")
    if first is None:
        return warc_record([("WARC-Type", "response"), *common,
                            ("Content-Type", "application/http; msgtype=response"),
                            ("WARC-Block-Digest", f"sha1:{base32_sha1(body)}"), digest], body)
    return warc_record([("WARC-Type", "revisit"), *common, ("WARC-Refers-To", f"<{first[1]}>"),
                        (f"{KEY_HEADER}-Referred", first[0]), ("WARC-Profile", PROFILE),
                        ("Content-Type", "application/http; msgtype=response"),
                        ("WARC-Block-Digest", f"sha1:{base32_sha1(head)}"), digest], head)


def _split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The records of each archive as rows; the version block is a row too."""
    enter(__name__)
    for b in batches:
        for content in b.column(0):
            rows, held, archive = [], 0, ""
            for n, (fields, at, body) in enumerate(arc_records(_unpack(content))):
                if n == 0:
                    archive = _archive_name(fields)
                parts = http_parts(body)
                rows.append((archive, at, list(fields.items()), body, base32_sha1(parts[1]) if parts else None))
                held += len(body)
                if held >= 1 << 20:
                    yield _record_rows(rows)
                    rows, held = [], 0
            if rows:
                yield _record_rows(rows)


RECORDS = "archive string, offset long, fields map<string,string>, body binary, digest string"


def _record_rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int64(), pa.map_(pa.string(), pa.string()), pa.binary(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)],
                                      names=["archive", "offset", "fields", "body", "digest"])


def _warc_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per WARC file, without its last line end."""
    enter(__name__)
    held = bytearray()
    for b in batches:
        for archive, at, fields, body, key, first in zip(*(b.column(c) for c in (
                "archive", "offset", "fields", "body", "first_key", "first"))):
            archive, at = archive.as_py(), at.as_py()
            known = (key.as_py(), first.as_py()) if first.is_valid else None
            if known and known[1] == record_id(archive, at):
                known = None  # the response itself
            held += convert(archive, at, dict(fields.as_py()), body.as_buffer().to_pybytes(), known)
            if len(held) >= ARCHIVE_BYTES:
                yield pa.RecordBatch.from_pydict({"value": pa.array([bytes(held[:-2])], pa.binary())})
                held = bytearray()
    if held:
        yield pa.RecordBatch.from_pydict({"value": pa.array([bytes(held[:-2])], pa.binary())})


def _files(spark: SparkSession, folder: str) -> DataFrame:
    """The contents of a folder's files, compressed as they are."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).select("content")


def arc_to_warc(spark: SparkSession, arc: str, warc: str, min_bytes: int = MIN_BYTES) -> None:
    """Convert the ARC files of a folder to WARC files in another one."""
    ship(spark)
    seen = _files(spark, arc).mapInArrow(_digests, "digest string, bytes long, page_id long, record string")
    first = F.min(F.struct(F.col("page_id").isNull().alias("none"), "page_id", "record"))
    again = Table(seen.where(F.col("bytes") >= min_bytes).groupBy("digest", "bytes")
                  .agg(first.alias("f"), F.count("*").alias("n")).where("n > 1")
                  .select("digest", F.col("f.page_id").alias("first_key"), F.col("f.record").alias("first")),
                  "payloads")
    records = _files(spark, arc).mapInArrow(_split, RECORDS)
    _save(records.join(again.df, "digest", "left").mapInArrow(_warc_files, "value binary"), warc, "\r\n")
    again.drop()


def warc_records(data: bytes) -> Iterator[tuple[bytes, bytes]]:
    """Header and block of each record of a WARC file, by the declared lengths."""
    at = 0
    while at < len(data):
        end = data.find(b"\r\n\r\n", at)
        if not data.startswith(b"WARC/1.", at) or end < 0:
            raise ValueError(f"WARC: no record at byte {at}")
        head = data[at:end + 2]
        size = header(head, "Content-Length")
        block = data[end + 4:end + 4 + int(size or -1)]
        at = end + 4 + len(block)
        if size is None or len(block) != int(size) or data[at:at + 4] != b"\r\n\r\n":
            raise ValueError("WARC: a record doesn't have the length it declares")
        at += 4
        yield head, block


READ = ("page_id long, url string, warc_date string, record_id string, record_type string, payload_bytes long, "
        "payload_digest string, refers_to long, payload binary")


def _read(payloads: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter(__name__)
        kinds = (pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(),
                 pa.binary())
        names = [c.strip().split()[0] for c in READ.split(",")]
        for b in batches:
            for content in b.column(0):
                rows = []
                for head, block in warc_records(_unpack(content)):
                    kind = header(head, "WARC-Type")
                    if kind == "warcinfo":
                        continue
                    told = (header(head, "WARC-Payload-Digest") or "").removeprefix("sha1:")
                    http, payload = http_parts(block) if kind != "resource" else (b"", block)
                    size = len(payload)
                    if kind == "revisit":
                        size = int(header(http, "Content-Length") or 0)
                    elif base32_sha1(payload) != told:
                        raise ValueError(f"WARC: wrong payload digest of {header(head, 'WARC-Record-ID')}")
                    if base32_sha1(block) != (header(head, "WARC-Block-Digest") or "").removeprefix("sha1:"):
                        raise ValueError(f"WARC: wrong block digest of {header(head, 'WARC-Record-ID')}")
                    refers = header(head, f"{KEY_HEADER}-Referred")
                    rows.append((_key(http), header(head, "WARC-Target-URI"), header(head, "WARC-Date"),
                                 (header(head, "WARC-Record-ID") or "").strip("<>"), kind, size, told,
                                 int(refers) if refers else None, payload if payloads and kind != "revisit" else None))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)
    return run


def read_warc(spark: SparkSession, folder: str, payloads: bool = False) -> DataFrame:
    """A row per record of a folder's WARC files but ``warcinfo``, digests verified:
    page_id, url, warc_date, record_id, record_type, payload_bytes (of the full
    payload, also for revisits), payload_digest, refers_to, payload (on request; null
    for revisits)."""
    ship(spark)
    return _files(spark, folder).mapInArrow(_read(payloads), READ)


def archive_pages(pages: DataFrame, min_bytes: int = MIN_BYTES, version: int | None = None) -> str:
    """Pages as ARC files, converted to WARC files: the folder of these."""
    spark = pages.sparkSession
    arc, warc = scratch_dir(spark, "arc"), scratch_dir(spark, "warc")
    write_arc(pages, arc, version)
    arc_to_warc(spark, arc, warc, min_bytes)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(arc)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    return warc
