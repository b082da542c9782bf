"""Web pages as WARC records inside ZIP packages, read back by ranges.

A package is a ZIP file whose members are stored, not compressed:

    archive/data.warc.gz   one gzip member per WARC record
    indexes/index.cdxj     one line per record: "<offset> <length>"

A reader needs the end of the file, the central directory and the index member; it
then fetches spans of records and never unpacks the package. ZIP64 directories are
followed wherever the 32-bit fields are full.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import struct
import uuid
import zipfile
import zlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adloom.llm.files import attempt_name, create, open_for_reading
from adloom.operators.joins import fits_broadcast
from adloom.storage import fresh_path, materialize

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
# Shorter payloads are always stored.
LEAST_SHARED = 1000
# Bytes of records fetched at once.
SPAN = 4 << 20

_END = struct.Struct("<4s4H2LH")
_END64_LOCATOR = struct.Struct("<4sLQL")
_END64 = struct.Struct("<4sQ2H2L4Q")
_ENTRY = struct.Struct("<4s6H3L5H2L")
_LOCAL = struct.Struct("<4s5H3L2H")
_FULL16, _FULL32 = 0xFFFF, 0xFFFFFFFF


@dataclass
class Member:
    name: str
    method: int
    size: int
    packed: int
    header: int


class Package:
    """The members of a ZIP file, by range reads of ``read(offset, size)``."""

    def __init__(self, read: Callable[[int, int], bytes], size: int) -> None:
        self.read = read
        self.members = {m.name: m for m in self._directory(size)}

    def _directory(self, size: int) -> Iterator[Member]:
        tail_size = min(size, _END.size + _FULL16)
        tail = self.read(size - tail_size, tail_size)
        at = tail.rfind(b"PK\x05\x06")
        # The comment may hold the signature itself: its length has to fit.
        while at >= 0 and at + _END.size + struct.unpack_from("<H", tail, at + 20)[0] != len(tail):
            at = tail.rfind(b"PK\x05\x06", 0, at)
        if at < 0:
            raise ValueError("no ZIP end record")
        _, _, _, _, entries, length, offset, _ = _END.unpack_from(tail, at)
        if entries == _FULL16 or length == _FULL32 or offset == _FULL32:
            locator = self.read(size - tail_size + at - _END64_LOCATOR.size, _END64_LOCATOR.size)
            signature, _, end64, _ = _END64_LOCATOR.unpack(locator)
            if signature != b"PK\x06\x07":
                raise ValueError("no ZIP64 locator")
            record = _END64.unpack(self.read(end64, _END64.size))
            if record[0] != b"PK\x06\x06":
                raise ValueError("no ZIP64 end record")
            entries, length, offset = record[7:10]
        data, at = self.read(offset, length), 0
        for _ in range(entries):
            field = _ENTRY.unpack_from(data, at)
            if field[0] != b"PK\x01\x02":
                raise ValueError("broken ZIP directory")
            method, packed, full = field[4], field[8], field[9]
            name_size, extra_size, comment_size, header = field[10], field[11], field[12], field[16]
            name = data[at + _ENTRY.size : at + _ENTRY.size + name_size]
            extra = data[at + _ENTRY.size + name_size : at + _ENTRY.size + name_size + extra_size]
            full, packed, header = _wide(extra, full, packed, header)
            yield Member(name.decode("utf-8"), method, full, packed, header)
            at += _ENTRY.size + name_size + extra_size + comment_size

    def start(self, name: str) -> int:
        """Where the bytes of a stored member begin."""
        member = self.members[name]
        if member.method != zipfile.ZIP_STORED:
            raise ValueError(f"{name} is compressed")
        fields = _LOCAL.unpack(self.read(member.header, _LOCAL.size))
        if fields[0] != b"PK\x03\x04":
            raise ValueError(f"no local header for {name}")
        return member.header + _LOCAL.size + fields[9] + fields[10]

    def range(self, name: str, offset: int, size: int) -> bytes:
        return self.read(self.start(name) + offset, size)


def _wide(extra: bytes, full: int, packed: int, header: int) -> tuple[int, int, int]:
    """Full fields continue in the ZIP64 extra field, in this order."""
    at, wide = 0, b""
    while at + 4 <= len(extra):
        kind, size = struct.unpack_from("<HH", extra, at)
        if kind == 1:
            wide = extra[at + 4 : at + 4 + size]
        at += 4 + size
    values = iter(struct.unpack(f"<{len(wide) // 8}Q", wide[: len(wide) // 8 * 8]))
    return tuple(next(values) if v == _FULL32 else v for v in (full, packed, header))


def open_package(path: str) -> Package:
    source = open_for_reading(path)

    def read(offset: int, size: int) -> bytes:
        source.seek(offset)
        return source.read(size)

    return Package(read, source.size())


def _record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>"


def _uri(url: str | None, page_id: int | None) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m.group()):02X}", url) if url else f"urn:page:{page_id}"


def record(page_id: int | None, url: str | None, payload: bytes, digest: bytes, refers_to: int | None) -> bytes:
    """One WARC/1.1 record. A revisit holds the HTTP head only and names the response."""
    revisit = refers_to is not None
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    block = head if revisit else head + payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", _record_id(page_id)),
        ("WARC-Target-URI", _uri(url, page_id)),
        ("WARC-Date", "1970-01-01T00:00:00Z"),
        ("WARC-Payload-Digest", f"sha1:{base64.b32encode(digest).decode()}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
        ("X-Payload-Length", str(len(payload))),
    ]
    if page_id is not None:
        fields.append(("X-Page-ID", str(page_id)))
    if revisit:
        fields += [
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("WARC-Refers-To", _record_id(refers_to)),
            ("X-Refers-To-Page-ID", str(refers_to)),
        ]
    text = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return text.encode() + block + b"\r\n\r\n"


# Compressed bytes handed to the decompressor at a time.
FED = 16 << 10


@dataclass
class Record:
    fields: dict[str, str]
    payload: bytes

    @property
    def page_id(self) -> int | None:
        return int(self.fields["x-page-id"]) if "x-page-id" in self.fields else None


def parse_records(data: bytes) -> Iterator[Record]:
    """The records of consecutive gzip members, fed a piece at a time, so that what is
    behind a record is not copied with it."""
    at = 0
    while at < len(data):
        member, parts = zlib.decompressobj(31), []
        while not member.eof:
            if at >= len(data):
                raise ValueError("a record is cut off")
            piece = data[at : at + FED]
            parts.append(member.decompress(piece))
            at += len(piece) - len(member.unused_data)
        text = b"".join(parts)
        head, _, rest = text.partition(b"\r\n\r\n")
        lines = head.decode("utf-8").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError("no WARC record")
        fields = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines[1:])}
        block = rest[: int(fields["content-length"])]
        yield Record(fields, block.partition(b"\r\n\r\n")[2])


MANIFEST = "path string, records long"


def write_packages(pages: DataFrame, folder: str) -> DataFrame:
    """One package per partition of ``pages`` (page_id, url, html); returns the manifest
    (path, records).

    Of rows with equal payloads of LEAST_SHARED bytes or more, those with the largest
    page_id are responses and the rest revisits of it; a null page_id is the smallest,
    and a group without any id is all responses. A null html is an empty payload, a
    null url the page's own URN. Digests are grouped as narrow rows, combined before
    the shuffle; the html itself is not moved.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).cast("binary").alias("html"))
    digest = F.unhex(F.sha1("html"))
    shared = (
        rows.where(F.octet_length("html") >= LEAST_SHARED)
        .groupBy(digest.alias("_digest"))
        .agg(F.max("page_id").alias("_top"), F.count(F.lit(1)).alias("_n"))
        .where("_n > 1")
        .select("_digest", "_top")
    )
    shared = materialize(shared, "shared-payloads")
    if fits_broadcast(shared):
        shared = F.broadcast(shared)
    own = rows.withColumn("digest", digest)
    revisit = (F.octet_length("html") >= LEAST_SHARED) & ~F.col("page_id").eqNullSafe(F.col("_top"))
    rows = own.join(shared, F.col("digest") == F.col("_digest"), "left").select(
        "page_id", "url", "html", "digest", F.when(revisit, F.col("_top")).alias("refers_to")
    )

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        path, sink, package, member, index, offset = "", None, None, None, [], 0
        for batch in batches:
            if package is None:
                path = attempt_name(folder, TaskContext.get().partitionId(), ".wacz")
                sink = create(path)
                package = zipfile.ZipFile(_Forward(sink), "w", zipfile.ZIP_STORED)
                # Sizes are not known yet: ZIP64 fields from the start.
                member = package.open(zipfile.ZipInfo(DATA), "w", force_zip64=True)
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                data = gzip.compress(record(*row), 6, mtime=0)
                member.write(data)
                index.append(f"{offset} {len(data)}\n")
                offset += len(data)
        if package is not None:
            member.close()
            package.writestr(zipfile.ZipInfo(INDEX), "".join(index))
            package.close()
            sink.close()
            yield pa.RecordBatch.from_pydict({"path": [path], "records": [len(index)]})

    return materialize(rows.mapInArrow(write, MANIFEST), "packages")


class _Forward:
    """A file that can only be written forward, as object stores have it."""

    def __init__(self, sink) -> None:
        self.sink, self.at = sink, 0

    def write(self, data: bytes) -> int:
        self.sink.write(data)
        self.at += len(data)
        return len(data)

    def flush(self) -> None:
        pass

    def seekable(self) -> bool:
        return False


def spans(manifest: DataFrame, span: int = SPAN) -> DataFrame:
    """(path, offset, size) of runs of whole records, from the packages' indexes."""

    def locate(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                package = open_package(path)
                lines = package.range(INDEX, 0, package.members[INDEX].size).splitlines()
                base, rows = package.start(DATA), []
                for offset, size in (map(int, line.split()) for line in lines):
                    if rows and rows[-1][1] + size <= span:
                        rows[-1][1] += size
                    else:
                        rows.append([base + offset, size])
                yield pa.RecordBatch.from_pydict(
                    {"path": [path] * len(rows), "offset": [r[0] for r in rows], "size": [r[1] for r in rows]},
                    pa.schema([("path", pa.string()), ("offset", pa.int64()), ("size", pa.int64())]),
                )

    files = manifest.select("path").repartition(max(1, manifest.count()), "path")
    return files.mapInArrow(locate, "path string, offset long, size long")


READ = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def read_packages(manifest: DataFrame) -> DataFrame:
    """A row per record. A response's length and digest are those of the payload read,
    which must agree with its header; a revisit's are the header's."""

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, offset, size in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                source = open_for_reading(path)
                source.seek(offset)
                rows = [_summary(r) for r in parse_records(source.read(size))]
                source.close()
                columns = list(zip(*rows, strict=True)) or [()] * 5
                kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                    names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"],
                )

    found = materialize(spans(manifest), "spans")
    cores = found.sparkSession.sparkContext.defaultParallelism
    return found.repartition(max(cores, found.count() // 16), "path", "offset").mapInArrow(read, READ)


def _summary(found: Record) -> tuple[int | None, int, str, str, int | None]:
    fields = found.fields
    digest = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex()
    if fields["warc-type"] == "response" and hashlib.sha1(found.payload).hexdigest() != digest:
        raise ValueError("a payload does not match its digest")
    refers_to = fields.get("x-refers-to-page-id")
    return found.page_id, int(fields["x-payload-length"]), digest, fields["warc-type"], int(refers_to) if refers_to else None


def archived(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Write the packages of ``pages`` to the shared folder and read them back."""
    return read_packages(write_packages(pages, fresh_path(spark, "warc")))


ORACLE = f"""
SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes, sha1(body) AS payload_digest,
       CASE WHEN strlen(body) < {LEAST_SHARED} OR page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN strlen(body) >= {LEAST_SHARED} AND page_id <> top THEN top END AS refers_to
FROM (SELECT *, max(page_id) OVER (PARTITION BY body) AS top FROM (SELECT page_id, coalesce(html, '') AS body FROM pages))"""
