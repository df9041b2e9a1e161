"""Web archives packaged in ZIP files: written once per task, read back by byte ranges.

An archive holds `archive/data.warc.gz`, in which every record is a gzip member of its own, and `indexes/index.cdxj`, sorted lines of a
page's address with its parts in reverse, a time and what says where its record lies. Both are stored members, so nothing needs to be extracted: the
reader parses the end record, the ZIP64 end record and the central directory, then reads a range of the index and single records by
their ranges. Ranges of an index, not archives, are dealt to the reading tasks.

A response holds an HTTP message whose body is the payload; a revisit holds its head alone, and names the record and the profile
by which the payload is the same. All records of one writing have one date.

Records of equal payloads of at least 100 bytes: the one with the smallest page_id is a response, the others revisit it. Shorter
payloads are all responses. A NULL html is an empty payload. Rows without a page_id are responses; they are never
the first of others unless all are without. Repeated rows with the smallest page_id are all responses.

Archives go to the shared folder under names of their own for each attempt of a task; the list of finished archives is written
before anything is read, so a repeated task leaves at most a file nobody reads.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import struct
import uuid
import zipfile
from collections.abc import Iterator
from datetime import UTC, datetime

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, functions as F

from .storage import new_folder, stored

SHORTEST = 100  # bytes of a payload that others may revisit
ARCHIVE_RECORDS = 50_000
RANGE_RECORDS = 2_000  # records that are read at once
MOST_TASKS = 20_000  # by which ranges are read
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"  # fixed value of the format
WARC, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"


def _urn(page_id) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def record(page_id, url, payload: bytes, digest: str, refers_to, date: str) -> bytes:
    """One WARC record. A revisit has the size and digest of its payload, not the payload."""
    revisit = refers_to is not None
    address = "".join(c for c in url or "" if c >= " ")
    message = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    head = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", _urn(page_id)),
        ("WARC-Date", date),
        ("WARC-Target-URI", address),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("X-Payload-Length", str(len(payload))),
    ]
    if revisit:
        head += [("WARC-Profile", SAME_PAYLOAD), ("WARC-Refers-To", _urn(refers_to)), ("WARC-Refers-To-Date", date)]
        payload = b""
    block = message + payload
    head.append(("Content-Length", str(len(block))))
    lines = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head) + "\r\n"
    return lines.encode() + block + b"\r\n\r\n"


def reversed_address(url: str | None) -> str:
    """An address with the parts of its host in reverse, by which neighbours of one host stand together in an index."""
    address = "".join(c for c in url or "" if c > " ")
    rest = address.split("://", 1)[-1]
    host, slash, path = rest.partition("/")
    name, _, port = host.rpartition("@")[2].lower().partition(":")
    return f"{','.join(reversed(name.split('.')))}{':' + port if port else ''}){slash or '/'}{path}"


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines)
    block = rest[: int(fields["Content-Length"])]
    if fields.get("Content-Type", "").startswith("application/http"):
        block = block.partition(b"\r\n\r\n")[2]
    return fields, block


class Ranges:
    """A file of any file system that pyarrow knows, read by ranges."""

    def __init__(self, uri: str):
        system, path = pafs.FileSystem.from_uri(uri)
        self.file = system.open_input_file(path)
        self.size = self.file.size()

    def read(self, start: int, length: int) -> bytes:
        self.file.seek(start)
        return self.file.read(length)


def central_directory(source) -> dict[str, tuple[int, int]]:
    """Name -> (first byte of its data, length) of the stored members. `source` has size and read(start, length)."""
    tail_at = max(0, source.size - 22 - 65_535)
    tail = source.read(tail_at, source.size - tail_at)
    end = tail.rfind(b"PK\x05\x06")
    if end < 0:
        raise ValueError("no end of central directory")
    entries, size, start = struct.unpack("<10xHII", tail[end : end + 20])
    if entries == 0xFFFF or size == 0xFFFFFFFF or start == 0xFFFFFFFF or tail[max(0, end - 20) : end][:4] == b"PK\x06\x07":
        locator = source.read(tail_at + end - 20, 20)
        if locator[:4] != b"PK\x06\x07":
            raise ValueError("no ZIP64 locator")
        record64 = source.read(struct.unpack("<8xQ4x", locator)[0], 56)
        if record64[:4] != b"PK\x06\x06":
            raise ValueError("no ZIP64 end record")
        entries, size, start = struct.unpack("<32xQQQ", record64)
    directory, at, found = source.read(start, size), 0, {}
    for _ in range(entries):
        if directory[at : at + 4] != b"PK\x01\x02":
            raise ValueError("broken central directory")
        method, packed, plain, name_n, extra_n, comment_n, header = struct.unpack(
            "<10xH8xIIHHH8xI", directory[at : at + 46]
        )
        name = directory[at + 46 : at + 46 + name_n].decode()
        extra = directory[at + 46 + name_n : at + 46 + name_n + extra_n]
        packed, plain, header = _zip64(extra, packed, plain, header)
        at += 46 + name_n + extra_n + comment_n
        if method == 0:
            local_name, local_extra = struct.unpack("<26xHH", source.read(header, 30))
            found[name] = (header + 30 + local_name + local_extra, plain)
    return found


def _zip64(extra: bytes, packed: int, plain: int, header: int) -> tuple[int, int, int]:
    """The 64-bit values that stand in the extra field where the 32-bit ones are full."""
    at = 0
    while at + 4 <= len(extra):
        tag, size = struct.unpack("<HH", extra[at : at + 4])
        if tag == 1:
            values = iter(struct.unpack(f"<{size // 8}Q", extra[at + 4 : at + 4 + size // 8 * 8]))
            plain = next(values) if plain == 0xFFFFFFFF else plain
            packed = next(values) if packed == 0xFFFFFFFF else packed
            header = next(values) if header == 0xFFFFFFFF else header
        at += 4 + size
    return packed, plain, header


class Archive:
    """An open ZIP package, its records addressed through its index."""

    def __init__(self, source):
        self.source = source
        members = central_directory(source)
        self.start, self.length = members[WARC]
        self.index_start, self.index_length = members[INDEX]

    def entries(self, start: int = 0, length: int | None = None) -> list[dict]:
        """What the lines of the index say in a range of its bytes, which must begin and end with a line."""
        length = self.index_length - start if length is None else length
        if start + length > self.index_length:
            raise ValueError("the range lies beyond the index")
        lines = self.source.read(self.index_start + start, length).decode().splitlines()
        return [json.loads(line.split(" ", 2)[2]) for line in lines]

    def record(self, entry: dict) -> tuple[dict[str, str], bytes]:
        offset, length = int(entry["offset"]), int(entry["length"])
        if offset + length > self.length:
            raise ValueError("the index points beyond the member")
        return parse_record(gzip.decompress(self.source.read(self.start + offset, length)))


def write_archive(stream, records: Iterator[tuple[str | None, str, str, bytes]], date: str) -> list[tuple[int, int]]:
    """Write records (address, digest, kind, bytes) to a stream as one package; the ranges of bytes of its index, RANGE_RECORDS lines each."""
    lines, at = [], 0
    moment = "".join(c for c in date if c.isdigit())[:14]
    with zipfile.ZipFile(stream, "w", zipfile.ZIP_STORED, allowZip64=True) as package:
        with package.open(WARC, "w", force_zip64=True) as member:
            for url, digest, kind, raw in records:
                packed = gzip.compress(raw, 6, mtime=0)
                member.write(packed)
                entry = {
                    "url": "".join(c for c in url or "" if c >= " "),
                    "mime": "warc/revisit" if kind == "revisit" else "text/html",
                    "status": "200",
                    "digest": f"sha256:{digest}",
                    "length": str(len(packed)),
                    "offset": str(at),
                    "filename": WARC.rpartition("/")[2],
                }
                lines.append(f"{reversed_address(url)} {moment} {json.dumps(entry)}\n".encode())
                at += len(packed)
        lines.sort()
        package.writestr(INDEX, b"".join(lines))
    ranges, start = [], 0
    for first in range(0, len(lines), RANGE_RECORDS):
        length = sum(map(len, lines[first : first + RANGE_RECORDS]))
        ranges.append((start, length))
        start += length
    return ranges


def with_origin(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, digest, refers_to (NULL for responses)."""
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    all_pages = pages.select("page_id", "url", payload.alias("payload")).withColumn("digest", F.sha2("payload", 256))
    long = all_pages.where(F.length("payload") >= SHORTEST).groupBy("digest")
    first = long.agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").select("digest", "first")
    joined = all_pages.join(first, "digest", "left")
    revisit = F.when(F.col("page_id") != F.col("first"), F.col("first"))
    return joined.select("page_id", "url", "payload", "digest", revisit.alias("refers_to"))


def write(pages: DataFrame, folder: str) -> DataFrame:
    """Write all pages as records into archives in the folder; returns the ranges of their indexes: path, start, length."""
    date = datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = pafs.FileSystem.from_uri(folder)

        def rows():
            for batch in batches:
                columns = [batch.column(c).to_pylist() for c in ("page_id", "url", "payload", "digest", "refers_to")]
                yield from zip(*columns)

        left = rows()
        while (head := next(left, None)) is not None:

            def some():
                now = head
                for n in range(ARCHIVE_RECORDS):
                    page_id, url, payload, digest, refers_to = now
                    kind = "response" if refers_to is None else "revisit"
                    yield url, digest, kind, record(page_id, url, payload, digest, refers_to, date)
                    if n + 1 == ARCHIVE_RECORDS or (now := next(left, None)) is None:
                        return

            name = f"{uuid.uuid4().hex}.wacz"
            system.create_dir(root, recursive=True)
            with system.open_output_stream(f"{root}/{name}") as stream:
                ranges = write_archive(stream, some(), date)
            starts, lengths = zip(*ranges)
            yield pa.RecordBatch.from_pydict(
                {"path": [f"{folder}/{name}"] * len(ranges), "start": pa.array(starts, pa.int64()), "length": pa.array(lengths, pa.int64())}
            )

    return stored(with_origin(pages).mapInArrow(run, "path string, start bigint, length bigint"))


def read(ranges: DataFrame) -> DataFrame:
    """One row per record: record_id, url, payload, payload_bytes, payload_digest, record_type, refers_to. Every range is a task's own."""
    names = ["record_id", "url", "payload", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    schema = "record_id string, url string, payload binary, payload_bytes bigint, payload_digest string, record_type string, refers_to string"

    def rows_of(path: str, start: int, length: int):
        archive = Archive(Ranges(path))
        for entry in archive.entries(start, length):
            fields, payload = archive.record(entry)
            digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
            if fields["WARC-Type"] == "response" and hashlib.sha256(payload).hexdigest() != digest:
                raise ValueError(f"{path}: the payload of {fields['WARC-Record-ID']} is damaged")
            size = int(fields["X-Payload-Length"])
            ids = [fields.get(k, "").removeprefix("<urn:page:").removesuffix(">") or None for k in ("WARC-Record-ID", "WARC-Refers-To")]
            yield ids[0], fields["WARC-Target-URI"], payload, size, digest, fields["WARC-Type"], ids[1]

    kinds = (pa.string(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string(), pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for place in zip(*(batch.column(c).to_pylist() for c in ("path", "start", "length"))):
                rows, size = [], 0
                for row in rows_of(*place):
                    rows.append(row)
                    size += len(row[2])
                    if size > 1 << 22:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    # Dealt in turn, since a hash would leave some tasks without a range; a number, since the adaptive planner would join few short rows.
    spread = ranges.select("path", "start", "length").repartition(max(1, min(ranges.count(), MOST_TASKS)))
    return spread.mapInArrow(run, schema)


def round_trip(pages: DataFrame) -> DataFrame:
    """Write the pages to new archives in the shared folder and read them back."""
    folder = new_folder(pages.sparkSession, "warc")
    kind = pages.schema["page_id"].dataType
    back = read(write(pages, folder))
    return back.select(
        F.col("record_id").cast(kind).alias("page_id"),
        "url",
        "payload",
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"),
    )
