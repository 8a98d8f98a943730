"""WARC records in ZIP-packaged archives: written by tasks, read back by ranges.

An archive is a ZIP file of two stored members: archive/data.warc.gz, one gzip member for each record, and
indexes/index.jsonl, each record's offset and length in it. The reader parses the end record, the ZIP64 locator and end
record and the central directory, finds the members' data from their local headers and reads the index and then records
by ranges of the file; nothing is extracted and no archive is read as a whole.

Archives are files of a shared folder (any that pyarrow.fs opens by its URI). A task gives each archive a name of its own,
and only the archives in the written manifest are read, so what a failed or repeated attempt leaves behind is ignored.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textflow.llm._shared import cut, new_path, qualified, with_group

DATA, INDEX = "archive/data.warc.gz", "indexes/index.jsonl"
#: Compressed bytes after which a task begins a new archive; also what a writing task holds.
ARCHIVE_BYTES = 16 << 20
#: Bytes that a reading task holds at a time, unless one record is larger.
READ_BYTES = 4 << 20


# -- ZIP


def zip_bytes(members: list[tuple[str, bytes]], zip64: bool = False, comment: bytes = b"") -> bytes:
    """A ZIP file of stored members. zip64: with 64-bit fields and end records even where 32 bits would do."""
    out, directory, at = [], [], 0
    for name, data in members:
        raw, crc = name.encode(), zlib.crc32(data)
        wide = zip64 or max(len(data), at) >= 0xFFFFFFFF
        extra = struct.pack("<HHQQQ", 1, 24, len(data), len(data), at) if wide else b""
        short = 0xFFFFFFFF if wide else len(data)
        local = struct.pack("<4sHHHHHIIIHH", b"PK\3\4", 45 if wide else 20, 0x800, 0, 0, 0x21, crc, short, short, len(raw), 20 if wide else 0)
        local += raw + (struct.pack("<HHQQ", 1, 16, len(data), len(data)) if wide else b"")
        directory.append(struct.pack("<4sHHHHHHIIIHHHHHII", b"PK\1\2", 45, 45 if wide else 20, 0x800, 0, 0, 0x21, crc, short, short, len(raw), len(extra), 0, 0, 0, 0, 0xFFFFFFFF if wide else at) + raw + extra)
        out += [local, data]
        at += len(local) + len(data)
    central = b"".join(directory)
    wide = zip64 or at >= 0xFFFFFFFF or len(members) >= 0xFFFF
    end = b""
    if wide:
        end = struct.pack("<4sQHHIIQQQQ", b"PK\6\6", 44, 45, 45, 0, 0, len(members), len(members), len(central), at)
        end += struct.pack("<4sIQI", b"PK\6\7", 0, at + len(central), 1)
    n = 0xFFFF if wide else len(members)
    end += struct.pack("<4sHHHHIIH", b"PK\5\6", 0, 0, n, n, 0xFFFFFFFF if wide else len(central), 0xFFFFFFFF if wide else at, len(comment)) + comment
    return b"".join([*out, central, end])


@dataclass(frozen=True)
class Member:
    name: str
    method: int
    size: int
    header: int


Read = Callable[[int, int], bytes]


def zip_members(read: Read, size: int) -> dict[str, Member]:
    """The central directory of a file of `size` bytes; read(offset, n) gives n bytes. ValueError if it isn't a ZIP file."""
    tail_at = max(0, size - 22 - 0xFFFF)
    tail = read(tail_at, size - tail_at)
    i = tail.rfind(b"PK\5\6")
    while i >= 0 and (len(tail) - i < 22 or i + 22 + struct.unpack_from("<H", tail, i + 20)[0] != len(tail)):
        i = tail.rfind(b"PK\5\6", 0, i)
    if i < 0:
        raise ValueError("no end of central directory")
    n, length, start = struct.unpack_from("<HII", tail, i + 10)
    if 0xFFFF == n or 0xFFFFFFFF in (length, start):
        where = tail_at + i - 20
        locator = read(where, 20) if where >= 0 else b""
        if locator[:4] != b"PK\6\7":
            raise ValueError("no ZIP64 locator")
        end = read(struct.unpack_from("<Q", locator, 8)[0], 56)
        if end[:4] != b"PK\6\6":
            raise ValueError("no ZIP64 end of central directory")
        n, length, start = struct.unpack_from("<QQQ", end, 32)
    directory, at, out = read(start, length), 0, {}
    for _ in range(n):
        if directory[at : at + 4] != b"PK\1\2":
            raise ValueError("broken central directory")
        method, packed, full = *struct.unpack_from("<H", directory, at + 10), *struct.unpack_from("<II", directory, at + 20)
        n_name, n_extra, n_comment = struct.unpack_from("<HHH", directory, at + 28)
        header = struct.unpack_from("<I", directory, at + 42)[0]
        name = directory[at + 46 : at + 46 + n_name].decode()
        extra, k = directory[at + 46 + n_name : at + 46 + n_name + n_extra], 0
        while k + 4 <= len(extra):
            kind, m = struct.unpack_from("<HH", extra, k)
            if kind == 1:  # 64-bit values, only of those fields that are full
                values = list(struct.unpack_from(f"<{m // 8}Q", extra, k + 4))
                full = values.pop(0) if full == 0xFFFFFFFF else full
                packed = values.pop(0) if packed == 0xFFFFFFFF else packed
                header = values.pop(0) if header == 0xFFFFFFFF else header
            k += 4 + m
        out[name] = Member(name, method, packed, header)
        at += 46 + n_name + n_extra + n_comment
    return out


def data_start(read: Read, member: Member) -> int:
    """Where a stored member's bytes begin."""
    if member.method != 0:
        raise ValueError(f"{member.name} is not stored")
    local = read(member.header, 30)
    if local[:4] != b"PK\3\4":
        raise ValueError("no local header")
    return member.header + 30 + sum(struct.unpack_from("<HH", local, 26))


# -- WARC


def base32(digest_hex: str) -> str:
    return base64.b32encode(bytes.fromhex(digest_hex)).decode()


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool, date: str = "1970-01-01T00:00:00Z") -> bytes:
    """A gzip member: a response with its payload, or a revisit of another page's response."""
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = head if revisit else head + payload
    uri = "".join(c if " " < c else f"%{ord(c):02X}" for c in url or "about:blank")
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{page_id}>", f"WARC-Date: {date}", f"WARC-Target-URI: {uri}", f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Bytes: {len(payload)}"]
    if revisit:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + z.flush()


def parsed(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Fields (names in lower case) and payload of a record's gzip member."""
    data = zlib.decompress(raw, 31)
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
    block = rest[: int(fields["content-length"])]
    return fields, block.partition(b"\r\n\r\n")[2]


def read_archive(read: Read, size: int) -> Iterator[tuple[dict[str, str], bytes]]:
    """All records of an archive, by ranges."""
    members = zip_members(read, size)
    start = data_start(read, members[DATA])
    entries = [json.loads(x) for x in read(data_start(read, members[INDEX]), members[INDEX].size).splitlines()]
    i = 0
    while i < len(entries):
        j = i + 1
        while j < len(entries) and entries[j]["offset"] == entries[j - 1]["offset"] + entries[j - 1]["length"] and entries[j]["offset"] + entries[j]["length"] - entries[i]["offset"] <= READ_BYTES:
            j += 1
        first = entries[i]["offset"]
        data = read(start + first, entries[j - 1]["offset"] + entries[j - 1]["length"] - first)
        for e in entries[i:j]:
            yield parsed(data[e["offset"] - first : e["offset"] - first + e["length"]])
        i = j


# -- DataFrames


def with_references(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """pages (page_id, url, html, ...) -> page_id, url, html (null: empty), digest (hex), first, revisit: of rows with equal
    payloads of least_bytes bytes or more, those with the smallest page_id are responses and the others revisit it.

    A large group's rows don't meet in one task, see with_group()."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumn("digest", F.sha1("html"))
    groups = rows.where(F.octet_length("html") >= least_bytes).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1")
    found = with_group(rows, cut(groups.withColumn("grouped", F.lit(True)), "groups"), ["digest"], F.col("page_id"), ["first", "grouped"])
    return found.select("page_id", "url", "html", "digest", "first", (F.coalesce("grouped", F.lit(False)) & ~F.col("page_id").eqNullSafe(F.col("first"))).alias("revisit"))


def write(pages: DataFrame, folder: str, least_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES, zip64: bool = False) -> DataFrame:
    """A record for each row of pages in archives of `folder` (a folder that all executors share, as Spark resolves it) -> manifest
    (path, bytes, records), written once."""
    folder = qualified(pages.sparkSession, folder)

    def run(batches):
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        data, index, size = [], [], 0

        def flush():
            name = f"{root}/{uuid.uuid4().hex}.zip"
            body = zip_bytes([(DATA, b"".join(data)), (INDEX, "\n".join(index).encode())], zip64)
            with store.open_output_stream(name) as out:
                out.write(body)
            return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([len(body)]), pa.array([len(data)])], ["path", "bytes", "records"])

        for batch in batches:
            for page_id, url, html, digest, first, revisit in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
                one = record(page_id, url, html.encode(), base32(digest), first, revisit)
                index.append(json.dumps({"offset": size, "length": len(one), "page_id": page_id}))
                data.append(one)
                size += len(one)
                if size >= archive_bytes:
                    yield flush()
                    data, index, size = [], [], 0
        if data:
            yield flush()

    return cut(with_references(pages, least_bytes).mapInArrow(run, "path string, bytes long, records long"), "manifest")


def read(manifest: DataFrame, folder: str) -> DataFrame:
    """All records of the manifest's archives -> page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload
    (null for revisits). A response whose payload doesn't have its digest is an error."""

    folder = qualified(manifest.sparkSession, folder)

    def number(uri: str | None) -> int | None:
        text = (uri or "").removeprefix("<urn:page:").removesuffix(">")
        return int(text) if text.lstrip("-").isdigit() else None

    def run(batches):
        store = fs.FileSystem.from_uri(folder)[0]
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary())
        names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
        for batch in batches:
            for path, size in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                out = []
                with store.open_input_file(path) as file:
                    for fields, payload in read_archive(lambda at, n, f=file: f.read_at(n, at), size):
                        kind, digest = fields["warc-type"], fields["warc-payload-digest"].removeprefix("sha1:")
                        if kind == "response" and base32(hashlib.sha1(payload).hexdigest()) != digest:
                            raise ValueError(f"{path}: payload of {fields['warc-record-id']} doesn't match its digest")
                        revisit = kind == "revisit"
                        out.append((number(fields["warc-record-id"]), fields["warc-target-uri"], int(fields["x-payload-bytes"]), digest, kind, number(fields.get("warc-refers-to")) if revisit else None, None if revisit else payload))
                        if len(out) >= 500:
                            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out, strict=True), kinds, strict=True)], names)
                            out = []
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out, strict=True), kinds, strict=True)], names)

    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
    return manifest.select("path", "bytes").repartition("path").mapInArrow(run, schema)


def round_trip(pages: DataFrame, least_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES, zip64: bool = False) -> DataFrame:
    """pages (page_id, url, html, ...) -> what read() finds after write() into the shared folder; a row for each row.

    A null html is an empty payload, a null url about:blank. Rows with the smallest page_id of their group, more than one
    if it repeats, are responses. A row without page_id revisits its group's smallest, or is a response if there is none."""
    folder = new_path(pages.sparkSession, "archives")
    return read(write(pages, folder, least_bytes, archive_bytes, zip64), folder)
