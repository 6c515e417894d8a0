"""WARC archives of pages: a writer with revisit records and a reader that salvages damaged archives.

Archives are rows of gzip members, one record each, in the folder all executors share.  A task writes files named after
its own attempt and reports them; the reports of the attempts that count are stored as a table, so a lost executor or a
second attempt leaves at most files that nobody reads.

The reader checks every record: member, version line, lengths, digests.  When a check fails it searches for the next
place where a whole valid record starts (a gzip member or a version line of an uncompressed record), goes on from
there, and reports the bytes in between as a quarantined gap.
"""

from __future__ import annotations

import hashlib
import io
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import BinaryIO
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stakefold.llm import common

MAGIC, VERSION = b"\x1f\x8b\x08", b"WARC/1."
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
DATE = "2024-01-01T00:00:00Z"
FIELD = re.compile(rb"[ \t]|[^\s:]+[ \t]*:")  # of a header line: folded on, or a name
HEADER_BLOCK = 1 << 12
BLOCK = 1 << 20
ARCHIVE_BYTES = 64 << 20
LEAST_REVISIT = 100
MANIFEST = "archive string, records long, bytes long"
SCHEMA = ("archive string, start long, stop long, kind string, page_id long, url string, payload_bytes long, "
          "payload_digest string, record_type string, refers_to long")


@dataclass
class Record:
    fields: dict[str, str]
    payload: bytes = b""

    @property
    def page_id(self) -> int | None:
        return page_of(self.fields.get("warc-record-id", ""))


def page_of(urn: str) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?[0-9]+)>", urn)
    return int(found[1]) if found else None


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record.  A revisit keeps the digest and length of its payload but not the payload."""
    block = HTTP % len(payload) + (payload if refers_to is None else b"")
    name = "-" if page_id is None else page_id
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{name}>",
             f"WARC-Date: {DATE}", "Content-Type: application/http; msgtype=response",
             f"WARC-Payload-Digest: sha256:{digest}", f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
             f"Content-Length: {len(block)}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {quote(url, safe=''.join(map(chr, range(33, 127))))}")
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <urn:page:{refers_to}>",
                  "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(record: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(record) + packer.flush()


class Bad(ValueError):
    """A record that fails a check."""


def checked(head: bytes, block: bytes) -> Record:
    """The record of a header and its block, if version, lengths and digests agree."""
    lines = re.sub(rb"\r\n[ \t]+", b" ", head).split(b"\r\n")  # folded lines are one
    if not re.fullmatch(rb"WARC/1\.[01]", lines[0]):
        raise Bad("version line")
    if re.search(rb"WARC/1\.[01](\r\n|$)", head[len(lines[0]):]):
        raise Bad("another record starts in the header")
    fields: dict[str, str] = {}
    for line in lines[1:]:
        name, sign, value = line.decode("utf-8", "replace").partition(":")
        if not sign:
            raise Bad("header line")
        fields[name.strip().lower()] = value.strip()
    if fields.get("content-length") != str(len(block)):
        raise Bad("length")
    if fields.get("warc-block-digest", "") not in ("", f"sha256:{hashlib.sha256(block).hexdigest()}"):
        raise Bad("block digest")
    record = Record(fields)
    if fields.get("content-type", "").startswith("application/http"):
        http, sign, record.payload = block.partition(b"\r\n\r\n")
        if not sign:
            raise Bad("response head")
        length = re.search(rb"(?im)^Content-Length: *([0-9]+)", http)
        fields["payload-length"] = length[1].decode() if length else str(len(record.payload))
    else:
        record.payload = block
    if fields.get("warc-type") != "revisit":
        own = f"sha256:{hashlib.sha256(record.payload).hexdigest()}"
        if fields.get("warc-payload-digest", own) != own:
            raise Bad("payload digest")
        fields["warc-payload-digest"], fields["payload-length"] = own, str(len(record.payload))
    return record


def read_member(file: BinaryIO, at: int) -> tuple[bytes, int]:
    """What the gzip member at a place holds, and where the member ends."""
    file.seek(at)
    unpacker, parts, read = zlib.decompressobj(31), [], 0
    while not unpacker.eof:
        data = file.read(BLOCK)
        if not data:
            raise Bad("member ends early")
        read += len(data)
        try:
            parts.append(unpacker.decompress(data))
        except zlib.error as error:
            raise Bad("member") from error
    return b"".join(parts), at + read - len(unpacker.unused_data)


def header_at(file: BinaryIO, at: int) -> bytes:
    """The version line and the fields that start at a place, up to the blank line, however long they are.  A whole line
    that is no field ends the search, so a stray version line does not lead to the end of the file."""
    file.seek(at)
    head, checked_to = b"", 0
    while True:
        data = file.read(HEADER_BLOCK)
        stop = (head := head + data).find(b"\r\n\r\n", max(0, len(head) - len(data) - 3))
        whole = stop if stop >= 0 else head.rfind(b"\r\n")
        lines = head[checked_to:max(whole, checked_to)].split(b"\r\n")
        if not all(FIELD.match(line) for line in (lines if checked_to else lines[1:]) if line):
            raise Bad("header")
        if stop >= 0:
            return head[:stop]
        if not data:
            raise Bad("header ends early")
        checked_to = whole + 2 if whole >= 0 else 0


def read_plain(file: BinaryIO, at: int, size: int) -> tuple[Record, int]:
    """The uncompressed record at a place, and where it ends."""
    head = header_at(file, at)
    length = re.search(rb"(?im)^Content-Length: *([0-9]{1,18})\r?$", head)
    if length is None:
        raise Bad("length")
    start, n = at + len(head) + 4, int(length[1])
    if start + n + 4 > size:
        raise Bad("record ends early")
    file.seek(start)
    block = file.read(n)
    if file.read(4) != b"\r\n\r\n":
        raise Bad("record end")
    return checked(head, block), start + n + 4


def next_start(file: BinaryIO, at: int, size: int) -> int:
    """The next place from at on where a member or a version line may start."""
    tail = b""
    while at < size:
        file.seek(at)
        data = tail + file.read(BLOCK)
        base = at - len(tail)
        found = [i for i in (data.find(MAGIC), data.find(VERSION)) if i >= 0]
        if found:
            return base + min(found)
        at = base + len(data)
        tail = data[-(len(VERSION) - 1):]
    return size


def salvage(file: BinaryIO, size: int, members: bool = True) -> Iterator[tuple[int, int, Record | None]]:
    """(start, stop, record) of all that can be read, and (start, stop, None) for every gap.

    A member may hold several records: the first has the member's place, the others stand at its end.  If something in
    it is damaged, the member is a gap and the records that can be read in it stand at its end."""
    at, bad_from = 0, -1
    while at < size:
        file.seek(at)
        first = file.read(len(VERSION))
        try:
            if members and first.startswith(MAGIC):
                whole, stop = read_member(file, at)
                inside = [r for *_, r in salvage(io.BytesIO(whole), len(whole), members=False)]
                if not any(inside):
                    raise Bad("no record in the member")
                records = [*([None] if None in inside else []), *filter(None, inside)]
            elif first == VERSION:
                record, stop = read_plain(file, at, size)
                records = [record]
            else:
                raise Bad("no record starts here")
        except Bad:
            bad_from = at if bad_from < 0 else bad_from
            at = next_start(file, at + 1, size)
            continue
        if bad_from >= 0:
            yield bad_from, at, None
            bad_from = -1
        for record in records:
            yield at, stop, record
            at = stop
    if bad_from >= 0:
        yield bad_from, size, None


def filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", uri))


@dataclass
class Archive:
    """A file under way, in the shared folder."""

    uri: str
    records: int = 0
    bytes: int = 0
    out: pa.NativeFile = field(init=False)

    def __post_init__(self) -> None:
        system, path = filesystem(self.uri)
        system.create_dir(path.rpartition("/")[0], recursive=True)
        self.out = system.open_output_stream(path, compression=None)  # the members are compressed already

    def add(self, data: bytes) -> None:
        self.out.write(data)
        self.records, self.bytes = self.records + 1, self.bytes + len(data)

    def close(self) -> tuple[str, int, int]:
        self.out.close()
        return self.uri, self.records, self.bytes


def with_revisits(pages: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """(page_id, url, html, digest, refers_to): of equal payloads of at least so many bytes the smallest page_id is the
    response.  Only ids and digests meet by digest; the pages themselves are dealt by their own id."""
    known = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                         F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    known = known.withColumn("digest", F.sha2(F.col("html").cast("binary"), 256))
    ids = known.where(F.octet_length("html") >= least).select("page_id", F.unhex("digest").alias("key"))
    firsts = ids.groupBy("key").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1")
    later = ids.join(firsts, "key").where("page_id > first").select(
        "page_id", F.lower(F.hex("key")).alias("digest"), F.col("first").alias("refers_to")).distinct()
    return known.join(later, ["page_id", "digest"], "left")


def write_archives(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write all pages as records and return the stored manifest (archive, records, bytes).  Null html is an empty
    payload, null urls have no target line; a null page_id is always a response; repeated rows are repeated records."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, archive, done, number = TaskContext.get(), None, [], 0
        for batch in batches:
            for page_id, digest, url, html, refers_to in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if archive is None:
                    archive = Archive(f"{folder}/part-{task.partitionId():05d}-{task.taskAttemptId()}-{number:04d}.warc.gz")
                    number += 1
                archive.add(member(record_bytes(page_id, url, html.encode(), digest, refers_to)))
                if archive.bytes >= archive_bytes:
                    done.append(archive.close())
                    archive = None
        if archive is not None:
            done.append(archive.close())
        if done:
            names, records, size = zip(*done, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(records, pa.int64()), pa.array(size, pa.int64())],
                                             ["archive", "records", "bytes"])

    rows = with_revisits(pages).select("page_id", "digest", "url", "html", "refers_to")
    return common.stored(rows.mapInArrow(run, MANIFEST), "warc-manifest")


def read_archives(archives: DataFrame) -> DataFrame:
    """Records (kind `record`) and quarantined byte gaps (kind `gap`) of the archives named in column archive."""

    def rows(archive: str) -> Iterator[tuple]:
        system, path = filesystem(archive)
        with system.open_input_file(path) as file:
            for start, stop, record in salvage(file, file.size()):
                if record is None:
                    yield archive, start, stop, "gap", None, None, None, None, None, None
                else:
                    f = record.fields
                    yield (archive, start, stop, "record", record.page_id, f.get("warc-target-uri"), int(f.get("payload-length", 0)),
                           f.get("warc-payload-digest", "").rpartition(":")[2], f.get("warc-type"), page_of(f.get("warc-refers-to", "")))

    names = [f.split()[0] for f in SCHEMA.split(", ")]
    kinds = [pa.string() if f.endswith("string") else pa.int64() for f in SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for batch in batches:
            for archive in batch.column(0).to_pylist():
                for row in rows(archive):
                    out.append(row)
                    if len(out) >= 5_000:
                        yield batch_of(out)
                        out = []
        if out:
            yield batch_of(out)

    def batch_of(out: list[tuple]) -> pa.RecordBatch:
        columns = zip(*out, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return archives.select("archive").mapInArrow(run, SCHEMA)
