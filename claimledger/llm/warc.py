"""WARC archives with a Zstandard dictionary: a writer and a reader, each a Spark job.

An archive is a ``.warc.zst`` file. It begins with a skippable frame that holds the dictionary; after it every record is a
Zstandard frame of its own, so a reader can start at any record. The dictionary is trained on a bounded sample of the
records that are archived and is the same in every file of a load. It only affects sizes.

A page is a ``response`` record with its payload, or a ``revisit`` record without one if an equal payload
of at least ``LEAST_REVISIT`` bytes belongs to a page with a smaller id. Which page that is comes from digests, grouped before
they are shuffled; payloads that occur once, and short ones, look up a key of their own.

Each task of the writer writes files of at most about ``ARCHIVE_BYTES`` of records, a record at a time, under
a hidden name that is changed when the file is whole. Names are unique to the attempt, and the stored list of files has only those
of attempts that succeeded, so a lost executor, a retry or a speculative copy leaves no record out and none twice. Readers
take that list. Files are written and read through ``pyarrow.fs``, whose stores are those of the folder's address.
"""

import hashlib
import io
import re
import struct
import uuid
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimledger.llm.common import shared_folder, stored

# The format's names.
VERSION = "WARC/1.1"
RESPONSE, REVISIT = "response", "revisit"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DICTIONARY_MAGIC = 0x184D2A5D

LEAST_REVISIT = 100
ARCHIVE_BYTES = 512 * 1024 * 1024
LEVEL = 3
DICTIONARY_BYTES = 64 * 1024
# The dictionary is trained on about so many pages, those of at most so many bytes.
SAMPLE_PAGES = 1_000
SAMPLE_BYTES = 20_000
READ_BYTES = 1 << 20
# The pages have no time of capture; a fixed one keeps archives of equal pages equal.
DATE = "1970-01-01T00:00:00Z"

FILES = "file string, records bigint, bytes bigint"
RECORDS = (
    "page_id bigint, url string, payload binary, payload_bytes bigint, payload_digest string, record_type string,"
    " refers_to bigint"
)


class ArchiveError(ValueError):
    """An archive that is not as the writer leaves it."""


# Which record refers to which


def with_first(pages: DataFrame) -> DataFrame:
    """(page_id, url, payload, digest, first): ``first`` is the smallest id with an equal payload, NULL if not looked for."""
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"),
    ).withColumn("digest", F.sha2("payload", 256))
    long = F.octet_length("payload") >= LEAST_REVISIT
    first = (
        rows.where(long)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("pages"))
        .where("pages > 1")
        .select(F.col("digest").alias("key"), "first")
    )
    # Short payloads, however many are alike, are spread by page.
    key = F.when(long, F.col("digest")).otherwise(F.concat_ws(" ", F.lit("short"), F.col("page_id"), F.col("url")))
    return rows.withColumn("key", key).join(first, "key", "left").drop("key")


# Records as text


def _field(text: str) -> str:
    """A value that fits a header line: control characters and % are written as %XX."""
    return re.sub(r"[\x00-\x1f\x7f%]", lambda m: f"%{ord(m[0]):02X}", text)


def _unfield(text: str) -> str:
    return re.sub(r"%([0-9A-F]{2})", lambda m: chr(int(m[1], 16)), text)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC record. With ``refers_to`` it is a revisit, whose block ends after the HTTP header."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    name = uuid.uuid5(uuid.NAMESPACE_URL, f"{page_id} {url} {digest}")
    lines = [
        VERSION,
        f"WARC-Type: {RESPONSE if refers_to is None else REVISIT}",
        f"WARC-Record-ID: <urn:uuid:{name}>",
        f"WARC-Date: {DATE}",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha256:{digest}",
    ]
    if page_id is not None:
        lines.append(f"Page-ID: {page_id}")
    if url is not None:
        lines.append(f"WARC-Target-URI: {_field(url)}")
    if refers_to is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"Refers-To-Page-ID: {refers_to}"]
    lines += [f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode("utf-8", "surrogatepass") + block + b"\r\n\r\n"


def _header(stream: BinaryIO) -> dict[str, str]:
    """The lines up to an empty one, by name in lower case; the first line under an empty name."""
    fields: dict[str, str] = {}
    while line := stream.readline():
        line = line.rstrip(b"\r\n")
        if not line:
            return fields
        name, _, value = line.decode("utf-8", "surrogatepass").partition(": ")
        fields[name.lower() if fields else ""] = value if fields else name
    if fields:
        raise ArchiveError("a header has no end")
    return fields


def parse(data: BinaryIO) -> Iterator[tuple]:
    """The records of a stream as (page_id, url, payload, payload_bytes, payload_digest, record_type, refers_to)."""
    while fields := _header(data):
        size = int(fields["content-length"])
        block = data.read(size)
        if fields[""] != VERSION or len(block) != size or data.read(4) != b"\r\n\r\n":
            raise ArchiveError("a record is cut short or of another version")
        inner = io.BytesIO(block)
        http = _header(inner)
        kind, digest = fields["warc-type"], fields["warc-payload-digest"].removeprefix("sha256:")
        payload = inner.read() if kind == RESPONSE else None
        length = int(http["content-length"])
        if payload is not None and (len(payload) != length or hashlib.sha256(payload).hexdigest() != digest):
            raise ArchiveError(f"page {fields.get('page-id')} does not match its digest")
        url = fields.get("warc-target-uri")
        number, other = fields.get("page-id"), fields.get("refers-to-page-id")
        yield (
            None if number is None else int(number),
            None if url is None else _unfield(url),
            payload,
            length,
            digest,
            kind,
            None if other is None else int(other),
        )


# Files


def train_dictionary(records: list[bytes]) -> bytes:
    """A dictionary from sample records; empty if there are too few to learn from."""
    total = sum(map(len, records))
    try:
        return zstandard.train_dictionary(min(DICTIONARY_BYTES, max(256, total // 8)), records).as_bytes()
    except zstandard.ZstdError:
        return b""


def dictionary_frame(dictionary: bytes) -> bytes:
    """The skippable frame that an archive begins with; nothing without a dictionary."""
    return struct.pack("<II", DICTIONARY_MAGIC, len(dictionary)) + dictionary if dictionary else b""


def open_records(stream: BinaryIO) -> BinaryIO:
    """The records of an archive as one stream, read bit by bit. Its dictionary comes from its leading frame."""
    head = stream.read(8)
    dictionary = None
    if len(head) == 8 and struct.unpack("<II", head)[0] == DICTIONARY_MAGIC:
        dictionary, head = zstandard.ZstdCompressionDict(stream.read(struct.unpack("<II", head)[1])), b""
    source = _Joined(head, stream)
    reader = zstandard.ZstdDecompressor(dict_data=dictionary).stream_reader(source, read_across_frames=True)
    return io.BufferedReader(reader, READ_BYTES)


class _Joined(io.RawIOBase):
    """Some bytes, and then a stream."""

    def __init__(self, first: bytes, rest: BinaryIO):
        self.first, self.rest = first, rest

    def readable(self) -> bool:
        return True

    def read(self, size: int = -1) -> bytes:
        if self.first:
            out, self.first = self.first, b""
            return out
        return self.rest.read(size)


def _store(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system of an address, and the path there. An address without a scheme, or with ``file:``, is local."""
    if "://" in folder and not folder.startswith("file:"):
        return fs.FileSystem.from_uri(folder)
    return fs.LocalFileSystem(), re.sub("^file:/+", "/", folder)


class Archive:
    """An archive being written."""

    def __init__(self, folder: str, dictionary: bytes):
        self.store, root = _store(folder)
        name = f"{uuid.uuid4().hex}.warc.zst"
        self.hidden, self.path = f"{root}/.{name}", f"{root}/{name}"
        self.name = f"{folder}/{name}"
        self.out = self.store.open_output_stream(self.hidden, compression=None)
        self.out.write(dictionary_frame(dictionary))
        known = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        self.compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=known, write_checksum=True)
        self.records = self.size = 0

    def add(self, data: bytes) -> None:
        self.out.write(self.compressor.compress(data))
        self.records += 1
        self.size += len(data)

    def close(self) -> tuple[str, int, int]:
        size = self.out.tell()
        self.out.close()
        self.store.move(self.hidden, self.path)
        return self.name, self.records, size


def _files(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (("file", pa.string()), ("records", pa.int64()), ("bytes", pa.int64()))
    return pa.RecordBatch.from_arrays(
        [pa.array([r[at] for r in rows], kind) for at, (_, kind) in enumerate(kinds)], [n for n, _ in kinds]
    )


def sample_records(pages: DataFrame) -> list[bytes]:
    """Records of about ``SAMPLE_PAGES`` pages, drawn by hash, for the dictionary. Bounded in number and bytes."""
    buckets = 1 << 40
    limit = buckets * SAMPLE_PAGES // max(pages.count(), 1)
    drawn = (F.pmod(F.xxhash64("page_id", "url"), F.lit(buckets)) < limit) & (F.octet_length("html") <= SAMPLE_BYTES)
    rows = pages.where(drawn).select("page_id", "url", "html").limit(2 * SAMPLE_PAGES).collect()
    texts = sorted(((r.page_id, r.url, r.html.encode()) for r in rows), key=repr)
    return [record(page_id, url, t, hashlib.sha256(t).hexdigest(), None) for page_id, url, t in texts]


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write a record for every row of ``pages`` (page_id, url, html) below ``folder``: the list of files, stored.

    A NULL html is an empty payload, and a NULL url has no target. Pages with the smallest id of their payload are
    responses, repeated rows of one page too, and so are rows without an id unless a page with one has the same payload.
    Other columns are ignored. An empty table gives no file.
    """
    spark = pages.sparkSession
    dictionary = train_dictionary(sample_records(pages))
    store, root = _store(folder)
    store.create_dir(root, recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive, done = None, []
        for batch in batches:
            columns = (batch.column(c) for c in ("page_id", "url", "payload", "digest", "first"))
            for row in zip(*columns, strict=True):
                page_id, url, payload, digest, first = (value.as_py() for value in row)
                if archive is None:
                    archive = Archive(folder, dictionary)
                archive.add(record(page_id, url, payload, digest, first if first is not None and first != page_id else None))
                if archive.size >= ARCHIVE_BYTES:
                    done.append(archive.close())
                    archive = None
        if archive is not None:
            done.append(archive.close())
        yield _files(done)

    return stored(with_first(pages).mapInArrow(run, FILES))


def read_archives(files: DataFrame) -> DataFrame:
    """The records of listed archives, ``RECORDS``; a revisit has no payload. A file at a time, a record at a time.

    Payloads are checked against their digests and lengths; a damaged archive raises ``ArchiveError``.
    """
    count = max(1, files.count())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string(), pa.int64())
        names = [part.split()[0] for part in RECORDS.split(",")]

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[at] for r in rows], k) for at, k in enumerate(kinds)], names)

        for batch in batches:
            for file in batch.column("file").to_pylist():
                store, path = _store(file)
                rows, size = [], 0
                with store.open_input_stream(path, compression=None) as stream:
                    for row in parse(open_records(stream)):
                        rows.append(row)
                        size += len(row[2] or b"")
                        if size >= READ_BYTES or len(rows) == 1000:
                            yield batch_of(rows)
                            rows, size = [], 0
                yield batch_of(rows)

    return files.select("file").repartition(count, "file").mapInArrow(run, RECORDS)


def archive_folder(pages: DataFrame) -> str:
    """A new folder for archives in the folder that all executors share."""
    return shared_folder(pages.sparkSession)
