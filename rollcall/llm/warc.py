"""WARC archives: whole-file gzip made seekable, equal payloads stored once.

Crawl archives often come as one gzip stream over the whole file, which nobody can enter
in the middle. The normaliser inflates such a file once from its start, holding one record
at a time, writes every record as a gzip member of its own and a sidecar with each
member's offset; a reader then seeks to any record and inflates only that.

``write_archives`` puts pages into whole-file archives and lists their records;
``list_records`` lists those of archives from elsewhere. ``find_revisits`` decides on the
list alone which records only repeat a payload; ``normalise`` rewrites the archives with
these decisions, each along its records in their order; ``read_records`` reads the result
back through the sidecars.

Of records whose payloads are equal and have ``LEAST`` bytes or more, that with the largest
page_id stays a response (of several rows with that id, one) and the others become revisits,
which keep the HTTP header and name the response, but have no payload.

Files are named anew by every attempt at a task, and only rows of attempts that Spark
committed name them, so a lost executor leaves files nobody reads, and never half a file
in use. Nothing is grouped by archive but the records of one archive, which
``ARCHIVE_BYTES`` bounds; payloads never pass through a shuffle.

Nulls and odd input: a missing html is an empty payload; a missing url gives a record
without a target; a missing page_id gives a record without one, which is the response only
of records that all have none, so refers_to is null there; rows that repeat an id are
records of their own; an empty table writes no archive. Payloads of any length make one
record. Columns other than page_id, url and html are not read.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator
from typing import NamedTuple
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import ship
from rollcall.llm.token_files import place
from rollcall.session import broadcast_if_small, materialize, scratch_path

LEAST = 1000
ARCHIVE_BYTES = 64 << 20  # of records, before compression
PIECE = 1 << 20
DATE = "1970-01-01T00:00:00Z"  # pages have no date, and the format wants one
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
URL_SAFE = "!#$%&'()*+,/:;=?@[]~"

LISTED = "archive bigint, ordinal bigint, path string, page_id bigint, bytes bigint, sha1 string, sha256 string"
READ = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, url string"


class Record(NamedTuple):
    version: str
    fields: list[tuple[str, str]]
    block: bytes

    def get(self, name: str) -> str | None:
        return next((v for k, v in self.fields if k.lower() == name.lower()), None)

    def number(self, name: str) -> int | None:
        found = self.get(name)
        return None if found is None else int(found)

    def parts(self) -> tuple[bytes, bytes]:
        """HTTP header with its empty line, and payload; a block without one is all payload."""
        if not (self.get("Content-Type") or "").startswith("application/http"):
            return b"", self.block
        end = self.block.find(b"\r\n\r\n")
        return (self.block, b"") if end < 0 else (self.block[: end + 4], self.block[end + 4 :])

    def raw(self) -> bytes:
        fields = [(k, v) for k, v in self.fields if k.lower() != "content-length"]
        fields.append(("Content-Length", str(len(self.block))))
        head = "\r\n".join([self.version, *(f"{k}: {v}" for k, v in fields)])
        return head.encode() + b"\r\n\r\n" + self.block + b"\r\n\r\n"


def record_id(archive: int, ordinal: int) -> str:
    return f"<{uuid.uuid5(uuid.NAMESPACE_URL, f'rollcall:{archive}:{ordinal}').urn}>"


def base32(sha1: str) -> str:
    return "sha1:" + base64.b32encode(bytes.fromhex(sha1)).decode()


def bare_hex(field: str) -> str:
    return base64.b32decode(field.split(":", 1)[1]).hex()


def page_record(page_id: int | None, url: str | None, payload: bytes, sha1: str, name: str) -> Record:
    fields = [("WARC-Type", "response"), ("WARC-Record-ID", name), ("WARC-Date", DATE)]
    if url is not None:
        fields.append(("WARC-Target-URI", quote(url, safe=URL_SAFE)))
    if page_id is not None:
        fields.append(("X-Page-Id", str(page_id)))
    fields += [("WARC-Payload-Digest", base32(sha1)), ("Content-Type", "application/http;msgtype=response")]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    return Record("WARC/1.1", fields, http.encode() + payload)


def as_revisit(record: Record, refers_to: int | None, refers_id: str) -> Record:
    """The record without its payload, naming the response that has it."""
    changed = [("WARC-Type", "revisit") if k.lower() == "warc-type" else (k, v) for k, v in record.fields]
    changed += [("WARC-Profile", PROFILE), ("WARC-Refers-To", refers_id)]
    if refers_to is not None:
        changed.append(("X-Refers-To-Page", str(refers_to)))
    head, payload = record.parts()
    # a header that does not state the length would leave it unknown without the payload
    changed.append(("X-Payload-Length", str(len(payload))))
    return Record(record.version, changed, head)


class Inflated:
    """Bytes of a plain or gzip file from its start to its end, one piece in memory at a time."""

    def __init__(self, stream):
        self.stream, self.left, self.zip = stream, bytearray(), None
        self.raw = bytes(stream.read(max(2, PIECE)))
        if self.raw[:2] == b"\x1f\x8b":
            self.zip = zlib.decompressobj(31)

    def _next(self) -> bytes:
        return bytes(self.stream.read(PIECE))

    def _more(self) -> bool:
        """Inflate up to one piece more; false at the end of the file."""
        while True:
            self.raw = self.raw or self._next()
            if not self.raw and (self.zip is None or self.zip.eof):
                return False
            if self.zip is None:
                got, self.raw = self.raw, b""
            else:
                if self.zip.eof:  # archives of several members are read alike
                    self.zip = zlib.decompressobj(31)
                got = self.zip.decompress(self.raw, PIECE)  # without input, what it has not given out yet
                if not self.raw and not got:
                    raise EOFError("the archive ends inside a gzip stream")
                self.raw = self.zip.unused_data if self.zip.eof else self.zip.unconsumed_tail
            if got:
                self.left += got
                return True

    def read(self, size: int) -> bytes:
        while len(self.left) < size:
            if not self._more():
                raise EOFError("the archive ends inside a record")
        got = bytes(self.left[:size])
        del self.left[:size]
        return got

    def until(self, mark: bytes) -> bytes | None:
        """Bytes up to and with the mark; None if only line ends are left."""
        start = 0
        while (at := self.left.find(mark, start)) < 0:
            start = max(0, len(self.left) - len(mark) + 1)
            if not self._more():
                if self.left.strip():
                    raise EOFError("the archive ends inside a header")
                return None
        return self.read(at + len(mark))

    def records(self) -> Iterator[Record]:
        while (head := self.until(b"\r\n\r\n")) is not None:
            lines = head.strip(b"\r\n").decode("utf-8", "replace").split("\r\n")
            fields = [(k.strip(), v.strip()) for k, _, v in (line.partition(":") for line in lines[1:])]
            size = int(next(v for k, v in fields if k.lower() == "content-length"))
            block = self.read(size)
            self.read(4)
            yield Record(lines[0], fields, block)


class MonolithicWriter:
    """One gzip stream over all records of a file."""

    def __init__(self, uri: str):
        files, path = place(uri)
        self.out, self.zip, self.size = files.open_output_stream(path, compression=None), zlib.compressobj(1, wbits=31), 0

    def add(self, raw: bytes) -> None:
        self.out.write(self.zip.compress(raw))
        self.size += len(raw)

    def close(self) -> None:
        self.out.write(self.zip.flush())
        self.out.close()


class MemberWriter:
    """A gzip member for each record, and the sidecar: a line of JSON for each, in order."""

    def __init__(self, uri: str):
        files, path = place(uri)
        self.out = files.open_output_stream(path, compression=None)
        self.side = files.open_output_stream(f"{path}.idx", compression=None)
        self.offset = self.count = 0

    def add(self, record: Record) -> None:
        zipper = zlib.compressobj(6, wbits=31)
        member = zipper.compress(record.raw()) + zipper.flush()
        line = {
            "offset": self.offset, "length": len(member), "type": record.get("WARC-Type"),
            "id": record.get("WARC-Record-ID"), "page_id": record.number("X-Page-Id"),
        }
        self.out.write(member)
        self.side.write(json.dumps(line).encode() + b"\n")
        self.offset += len(member)
        self.count += 1

    def close(self) -> None:
        self.out.close()
        self.side.close()


def _prepare(df: DataFrame, folder: str) -> None:
    ship(df.sparkSession)
    files, path = place(folder)
    files.create_dir(path, recursive=True)


def write_archives(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Pages as whole-file gzip archives; one row for each record (``LISTED``), as a written table."""
    _prepare(pages, folder)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, attempt, writer, made = TaskContext.get().partitionId(), uuid.uuid4().hex[:12], None, 0
        for batch in batches:
            rows = []
            for page_id, url, html in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if writer is None:
                    archive, ordinal = (part << 20) + made, 0
                    path = f"{folder}/{part:06d}-{made:04d}-{attempt}.warc.gz"
                    writer, made = MonolithicWriter(path), made + 1
                sha1, sha256 = hashlib.sha1(html).hexdigest(), hashlib.sha256(html).hexdigest()
                writer.add(page_record(page_id, url, html, sha1, record_id(archive, ordinal)).raw())
                rows.append((archive, ordinal, path, page_id, len(html), sha1, sha256))
                ordinal += 1
                if writer.size >= archive_bytes:
                    writer.close()
                    writer = None
            if rows:
                yield _batch(rows, LISTED)
        if writer is not None:
            writer.close()

    rows = pages.select(
        F.col("page_id").cast("bigint"), F.col("url").cast("string"),
        F.coalesce(F.col("html"), F.lit("")).cast("binary"),
    )
    return materialize(rows.mapInArrow(write, LISTED), "warc-written")


def list_records(archives: DataFrame) -> DataFrame:
    """The records (``LISTED``) of archives given as ``archive`` (a number of its own) and ``path``."""
    ship(archives.sparkSession)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive, path in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                rows = []
                for ordinal, record in enumerate(_open(path).records()):
                    payload = record.parts()[1]
                    rows.append((
                        archive, ordinal, path, record.number("X-Page-Id"), len(payload),
                        hashlib.sha1(payload).hexdigest(), hashlib.sha256(payload).hexdigest(),
                    ))
                    if len(rows) == 1000:
                        yield _batch(rows, LISTED)
                        rows = []
                if rows:
                    yield _batch(rows, LISTED)

    found = archives.select(F.col("archive").cast("bigint"), "path").mapInArrow(scan, LISTED)
    return materialize(found, "warc-listed")


def find_revisits(listed: DataFrame, least: int = LEAST) -> DataFrame:
    """The listed records with ``refers_page``, ``refers_archive`` and ``refers_ordinal`` of the
    response that has their payload; null where a record has its own.

    One row for each repeated payload comes out of an aggregate with map-side combine;
    payload bytes are compared by SHA-256. A page without an id ranks below all others.
    """
    place_of = F.struct("page_id", "archive", "ordinal")
    repeated = (
        listed.filter(F.col("bytes") >= least)
        .groupBy("sha256").agg(F.max(place_of).alias("_first"), F.count("*").alias("_n"))
        .filter(F.col("_n") > 1)
        .select(F.col("sha256").alias("_sha256"), "_first")
    )
    other = (F.col("archive") != F.col("_first.archive")) | (F.col("ordinal") != F.col("_first.ordinal"))
    joined = listed.join(broadcast_if_small(repeated, "warc-repeated"), F.col("sha256") == F.col("_sha256"), "left")
    return joined.select(
        *listed.columns,
        *[
            F.when(other, F.col(f"_first.{field}")).alias(f"refers_{name}")
            for field, name in (("page_id", "page"), ("archive", "archive"), ("ordinal", "ordinal"))
        ],
    )


def normalise(decided: DataFrame, folder: str) -> DataFrame:
    """The archives rewritten, a gzip member for each record; one row for each: path, records.

    A task gets the decisions of whole archives in the order of their records and
    inflates each archive once along them, so it holds one record at a time. The
    sidecar stands beside the archive, under its name with ``.idx``.
    """
    _prepare(decided, folder)

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        attempt, at, writer, done = uuid.uuid4().hex[:12], None, None, []
        for batch in batches:
            for path, page, archive, ordinal in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if path != at:
                    if writer is not None:
                        writer.close()
                        done.append((target, writer.count))
                    at, records = path, _open(path).records()
                    target = f"{folder}/{path.rsplit('/', 1)[-1].split('.')[0]}-{attempt}.warc.gz"
                    writer = MemberWriter(target)
                record = next(records)
                if archive is not None:
                    record = as_revisit(record, page, record_id(archive, ordinal))
                writer.add(record)
            if done:
                yield _batch(done, "path string, records bigint")
                done = []
        if writer is not None:
            writer.close()
            yield _batch([(target, writer.count)], "path string, records bigint")

    archives = max(1, decided.select("archive").distinct().count())
    ordered = (
        decided.select("archive", "ordinal", "path", "refers_page", "refers_archive", "refers_ordinal")
        .repartitionByRange(archives, "archive").sortWithinPartitions("archive", "ordinal")
        .select("path", "refers_page", "refers_archive", "refers_ordinal")
    )
    return materialize(ordered.mapInArrow(rewrite, "path string, records bigint"), "warc-normalised")


def read_records(files: DataFrame) -> DataFrame:
    """Every record of normalised archives (``READ``), each found by its offset in the sidecar.

    A payload that does not have the digest its record states is an error.
    """
    ship(files.sparkSession)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows = []
                for record in members(path):
                    rows.append(_read_row(record, path))
                    if len(rows) == 1000:
                        yield _batch(rows, READ)
                        rows = []
                if rows:
                    yield _batch(rows, READ)

    count = max(1, files.count())
    return files.select("path").repartitionByRange(count, "path").mapInArrow(read, READ)


def members(uri: str, numbers: list[int] | None = None) -> Iterator[Record]:
    """Records of a normalised archive, all or those of the given numbers, by their offsets."""
    files, path = place(uri)
    with files.open_input_file(path) as data, files.open_input_stream(f"{path}.idx", compression=None) as side:
        lines = side.read().splitlines()
        for i in range(len(lines)) if numbers is None else numbers:
            line = json.loads(lines[i])
            data.seek(line["offset"])
            member = data.read(line["length"])
            yield next(Inflated(pa.BufferReader(member)).records())


def _open(uri: str) -> Inflated:
    files, path = place(uri)
    return Inflated(files.open_input_stream(path, compression=None))


def _read_row(record: Record, path: str) -> tuple:
    kind, stated = record.get("WARC-Type"), record.get("WARC-Payload-Digest")
    payload = record.parts()[1]
    size, digest = len(payload), hashlib.sha1(payload).hexdigest()
    if kind == "revisit":
        size, digest = record.number("X-Payload-Length"), bare_hex(stated)
    elif stated and bare_hex(stated) != digest:
        raise ValueError(f"{record.get('WARC-Record-ID')} in {path} does not have its digest")
    return record.number("X-Page-Id"), size, digest, kind, record.number("X-Refers-To-Page"), record.get("WARC-Target-URI")


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    columns = [c.split() for c in schema.split(", ")]
    kinds = {"bigint": pa.int64(), "string": pa.string()}
    arrays = [pa.array(c, kinds[kind]) for c, (_, kind) in zip(zip(*rows, strict=True), columns, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=[name for name, _ in columns])


def store_pages(pages: DataFrame) -> DataFrame:
    """Pages written, deduplicated, normalised and read back, in the shared folder."""
    folder = scratch_path(pages.sparkSession, "warc")
    listed = write_archives(pages, f"{folder}/crawled")
    return read_records(normalise(find_revisits(listed), f"{folder}/normalised"))
