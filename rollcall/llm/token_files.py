"""Token ids in fixed-width binary files.

Every id takes the fewest bits the vocabulary needs. Documents stand in ascending
id order over numbered files; a file holds a range of ids.

A file, all numbers little-endian:

    magic "RCTK", version u32, width u32 (bits of an id), block u32 (ids in a full block)
    documents u64, ids u64
    doc_id i64 for each document      (null: the smallest i64)
    end u64 for each document         (ids of the file up to its end)
    offset u64 for each block, and one for the end of the data (bytes from the data's start)
    data: each block bit-packed on its own, lowest bit first, padded to whole bytes

The offsets let a reader unpack any block, or any document, without the others.

Nulls and odd input: a missing text is empty, so its document has only the end id; a
missing document id stands first; repeated ids stand beside each other in text order;
an empty table writes no file. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rollcall.llm.common import ship
from rollcall.llm.tokens import encoder
from rollcall.session import materialize, scratch_path

MAGIC, VERSION, BLOCK = b"RCTK", 1, 1 << 16
HEAD = struct.Struct("<4sIIIQQ")
NO_ID = -(1 << 63)


def width_of(vocabulary: int) -> int:
    return max(1, int(vocabulary - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> bytes:
    """Ids to bits, lowest first."""
    if width in (8, 16, 32):
        return ids.astype(f"<u{width // 8}").tobytes()
    bits = (ids.astype(np.uint32)[:, None] >> np.arange(width, dtype=np.uint32)) & 1
    return np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack(data: bytes, width: int, count: int) -> np.ndarray:
    if width in (8, 16, 32):
        return np.frombuffer(data, dtype=f"<u{width // 8}", count=count).astype("<u4")
    bits = np.unpackbits(np.frombuffer(data, np.uint8), count=count * width, bitorder="little")
    return (bits.reshape(count, width).astype("<u4") << np.arange(width, dtype="<u4")).sum(axis=1, dtype="<u4")


def place(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI, or of a plain local path."""
    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri if "://" in uri else uri.replace("file:", "file://", 1))


class FileWriter:
    """Packs ids block by block into a side file; ``finish`` puts the head before it."""

    def __init__(self, uri: str, width: int):
        self.fs, self.path = place(uri)
        self.fs.create_dir(self.path.rsplit("/", 1)[0], recursive=True)
        # a second attempt at the same task must not write into the first one's file
        self.side = f"{self.path}.data-{TaskContext.get().taskAttemptId() if TaskContext.get() else 0}"
        self.width, self.out = width, self.fs.open_output_stream(self.side)
        self.doc_ids: list[int] = []
        self.ends: list[int] = []
        self.offsets, self.left, self.total = [0], b"", 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.total += len(ids) // 4
        self.doc_ids.append(NO_ID if doc_id is None else doc_id)
        self.ends.append(self.total)
        self.left += ids
        while len(self.left) >= 4 * BLOCK:
            self._block(self.left[: 4 * BLOCK])
            self.left = self.left[4 * BLOCK :]

    def _block(self, ids: bytes) -> None:
        packed = pack(np.frombuffer(ids, "<u4"), self.width)
        self.out.write(packed)
        self.offsets.append(self.offsets[-1] + len(packed))

    def finish(self) -> tuple[int, int]:
        if self.left:
            self._block(self.left)
        self.out.close()
        whole = f"{self.side}.whole"
        with self.fs.open_output_stream(whole) as out, self.fs.open_input_stream(self.side) as data:
            out.write(HEAD.pack(MAGIC, VERSION, self.width, BLOCK, len(self.doc_ids), self.total))
            out.write(np.array(self.doc_ids, "<i8").tobytes())
            out.write(np.array(self.ends, "<u8").tobytes())
            out.write(np.array(self.offsets, "<u8").tobytes())
            while piece := data.read(1 << 20):
                out.write(piece)
        if self.fs.get_file_info(self.path).type != fs.FileType.NotFound:
            self.fs.delete_file(self.path)  # of an earlier attempt, with the same bytes
        self.fs.move(whole, self.path)
        self.fs.delete_file(self.side)
        return len(self.doc_ids), self.total


class FileReader:
    """Random access to the ids of one file."""

    def __init__(self, uri: str):
        files, path = place(uri)
        self.file = files.open_input_file(path)
        magic, version, self.width, self.block, documents, self.total = HEAD.unpack(self.file.read(HEAD.size))
        if magic != MAGIC or version != VERSION:
            raise ValueError(f"{uri} is no token file")
        blocks = -(-self.total // self.block)
        self.doc_ids = np.frombuffer(self.file.read(8 * documents), "<i8")
        self.ends = np.frombuffer(self.file.read(8 * documents), "<u8").astype(np.int64)
        self.offsets = np.frombuffer(self.file.read(8 * (blocks + 1)), "<u8").astype(np.int64)
        self.data = HEAD.size + 16 * documents + 8 * (blocks + 1)

    def block_ids(self, number: int) -> np.ndarray:
        start, end = int(self.offsets[number]), int(self.offsets[number + 1])
        self.file.seek(self.data + start)
        count = min(self.block, self.total - number * self.block)
        return unpack(self.file.read(end - start), self.width, count)

    def ids(self, start: int, end: int) -> np.ndarray:
        """Ids ``start`` to ``end`` of the file, from the blocks that hold them."""
        if end <= start:
            return np.empty(0, "<u4")
        first, last = start // self.block, (end - 1) // self.block
        found = np.concatenate([self.block_ids(i) for i in range(first, last + 1)])
        return found[start - first * self.block : end - first * self.block]

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """doc_id, start in the file and ids of every document; each block is unpacked once."""
        start, at, held = 0, -1, np.empty(0, "<u4")
        for doc_id, end in zip(self.doc_ids.tolist(), self.ends.tolist(), strict=True):
            parts, pos = [], start
            while pos < end:
                if pos // self.block != at:
                    at = pos // self.block
                    held = self.block_ids(at)
                low = pos - at * self.block
                piece = held[low : low + end - pos]
                parts.append(piece)
                pos += len(piece)
            yield None if doc_id == NO_ID else doc_id, start, np.concatenate(parts) if parts else held[:0]
            start = end


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 1) -> DataFrame:
    """Encode, append ``end_id`` and write; returns file, path, documents, ids, start.

    Documents are range-partitioned by id, so every task writes one file. A task
    that runs again replaces its file with the same bytes. ``start`` is the number
    of ids in all files before.
    """
    spark = docs.sparkSession
    ship(spark)
    end = np.array([end_id], "<u4").tobytes()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, writer, number = encoder(tokenizer), None, TaskContext.get().partitionId()
        path = f"{folder}/{number:08d}.tok"
        for batch in batches:
            if not batch.num_rows:
                continue
            if writer is None:
                writer = FileWriter(path, width_of(max(coder.vocabulary, end_id + 1)))
            ids, texts = batch.column(0).to_pylist(), batch.column(1)
            for i, doc_id in enumerate(ids):
                writer.add(doc_id, coder.encode(texts[i].as_py()) + end)
        if writer is not None:
            documents, total = writer.finish()
            yield pa.RecordBatch.from_arrays(
                [pa.array([x]) for x in (number, path, documents, total)], names=["file", "path", "documents", "ids"]
            )

    ordered = (
        docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
        .repartitionByRange(F.col("doc_id").asc_nulls_first())
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    )
    files = materialize(
        ordered.mapInArrow(write, "file bigint, path string, documents bigint, ids bigint"), "token-files"
    )
    earlier = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    return files.withColumn("start", F.coalesce(F.sum("ids").over(earlier), F.lit(0)))


def read_token_files(files: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the files; a task reads one file at a time."""
    ship(files.sparkSession)
    names = ["doc_id", "start", "n_tokens", "ids_crc32"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows = [
                    (doc_id, base + start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()))
                    for doc_id, start, ids in FileReader(path).documents()
                ]
                columns = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    spread = files.select("path", "start").repartitionByRange("path")
    return spread.mapInArrow(read, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def token_folder(spark: SparkSession) -> str:
    return scratch_path(spark, "tokens")
