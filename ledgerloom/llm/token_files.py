"""Binary files of token ids with Elias-Fano coded document boundaries.

A file is a run of blocks, each followed by a line feed. A block is a header, the ids of its
documents in one array (16 bits each where the vocabulary allows it), and two Elias-Fano
codes: where each document ends, and its doc_id less the first one. Documents are in
ascending order of doc_id, nulls first, over all files. No table of 64-bit offsets is
stored; place and length of a document come from select.

Files go through Spark's own writer and reader of files, so any store that Spark reaches will do.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import elias_fano
from .tables import shared_folder, written
from .texts import blocks, strings
from .tokens import encoder

_HEAD = struct.Struct("<4sBxxxIIQIIqQ")  # magic, bytes of an id, file, block, ids, documents, of them without doc_id, first doc_id, bytes after the header
_MAGIC = b"TIDF"


def block_bytes(file: int, number: int, names: list[int | None], ids: np.ndarray, ends: np.ndarray, width: int) -> bytes:
    """One block; names ascend, nulls first."""
    known = [x for x in names if x is not None]
    first = known[0] if known else 0
    body = ids.astype("<u2" if width == 2 else "<u4").tobytes() + elias_fano.encode(ends)
    body += elias_fano.encode(np.array([x - first for x in known], np.uint64))
    return _HEAD.pack(_MAGIC, width, file, number, len(ids), len(names), len(names) - len(known), first, len(body)) + body


class Block:
    """A block in a buffer. document(i) gives (doc_id, start in the block, ids)."""

    def __init__(self, buffer: bytes, at: int = 0):
        magic, width, self.file, self.number, count, self.n, self.nulls, self.first, size = _HEAD.unpack_from(buffer, at)
        if magic != _MAGIC:
            raise ValueError("This is no block of token ids")
        start = at + _HEAD.size
        self.ids = np.frombuffer(buffer, "<u2" if width == 2 else "<u4", count, start)
        self.ends = elias_fano.Values(buffer, start + width * count)
        self.names = elias_fano.Values(buffer, start + width * count + self.ends.size)
        self.stop = start + size

    def document(self, i: int) -> tuple[int | None, int, np.ndarray]:
        start = self.ends[i - 1] if i else 0
        name = None if i < self.nulls else self.first + self.names[i - self.nulls]
        return name, start, self.ids[start : self.ends[i]]

    def documents(self) -> tuple[list[int | None], np.ndarray]:
        """All doc_ids, and the boundaries of all documents beginning with 0."""
        return [None] * self.nulls + (self.names.all() + self.first).tolist(), np.concatenate(([0], self.ends.all()))


def blocks_of(content: bytes) -> Iterator[Block]:
    at = 0
    while at < len(content):
        block = Block(content, at)
        yield block
        at = block.stop + 1  # the line feed


def write(documents: DataFrame, path: str, tokenizer: str, end: int, id: str = "doc_id", text: str = "text", files: int | None = None) -> None:
    """Writes the ids of all texts, each followed by `end`, in ascending order of doc_id.

    A null text is an empty one. Documents without doc_id come first, and those that repeat one
    stand side by side. `files` defaults to the shuffle partitions; a file should hold some
    16 MB of ids, and a task holds a block of about 4 MB at a time. Only the two columns
    named are read.
    """
    rows = documents.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    spread = rows.repartitionByRange(files, "id") if files else rows.repartitionByRange("id")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use, file, number = encoder(tokenizer), TaskContext.get().partitionId(), 0
        width = 2 if use.tokenizer.get_vocab_size() <= 1 << 16 and end < 1 << 16 else 4
        names, parts, ends, total = [], [], [], 0

        def full() -> pa.RecordBatch:
            return pa.record_batch({"block": pa.array([block_bytes(file, number, names, np.concatenate(parts), np.array(ends), width)], pa.binary())})

        for block in blocks(batches):
            ids, offsets = use.encode(strings(block))
            stops = offsets[1:] + np.arange(1, block.num_rows + 1)
            parts.append(np.insert(ids, offsets[1:], np.uint32(end)))
            ends += (stops + total).tolist()
            names += block.column("id").to_pylist()
            total += len(parts[-1])
            if total >= 2_000_000:
                yield full()
                names, parts, ends, total, number = [], [], [], 0, number + 1
        if names:
            yield full()

    sorted_rows = spread.sortWithinPartitions(F.col("id").asc_nulls_first())
    # A string column is written byte for byte, so the text writer writes binary files.
    sorted_rows.mapInArrow(encode, "block binary").select(F.col("block").cast("string")).write.text(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """One row per document of the files: doc_id, start, n_tokens, ids_crc32.

    start counts the ids of all documents before it, over all files.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                for block in blocks_of(memoryview(content.as_buffer())):
                    names, edges = block.documents()
                    wide = block.ids.astype("<u4")
                    yield pa.record_batch(
                        {
                            "file": pa.array([block.file] * block.n, pa.int64()),
                            "block": pa.array([block.number] * block.n, pa.int64()),
                            "doc_id": pa.array(names, pa.int64()),
                            "start": pa.array(edges[:-1], pa.int64()),
                            "n_tokens": pa.array(np.diff(edges), pa.int64()),
                            "ids_crc32": pa.array([zlib.crc32(wide[i:j]) for i, j in zip(edges[:-1], edges[1:])], pa.int64()),
                        }
                    )

    schema = "file long, block long, doc_id long, start long, n_tokens long, ids_crc32 long"
    rows = written(files.mapInArrow(decode, schema), "decoded")
    # One row for each block, that is for some million ids.
    before = Window.orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy("file", "block").agg(F.sum("n_tokens").alias("ids"))
    totals = totals.select("file", "block", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("before"))
    return rows.join(totals, ["file", "block"]).select("doc_id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")


def scratch(spark: SparkSession) -> str:
    """A new folder name for files in the shared folder."""
    return f"{shared_folder(spark)}/llm-token-files-{uuid.uuid4().hex}"
