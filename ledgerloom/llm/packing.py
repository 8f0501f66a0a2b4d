"""Packing of token ids into sequences of a fixed length, with bounded space.

Each task keeps a fixed number of open windows. Whole windows of a document go out as
they are; what remains goes to the open window with the least room that holds it. When
none does and no further window may be opened, the fullest window is filled up with the
front of the remainder and emitted. What is left open at the end of the tasks is merged:
windows of `together` tasks are strung together and cut anew, and the last rest is cut
into powers of two, which need no padding.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import written
from .texts import blocks, strings
from .tokens import encoder


@dataclass(frozen=True)
class Settings:
    """length: ids of a sequence. windows: open windows of a task. end: the id after each document."""

    length: int = 1024
    windows: int = 16
    end: int = 0
    together: int = 32


class Packer:
    """Open windows of one task. `out` gathers (document, start, ids, sequence, offset)."""

    def __init__(self, settings: Settings):
        self.length, self.most = settings.length, settings.windows
        self.open: dict[int, list] = {}
        self.fill: dict[int, int] = {}
        self.next, self.out = 0, []

    def add(self, document: tuple, ids: np.ndarray) -> None:
        whole = len(ids) // self.length * self.length
        for start in range(0, whole, self.length):
            self.out.append((document, start, ids[start : start + self.length], self._new(), 0))
        start = whole
        while start < len(ids):
            size = len(ids) - start
            fitting = [(self.length - fill, w) for w, fill in self.fill.items() if self.length - fill >= size]
            if fitting:
                window = min(fitting)[1]
            elif len(self.fill) < self.most:
                window = self._new()
                self.open[window], self.fill[window] = [], 0
            else:
                window = max(self.fill, key=lambda w: (self.fill[w], -w))
                size = self.length - self.fill[window]
            self.open[window].append((document, start, ids[start : start + size], window, self.fill[window]))
            self.fill[window] += size
            start += size
            if self.fill[window] == self.length:
                del self.fill[window]
                self.out += self.open.pop(window)

    def _new(self) -> int:
        self.next += 1
        return self.next - 1


_PIECE = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def crc(ids: np.ndarray) -> int:
    """crc32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(np.ascontiguousarray(ids, "<u4").tobytes())


def _rows(pieces: list[tuple], kind: pa.DataType, sequences: list[int], open: bool) -> pa.RecordBatch:
    longs = lambda values: pa.array(values, pa.int64())
    return pa.RecordBatch.from_arrays(
        [
            pa.array([p[0][0] for p in pieces], kind),
            longs([p[1] for p in pieces]),
            longs([len(p[2]) for p in pieces]),
            longs([crc(p[2]) for p in pieces]),
            longs([p[0][1] for p in pieces]),
            longs(sequences),
            longs([p[4] for p in pieces]),
            pa.array([p[2].astype("<u4").tobytes() if open else None for p in pieces], pa.binary()),
        ],
        ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"],
    )


def pack(documents: DataFrame, tokenizer: str, id: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document is the ids of its text by the tokenizer file `tokenizer`, followed by
    `settings.end`; a null or empty text is that id alone. Rows without an id and rows
    that repeat are documents of their own. Other columns are not read. An empty table
    gives no rows.
    """
    rows = documents.select(F.col(id).alias("id"), F.col(text).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, encode, task = Packer(settings), encoder(tokenizer).encode, TaskContext.get().partitionId()
        arrow = None
        for block in blocks(batches):
            arrow = block.column("id").type
            ids, offsets = encode(strings(block))
            for name, start, stop in zip(block.column("id").to_pylist(), offsets[:-1].tolist(), offsets[1:].tolist()):
                tokens = np.append(ids[start:stop], np.uint32(settings.end))
                packer.add((name, len(tokens)), tokens)
            yield _rows(packer.out, arrow, [(task << 32) + p[3] for p in packer.out], False)
            packer.out = []
        rest = [p for window in packer.open.values() for p in window]
        if rest:
            yield _rows(rest, arrow, [(task << 32) + p[3] for p in rest], True)

    pieces = written(rows.mapInArrow(fill, f"id {kind}, {_PIECE}, ids binary"), "pieces")
    whole = pieces.filter("ids is null").drop("ids")
    left = pieces.filter("ids is not null")
    group = F.shiftright(F.col("sequence_id"), 32) / settings.together
    merged = left.withColumn("group", F.floor(group).cast("long")).groupBy("group").applyInArrow(
        lambda g: _merge(g, settings.length), f"id {kind}, {_PIECE}"
    )
    return whole.union(merged).withColumnRenamed("id", id)


def _merge(group: pa.Table, length: int) -> pa.Table:
    """Strings the open windows together and cuts them into sequences without padding."""
    group = group.sort_by([("sequence_id", "ascending"), ("offset", "ascending")])
    total, at, sequence = pc.sum(group["length"]).as_py(), 0, (1 << 60) + (group["group"][0].as_py() << 32)
    ends = list(range(length, total + 1, length))
    rest = total - (ends[-1] if ends else 0)
    ends += list(total - rest + np.cumsum([1 << k for k in range(rest.bit_length() - 1, -1, -1) if rest >> k & 1])) if rest else []
    begins, out, number = [0, *ends], [], 0
    columns = [group[c].to_pylist() for c in ("start", "doc_tokens", "ids")]
    for row, (start, tokens, packed) in enumerate(zip(*columns)):
        ids, used = np.frombuffer(packed, "<u4"), 0
        while used < len(ids):
            size = min(len(ids) - used, int(ends[number]) - at)
            out.append((row, start + used, size, crc(ids[used : used + size]), tokens, sequence + number, at - int(begins[number])))
            used, at = used + size, at + size
            number += at == ends[number]
    rows, *values = zip(*out)
    names = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    return pa.table([group["id"].take(pa.array(rows)), *(pa.array(v, pa.int64()) for v in values)], ["id", *names])
