"""Benchmark items in documents, allowing for edits: pieces find them, bit-parallel distance decides.

Texts are folded (see texts.folded) and runs of spaces become one. An item of m bytes may be
changed in k = m // piece - 1 bytes; it is cut into k + 1 pieces of `piece` bytes or
more, one of which any passage within k edits holds unchanged. The starts of all
pieces are looked up in the hashes of all places of the documents. Where one is found, the
count of common 3-grams and then Myers' bit-parallel edit distance decide.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .texts import blocks, collapsed, folded, grams


@dataclass(frozen=True)
class Settings:
    """piece: least bytes of a piece; shorter items are not looked for. block_bytes: items searched for in one pass."""

    piece: int = 12
    block_bytes: int = 1 << 22


def distance(pattern: bytes, text: bytes, most: int) -> int:
    """The least edit distance of pattern to any part of text, or most + 1 if it is larger."""
    masks: dict[int, int] = {}
    for i, c in enumerate(pattern):
        masks[c] = masks.get(c, 0) | 1 << i
    full = (1 << len(pattern)) - 1
    last = 1 << len(pattern) - 1
    plus, minus, score = full, 0, len(pattern)
    best = score
    for c in text:
        eq = masks.get(c, 0)
        diagonal = (((eq & plus) + plus) ^ plus) | eq | minus
        up = minus | (full & ~(diagonal | plus))
        down = plus & diagonal
        if up & last:
            score += 1
        elif down & last:
            score -= 1
        up = up << 1 & full
        plus = (down << 1 & full) | (full & ~(diagonal | up))
        minus = up & diagonal
        best = min(best, score)
    return best if best <= most else most + 1


@dataclass
class Item:
    text: bytes
    ids: list = field(default_factory=list)

    def prepare(self, piece: int) -> None:
        m = len(self.text)
        self.edits = max(0, m // piece - 1)
        count = self.edits + 1
        self.starts = [i * m // count for i in range(count)]
        self.pieces = [self.text[i * m // count : (i + 1) * m // count] for i in range(count)]
        symbols = np.frombuffer(self.text, np.uint8).astype(np.int64)
        self.threes = np.sort(symbols[:-2] << 16 | symbols[1:-1] << 8 | symbols[2:])

    def distance(self, text: bytes, start: int) -> int | None:
        """The distance of the best part of text near start, if within the allowed edits."""
        if start >= 0 and text[start : start + len(self.text)] == self.text:
            return 0
        window = text[max(0, start - self.edits) : start + len(self.text) + self.edits]
        symbols = np.frombuffer(window, np.uint8).astype(np.int64)
        if len(symbols) < 3:
            return None
        near = np.unique(symbols[:-2] << 16 | symbols[1:-1] << 8 | symbols[2:])
        at = np.minimum(np.searchsorted(near, self.threes), len(near) - 1)
        if (near[at] == self.threes).sum() < len(self.threes) - 3 * self.edits:
            return None
        found = distance(self.text, window, self.edits)
        return found if found <= self.edits else None


class Index:
    """The pieces of a bounded set of items by the hash of their first bytes."""

    def __init__(self, items: dict[bytes, Item], size: int):
        self.size, self.items = size, list(items.values())
        places = []
        for k, item in enumerate(self.items):
            item.prepare(size)
            for j, piece in enumerate(item.pieces):
                places.append((int(grams(np.frombuffer(piece[:size], np.uint8), size)[0]), k, j))
        places.sort()
        self.hashes = np.array([p[0] for p in places], np.uint64)
        self.places = [p[1:] for p in places]
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(self.hashes >> np.uint64(44)).astype(np.int64)] = True

    def search(self, block: pa.RecordBatch) -> list[tuple[int, int, int]]:
        """(row, item number, distance) of all items found in the texts of the block, once each."""
        data, begins = collapsed(*folded(block))
        hashes = grams(data, self.size)
        at = np.flatnonzero(self.maybe[(hashes >> np.uint64(44)).astype(np.int64)])
        low, high = (np.searchsorted(self.hashes, hashes[at], side) for side in ("left", "right"))
        hit = high > low
        best: dict[tuple[int, int], int] = {}
        tried = set()
        rows = np.searchsorted(begins, at[hit], "right") - 1
        texts: dict[int, bytes] = {}
        for place, row, first, stop in zip(at[hit].tolist(), rows.tolist(), low[hit].tolist(), high[hit].tolist()):
            if row not in texts:
                texts = {row: data[begins[row] : begins[row + 1]].tobytes()}
            text, place = texts[row], place - int(begins[row])
            for number, j in self.places[first:stop]:
                item = self.items[number]
                start = place - item.starts[j]
                if best.get((row, number)) == 0 or (row, number, start) in tried:
                    continue
                if text[place : place + len(item.pieces[j])] != item.pieces[j]:
                    continue
                tried.add((row, number, start))
                found = item.distance(text, start)
                if found is not None and found < best.get((row, number), found + 1):
                    best[row, number] = found
        return [(row, number, found) for (row, number), found in best.items()]


def indexes(benchmark: DataFrame, item_id: str, text: str, settings: Settings) -> Iterator[Index]:
    """Indexes of all items; each holds block_bytes of them at most, and only one is held here at a time."""
    items: dict[bytes, Item] = {}
    size = 0
    rows = benchmark.select(F.col(item_id).alias("item_id"), F.col(text).alias("text")).filter("text is not null")
    for row in rows.toLocalIterator(prefetchPartitions=True):
        data, _ = collapsed(*folded(pa.record_batch({"text": pa.array([row["text"]], pa.string())})))
        name = data.tobytes().rstrip(b" ")
        if len(name) < settings.piece:
            continue
        if name not in items and size + len(name) > settings.block_bytes and items:
            yield Index(items, settings.piece)
            items, size = {}, 0
        size += len(name) * (name not in items)
        items.setdefault(name, Item(name)).ids.append(row["item_id"])
    if items:
        yield Index(items, settings.piece)


def contaminated(
    documents: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", settings: Settings = Settings()
) -> DataFrame:
    """(id, item_id, distance): every benchmark item that a document holds, with its least distance.

    Null texts hold nothing and null items are not looked for; items that repeat a text are
    found under each of their ids. Rows that repeat give repeated results. Other columns
    are not read. An empty table on either side gives no rows.
    """
    rows = documents.select(F.col(id).alias("id"), F.col(text).alias("text"))
    kinds = rows.schema["id"].dataType.simpleString(), benchmark.schema[item_id].dataType.simpleString()
    schema = f"id {kinds[0]}, item_id {kinds[1]}, distance int"
    out = documents.sparkSession.createDataFrame([], schema)
    item_type = pa.int64() if kinds[1] == "bigint" else pa.int32() if kinds[1] == "int" else pa.string()
    for index in indexes(benchmark, item_id, item_text, settings):
        shared = documents.sparkSession.sparkContext.broadcast(index)  # bounded by block_bytes

        def find(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for block in blocks(batches):
                found = [(row, name, d) for row, number, d in shared.value.search(block) for name in shared.value.items[number].ids]
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [block.column("id").take(pa.array([f[0] for f in found])), pa.array([f[1] for f in found], item_type), pa.array([f[2] for f in found], pa.int32())],
                        ["id", "item_id", "distance"],
                    )

        out = out.union(rows.mapInArrow(find, schema))
    return out.select(F.col("id").alias(id), F.col("item_id").alias(item_id) if item_id != id else F.col("item_id"), "distance")


def decontaminated(documents: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """The documents that hold no benchmark item, with all their columns."""
    out = documents
    for index in indexes(benchmark, item_id, item_text, settings):
        shared = documents.sparkSession.sparkContext.broadcast(index)

        def keep(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for block in blocks(batches, text):
                mask = np.ones(block.num_rows, bool)
                only = pa.record_batch({"text": block.column(text)})
                mask[[row for row, _, _ in shared.value.search(only)]] = False
                yield block.filter(pa.array(mask))

        out = out.mapInArrow(keep, documents.schema)
    return out
