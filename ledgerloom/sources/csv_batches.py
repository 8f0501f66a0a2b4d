"""Batches of CSV files that may not share a header.

All files are read in one scan, whatever their headers: the task that opens a file reads its header and
puts each value under the column of its name. A CSV scan of Spark's takes one header for
all files and would put values under wrong names.
"""

from __future__ import annotations

import codecs
import csv
import io
from collections.abc import Callable, Iterable, Iterator, Sequence
from itertools import chain, islice

import pyarrow as pa
from pyarrow import csv as pa_csv
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.operators.checkpoints import scratch_folder
from ledgerloom.operators.columns import require_columns
from ledgerloom.schemas import PREPARED_COLUMNS
from ledgerloom.sources.intake import LOAD_ORDER, LOAD_TYPES, TASK_BYTES, dealt, file_name, listed, store_of

#: Records of a batch, and bytes of a block of lines that are parsed together.
BATCH, BLOCK_BYTES = 8192, 2 << 20
_LONGEST_FIELD = (1 << 31) - 1
#: Endings of compressed files, which the streams undo, and about how many bytes stand behind one of theirs.
PACKED, UNPACKED_BYTES = (".gz", ".zst"), 8


def _is_packed(path: str) -> bool:
    return path.lower().endswith(PACKED)


def _plain_name(path: str) -> str:
    """The name of a file, of a compressed one that of what it holds."""
    name = file_name(path)
    return name.rpartition(".")[0] if _is_packed(name) else name


def _open(path: str) -> io.TextIOWrapper:
    store, inner = store_of(path)
    return io.TextIOWrapper(store.open_input_stream(inner), encoding="utf-8-sig", errors="replace", newline="")


def _header(path: str) -> list[str]:
    with _open(path) as lines:
        return next(csv.reader(lines), [])


def _headers(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first record of each file; the rest of the file is not read."""
    csv.field_size_limit(_LONGEST_FIELD)
    for batch in batches:
        headers = pa.array([_header(p) for p in batch.column("load_path").to_pylist()], pa.list_(pa.string()))
        yield pa.RecordBatch.from_arrays([batch.column("load_rank"), batch.column("load_path"), headers], ["load_rank", "load_path", "header"])


def _rest(path: str, start: int) -> Iterator[list[str]]:
    """The records from byte `start`, which begins a line, to the end of the file."""
    store, inner = store_of(path)
    with store.open_input_stream(inner) if _is_packed(path) else store.open_input_file(inner) as file:
        if _is_packed(path):
            before = start
            while before and (passed := file.read(min(before, BLOCK_BYTES))):
                before -= len(passed)
        else:
            file.seek(start)
        yield from csv.reader(io.TextIOWrapper(file, encoding="utf-8" if start else "utf-8-sig", errors="replace", newline=""))


def _blocks(path: str) -> Iterator[pa.RecordBatch | Iterable[list[str]]]:
    """The records of a file without its header, in blocks: as a batch of text columns where all agree in width.

    Without quotes a line is a record, so blocks of whole lines are parsed by Arrow. Records of unequal widths, and all from
    the first quote on, go through the standard reader.
    """
    store, inner = store_of(path)
    with store.open_input_stream(inner) as stream:
        file = io.BufferedReader(stream, 1 << 20)
        first = file.readline(BLOCK_BYTES)
        # Headers beyond one plain line are left to the standard reader.
        if not first.endswith(b"\n") or b'"' in first or b"\r" in first[:-2] or not first.strip():
            yield islice(_rest(path, 0), 1, None)
            return
        at, width = len(first), first.count(b",") + 1
        names = [str(k) for k in range(width)]
        reading = pa_csv.ReadOptions(use_threads=False, column_names=names, block_size=4 * BLOCK_BYTES)
        parsing = pa_csv.ParseOptions(quote_char=False)
        typing = pa_csv.ConvertOptions(column_types={n: pa.string() for n in names}, strings_can_be_null=False)
        while block := file.read(BLOCK_BYTES):
            if not block.endswith(b"\n"):
                block += file.readline(BLOCK_BYTES)
            whole = block.endswith(b"\n") or not file.peek(1)
            if not whole or b'"' in block:
                yield _rest(path, at)
                return
            lines: pa.Table | None = None
            if b"\0" not in block and not block.startswith(codecs.BOM_UTF8):
                try:
                    lines = pa_csv.read_csv(io.BytesIO(block), reading, parsing, typing)
                except pa.ArrowInvalid:
                    # Unequal widths, or bytes that are no text.
                    pass
            if lines is None:
                yield csv.reader(io.StringIO(block.decode("utf-8", "replace"), newline=""))
            else:
                yield from lines.combine_chunks().to_batches()
            at += len(block)


def _part(path: str, start: int, stop: int) -> Iterator[list[str]]:
    """The records of the lines that begin from byte `start` to before `stop`, without the header."""
    store, inner = store_of(path)
    with store.open_input_file(inner) as file:
        file.seek(max(0, start - 1))
        raw = io.BufferedReader(file, 1 << 20)
        # A line that begins right at `start` is told by the line break before it.
        at = start - 1 + len(raw.readline()) if start else len(raw.readline())
        while at < stop:
            line = raw.readline()
            if not line:
                return
            at += len(line)
            yield next(csv.reader([line.decode("utf-8", "replace")]), [])


def _columns(block: pa.RecordBatch | Iterable[list[str]], width: int) -> Iterator[list[pa.Array]]:
    """The columns of a block, for some records at a time; records are filled up or cut to the width."""
    if isinstance(block, pa.RecordBatch):
        if block.num_rows:
            yield block.columns
        return
    records = (r for r in block if r)
    while some := list(islice(records, BATCH)):
        if any(len(r) != width for r in some):
            some = [(r + [""] * (width - len(r)))[:width] for r in some]
        yield [pa.array(column, pa.string()) for column in zip(*some)]


def _reader(columns: list[str], multi_line: bool, load_order: bool) -> Callable:
    """Reads parts of files as batches of all the columns; what a file lacks is ""."""
    places = {c.lower(): k for k, c in enumerate(columns)}

    def sources(header: Sequence[str]) -> list[int | None]:
        found: list[int | None] = [None] * len(columns)
        for k, name in enumerate(unrepeated(header)):
            found[places[name.lower()]] = k
        return found

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        csv.field_size_limit(_LONGEST_FIELD)
        known: dict[tuple, list[int | None]] = {}
        names = [*columns, *(LOAD_ORDER if load_order else [])]
        for batch in batches:
            for part in batch.to_pylist():
                path, start = part["load_path"], part["start"]
                header = tuple(_header(path))
                if not header:
                    continue
                if header not in known:
                    known[header] = sources(header)
                width, number = len(header), 0
                blocks = _blocks(path) if multi_line or _is_packed(path) else [_part(path, start, min(start + TASK_BYTES, part["size"]))]
                for values in (v for block in blocks for v in _columns(block, width)):
                    n = len(values[0])
                    arrays = [
                        values[k] if k is not None else pa.repeat(pa.scalar(_plain_name(path) if c == "SourceFile" else ""), n)
                        for c, k in zip(columns, known[header], strict=True)
                    ]
                    if load_order:
                        arrays += [pa.repeat(pa.scalar(part["load_rank"], pa.int32()), n), pa.repeat(pa.scalar(path), n)]
                        arrays += [pa.repeat(pa.scalar(start), n), pa.array(range(number, number + n), pa.int64())]
                    number += n
                    yield pa.RecordBatch.from_arrays(arrays, names)

    return read


def read_csv_batch(
    spark: SparkSession, paths: Sequence[str], multi_line: bool = True, load_order: bool = False, packed: bool = False
) -> DataFrame:
    """All files as text columns, united by column name; what is missing is "".

    Columns come in the order in which files bring them. ``SourceFile`` is the file name
    unless the files bring that column. A record with fewer values than its header is filled up, one with
    more is cut. Turn ``multi_line`` off for big files without line breaks inside quotes: they are then
    split between tasks. ``load_order`` adds each row's place in the order of loading (``LOAD_ORDER``). ``packed`` reads
    compressed files (.csv.gz, .csv.zst) too, each by one task.
    """
    files = listed(spark, paths, (".csv", *(f".csv{e}" for e in PACKED if packed)), "CSV file")
    is_packed = F.lower("load_path").rlike(f"({'|'.join(PACKED)})$".replace(".", "[.]"))
    files = files.withColumn("size", F.when(is_packed, F.col("size") * UNPACKED_BYTES).otherwise(F.col("size")))
    # Kept, so that the layouts come from one opening of every file.
    kept = scratch_folder(spark, "csv-headers")
    described = "load_rank int, load_path string, header array<string>"
    dealt(files).mapInArrow(_headers, described).write.parquet(kept)
    headers = spark.read.schema(described).parquet(kept).filter(F.size("header") > 0)
    # One row for each distinct header.
    layouts = headers.groupBy("header").agg(F.min(F.struct("load_rank", "load_path")).alias("first")).orderBy("first").collect()
    if not layouts:
        raise ValueError("The CSV files hold no header")
    columns: dict[str, str] = {}
    for layout in layouts:
        own = unrepeated(layout.header)
        for name in own if any(c.lower() == "sourcefile" for c in own) else ["SourceFile", *own]:
            columns.setdefault(name.lower(), name)
    columns["sourcefile"] = "SourceFile"
    clashing = [c for c in LOAD_ORDER if load_order and c in columns]
    if clashing:
        raise ValueError(f"Columns of the files take the names of the load order: {clashing}")
    last = F.when(is_packed, F.lit(0)).otherwise(F.greatest(F.col("size") - 1, F.lit(0)))
    starts = F.lit(0) if multi_line else F.explode(F.sequence(F.lit(0), last, F.lit(TASK_BYTES)))
    parts = dealt(files.withColumn("start", starts.cast("long")) if multi_line else files.select("*", starts.alias("start")))
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns.values()])
    if load_order:
        schema = T.StructType([*schema.fields, *T.StructType.fromDDL(LOAD_TYPES).fields])
    return parts.mapInArrow(_reader(list(columns.values()), multi_line, load_order), schema)


def unrepeated(header: Sequence[str]) -> list[str]:
    """Column names in which a name that comes again, in any letter case, is numbered: a, a.1, a.2."""
    names: list[str] = []
    taken: set[str] = set()
    for column in header:
        name, number = column, 0
        while name.lower() in taken:
            number += 1
            name = f"{column}.{number}"
        taken.add(name.lower())
        names.append(name)
    return names


def read_prepared_lines(
    spark: SparkSession, paths: Sequence[str], multi_line: bool = True, load_order: bool = False, packed: bool = False
) -> DataFrame:
    """A CSV batch that must bring every column of a prepared line file."""
    return require_columns(read_csv_batch(spark, paths, multi_line, load_order, packed), PREPARED_COLUMNS, "Prepared line file")
