"""Very many files: listed, opened and read by tasks.

Folders are listed in tasks, level by level, and the names go to a table in the shared
folder: the driver sees the paths it was given and nothing else. Small files are landed
in containers of many; archives are containers already and are read where they lie, member by member.
What is read from a file can carry its place in the order of
loading: the given path, the file in it, the first byte of the part read, and the row in that
part.
"""

from __future__ import annotations

import io
import tarfile
from collections.abc import Callable, Iterator, Sequence
from fnmatch import fnmatchcase
from functools import reduce
from typing import BinaryIO

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators.checkpoints import scratch_folder
from ledgerloom.sources.files import qualified

#: Columns of a row's place in the order of loading, for sorting by all of them.
LOAD_ORDER = ["load_rank", "load_path", "load_start", "load_row"]
LOAD_TYPES = "load_rank int, load_path string, load_start long, load_row long"

_FOUND = "load_rank int, load_path string, size long, folder boolean, rest array<string>"
#: Endings of archives of many files.
ARCHIVES = (".tar", ".tar.gz", ".tgz", ".tar.zst")
#: Bytes of small files that a task reads, and that go into one batch.
TASK_BYTES, BATCH_BYTES = 64 << 20, 8 << 20


def check_endings(paths: Sequence[str], endings: tuple[str, ...], what: str) -> None:
    """Refuse an empty batch and files of another kind; a path without a dot is a folder."""
    if not paths:
        raise ValueError(f"Give at least one {what}")
    for path in paths:
        name = path.rstrip("/").rsplit("/", 1)[-1]
        if "." in name and "*" not in name and not name.lower().endswith(endings):
            raise ValueError(f"Not a {what}: {name}")


def store_of(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a qualified path, and the path inside it."""
    scheme, _, rest = path.partition(":")
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


def _look(endings: tuple[str, ...]) -> Callable:
    """Lists folders: files with the right ending go on as files, folders as what is to be listed next."""

    def entries(path: str) -> Iterator[tuple[str, fs.FileInfo]]:
        store, inner = store_of(path)
        for info in sorted(store.get_file_info(fs.FileSelector(inner)), key=lambda i: i.base_name):
            if not info.base_name.startswith(("_", ".")):
                yield f"{path.rstrip('/')}/{info.base_name}", info

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int32(), pa.string(), pa.int64(), pa.bool_(), pa.list_(pa.string())]

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            columns = zip(*rows) if rows else [[]] * 5
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["load_rank", "load_path", "size", "folder", "rest"])

        out: list[tuple] = []
        for given in batches:
            for rank, path, rest in zip(*(given.column(c).to_pylist() for c in ("load_rank", "load_path", "rest")), strict=True):
                store, inner = store_of(path)
                info = store.get_file_info(inner)
                if info.type == fs.FileType.NotFound:
                    raise FileNotFoundError(path)
                if info.type == fs.FileType.File:
                    out.append((rank, path, info.size, False, []))
                    continue
                for name, entry in entries(path):
                    if rest and not fnmatchcase(entry.base_name, rest[0]):
                        continue
                    if entry.type == fs.FileType.Directory:
                        out.append((rank, name, 0, True, rest[1:]))
                    elif len(rest) <= 1 and entry.base_name.lower().endswith(endings):
                        out.append((rank, name, entry.size, False, []))
                    if len(out) >= 10_000:
                        yield batch(out)
                        out = []
        yield batch(out)

    return look


def listed(spark: SparkSession, paths: Sequence[str], endings: tuple[str, ...], what: str) -> DataFrame:
    """(load_rank, load_path, size) of all files with the endings, in the paths given and all folders below.

    A path may hold * ? and [ ] as patterns. Names that begin with _ or . are passed over. The
    rank is that of the given path.
    """
    check_endings(paths, endings, what)
    given = []
    for rank, path in enumerate(paths):
        steps = qualified(spark, path).rstrip("/").split("/")
        plain = next((k for k, s in enumerate(steps) if any(c in s for c in "*?[")), len(steps))
        given.append((rank, "/".join(steps[:plain]), steps[plain:]))
    todo = spark.createDataFrame(given, "load_rank int, load_path string, rest array<string>")
    levels = []
    while not levels or not todo.isEmpty():
        kept = scratch_folder(spark, "listing")
        todo.repartition(spark.sparkContext.defaultParallelism).mapInArrow(_look(endings), _FOUND).write.parquet(kept)
        levels.append(spark.read.schema(_FOUND).parquet(kept))
        todo = levels[-1].filter("folder").select("load_rank", "load_path", "rest")
    files = reduce(DataFrame.union, levels)
    return files.filter("not folder").select("load_rank", "load_path", "size")


def dealt(files: DataFrame) -> DataFrame:
    """Files, or parts of them, dealt evenly to as many tasks as their bytes ask for."""
    total = files.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    return files.repartition(max(files.sparkSession.sparkContext.defaultParallelism, -(-total // TASK_BYTES)))


def file_name(path: str) -> str:
    return path.rsplit("/", 1)[-1]


_LANDED = "load_rank int, load_path string, source_file string, content binary"


def _contents(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.string(), pa.string(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["load_rank", "load_path", "source_file", "content"])


def landed(files: DataFrame) -> DataFrame:
    """(load_rank, load_path, source_file, content) of the files, in containers under the shared folder."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for given in batches:
            for rank, path, expected in zip(*(given.column(c).to_pylist() for c in ("load_rank", "load_path", "size")), strict=True):
                if held and size + expected > BATCH_BYTES:
                    yield _contents(held)
                    held, size = [], 0
                store, inner = store_of(path)
                with store.open_input_stream(inner) as stream:
                    held.append((rank, path, file_name(path), stream.read()))
                size += expected
        if held:
            yield _contents(held)

    kept = scratch_folder(files.sparkSession, "containers")
    dealt(files).mapInArrow(read, _LANDED).write.parquet(kept)
    return files.sparkSession.read.schema(_LANDED).parquet(kept)


def is_archive(path: str) -> Column:
    return reduce(Column.__or__, [F.lower(path).endswith(e) for e in ARCHIVES])


class _Rest:
    """A stream whose next bytes have been taken from it already."""

    def __init__(self, taken: bytes, stream: BinaryIO):
        self.taken, self.stream = taken, stream

    def read(self, n: int) -> bytes:
        if not self.taken:
            return self.stream.read(n)
        out, self.taken = self.taken[:n], self.taken[n:]
        return out


def _opened(stream: BinaryIO) -> Iterator[tuple[str, int, Callable[[], bytes]]]:
    """(name, size, reading) of the files of a tar archive, one after the other, as the standard reader finds them."""
    # The stream undoes what the ending tells of; tarfile finds out the rest.
    with tarfile.open(fileobj=stream, mode="r|*", bufsize=1 << 20) as archive:
        while (member := archive.next()) is not None:
            # tarfile would remember all of them.
            archive.members = []
            if member.isfile():
                yield member.name, member.size, archive.extractfile(member).read


def _plain_size(header: bytes) -> int | None:
    """The size of a plain file, by its header; None of any other header."""
    if len(header) < tarfile.BLOCKSIZE or header[156:157] != tarfile.REGTYPE or header[257:262] != b"ustar" or header[345] or header[135] not in b"\0 ":
        return None
    try:
        right = int(header[148:154], 8) == 256 + sum(header[:148]) + sum(header[156:])
        return int(header[124:135], 8) if right else None
    except ValueError:
        return None


def members(stream: BinaryIO) -> Iterator[tuple[str, int, Callable[[], bytes]]]:
    """The same, with the headers of plain files read here; from the first other member on, the standard reader goes on."""
    raw = io.BufferedReader(stream, 1 << 20)
    block, first = tarfile.BLOCKSIZE, True
    while True:
        header = raw.read(block)
        size = _plain_size(header)
        if size is None:
            try:
                if not first:
                    tarfile.TarInfo.frombuf(header, tarfile.ENCODING, "surrogateescape")
            except tarfile.HeaderError:
                # Where the standard reader ends as well; of the first header it makes an error.
                return
            yield from _opened(_Rest(header, raw))
            return
        first = False
        name = header[: header.index(0)] if not header[99] else header[:100]
        taken = False

        def content(size: int = size) -> bytes:
            nonlocal taken
            taken = True
            found, filling = raw.read(size), -size % block
            if len(found) < size or len(raw.read(filling)) < filling:
                raise tarfile.ReadError("unexpected end of data")
            return found

        yield name.decode(tarfile.ENCODING, "surrogateescape"), size, content
        if not taken:
            content()


def unpacked(archives: DataFrame, ending: str) -> DataFrame:
    """(load_rank, load_path, source_file, content) of the files with the ending inside archives.

    An archive is read once from front to end by one task, which holds some members at a time. The path of a member is that
    of its archive and its own name. Names that begin with _ or . are passed over.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for given in batches:
            for rank, path in zip(*(given.column(c).to_pylist() for c in ("load_rank", "load_path")), strict=True):
                store, inner = store_of(path)
                with store.open_input_stream(inner) as stream:
                    for inside, n, content in members(stream):
                        name = file_name(inside)
                        if name.startswith(("_", ".")) or not name.lower().endswith(ending):
                            continue
                        if held and size + n > BATCH_BYTES:
                            yield _contents(held)
                            held, size = [], 0
                        held.append((rank, f"{path}/{inside}", name, content()))
                        size += n
        if held:
            yield _contents(held)

    return dealt(archives).mapInArrow(read, _LANDED)
