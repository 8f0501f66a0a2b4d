"""Named tables of one client under one folder, as plain Parquet.

A *replaceable* table is a folder of versions. Publishing writes a new version
beside the old ones, and Spark's own ``_SUCCESS`` marker makes it current: readers
never see half a table, a lost executor or driver leaves the old version in place,
and a table can be rebuilt from its own previous contents. Tables that belong together
are staged first, out of sight, and become current one right after the other when all
are written.

An *append-only* table is one dataset that only gains files.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone
from uuid import uuid4

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions import check_table_name
from ledgerloom.operators.checkpoints import shuffles_freed
from ledgerloom.operators.columns import has_column
from ledgerloom.operators.ordered_lag import ranged
from ledgerloom.sources.files import path_exists, remove_folder, rename_folder, subfolders


# A folder inside a version, passed over by Spark's readers.
ATTACHED = "_attached"


def utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


@dataclass(frozen=True)
class Staged:
    """A version that is written and not current yet."""

    name: str
    path: str
    rows: int


class TableStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{check_table_name(name)}"

    # -- replaceable tables -------------------------------------------------

    def versions(self, name: str) -> list[str]:
        """Paths of the complete versions, oldest first."""
        folders = [f"{self.path(name)}/{f}" for f in subfolders(self.spark, self.path(name)) if f.startswith("version=")]
        return [f for f in folders if path_exists(self.spark, f"{f}/_SUCCESS")]

    def publish(self, name: str, df: DataFrame, replace: bool = True, cluster_by: Sequence[str] = ()) -> int:
        """Write a new current version; the row count is taken during the write."""
        if not replace and self.exists(name):
            raise ValueError(f"Table {name} exists already")
        staged = self.stage(name, df, cluster_by)
        self.switch([staged])
        return staged.rows

    def stage(self, name: str, df: DataFrame, cluster_by: Sequence[str] = ()) -> Staged:
        """Write a version that readers do not see yet.

        ``cluster_by`` puts the rows in order by those columns, in files of even size, so that a reader who asks for some
        values skips by Parquet's statistics what cannot hold them. A value that has most of the rows gets many files.
        """
        counted = Observation()
        path = f"{self.path(name)}/staged={uuid4().hex}"
        if cluster_by:
            df = ranged(df, cluster_by)
        with shuffles_freed(self.spark):
            df.observe(counted, F.count(F.lit(1)).alias("rows")).write.parquet(path)
        return Staged(name, path, counted.get["rows"])

    def switch(self, staged: Iterable[Staged]) -> None:
        """Make staged versions current: one rename each, and no work in between."""
        for version in staged:
            current = f"version={utc_now():%Y%m%dT%H%M%S%f}-{uuid4().hex[:8]}"
            rename_folder(self.spark, version.path, f"{self.path(version.name)}/{current}")

    def attach(self, version: Staged, rows: DataFrame) -> None:
        """Put rows about a staged version inside it, where readers of the table do not see them."""
        rows.write.parquet(f"{version.path}/{ATTACHED}")

    def attached(self) -> list[str]:
        """Folders of the rows attached to complete versions of any table."""
        found = [f"{v}/{ATTACHED}" for name in subfolders(self.spark, self.root) for v in self.versions(name)]
        return [f for f in found if path_exists(self.spark, f"{f}/_SUCCESS")]

    def drop(self, name: str) -> None:
        """Remove the table with all its versions; nothing happens if it is absent."""
        remove_folder(self.spark, self.path(name))

    # -- append-only tables -------------------------------------------------

    def append(self, name: str, df: DataFrame) -> None:
        df.write.mode("append").parquet(f"{self.path(name)}/rows")

    def read_appended(self, name: str, schema: T.StructType) -> DataFrame:
        """All rows appended so far, or none in the given layout."""
        location = f"{self.path(name)}/rows"
        if not path_exists(self.spark, location):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(location)

    # -- catalogue ----------------------------------------------------------

    def _location(self, name: str) -> str | None:
        """Folder of the appended rows or of the newest complete version."""
        appended = f"{self.path(name)}/rows"
        if path_exists(self.spark, appended):
            return appended
        return next(reversed(self.versions(name)), None)

    def exists(self, name: str) -> bool:
        return self._location(name) is not None

    def has_column(self, name: str, column: str) -> bool:
        return self.exists(name) and has_column(self.read(name), column)

    def find(self, name: str) -> DataFrame | None:
        location = self._location(name)
        return None if location is None else self.spark.read.parquet(location)

    def read(self, name: str) -> DataFrame:
        df = self.find(name)
        if df is None:
            raise ValueError(f"No table {name} under {self.root}")
        return df

    def names(self) -> list[str]:
        """Readable tables, sorted; none where nothing was written yet."""
        return [f for f in subfolders(self.spark, self.root) if self.exists(f)]
