"""Append-only line history, one partition per run, with columns that may grow."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions import check_table_name, quoted
from ledgerloom.schemas import META_COLUMNS
from ledgerloom.sources.files import path_exists
from ledgerloom.sources.tables import TableStore, utc_now

_COLUMN_LOG = T.StructType(
    [T.StructField("position", T.IntegerType()), T.StructField("column_name", T.StringType())]
)


def _text(column: str | None) -> Column:
    """A cell as the history keeps it; "" where the column is missing."""
    return F.lit("") if column is None else F.coalesce(F.col(quoted(column)).cast("string"), F.lit(""))


class LineHistory:
    """Rows of every run of one line table.

    The columns seen so far are kept in a small table of their own, so a reader
    neither opens the footers of all files to merge their schemas nor lists the
    partitions of other runs.
    """

    def __init__(self, store: TableStore, name: str):
        self.store = store
        self.name = check_table_name(name)
        self.location = f"{store.path(name)}/rows"

    @property
    def _column_log(self) -> str:
        return f"{self.name}_columns"

    def columns(self) -> list[str]:
        """Line columns in the order they first arrived; bounded by the table's width."""
        log = self.store.read_appended(self._column_log, _COLUMN_LOG)
        seen = log.groupBy("column_name").agg(F.min("position").alias("position"))
        return [row.column_name for row in seen.orderBy("position", "column_name").collect()]

    def exists(self) -> bool:
        return path_exists(self.store.spark, self.location)

    def _schema(self) -> T.StructType:
        fields = [T.StructField(c, T.StringType()) for c in self.columns()]
        meta = [T.StructField("loaded_at", T.TimestampNTZType()), T.StructField("run_id", T.StringType())]
        return T.StructType([*fields, *meta])

    def _record(self, known: list[str], new: list[str]) -> None:
        """Columns are recorded before rows, so that every column of a written file is known to
        readers even if the job dies in between."""
        if new:
            log = [(len(known) + i, c) for i, c in enumerate(new)]
            self.store.append(self._column_log, self.store.spark.createDataFrame(log, _COLUMN_LOG).coalesce(1))

    def append(self, frame: DataFrame, run_id: str, replace_run: bool = False) -> None:
        """Add one run's lines: nulls as "", known columns that are missing as "".

        ``replace_run`` makes repeating a load harmless: the run's earlier rows go.
        """
        known = self.columns()
        lower = {c.lower() for c in known}
        new = [c for c in frame.columns if c.lower() not in lower]
        self._record(known, new)
        given = {c.lower(): c for c in frame.columns}
        rows = frame.select(
            *[_text(given.get(c.lower())).alias(c) for c in [*known, *new]],
            F.lit(str(utc_now())).cast("timestamp_ntz").alias("loaded_at"),
            F.lit(run_id).alias("run_id"),
        )
        if replace_run:
            rows.drop("run_id").write.mode("overwrite").parquet(f"{self.location}/run_id={run_id}")
        else:
            rows.write.mode("append").partitionBy("run_id").parquet(self.location)

    def append_runs(self, frame: DataFrame, run: str, columns: Mapping[str, Sequence[str]]) -> None:
        """Add the lines of several runs by one write, as if ``append`` had been called for each in turn.

        ``run`` names the column with a line's run; ``columns`` lists the runs in order, with the columns of the frame that
        each of them brings.
        """
        known = self.columns()
        # The run that brings a column first; earlier runs do not know it.
        first = {c.lower(): -1 for c in known}
        new = []
        for number, brought in enumerate(columns.values()):
            for c in brought:
                if c.lower() not in first:
                    first[c.lower()] = number
                    new.append(c)
        self._record(known, new)
        given = {c.lower(): c for c in frame.columns}
        names = list(columns)

        def value(column: str) -> Column:
            bringing = [r for r in names if any(b.lower() == column.lower() for b in columns[r])]
            later = names[max(first[column.lower()], 0) :]
            text = _text(given[column.lower()]) if bringing else F.lit("")
            if len(bringing) < len(later):
                text = F.when(F.col(run).isin(bringing), text).otherwise(F.lit("")) if bringing else text
            return (F.when(F.col(run).isin(later), text) if len(later) < len(names) else text).alias(column)

        rows = frame.filter(F.col(run).isin(names)).select(
            *[value(c) for c in [*known, *new]],
            F.lit(str(utc_now())).cast("timestamp_ntz").alias("loaded_at"),
            F.col(run).alias("run_id"),
        )
        rows.write.mode("append").partitionBy("run_id").parquet(self.location)

    def read(self) -> DataFrame:
        """Every run, meta columns first; columns newer than a row are null in it."""
        if not self.exists():
            raise ValueError(f"No rows in {self.name} yet")
        rows = self.store.spark.read.schema(self._schema()).parquet(self.location)
        return rows.select(*META_COLUMNS, *[quoted(c) for c in self.columns()])

    def read_run(self, run_id: str) -> DataFrame:
        """One run's lines without the meta columns; only its partition is listed."""
        if not self.exists():
            raise ValueError(f"No rows in {self.name} yet")
        schema, partition = self._schema(), f"{self.location}/run_id={run_id}"
        if path_exists(self.store.spark, partition):
            reader = self.store.spark.read.schema(schema).option("basePath", self.location)
            rows = reader.parquet(partition)
        else:
            rows = self.store.spark.createDataFrame([], schema)
        return rows.drop(*META_COLUMNS)
