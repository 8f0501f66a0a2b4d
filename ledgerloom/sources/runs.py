"""Run log: one event per change, current state by aggregation.

Nothing is updated in place. A run's rows are written before its success event,
so whatever dies half-way leaves readers on the last successful run.

Every event is a small file. Once there are many, they are folded into a snapshot, which names the files it took in;
readers take the snapshot and the files that it does not name. Those files are deleted by the fold after it, so that
two folds at once, or one that dies, lose nothing.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from uuid import uuid4

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.schemas import PIPELINE_RUN
from ledgerloom.sources.files import file_names, remove_folder
from ledgerloom.sources.tables import TableStore, utc_now

# What an event says about its run.
CREATED, SUCCESS, FAILED, SELECTED = "running", "success", "failed", "selected"

# The table of folded events, and the event that names a file they come from.
SNAPSHOT, FOLDED = "pipeline_runs_snapshot", "folded"

COUNTS = [f.name for f in PIPELINE_RUN.fields if isinstance(f.dataType, T.IntegerType)]
OUTCOME = ["status", "finished_at", *COUNTS, "derived_table_counts_json", "error_message"]
RUN_EVENT = T.StructType(
    [
        T.StructField("event", T.StringType()),
        T.StructField("at", T.TimestampNTZType()),
        *[f for f in PIPELINE_RUN.fields if f.name not in ("status", "selected_run")],
    ]
)


def run_states(events: DataFrame) -> DataFrame:
    """One row per run: how it began, its latest outcome, whether it is selected.

    A run is selected by its success or by hand, until another run is. The newest
    selecting event of the whole log is a single value, read as a scalar subquery.
    """
    at, event = F.col("at"), F.col("event")
    began, ended = event == CREATED, event.isin(SUCCESS, FAILED)
    selecting = event.isin(SUCCESS, SELECTED)
    outcome = F.struct(event.alias("status"), *[F.col(c) for c in OUTCOME if c != "status"])
    runs = events.groupBy("run_id").agg(
        F.min(F.when(began, F.struct("started_at", "client_id", "run_type", "started_by"))).alias("start"),
        F.max_by(F.when(ended, outcome), F.when(ended, at)).alias("last"),
        F.max(F.when(selecting, F.struct(at, F.col("run_id").alias("run")))).alias("selected_at"),
    )
    newest = events.filter(selecting).agg(F.max(F.struct(at, F.col("run_id").alias("run")))).scalar()
    status = F.coalesce(F.col("last.status"), F.lit(CREATED))
    selected = F.coalesce(F.col("selected_at") == newest, F.lit(False)) & (status == SUCCESS)
    values: dict[str, Column] = {
        "status": status,
        "selected_run": selected,
        **{c: F.col(f"start.{c}") for c in ("client_id", "run_type", "started_at", "started_by")},
        **{c: F.col(f"last.{c}") for c in OUTCOME if c != "status"},
    }
    return runs.select(*[values.get(f.name, F.col(f.name)).alias(f.name) for f in PIPELINE_RUN.fields])


def folded(events: DataFrame) -> DataFrame:
    """The events that ``run_states`` needs of these: of each run the first beginning, the last outcome and
    the last selection. Later events can be added to them as to all the events."""
    at, event = F.col("at"), F.col("event")
    row = F.struct(*RUN_EVENT.names)
    began, ended, selecting = event == CREATED, event.isin(SUCCESS, FAILED), event.isin(SUCCESS, SELECTED)
    start = F.struct("started_at", "client_id", "run_type", "started_by")
    kept = events.groupBy("run_id").agg(
        F.min_by(row, F.when(began, start)).alias("start"),
        F.max_by(row, F.when(ended, at)).alias("last"),
        F.max_by(row, F.when(selecting, at)).alias("chosen"),
    )
    rows = F.array_distinct(F.array_compact(F.array("start", "last", "chosen")))
    return kept.select(F.inline(rows))


def newest_first(runs: DataFrame) -> DataFrame:
    """The listing shown to a user."""
    return runs.select(
        "run_id",
        "client_id",
        "run_type",
        "status",
        "started_at",
        "finished_at",
        "started_by",
        "selected_run",
        "invoice_rows_loaded",
        "credit_note_rows_loaded",
        "error_message",
    ).orderBy(F.desc_nulls_last("started_at"), "run_id")


def selected_run(runs: DataFrame) -> DataFrame:
    """The selected successful run, else the newest successful one: at most one row."""
    return (
        runs.filter(F.col("status") == SUCCESS)
        .orderBy(F.desc("selected_run"), F.desc_nulls_last("started_at"), "run_id")
        .limit(1)
        .select("run_id")
    )


def run_labels(runs: DataFrame) -> DataFrame:
    """Text that names each successful run in a list."""

    def rows(column: str) -> Column:
        return F.format_number(F.coalesce(F.col(column), F.lit(0)), 0)

    moment = F.date_format("started_at", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    label = F.concat(
        F.regexp_replace(moment, r"\.000000$", ""),
        F.lit(" | invoices: "),
        rows("invoice_rows_loaded"),
        F.lit(" | credit notes: "),
        rows("credit_note_rows_loaded"),
    )
    return runs.filter(F.col("status") == SUCCESS).select("run_id", label.alias("run_label"))


def status_counts(runs: DataFrame) -> DataFrame:
    return runs.groupBy("status").agg(F.count("*").alias("runs"))


class RunLog:
    #: Files of events that are read one by one before they are folded.
    KEEP = 64

    def __init__(self, store: TableStore):
        self.store = store

    def _record(self, event: str, run_id: str, **values) -> None:
        row = {"event": event, "at": utc_now(), "run_id": run_id, **values}
        frame = self.store.spark.createDataFrame([tuple(row.get(f.name) for f in RUN_EVENT.fields)], RUN_EVENT)
        self.store.append("pipeline_runs", frame.coalesce(1))
        if len(self._files()) > 2 * self.KEEP:
            self.fold()

    @property
    def _folder(self) -> str:
        return f"{self.store.path('pipeline_runs')}/rows"

    def _files(self) -> list[str]:
        return file_names(self.store.spark, self._folder)

    def _snapshot(self) -> tuple[DataFrame, set[str]]:
        """The folded events, and the names of the files they come from that may still be there."""
        found = self.store.find(SNAPSHOT)
        if found is None:
            return self.store.spark.createDataFrame([], RUN_EVENT), set()
        names = found.filter(F.col("event") == FOLDED).select("run_id").collect()
        return found.filter(F.col("event") != FOLDED), {r.run_id for r in names}

    def fold(self) -> None:
        """Take the events so far into a new snapshot, and delete the files of the one before."""
        snapshot, taken = self._snapshot()
        files = self._files()
        names = [(FOLDED, None, f) for f in files]
        marks = self.store.spark.createDataFrame(names, "event string, at timestamp_ntz, run_id string")
        rows = folded(self._events(snapshot, taken, files)).unionByName(marks, allowMissingColumns=True)
        self.store.publish(SNAPSHOT, rows.coalesce(1))
        for name in taken.intersection(files):
            remove_folder(self.store.spark, f"{self._folder}/{name}")

    def create(
        self, client_id: str, username: str, run_type: str = "full_pipeline", run_id: str | None = None
    ) -> str:
        run_id = run_id or str(uuid4())
        self._record(
            CREATED, run_id, client_id=client_id, run_type=run_type, started_by=username, started_at=utc_now()
        )
        return run_id

    def succeed(self, run_id: str, counts: Mapping[str, int], derived: Mapping[str, int]) -> None:
        as_json = json.dumps(dict(derived), sort_keys=True)
        self._record(SUCCESS, run_id, finished_at=utc_now(), derived_table_counts_json=as_json, **counts)

    def fail(self, run_id: str, message: str) -> None:
        self._record(FAILED, run_id, finished_at=utc_now(), error_message=message)

    def select(self, run_id: str) -> None:
        """Make a successful run the current one; any other run is refused."""
        if self.runs().filter((F.col("run_id") == run_id) & (F.col("status") == SUCCESS)).isEmpty():
            raise ValueError(f"Run {run_id} did not succeed and cannot be selected")
        self._record(SELECTED, run_id)

    def _events(self, snapshot: DataFrame, taken: set[str], files: list[str]) -> DataFrame:
        later = [f"{self._folder}/{f}" for f in files if f not in taken]
        if not later:
            return snapshot
        return snapshot.unionByName(self.store.spark.read.schema(RUN_EVENT).parquet(*later))

    def events(self) -> DataFrame:
        """The snapshot's events and those after it."""
        snapshot, taken = self._snapshot()
        return self._events(snapshot, taken, self._files())

    def runs(self) -> DataFrame:
        return run_states(self.events())

    def selected(self) -> str | None:
        row = selected_run(self.runs()).first()
        return row.run_id if row else None
