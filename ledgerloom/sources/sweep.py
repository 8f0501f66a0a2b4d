"""Removal of what failed and replaced runs leave behind.

What is kept is found by reachability: the current version of every table, the lines of runs that
succeeded or still run, and everything younger than a given age, which covers whatever a job
that is under way has written so far. The rest goes folder by folder; a version loses its marker first, so a
sweep that dies half-way leaves nothing that looks complete, and the next one goes on.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators.checkpoints import SCRATCH_NAME, shared_folder
from ledgerloom.sources.files import folders_with_times, path_exists, remove_folder
from ledgerloom.sources.history import LineHistory
from ledgerloom.sources.runs import CREATED, SUCCESS
from ledgerloom.sources.tables import TableStore, utc_now

FOUND = "path string, what string, run_id string, modified timestamp_ntz"


@dataclass(frozen=True)
class Swept:
    """Folders that went, by what they were."""

    versions: int
    staged: int
    runs: int
    scratch: int


def unreachable(store: TableStore, histories: Iterable[LineHistory], runs: DataFrame, before: datetime) -> DataFrame:
    """(path, what) of folders last changed before a moment that nothing leads to."""
    spark = store.spark
    found = []
    for name in {n for n, _ in folders_with_times(spark, store.root)}:
        current = store.versions(name)[-1:]
        for folder, modified in folders_with_times(spark, f"{store.root}/{name}"):
            path = f"{store.root}/{name}/{folder}"
            if folder.startswith("staged="):
                found.append((path, "staged", None, modified))
            elif folder.startswith("version=") and path not in current:
                found.append((path, "versions", None, modified))
    for history in histories:
        for folder, modified in folders_with_times(spark, history.location):
            if folder.startswith("run_id="):
                found.append((f"{history.location}/{folder}", "runs", folder.removeprefix("run_id="), modified))
    for folder, modified in folders_with_times(spark, shared_folder(spark)):
        if SCRATCH_NAME.fullmatch(folder):
            found.append((f"{shared_folder(spark)}/{folder}", "scratch", None, modified))
    # Names of folders; the runs they are held against may be many.
    listed = spark.createDataFrame(found, FOUND).filter(F.col("modified") < F.lit(str(before)).cast("timestamp_ntz"))
    reached = runs.filter(F.col("status").isin(SUCCESS, CREATED)).select("run_id")
    return listed.join(reached, "run_id", "left_anti").select("path", "what")


def sweep(store: TableStore, histories: Iterable[LineHistory], runs: DataFrame, older_than: timedelta) -> Swept:
    """Remove the folders that are older than an age and that nothing leads to."""
    gone = dict.fromkeys(("versions", "staged", "runs", "scratch"), 0)
    for path, what in unreachable(store, histories, runs, utc_now() - older_than).collect():
        remove_marker_first(store.spark, path)
        gone[what] += 1
    return Swept(**gone)


def remove_marker_first(spark: SparkSession, path: str) -> None:
    if path_exists(spark, f"{path}/_SUCCESS"):
        remove_folder(spark, f"{path}/_SUCCESS")
    remove_folder(spark, path)
