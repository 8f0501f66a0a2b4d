"""Folders on shared, reliable storage."""

from __future__ import annotations

import re
from collections.abc import Iterator
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import SparkSession


#: The names that scratch_folder gives.
SCRATCH_NAME = re.compile(r"[a-z][a-z0-9-]*-[0-9a-f]{32}")


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``, else the warehouse."""
    return (spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")


def scratch_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder name under the shared folder; nothing is created yet."""
    return f"{shared_folder(spark)}/{purpose}-{uuid4().hex}"


#: Whether Spark removes what a query has shuffled at the end of it, and not once the driver has forgotten the query.
_FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """What is shuffled in here, for writes and counts that nobody runs a second time, goes from the disk as each of them ends."""
    before = spark.conf.get(_FREED, None)
    spark.conf.set(_FREED, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_FREED)
        else:
            spark.conf.set(_FREED, before)
