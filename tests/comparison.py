"""Runs a registered query and its DuckDB statement side by side.

    python -m tests.comparison /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

import __spark_entry__ as entry
from ledgerloom.session import local_session

TABLES = [
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
]


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        path = Path(folder) / f"{name}.parquet"
        if path.exists():
            connection.execute(f"create view {name} as select * from '{path}'")
    return connection


def _rows(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(repr(row[i]) for i in order) for row in rows)


def compare(spark: SparkSession, folder: str, name: str) -> str | None:
    """None if both give the same columns and rows, else what differs."""
    found = entry.queries()[name](spark, folder)
    ours = [tuple(r) for r in found.collect()]
    result = duck(folder).execute(entry.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    theirs = result.fetchall()
    if sorted(columns) != sorted(found.columns):
        return f"columns {sorted(found.columns)} against {sorted(columns)}"
    left, right = _rows(found.columns, ours), _rows(columns, theirs)
    if left == right:
        return None
    extra, missing = list((left - right).items())[:2], list((right - left).items())[:2]
    return f"{len(ours)} rows against {len(theirs)}; only here {extra}; only there {missing}"


def main() -> None:
    folder, *names = sys.argv[1:]
    spark = local_session(name="ledgerloom-comparison")
    for name in names or list(entry.queries()):
        if name not in entry.oracle_sql():
            print(f"NONE  {name}")
            continue
        started = time.time()
        try:
            difference = compare(spark, folder, name)
        except Exception as error:  # report and go on with the next query
            difference = f"{type(error).__name__}: {error}"[:1500]
        print(f"{'ok   ' if difference is None else 'DIFF '} {name} {time.time() - started:.1f}s {difference or ''}")


if __name__ == "__main__":
    main()
