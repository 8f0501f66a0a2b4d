"""Rows that belong together, from Arrow batches that are sorted by a column `run`."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def whole_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The sorted rows in tables that hold all rows of their runs."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        runs = batch.column("run").to_numpy()
        last = int(np.flatnonzero(runs == runs[-1])[0])  # the last run may go on in the next batch
        if last or (held and held[-1].column("run")[-1].as_py() != runs[0]):
            yield pa.Table.from_batches([*held, batch.slice(0, last)])
            held = []
        held.append(batch.slice(last))
    if held:
        yield pa.Table.from_batches(held)
