"""Sums of vectors of a fixed size over all rows of a table."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SLICES = 16


def vector_sum(rows: DataFrame, size: int, vector: Callable[[Iterator[pa.RecordBatch]], np.ndarray]) -> np.ndarray:
    """The sum of vector(batches) over all tasks; vectors hold `size` integers, a multiple of 16.

    Tasks hand over slices of their vectors, which are added up in two steps,
    the first in as many groups a slice as the square root of the cluster's cores.
    """
    step = size // _SLICES
    schema = "slice int, cells binary"

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = vector(batches)
        if total.any():
            parts = [total[k * step : (k + 1) * step].astype(np.int64).tobytes() for k in range(_SLICES)]
            yield pa.record_batch({"slice": pa.array(range(_SLICES), pa.int32()), "cells": pa.array(parts, pa.binary())})

    def add(group: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(step, np.int64)
        for part in group["cells"]:
            total += np.frombuffer(part, np.int64)
        return pd.DataFrame({"slice": group["slice"].iloc[:1].to_numpy(), "cells": [total.tobytes()]})

    parts = rows.mapInArrow(local, schema)
    folds = max(1, math.isqrt(rows.sparkSession.sparkContext.defaultParallelism))
    parts = parts.withColumn("fold", F.spark_partition_id() % folds)
    parts = parts.groupBy("slice", "fold").applyInPandas(add, schema)
    total = np.zeros(size, np.int64)
    for row in parts.groupBy("slice").applyInPandas(add, schema).collect():  # one row per slice
        total[row["slice"] * step : (row["slice"] + 1) * step] = np.frombuffer(row["cells"], np.int64)
    return total
