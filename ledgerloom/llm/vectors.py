"""Vectors in whole numbers, whose inner products doubles hold exactly."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Vectors of this squared length and beyond take no part: inner products of the others are exact in doubles.
LONGEST = 2.0**52


def quantised(rows: DataFrame, scale: float) -> DataFrame:
    """rows with v, an array of doubles, as floor(scale * component).

    Rows with a null vector, with a null or non-finite component, or beyond LONGEST are left out.
    """
    odd = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.filter(F.col("v").isNotNull()).filter(~odd)
    # floor() gives integers of 64 bits, which a finite component may exceed.
    fits = F.aggregate("v", F.lit(0.0), lambda total, x: total + (x * scale) * (x * scale)) < 4 * LONGEST
    rows = rows.filter(fits).withColumn("v", F.transform("v", lambda x: F.floor(x * scale).cast("long")))
    return rows.filter(F.aggregate("v", F.lit(0.0), lambda total, x: total + x * x) < LONGEST)


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Vectors as rows of doubles; shorter ones end with zeros."""
    flat, sizes = column.flatten().to_numpy(zero_copy_only=False), np.diff(column.offsets.to_numpy())
    out = np.zeros((len(sizes), width))
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def packed(values: np.ndarray, kind: str) -> pa.Array:
    """One cell that holds an array."""
    return pa.array([np.ascontiguousarray(values).astype(kind).tobytes()], pa.binary())


def best_of_each(who: np.ndarray, names: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The k best entries of each `who`, ties to smaller names, in order; and where an entry is the k-th."""
    best = np.lexsort((names, -scores, who))
    who, names, scores = who[best], names[best], scores[best]
    place = np.arange(len(who)) - np.searchsorted(who, who)
    kept = place < k
    return who[kept], names[kept], scores[kept], np.flatnonzero(place[kept] == k - 1)
