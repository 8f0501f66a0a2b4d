"""Working with whichever columns a raw table happens to have."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def has_column(df: DataFrame, name: str) -> bool:
    """Column test that ignores case."""
    return name.lower() in {c.lower() for c in df.columns}


def missing_columns(df: DataFrame, required: Iterable[str]) -> list[str]:
    return [name for name in required if not has_column(df, name)]


def require_columns(df: DataFrame, required: Iterable[str], what: str) -> DataFrame:
    missing = missing_columns(df, required)
    if missing:
        raise ValueError(f"{what} lacks columns: {', '.join(missing)}")
    return df


def with_optional_columns(df: DataFrame, defaults: Mapping[str, str | None]) -> DataFrame:
    """Add each absent column with its default; columns that exist keep their values."""
    absent = {n: F.lit(d).cast("string") for n, d in defaults.items() if not has_column(df, n)}
    return df.withColumns(absent) if absent else df
