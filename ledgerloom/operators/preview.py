"""Looking at a table: contains filter, limited preview, counts, description."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import as_text, quoted

# Smallest, usual and largest number of preview rows.
PREVIEW_ROWS = {"least": 10, "usual": 50, "most": 500}
SAMPLE_ROWS = 5


def contains(df: DataFrame, column: str, text: str) -> DataFrame:
    """Rows whose cell, as text, contains ``text`` in any letter case.

    ``%`` and ``_`` in the text are wildcards; a backslash is itself.
    """
    name = next(c for c in df.columns if c.lower() == column.lower())
    pattern = "%" + text.replace("\\", "\\\\") + "%"
    return df.filter(as_text(F.col(quoted(name)), df.schema[name].dataType).ilike(pattern))


def preview(
    df: DataFrame,
    order: Sequence[str],
    column: str | None = None,
    text: str = "",
    limit: int = PREVIEW_ROWS["usual"],
) -> DataFrame:
    """The first rows by ``order``, filtered if both a column and a text are given."""
    if not PREVIEW_ROWS["least"] <= limit <= PREVIEW_ROWS["most"]:
        raise ValueError(f"Preview shows {PREVIEW_ROWS['least']} to {PREVIEW_ROWS['most']} rows")
    rows = contains(df, column, text) if column and text else df
    return rows.orderBy(*[F.col(quoted(c)).asc_nulls_last() for c in order]).limit(limit)


def table_counts(tables: Mapping[str, DataFrame | None]) -> DataFrame:
    """Name and row count of each table that exists."""
    counts = [
        df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table"), "rows")
        for name, df in tables.items()
        if df is not None
    ]
    return reduce(DataFrame.unionByName, counts)


def inspect(df: DataFrame, order: Sequence[str], rows: int = SAMPLE_ROWS) -> DataFrame:
    """Each column's name, type and first values, top to bottom in column order."""
    first = df.orderBy(*[F.col(quoted(c)).asc_nulls_last() for c in order]).limit(rows)
    numbered = first.agg(F.sort_array(F.collect_list(F.struct(*order, F.struct(*df.columns).alias("row")))).alias("all"))
    lines = numbered.select(F.posexplode("all").alias("sample", "line")).select("sample", "line.row.*")
    cells = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            as_text(F.col(quoted(f.name)), f.dataType).alias("value"),
        )
        for i, f in enumerate(df.schema.fields)
    ]
    return lines.select("sample", F.inline(F.array(*cells)))
