"""Writing a table out for people."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import as_text, quoted
from ledgerloom.operators.checkpoints import shuffles_freed


def export_csv(df: DataFrame, path: str, order: Sequence[str], compression: str = "none") -> None:
    """CSV part files that are sorted within and from one to the next.

    The sort is a range exchange; the table is not squeezed through one task to
    get one file. Concatenate the parts in name order where one file is wanted. ``compression`` names one of Spark's codecs.
    """
    ordered = df.orderBy(*[F.col(quoted(c)).asc_nulls_last() for c in order])
    printed = ordered.select(*[as_text(F.col(quoted(f.name)), f.dataType).alias(f.name) for f in df.schema.fields])
    with shuffles_freed(df.sparkSession):
        printed.write.csv(path, header=True, escape='"', emptyValue='""', nullValue="", compression=compression)
