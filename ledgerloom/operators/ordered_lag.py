"""``lag`` over groups of any size.

A window would keep each group in one task, and a single product may hold a third of
all rows. So rows are dealt out by ranges of (group, order): a task gets a stretch of
that order, whichever groups it cuts through, and shifts its own rows by one. What a stretch
lacks is the row before its first one, which is the last row of the stretch before. One
such row a task is all that is carried over.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.operators.checkpoints import scratch_folder


def ranged(rows: DataFrame, columns: Sequence[str], tasks: int | None = None) -> DataFrame:
    """Rows in the order of the columns, nulls last, dealt out in stretches of about equal size.

    Rows that agree in all columns are told apart by the task they come from, so that not even
    one row repeated over and over stays together.
    """
    salted = rows.withColumn("_salt", F.spark_partition_id())
    order = [F.col(c).asc_nulls_last() for c in [*columns, "_salt"]]
    dealt = salted.repartitionByRange(*([tasks] if tasks else []), *order)
    return dealt.sortWithinPartitions(*order).drop("_salt")


def _equal(a: pa.Array, b: pa.Array) -> pa.Array:
    """Whether values are the same, as in a grouping: nulls and NaN are like themselves."""
    same = pc.or_(pc.fill_null(pc.equal(a, b), False), pc.and_(pc.is_null(a), pc.is_null(b)))
    if pa.types.is_floating(a.type):
        same = pc.or_(same, pc.fill_null(pc.and_(pc.is_nan(a), pc.is_nan(b)), False))
    return same


def with_previous(
    rows: DataFrame, group: Sequence[str], order: Sequence[str], previous: dict[str, str], tasks: int | None = None
) -> DataFrame:
    """Add a column ``previous[c]``: the value of ``c`` in the row before, within ``group``.

    Nulls of ``order`` come last; rows that agree in it are put in the order of the values carried over.
    The shifted rows are written to the shared folder, so that the stretches are the same for all that reads
    them. ``tasks`` sets the number of stretches, else the session does.
    """
    carried = [c for c in previous if c not in (*group, *order)]
    stretches = ranged(rows, [*group, *order, *carried], tasks)
    names = list(previous.values())
    kinds = [T.StructField(n, rows.schema[c].dataType) for c, n in previous.items()]
    marks = [T.StructField("_first", T.IntegerType()), T.StructField("_last", T.IntegerType())]

    def shift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        before: pa.RecordBatch | None = None
        held: list | None = None
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue

            def moved(column: str, batch=batch, n=n) -> pa.Array:
                own = batch.column(column)
                ahead = pa.nulls(1, own.type) if before is None else before.column(column)
                return pa.concat_arrays([ahead, own.slice(0, n - 1)])

            same = pa.array([before is not None] + [True] * (n - 1))
            for column in group:
                same = pc.and_(same, _equal(batch.column(column), moved(column)))
            values = [pc.if_else(same, moved(c), pa.nulls(n, batch.column(c).type)) for c in previous]
            first = pa.array([task if before is None else None] + [None] * (n - 1), pa.int32())
            if held is not None:
                yield pa.RecordBatch.from_arrays(*held)
            held = [[*batch.columns, *values, first, pa.nulls(n, pa.int32())], [*batch.schema.names, *names, "_first", "_last"]]
            before = batch.slice(n - 1)
        if held is not None:
            held[0][-1] = pa.array([None] * (len(held[0][-1]) - 1) + [task], pa.int32())
            yield pa.RecordBatch.from_arrays(*held)

    shifted = stretches.mapInArrow(shift, T.StructType([*rows.schema.fields, *kinds, *marks]))
    path = scratch_folder(rows.sparkSession, "stretches")
    shifted.write.parquet(path)
    shifted = rows.sparkSession.read.schema(shifted.schema).parquet(path)
    # One row for each task that had any; the next such task needs it.
    ends = shifted.filter("_last is not null").withColumn("_to", F.lead("_last").over(Window.orderBy("_last")))
    ends = ends.select("_to", F.struct(*group).alias("_group"), *[F.col(c).alias(f"_carried {n}") for c, n in previous.items()])
    joined = shifted.join(F.broadcast(ends.filter("_to is not null")), F.col("_first") == F.col("_to"), "left")
    goes_on = F.col("_first").isNotNull() & F.col("_group").eqNullSafe(F.struct(*group))
    values = {n: F.when(goes_on, F.col(f"`_carried {n}`")).otherwise(F.col(n)) for n in names}
    return joined.withColumns(values).select(*rows.columns, *names)
