"""Optional removal of repeated lines: one row per (document number, line number).

Both forms keep the first row of each pair and every row with neither key, in one pass:
rows without keys get a number of their own beside the keys, so they are dealt out
evenly, and the ``row_number() = 1`` filter lets Spark keep one row per pair and task
before the shuffle, so one pair repeated a billion times does not land in a single task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions import quoted, strip
from ledgerloom.operators.columns import require_columns

PAIR = ["NumeroConsecutivo", "NumeroLinea"]


def _first_of_pair(df: DataFrame, keys: Sequence[Column], order: Sequence[Column]) -> DataFrame:
    blank = [F.coalesce(k, F.lit("")) == "" for k in keys]
    alone = F.when(blank[0] & blank[1], F.monotonically_increasing_id())
    rank = F.row_number().over(Window.partitionBy(*keys, "_alone").orderBy(*order))
    ranked = df.withColumn("_alone", alone).withColumn("_rank", rank)
    return ranked.filter(F.col("_rank") == 1).drop("_rank", "_alone")


def dedupe_lines(raw: DataFrame) -> DataFrame:
    """Keep the line from the first source file; keys are compared after ``trim``.

    The other columns break ties, so that the same input always gives the same rows.
    """
    require_columns(raw, PAIR, "Line table")
    keys = [F.trim(F.col(c).cast("string")) for c in PAIR]
    rest = [c for c in raw.columns if c.lower() != "sourcefile"]
    order = [F.col(quoted(c)).asc_nulls_last() for c in ["SourceFile", *rest]]
    return _first_of_pair(raw, keys, order)


def dedupe_keep_first(frame: DataFrame, sequence: Sequence[str]) -> DataFrame:
    """Keep the row loaded first; keys are stripped of all white space and stay so.

    ``sequence`` names the columns that give the load order.
    """
    require_columns(frame, [*PAIR, *sequence], "Line table")
    stripped = frame.withColumns({c: F.coalesce(strip(F.col(c).cast("string")), F.lit("")) for c in PAIR})
    order = [F.col(quoted(c)).asc_nulls_last() for c in sequence]
    return _first_of_pair(stripped, [F.col(c) for c in PAIR], order)


def duplicate_count(frame: DataFrame) -> DataFrame:
    """One row: lines read, lines removed and lines kept by ``dedupe_keep_first``.

    Counts distinct pairs instead of removing anything: only keys are shuffled.
    """
    require_columns(frame, PAIR, "Line table")
    keys = {c: F.coalesce(strip(F.col(c).cast("string")), F.lit("")) for c in PAIR}
    copies = frame.select(*[k.alias(c) for c, k in keys.items()]).groupBy(*PAIR).agg(F.count("*").alias("n"))
    unkeyed = (F.col(PAIR[0]) == "") & (F.col(PAIR[1]) == "")
    kept = F.when(unkeyed, F.col("n")).otherwise(F.lit(1))
    return copies.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows_uploaded"),
        F.coalesce(F.sum(F.col("n") - kept), F.lit(0)).alias("duplicates_removed"),
        F.coalesce(F.sum(kept), F.lit(0)).alias("rows_loaded"),
    )
