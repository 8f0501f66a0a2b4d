"""Cell edits: what changed, the changed table, the audit rows."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import as_text, quoted
from ledgerloom.schemas import MANUAL_EDIT, READ_ONLY_TABLES


def refuse_read_only(table_name: str) -> None:
    if table_name in READ_ONLY_TABLES:
        raise ValueError(f"Table {table_name} is read-only")


def require_unique(rows: DataFrame, key: Sequence[str], what: str) -> None:
    """An error if a key names several rows: an edit could not tell them apart."""
    repeated = rows.groupBy(*[quoted(k) for k in key]).agg(F.count("*").alias("rows")).filter("rows > 1")
    if not repeated.isEmpty():
        raise ValueError(f"{what}: {', '.join(key)} names more than one row")


def changed_rows(original: DataFrame, edited: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows with at least one changed cell: the key, then per column its old and new
    value, or null where they agree (two nulls agree). Rows new in ``edited`` are skipped.

    ``key`` must identify a row in both frames.
    """
    types = {f.name: f.dataType for f in original.schema.fields}
    columns = [c for c in edited.columns if c not in key and c in types]
    old, new = original.alias("old"), edited.select(*[quoted(c) for c in [*key, *columns]]).alias("new")
    same_row = [F.col(f"old.{quoted(k)}") == F.col(f"new.{quoted(k)}") for k in key]

    def change(column: str) -> Column:
        before = F.col(f"old.{quoted(column)}")
        after = F.col(f"new.{quoted(column)}").cast(types[column])
        return F.when(~before.eqNullSafe(after), F.struct(before.alias("old"), after.alias("new"))).alias(column)

    compared = old.join(new, same_row, "inner").select(
        *[F.col(f"old.{quoted(k)}").alias(k) for k in key], *[change(c) for c in columns]
    )
    return compared.filter(F.coalesce(*[F.col(quoted(c)).isNotNull() | F.lit(None) for c in columns], F.lit(False)))


def row_id(key: Sequence[str]) -> Column:
    return F.concat_ws("|", *[F.col(quoted(k)).cast("string") for k in key])


def cell_edits(changes: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row per changed cell, old and new value as text, null as ""."""
    cells = []
    for field in changes.schema.fields:
        if field.name in key:
            continue
        cell, inner = F.col(quoted(field.name)), field.dataType["old"].dataType
        # A struct of the same shape for every column; null where nothing changed.
        cells.append(
            F.when(
                cell.isNotNull(),
                F.struct(
                    F.lit(field.name).alias("column_name"),
                    F.coalesce(as_text(cell.getField("old"), inner), F.lit("")).alias("old_value"),
                    F.coalesce(as_text(cell.getField("new"), inner), F.lit("")).alias("new_value"),
                ),
            )
        )
    return changes.select(row_id(key).alias("row_id"), F.inline(F.array_compact(F.array(*cells))))


def apply_changes(table: DataFrame, changes: DataFrame, key: Sequence[str]) -> DataFrame:
    """The table with every changed cell set, also to null, and all else as it is now."""
    columns = [c for c in changes.columns if c not in key]
    renamed = changes.select(*[F.col(quoted(k)) for k in key], *[F.col(quoted(c)).alias(f"_edit {c}") for c in columns])
    joined = table.join(renamed, list(key), "left")

    def value(column: str) -> Column:
        if column not in columns:
            return F.col(quoted(column))
        edit = F.col(quoted(f"_edit {column}"))
        return F.when(edit.isNotNull(), edit.getField("new")).otherwise(F.col(quoted(column))).alias(column)

    return joined.select(*[value(c) for c in table.columns])


def audit_rows(
    edits: DataFrame, table_name: str, edited_by: str, run_id: str | None, at: datetime | None = None
) -> DataFrame:
    """Cell edits in the layout of the audit table; ``at`` is UTC, by default now."""
    moment = at or datetime.now(timezone.utc).replace(tzinfo=None)
    values = {
        "edit_id": F.expr("uuid()"),
        "run_id": F.lit(run_id).cast("string"),
        "table_name": F.lit(table_name),
        "edited_by": F.lit(edited_by),
        # As text, so that the session time zone does not move it.
        "edited_at": F.lit(str(moment)).cast("timestamp_ntz"),
    }
    return edits.select(*[values.get(f.name, F.col(f.name)).alias(f.name) for f in MANUAL_EDIT.fields])
