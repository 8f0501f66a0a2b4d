"""Column helpers: pure ``Column -> Column`` functions, no actions."""

from ledgerloom.functions.amounts import as_text, r2, to_cents, to_double
from ledgerloom.functions.names import (
    TABLE_NAME,
    blank_to_null,
    check_table_name,
    provider_id,
    provider_name,
    quoted,
    strip,
)
from ledgerloom.functions.times import to_timestamp

__all__ = [
    "TABLE_NAME",
    "as_text",
    "blank_to_null",
    "check_table_name",
    "provider_id",
    "provider_name",
    "quoted",
    "r2",
    "strip",
    "to_cents",
    "to_double",
    "to_timestamp",
]
