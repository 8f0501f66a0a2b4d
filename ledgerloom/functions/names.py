"""Text helpers: blanks, provider identity, table names."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the shape of an acceptable table name.
TABLE_NAME = r"^[A-Za-z_][A-Za-z0-9_]*$"
# Fixed value: runs of characters replaced by one underscore in a derived provider id.
_NOT_ALPHANUMERIC = "[^A-Za-z0-9]+"


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def strip(text: Column) -> Column:
    """Drop white space of every kind at both ends (``trim`` drops spaces only)."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def provider_name(trade_name: Column, legal_name: Column) -> Column:
    """Trade name unless it is empty; neither name is trimmed."""
    return F.coalesce(blank_to_null(trade_name), legal_name)


def provider_id(identification: Column, name: Column) -> Column:
    """The tax identification, or a slug of the name where there is none."""
    slug = F.lower(F.regexp_replace(name, _NOT_ALPHANUMERIC, "_"))
    return F.coalesce(blank_to_null(identification), slug)


def check_table_name(name: str) -> str:
    cleaned = name.strip()
    if not re.fullmatch(TABLE_NAME, cleaned):
        raise ValueError(f"Not a table name: {name!r} (letters, digits and underscores, no leading digit)")
    return cleaned


def quoted(identifier: str) -> str:
    """Back-quote a column name so that spaces, dots and percent signs are literal."""
    return "`" + identifier.replace("`", "``") + "`"
