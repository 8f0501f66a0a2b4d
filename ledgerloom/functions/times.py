"""Dates and times without a zone: the wall clock printed on the document."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A full date, with "-" or "/" between its parts, then optionally a time to the
# minute or finer (with any number of fraction digits, of which six count), and an offset
# that is left out; white space may stand around. The cast alone would also read "2026",
# "now" or a time given only to the hour.
_DATE_TIME = (
    r"^\s*(\d{4}(?:-\d{1,2}-|/\d{1,2}/)\d{1,2}(?:[T ]\d{1,2}:\d{1,2}(?::\d{1,2}(?:\.\d{1,6})?)?)?)"
    r"(?:(?<=\.\d{6})\d+)?"
    r"(?:(?<=:\d{1,2}|\.\d{1,6}|\d{7})\s*(?:Z|UTC|[+-]\d{2}(?::?\d{2})?))?\s*$"
)


def to_timestamp(text: Column) -> Column:
    """Text to ``timestamp_ntz``, null where it is no full date.

    An offset is dropped and the written clock time kept, so that a late-evening
    document stays on its own day whatever the session time zone is.
    """
    return F.replace(F.regexp_extract(text, _DATE_TIME, 1), F.lit("/"), F.lit("-")).try_cast("timestamp_ntz")
