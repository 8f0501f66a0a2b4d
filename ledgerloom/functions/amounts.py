"""Numbers: reading them from text, rounding them to cents, printing them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Text without the letters that only literals of programming languages have
# (``1d``, ``1f``, hexadecimal floats), or a word for infinity.
_PLAIN_NUMBER = r"^(?:[^dDfFxX]*|\s*[+-]?(?i:inf(?:inity)?)\s*)$"

# ``r2`` and ``to_double`` name their argument once. Spark copies a column expression
# into filters that move towards the scan and into the branches of conditions, and
# does not share common parts there: an argument named three times at each of
# three levels would be computed 27 times per row.


def r2(x: Column) -> Column:
    """Round a double to two places: scale by 100, round half away from zero, scale back.

    Rounding the decimal text directly would turn 1.005 into 1.01; scaled first it
    becomes 1.0.
    """
    return F.round(x * F.lit(100.0)) / F.lit(100.0)


def to_cents(x: Column) -> Column:
    """``r2`` in machine arithmetic, for columns and sums: it names its argument several times.

    Spark rounds doubles by way of decimals and their text, which is most of the work of ``r2``.
    """
    scaled = x * F.lit(100.0)
    even = F.rint(scaled)
    # Halves are exact in doubles; rint takes them to even numbers. Adding zero makes a negative zero positive.
    away = F.when(F.abs(scaled - even) == 0.5, scaled + F.signum(scaled) * 0.5).otherwise(even)
    return (away + F.lit(0.0)) / F.lit(100.0)


def to_double(text: Column) -> Column:
    """Text to double, null where it is no number."""
    return F.regexp_extract(text, _PLAIN_NUMBER, 0).try_cast("double")


def as_text(column: Column, data_type: T.DataType) -> Column:
    """The value as a reader would type it into a search box.

    Doubles are the shortest digits that name them, never with an exponent: ``12345678.0``,
    ``0.0001``, ``10000000000000000.0``; everything else is the plain cast.
    """
    if not isinstance(data_type, (T.DoubleType, T.FloatType)):
        return column.cast("string")
    text, size = column.cast("string"), F.abs(column)
    # The formatter pads the shortest digits with zeros; no double has more places.
    plain = F.regexp_replace(F.format_string("%.340f", column), r"(\.\d+?)0+$", "$1")
    # From 1e7 on no double has more than ten places, and decimals are many times faster.
    large = F.regexp_replace(column.cast("double").try_cast("decimal(38,10)").cast("string"), r"(\.\d+?)0+$", "$1")
    return (
        F.when((size == 0) | ((size >= 1e-3) & (size < 1e7)), text)
        .when((size >= 1e7) & (size < 1e20), large)
        .when(F.isnan(column), F.lit("nan"))
        .when(size == F.lit(float("inf")), F.lower(F.replace(text, F.lit("inity"), F.lit(""))))
        .when(text.contains("E"), plain)
        .otherwise(text)
    )
