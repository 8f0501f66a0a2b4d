import decimal
import math

import duckdb
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from __spark_entry__ import queries
from ledgerloom.functions import as_text, check_table_name, provider_id, quoted, r2, strip, to_cents, to_double, to_timestamp


def _column(spark, values, kind, make):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.r for r in frame.select("i", make(F.col("v")).alias("r")).orderBy("i").collect()]


def test_rounding_matches_scale_and_round(spark):
    values = [1.005, 2.675, 0.125, -0.125, -1.005, 0.285, 1e17, 12.345, None] + [i / 200 for i in range(-999, 999)]
    expected = [duckdb.execute("select round(?::double, 2)", [v]).fetchall()[0][0] for v in values]
    assert _column(spark, values, "double", r2) == expected


def test_rounding_keeps_non_finite(spark):
    found = _column(spark, [float("inf"), float("-inf"), float("nan")], "double", r2)
    assert found[:2] == [math.inf, -math.inf] and math.isnan(found[2])


def test_cents_are_what_rounding_gives(spark):
    odd = [0.0, -0.0, -0.001, 0.0049999999999999994, 0.005, 0.015, 0.025, -0.005, -0.025, 45035996273704.955, 9e15, 1e17, 1e300, 5e-324]
    values = [*odd, math.inf, -math.inf, math.nan, None, *[i / 200 for i in range(-999, 999)], *[i * 0.1 * 512.5 for i in range(999)]]
    assert list(map(repr, _column(spark, values, "double", to_cents))) == list(map(repr, _column(spark, values, "double", r2)))


def test_large_numbers_in_shortest_digits(spark):
    values = [1e7, -1e7, 12345678.91, 9999999.999999998, 10000000.000000002, 123456789012345.67, -98765432.1, 2.0**53, 0.001, 0.0]
    expected = [format(decimal.Decimal(repr(v)), "f") for v in values]
    assert _column(spark, values, "double", lambda c: as_text(c, T.DoubleType())) == [x if "." in x else f"{x}.0" for x in expected]


def test_amounts_are_not_rounded_by_way_of_decimals(spark):
    lines = queries()["clean_invoice_lines"](spark, "/root/testdata/sf0.001")
    assert "round(" not in lines._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize(
    ("text", "number"),
    [
        ("1.005", 1.005),
        (" 12 ", 12.0),
        ("1e3", 1000.0),
        (".5", 0.5),
        ("-3", -3.0),
        ("inf", math.inf),
        ("-Infinity", -math.inf),
        *[(t, None) for t in ("", " ", "1,200", "1d", "1f", "2D", "0x1p3", "1_000", "abc", "1 2", None)],
    ],
)
def test_text_to_number(spark, text, number):
    assert _column(spark, [text], "string", to_double) == [number]


def test_nan_is_read(spark):
    assert math.isnan(_column(spark, ["NaN"], "string", to_double)[0])


@pytest.mark.parametrize(
    ("text", "moment"),
    [
        ("2026-01-15", "2026-01-15 00:00:00"),
        ("2026-01-15T22:30:00-06:00", "2026-01-15 22:30:00"),
        ("2026-01-15T22:30:00Z", "2026-01-15 22:30:00"),
        ("2026-01-15 22:30", "2026-01-15 22:30:00"),
        ("2026-01-15T10:00:00.123456-06:00", "2026-01-15 10:00:00.123456"),
        ("2026-01-15T10:00:00.1234567890Z", "2026-01-15 10:00:00.123456"),
        ("2026-01-15T10:00:00.1234567891234", "2026-01-15 10:00:00.123456"),
        ("2026-01-15 ", "2026-01-15 00:00:00"),
        ("2026-01-15T10:00:00 ", "2026-01-15 10:00:00"),
        ("2026/01/15", "2026-01-15 00:00:00"),
        ("2026/1/5 10:00:00", "2026-01-05 10:00:00"),
        *[(t, None) for t in ("2026", "2026-01", "now", "2026-01-15T10", "2026-02-30", "", "x", "2026-01/15", None)],
    ],
)
def test_text_to_time_keeps_the_wall_clock(spark, text, moment):
    spark.conf.set("spark.sql.session.timeZone", "America/Costa_Rica")
    try:
        found = _column(spark, [text], "string", to_timestamp)[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert (None if found is None else str(found)) == moment


def test_numbers_as_text(spark):
    values = [12.5, 12345678.0, -12345678.55, 0.01, 1e15, 0.0, float("nan"), float("-inf"), None]
    expected = ["12.5", "12345678.0", "-12345678.55", "0.01", "1000000000000000.0", "0.0", "nan", "-inf", None]
    values += [12345678.12345678, 0.0001, -1.25e-7, 1e16, 1.5e17, -1.2345e20, float("inf")]
    expected += ["12345678.12345678", "0.0001", "-0.000000125", "10000000000000000.0", "150000000000000000.0"]
    expected += ["-123450000000000000000.0", "inf"]
    assert _column(spark, values, "double", lambda c: as_text(c, T.DoubleType())) == expected


def test_provider_id(spark):
    rows = [("7", "x"), ("", "Café & Cía. S.A."), (None, "A  b"), ("", None)]
    frame = spark.createDataFrame(rows, "id string, name string")
    found = [r.p for r in frame.select(provider_id(F.col("id"), F.col("name")).alias("p")).collect()]
    assert found == ["7", "caf_c_a_s_a_", "a_b", None]


def test_strip_drops_every_white_space(spark):
    assert _column(spark, ["\t a b \n"], "string", strip) == ["a b"]


def test_names():
    assert check_table_name(" lines_1 ") == "lines_1"
    for bad in ("1a", "a-b", "a;b", ""):
        with pytest.raises(ValueError):
            check_table_name(bad)
    assert quoted("a`b") == "`a``b`"
