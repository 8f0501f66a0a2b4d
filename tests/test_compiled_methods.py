"""Queries over order lines run in methods that the JVM compiles, whatever the session was given."""

import pytest

from __spark_entry__ import queries

LIMIT = "spark.sql.codegen.hugeMethodLimit"
SMALLEST = "/root/testdata/sf0.001"


@pytest.fixture
def limit(spark):
    before = spark.conf.get(LIMIT)
    yield lambda value: spark.conf.set(LIMIT, value)
    spark.conf.set(LIMIT, before)


@pytest.mark.parametrize("name", ["price_history", "providers"])
def test_sessions_that_left_the_limit_alone_get_one(spark, limit, name):
    limit("65535")
    queries()[name](spark, SMALLEST)
    assert int(spark.conf.get(LIMIT)) <= 8000


def test_other_limits_stay(spark, limit):
    limit("5000")
    queries()["price_history"](spark, SMALLEST)
    assert spark.conf.get(LIMIT) == "5000"
