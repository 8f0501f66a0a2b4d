"""Providers are put together from hash aggregates; only few rows are sorted for the least of a text."""

import pytest

from __spark_entry__ import queries
from ledgerloom.plans.queries import DerivedTables, Tables

SMALLEST = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["providers", "provider_overview"])
def test_lines_are_not_sorted_for_names(spark, name):
    plan = queries()[name](spark, SMALLEST)._jdf.queryExecution().executedPlan().toString().splitlines()
    at = {kind: [i for i, line in enumerate(plan) if kind in line] for kind in ("SortAggregate", "HashAggregate")}
    # Two steps of both kinds follow upon the lines; those that sort come last, which is on top.
    assert at["HashAggregate"] and max(at["SortAggregate"], default=-1) < min(at["HashAggregate"])


def test_lines_are_put_together_once_for_two_builds(spark):
    plan = queries()["providers_credit_carry"](spark, SMALLEST)._jdf.queryExecution().optimizedPlan().toString()
    assert "l_orderkey" not in plan


def test_prices_of_all_providers_do_not_put_lines_in_order(spark):
    files = queries()["provider_product_prices"](spark, SMALLEST).inputFiles()
    assert files and not any("/provider_lines/" in f for f in files)


def test_tables_that_are_counted_are_made_of_the_columns_they_read(spark):
    lines = DerivedTables(spark, SMALLEST).lines
    assert len(lines.columns) == 14 and lines.count() == Tables(spark, SMALLEST).lines.count()
