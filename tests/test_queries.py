"""Every registered query against its DuckDB statement on the smallest tables."""

from pathlib import Path

import pytest

import __spark_entry__ as entry
from ledgerloom import oracle
from ledgerloom.plans import queries
from tests.comparison import compare

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="needs the driver's tables")


def test_every_query_has_a_statement():
    assert set(queries.registry()) == set(oracle.statements())
    assert set(queries.registry()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).columns == ["month", "invoices", "total_amount", "tax_amount", "units"]


@pytest.mark.parametrize("name", sorted(queries.registry()))
def test_same_rows(spark, name):
    assert compare(spark, FOLDER, name) is None
