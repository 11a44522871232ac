"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from catalog.compare import both_sides, open_tables
from catalog.registry import ORACLES, QUERIES
from tests.conftest import SF


@pytest.fixture(scope="module")
def db():
    return open_tables(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, db, name):
    left, right = both_sides(entry.queries()[name](spark, SF), db, entry.oracle_sql()[name])
    assert left[0] == right[0]
    assert left[1] == right[1]


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries())


def test_entry_returns_cells(spark):
    frame = entry.entry(spark)
    assert frame.columns == ["row_key", "family", "qualifier", "ts_micros", "value_hex"]
    assert frame.count() > 0
