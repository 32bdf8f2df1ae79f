"""Every registered query against its DuckDB twin."""

import pytest

import __spark_entry__ as entry
from compare import check, oracle


@pytest.fixture(scope="module")
def con(sf):
    return oracle(sf)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query_matches_its_twin(spark, con, sf, name):
    rows, problem = check(
        spark, con, sf, name, entry.queries()[name], entry.oracle_sql().get(name)
    )
    assert problem is None


def test_entry_has_rows(spark):
    assert entry.entry(spark).limit(1).count() == 1


def test_every_twin_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
