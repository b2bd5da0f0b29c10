"""Every registered query with a SQL form, compared row by row."""

import pytest
from compare import differences, duck

from lakerisk.plans.catalog import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(data):
    return duck(data)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, data, con, name):
    found = differences(QUERIES[name](spark, data), con, ORACLES[name])
    assert not found, "\n".join(found)


@pytest.mark.parametrize("name", sorted(QUERIES.keys() - ORACLES.keys()))
def test_runs(spark, data, name):
    assert QUERIES[name](spark, data).count() > 0


def test_entry_contract(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
