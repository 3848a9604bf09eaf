"""Every registered query against its SQL counterpart."""

import pytest
from conftest import SF
from oracle_check import connect, differences

import __spark_entry__ as entry
from assaylake.registry.oracle import ORACLE
from assaylake.registry.queries import QUERIES


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, con, name):
    assert differences(QUERIES[name](spark, SF), con, ORACLE[name]) == []


def test_every_query_of_the_lake_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_returns_rows(spark):
    assert entry.entry(spark).count() == 5
