"""Every registered query with an oracle gives the oracle's rows."""

import pytest
from compare import difference, duck

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.001"
ORACLES = entry.oracle_sql()
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def connection():
    return duck(SF_DIR)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, connection, name):
    actual = QUERIES[name](spark, SF_DIR).toArrow()
    expected = connection.sql(ORACLES[name]).to_arrow_table()
    assert difference(actual, expected) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs_without_oracle(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() == 6
