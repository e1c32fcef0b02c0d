"""Every registered query against its SQL twin on the smallest tables."""

import pytest

import __spark_entry__ as entry
from harness import compare, duck

SF_DIR = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, con, name):
    ok, note = compare(spark, con, QUERIES[name], ORACLES[name], SF_DIR)
    assert ok, note


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).count() == 20
