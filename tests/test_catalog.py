"""Every registered query against its SQL on the smallest given tables."""

import os

import pytest
from oracle import compare, duck

import __spark_entry__ as entry

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    result = QUERIES[name](spark, FOLDER)
    if name in ORACLES:
        assert compare(result, ORACLES[name], con) == []
    else:
        assert result.count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
