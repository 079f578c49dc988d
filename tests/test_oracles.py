"""Every registered query against its SQL on the smallest tables."""

import os

import __spark_entry__ as entry
import pytest
from compare import connect, difference

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, duck, name):
    assert difference(QUERIES[name](spark, SF_DIR), duck, ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_gives_rows(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).columns == ["word", "total_frequency", "position"]
