"""Every query with SQL next to it gives the rows the SQL gives."""

import os

import pytest
from compare import connect, spark_rows, sql_rows

import __spark_entry__ as entry

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.skipif(not os.path.isdir(SF), reason="tables not there")
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_rows_equal(spark, con, name):
    assert spark_rows(QUERIES[name](spark, SF)) == sql_rows(con, ORACLES[name])


def test_entry(spark):
    assert entry.entry(spark).count() > 0
