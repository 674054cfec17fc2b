"""Every registered query against its SQL twin."""

import pytest
from __spark_entry__ import entry, oracle_sql, queries
from check import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, con, name):
    df = queries()[name](spark, SF)
    sql = oracle_sql().get(name)
    if sql is None:
        assert df.count() > 0
    else:
        problem = compare(df, con, sql)
        assert problem in ("", "no rows"), problem


def test_entry(spark):
    assert entry(spark).count() > 0
