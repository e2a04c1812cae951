"""Every registered query against its SQL on the smallest tables."""

import pytest
from __spark_entry__ import oracle_sql, queries
from compare import difference, duck

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(name, spark, con):
    df = queries()[name](spark, SF_DIR)
    sql = oracle_sql().get(name)
    if sql is None:
        assert df.columns
        df.count()
    else:
        assert difference(df, con, sql) is None
