"""Every registered query against its DuckDB oracle (sf0.001, fast)."""

import pytest

import __spark_entry__ as E
from tools.oracle_check import canon_rows, duck

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("key", sorted(E.QUERIES))
def test_query_matches_oracle(spark, con, key):
    df = E.queries()[key](spark, SF)
    cols, rows = df.columns, [tuple(r) for r in df.collect()]
    sql = E.oracle_sql().get(key)
    assert sql is not None, f"{key} has no oracle"
    res = con.sql(sql)
    assert sorted(cols) == sorted(res.columns)
    assert canon_rows(cols, rows) == canon_rows(res.columns, res.fetchall())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
