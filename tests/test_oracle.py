"""Every query with SQL returns what that SQL returns on the same tables, without cross products or per-row Python."""

import duckdb
import pytest

import check_queries as ck
from rillmark.plans.registry import ORACLES, QUERIES, load_all

load_all()


@pytest.fixture(scope="module")
def con(sf):
    return ck.connect(sf)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con: duckdb.DuckDBPyConnection, sf, name):
    df = QUERIES[name](spark, sf)
    result = con.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    want = ck.rows_of(columns, result.fetchall())
    text = df._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert bad not in text
    got = ck.rows_of(df.columns, [tuple(r) for r in df.collect()])
    assert got == want


def test_entry_is_stable(spark):
    import __spark_entry__ as e
    assert e.entry(spark).columns[0] == "user_id"
    assert set(e.oracle_sql()) <= set(e.queries())
