"""Every registered query with SQL equals DuckDB on the same parquet tables (sf0.001),
and its executed plan contains no row-wise Python UDF evaluation."""

import pytest

from leadlens.plans import oracle_sql, queries
from tests.conftest import SF_SMALL
from tests.oracle_compare import compare, duck

SQL = oracle_sql()
ALL = queries()
PY_ROW_NODES = ("BatchEvalPython", "ArrowEvalPython", "PythonUDF")


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_sql_key_is_a_query():
    assert set(SQL) <= set(ALL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_duckdb(spark, con, name):
    df = ALL[name](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(n in plan for n in PY_ROW_NODES), plan
    r = compare(spark, name, lambda s, d: df, SQL[name], SF_SMALL, con, verbose=True)
    assert r["ok"], r
