"""Driver contract: entry(), every registered query against its DuckDB oracle, and plan shape."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from strata.plans.catalog import QUERIES  # noqa: E402
from check_oracle import TABLES, digest  # noqa: E402

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["department_id", "department_name", "headcount", "active_count", "avg_salary",
                          "attrition_count", "refresh_ts"]


def test_every_query_has_oracle():
    assert set(QUERIES) <= set(E.oracle_sql())


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle_and_plan(spark, duck, key):
    df = E.queries()[key](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(n in plan for n in PYTHON_NODES), key
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan, key
    rows = [tuple(r) for r in df.collect()]
    res = duck.execute(E.oracle_sql()[key])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows)[0] == digest(ocols, orows)[0]
