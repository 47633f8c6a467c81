"""Every registered query beside its SQL twin, on the smallest tables, and without a cross join."""

import importlib.util
import os

import duckdb
import pytest

from quayside.plans import all_queries

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
spec = importlib.util.spec_from_file_location("check", os.path.join(ROOT, "tools", "check.py"))
check = importlib.util.module_from_spec(spec)
spec.loader.exec_module(check)
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db() -> duckdb.DuckDBPyConnection:
    return check.connect(SF)


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query(spark, db, name):
    query = all_queries()[name]
    df = query.run(spark, SF)
    columns = sorted(df.columns)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    wanted = db.sql(query.sql)
    assert columns == sorted(wanted.columns)
    got = check.rows_of(columns, df.select(*[f"`{c}`" for c in columns]).collect())
    assert got == check.rows_of(columns, wanted.select(*[f'"{c}"' for c in columns]).fetchall())
