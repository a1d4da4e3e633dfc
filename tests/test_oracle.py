"""Every registered query against its SQL counterpart, on whole tables."""

import os

import pytest
from compare import difference, sql_connection

import __spark_entry__ as entry
from gridtally import catalog

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
QUERIES = {name: fn for name, fn in entry.queries().items() if name in catalog.QUERIES}
ORACLES = catalog.ORACLES

# Cross joins, pairwise loops and Python in the plan.
UNWANTED = ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "MapInPandas", "FlatMapGroups")

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="sample tables are not here")


@pytest.fixture(scope="module")
def con():
    return sql_connection(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows(spark, con, name):
    df = QUERIES[name](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [node for node in UNWANTED if node in plan]
    assert difference(df, con, ORACLES[name]) is None


def test_entry(spark):
    assert {r["tariff_code"] for r in entry.entry(spark).collect()} == {"Std", "ToU"}
