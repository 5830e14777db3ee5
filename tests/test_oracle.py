"""Every registered query against DuckDB on the smallest test tables, and what its plan must not contain."""

import os

import pytest

import __spark_entry__ as driver
from checks import oracle, registry
from checks.compare import connect, difference

# No Python workers, no all-pairs joins.
UNWANTED = (
    "ArrowEvalPython",
    "BatchEvalPython",
    "MapInPandas",
    "FlatMapGroupsInPandas",
    "ExistingRDD",
    "BroadcastNestedLoopJoin",
    "CartesianProduct",
)
SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_a_statement():
    assert registry.queries().keys() == oracle.oracle_sql().keys()


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_matches_duckdb(spark, duck, name):
    df = driver.queries()[name](spark, SF_DIR)
    assert difference(df, duck, name) is None
    plan = df._jdf.queryExecution().toString()
    assert [operator for operator in UNWANTED if operator in plan] == []


def test_entry(spark):
    result = driver.entry(spark)
    assert result.columns[:3] == ["city", "total_orders", "gmv"]
    assert result.count() > 0
