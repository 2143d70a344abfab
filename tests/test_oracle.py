"""Every registered query against the same query in DuckDB, on the smallest tables."""

import pytest

import __spark_entry__ as contract
from stratalake import registry
from tests.oracle import connect, differences

DATA = contract.SMALL_DATA


@pytest.fixture(scope="module")
def duck():
    return connect(DATA)


def test_every_query_has_sql():
    assert set(registry.oracle_sql()) == set(registry.queries())
    assert set(registry.queries()) <= set(contract.queries())


def test_flagship_returns_rows(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", registry.queries())
def test_same_result_as_duckdb(spark, duck, name):
    found = differences(contract.queries()[name](spark, DATA), duck, contract.oracle_sql()[name])
    assert not found


@pytest.mark.parametrize("name", registry.queries())
def test_plans_stay_in_the_jvm(spark, name):
    plan = contract.queries()[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    for python_node in ("PythonUDF", "InPandas", "InArrow", "ArrowEvalPython", "CartesianProduct", "NestedLoopJoin"):
        assert python_node not in plan
