"""Every registered query against its checking SQL on the smallest tables."""

import pytest

import __spark_entry__ as registry
from tests.conftest import SF
from tests.oracle_check import database, differences


@pytest.fixture(scope="module")
def tables():
    return database(SF)


@pytest.mark.parametrize("name", registry.own_queries())
def test_query_equals_its_sql(spark, tables, name):
    assert differences(spark, tables, name, SF) == []


def test_every_query_has_sql():
    assert registry.own_queries().keys() == registry.own_sql().keys()


def test_entry(spark):
    assert registry.entry(spark).count() == 7


def test_no_python_and_no_cross_join(spark):
    for name, query in registry.own_queries().items():
        if name.startswith("wide_") and name not in ("wide_silver", "wide_daily_summary"):
            continue  # the same star once more
        plan = query(spark, SF)._jdf.queryExecution().toString()
        for operator in ("EvalPython", "ArrowEval", "MapInPandas", "CartesianProduct", "NestedLoop"):
            assert operator not in plan, name
