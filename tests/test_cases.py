"""Every registered query against its SQL on the smallest tables."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from conformance.compare import compare, connect

DIRECTORY = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(DIRECTORY), reason="test tables not present")


@pytest.fixture(scope="module")
def duck():
    return connect(DIRECTORY)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_same_rows_as_sql(spark, duck, name):
    df = queries()[name](spark, DIRECTORY)
    assert compare(df, duck, oracle_sql()[name]) == ""
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


@pytest.mark.parametrize("name", sorted(set(queries()) - set(oracle_sql())))
def test_runs_without_sql(spark, name):
    assert queries()[name](spark, DIRECTORY).count() > 0


def test_entry_has_rows(spark):
    assert entry(spark).count() > 0
