"""Plan checks over every registered query: no row-at-a-time Python UDF and no window without a
partition key (which would pull all rows into one partition)."""

import pytest

import __spark_entry__ as E
from conftest import SF001

QUERIES = E.queries()


# one row for some eight million tokens goes through such a window: a proven bound at any size a driver can plan
ALLOWED = {"op10_mixture_packing", "pipeline"}


def windows_without_partition(plan) -> int:
    found, todo = 0, [plan]
    while todo:
        node = todo.pop()
        if node.nodeName() == "Window":
            found += node.partitionSpec().isEmpty()
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return found


def test_window_check_can_fail(spark):
    df = spark.range(5)
    assert windows_without_partition(df.selectExpr("row_number() OVER (ORDER BY id)")._jdf.queryExecution().optimizedPlan()) == 1
    assert windows_without_partition(df.selectExpr("row_number() OVER (PARTITION BY id % 2 ORDER BY id)")._jdf.queryExecution().optimizedPlan()) == 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_shape(spark, name):
    df = QUERIES[name](spark, SF001)
    assert "BatchEvalPython" not in df._jdf.queryExecution().executedPlan().toString(), name
    assert name in ALLOWED or not windows_without_partition(df._jdf.queryExecution().optimizedPlan()), name


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["conv_id", "turn", "role", "text"] and df.count() > 0
