"""Every registered query beside its SQL, on the smallest benchmark tables."""

import pytest

import __spark_entry__ as contract
from workload import ORACLES, QUERIES
from workload.check import connect, differences

FOLDER = contract.SMOKE_FOLDER
UNWANTED = ("CartesianProduct", "NestedLoopJoin", "EvalPython", "InPandas", "InArrow")


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_contract(spark):
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert contract.entry(spark).limit(1).count() == 1


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    result = QUERIES[name](spark, FOLDER)
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert not [step for step in UNWANTED if step in plan]
    sql = ORACLES.get(name)
    if sql is None:
        assert result.count() > 0
    else:
        assert differences(result, duck, sql) == []
