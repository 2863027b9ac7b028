"""Every registered query against its SQL. STARKIT_SF chooses the scale (default 0.001)."""

import os
import re

import pytest

import __spark_entry__ as contract
from compare import differences, oracle, plan_of
from starkit.plans import catalog

SF = f"/root/testdata/sf{os.environ.get('STARKIT_SF', '0.001')}"


@pytest.fixture(scope="module")
def connection():
    return oracle(SF)


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, connection, name):
    df = contract.queries()[name](spark, SF)
    assert differences(df, connection, contract.oracle_sql()[name]) == []
    plan = plan_of(df)
    # No query pairs all rows, sorts its input to aggregate it, or numbers rows in one task.
    assert not [node for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "SortAggregate") if node in plan]
    assert "Window [" not in plan or all(re.findall(r"Window \[.*?\], \[(.*?)\]", plan))


def test_every_query_has_sql():
    assert catalog.queries().keys() == catalog.oracle_sql().keys()
    assert contract.queries().keys() >= catalog.queries().keys() and contract.queries().keys() >= contract.oracle_sql().keys()


def test_entry(spark):
    assert contract.entry(spark).count() == 6
