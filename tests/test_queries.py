"""Every named query against its SQL, on the smallest tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import oracle  # noqa: E402

SF = os.environ.get("SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    return oracle.connect(SF)


def test_each_query_has_sql():
    assert set(oracle.contract.QUERIES) == set(oracle.contract.ORACLES)


@pytest.mark.parametrize("name", sorted(oracle.contract.QUERIES))
def test_same_rows(spark, duck, name):
    assert oracle.compare(spark, duck, name, SF) is None


@pytest.mark.parametrize("name", ["batch_plan_odd_ids", "late_partitions", "schema_diff", "value_diff", "summary"])
def test_plans_join_by_key(spark, name):
    plan = oracle.contract.queries()[name](spark, SF)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_entry(spark):
    assert oracle.contract.entry(spark).count() == 5
