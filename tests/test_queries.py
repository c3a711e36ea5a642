"""Every registered query next to its SQL, on the smallest tables."""

import os

import compare
import pytest

from wakeline.registry import ORACLES, QUERIES

FOLDER = f"{compare.DATA}/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables absent")


@pytest.fixture(scope="module")
def database():
    return compare.database(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, database, name):
    verdict = compare.compare(spark, database, FOLDER, name, QUERIES[name], ORACLES.get(name))
    assert verdict == "", verdict


def test_contract():
    import __spark_entry__ as contract

    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", ["w01_trips_gap20", "c01_trip_discovery", "a22_min_max", "j01_interval_join"])
def test_plans_have_no_cross_join_or_single_partition_window(spark, name):
    df = QUERIES[name](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "windowspecdefinition(" not in plan or "Window [" in plan
    for line in plan.splitlines():
        if "+- Window [" in line or ":- Window [" in line:
            assert "], [" in line, line
