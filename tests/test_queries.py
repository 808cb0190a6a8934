"""Every registered query against its SQL twin, and rules every plan must obey."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import difference, duck
from driver import oracle, queries as registry

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
#: The weather queries; those on text corpora have tests of their own.
RUNS, SQL = registry.registered(), oracle.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_a_twin():
    assert set(SQL) == set(RUNS)
    assert set(RUNS) <= set(queries()) and set(SQL) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(RUNS))
def test_query(spark, con, name):
    df = RUNS[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for forbidden in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "SinglePartition"):
        assert forbidden not in plan, f"{forbidden} in the plan of {name}"
    assert difference(df.toPandas(), con.execute(SQL[name]).df()) is None


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["station_id", "tmy_ts", "t_db", "ghi", "rh", "v_air"]
    assert df.limit(1).count() == 1


def test_filters_and_columns_reach_the_scan(spark):
    plan = RUNS["q_range_filter"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts,2024-01-05" in plan and "LessThan(ts,2024-01-20" in plan
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string>" in plan
