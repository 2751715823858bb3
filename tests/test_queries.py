"""Every registered query against its SQL twin, and what its plan must not hold."""

import pytest

import __spark_entry__ as entry
from tests.check_oracle import compare, connect

SF_DIR = "/root/testdata/sf0.001"
QUERIES, ORACLE = entry.REGISTRY, entry.ORACLE_SQL  # those of llm have tests of their own


@pytest.fixture(scope="module")
def checker():
    return connect(SF_DIR)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_its_twin(spark, checker, name):
    got, want = compare(spark, checker, SF_DIR, name, QUERIES[name], ORACLE[name])
    assert got == want
    assert got[1], "a query without rows checks nothing"


@pytest.mark.parametrize("name", QUERIES)
def test_plan_holds_at_scale(spark, plan_of, name):
    """With nothing small enough to broadcast, joins are equi-joins, no window or
    exchange gathers all rows in one partition, and no Python runs per row."""
    df = QUERIES[name](spark, SF_DIR)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(df)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "83886080")
    for operator in ("NestedLoopJoin", "CartesianProduct", "Python", "InMemoryTableScan"):
        assert operator not in plan
    assert "SinglePartition" not in plan


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0
