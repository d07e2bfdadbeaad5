"""Every registered query against its SQL in DuckDB, at the smallest scale."""

import os

import pytest

import __spark_entry__ as contract
from workload.compare import connect, difference
from workload.registry import QUERIES

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    con = connect(SF_DIR)
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_its_oracle(spark, duck, name):
    df = contract.queries()[name](spark, SF_DIR)
    assert difference(df, duck, contract.oracle_sql()[name]) is None
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(j in plan for j in ("CartesianProduct", "NestedLoopJoin")), plan


def test_entry(spark):
    assert contract.entry(spark).count() > 0
