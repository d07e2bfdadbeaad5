"""Queries of this subpackage that SQL can say, against it."""

import pytest

from galleyproof.llm import queries
from workload.compare import connect, difference

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_its_oracle(spark, name):
    con = connect(SF_DIR)
    try:
        assert difference(queries.QUERIES[name](spark, SF_DIR), con, queries.ORACLES[name]) is None
    finally:
        con.close()
