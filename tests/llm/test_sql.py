import pytest
from parity import compare

from beaconlake.llm import queries, sql


@pytest.mark.parametrize("name", sorted(sql.SQL))
def test_queries_agree_with_duckdb(spark, duck, data, name):
    assert compare(queries.QUERIES[name](spark, data), duck, sql.SQL[name]) is None
