"""Every registered query against its DuckDB SQL, on whole tables."""

import pytest
from parity import compare

from beaconlake.plans.oracle import SQL
from beaconlake.plans.registry import QUERIES


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_duckdb(spark, duck, data, name):
    difference = compare(QUERIES[name](spark, data), duck, SQL[name])
    assert difference is None, difference
