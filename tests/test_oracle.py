"""Every registered query against its DuckDB oracle on the supplied tables."""

import pytest

from tslake.plans.oracle import SQL
from tslake.plans.registry import QUERIES

from testdata_paths import SF01
from oracle_compare import compare, duck


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    assert name in SQL, f"{name} has no oracle SQL"
    ok, msg = compare(spark, con, name, QUERIES[name], SQL[name], SF01)
    assert ok, msg
