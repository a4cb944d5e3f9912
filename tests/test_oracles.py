"""Every registered query with an oracle matches DuckDB on sf0.001 (the
driver runs the same comparison at sf0.01; tools/check_oracles.py too)."""

import os

import pytest

from rebuy.plans.oracle import SQL
from rebuy.plans.queries import REGISTRY
from tests.conftest import SF001
from tests.oracle_harness import compare, duck

NAMES = sorted(k for k in REGISTRY if k in SQL)


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


@pytest.mark.skipif(not os.path.isdir(SF001), reason="test data missing")
@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(REGISTRY[name](spark, SF001), SQL[name], con)
    assert ok, msg
