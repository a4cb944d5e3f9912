import pytest

from rebuy.llm.queries import REGISTRY
from rebuy.llm.sql import SQL
from tests.oracle_harness import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_against_sql(spark, name):
    ok, why = compare(REGISTRY[name](spark, SF), SQL[name], duck(SF))
    assert ok, why
