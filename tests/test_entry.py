import __spark_entry__ as entry_mod
from rebuy.plans.features import FEATURES


def test_contract_keys():
    q, o = entry_mod.queries(), entry_mod.oracle_sql()
    assert set(o) <= set(q)
    assert len(o) >= 60 and len(q) > len(o)


def test_entry_flagship(spark):
    df = entry_mod.entry(spark)
    assert df.columns == ["user_id", "product_id", "reordered"] + FEATURES
    assert df.count() > 0
