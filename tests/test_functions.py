import pytest

from rebuy.functions.columns import feature_type, linspace, weekend_flag, zero_to_half


def test_linspace_matches_grid():
    assert linspace(0.02, 0.06, 5) == pytest.approx([0.02, 0.03, 0.04, 0.05, 0.06])
    assert linspace(0.3, 0.7, 5) == pytest.approx([0.3, 0.4, 0.5, 0.6, 0.7])
    assert linspace(1.0, 2.0, 1) == [1.0]


def test_feature_type_prefix_order(spark):
    names = ["user_product_x", "user_total_order", "product_dept_bin", "current_same_day_order",
             "userish"]
    d = spark.createDataFrame([(n,) for n in names], "n string")
    got = [r.t for r in d.select(feature_type("n").alias("t")).collect()]
    assert got == ["User-Product", "User", "Product", "Order", "Order"]


def test_weekend_and_zero_guard(spark):
    d = spark.createDataFrame([(0, 0.0), (1, 2.0), (2, None), (6, 0.5)], "dow int, x double")
    rows = d.select(weekend_flag("dow").alias("w"), zero_to_half("x").alias("z")).collect()
    assert [r.w for r in rows] == [1, 1, 0, 0]
    assert [r.z for r in rows] == [0.5, 2.0, None, 0.5]
