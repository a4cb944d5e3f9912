"""Invariants of the feature table on real test data (sf0.001)."""

from pyspark.sql import functions as F

from rebuy.plans.features import FEATURES
from rebuy.plans.queries import REGISTRY, tables
from tests.conftest import SF001


def test_feature_table_invariants(spark):
    ft = REGISTRY["feature_table"](spark, SF001).cache()
    n = ft.count()
    assert n > 0
    assert ft.select("user_id", "product_id").distinct().count() == n
    bad = ft.filter(
        ~F.col("reordered").isin(0, 1)
        | (F.col("user_product_percent_order_containing_product") <= 0)
        | (F.col("user_product_percent_order_containing_product") > 1)
        | (F.col("user_product_ordered_last_n_order") < 0)
        | (F.col("user_product_ave_add_to_cart_order_scale") <= 0)
        | (F.col("user_product_ave_add_to_cart_order_scale") > 1)
        | ~F.col("current_same_day_order").isin(0, 1)
        | (F.col("user_uniq_prod_over_total_prod") > 1)
        | (F.col("product_percent_order_containing_product") > 1)
        | (F.col("user_total_uniq_product") > F.col("user_total_product")))
    assert bad.count() == 0
    # Only the bins and the mean gap of single-order users may be NULL.
    nullable = {"user_days_since_last_order_mean", "product_dept_bin", "product_aisle_bin"}
    for c in FEATURES:
        if c not in nullable:
            assert ft.filter(F.col(c).isNull()).count() == 0, c


def test_labels_match_current_reorders(spark):
    t = tables(spark, SF001)
    ft = REGISTRY["feature_table"](spark, SF001)
    # every positive label is a reordered current line of a prior product
    positives = ft.filter(F.col("reordered") == 1).count()
    cur_reorders = t.train.filter(F.col("reordered") == 1).count()
    assert positives == cur_reorders
