"""Feature operators F1-F18 (user, product, user-product, current order).

Partitioning plan (see ``rebuy.plans.features`` for the composition):

* product features aggregate the prior lines directly by product_id
  (partial aggregation, so a product in a third of all lines is fine);
* user features aggregate the order-level table by user_id;
* every user-product feature comes out of ONE ``groupBy(user_id,
  product_id)`` over the prior details, including the cumulative days at the
  product's most recent order (``max_by``), so no second pass and no join on
  (user, order_number) is needed;
* nothing is computed with a window partitioned by user or order: a hot user
  or a huge order never becomes one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rebuy.functions.columns import (NO_SPREAD, safe_div, weekend_flag,
                                     zero_to_half)
from rebuy.operators.orders import GAP

CD = "user_product_days_before_last_product_order"


def reorder_summary(details: DataFrame) -> DataFrame:
    """A1: user_product_reordered_past = sum of the reordered flag per
    (user, product); an all-NULL sum is 0 as in pandas."""
    return details.groupBy("user_id", "product_id").agg(
        F.coalesce(F.sum("reordered"), F.lit(0)).cast("bigint")
        .alias("user_product_reordered_past"))


def user_product_aggregates(details: DataFrame) -> DataFrame:
    """A1 + F8-F12 (and notebook F9) in one aggregation.

    ``details`` = prior lines joined with the order-level table carrying
    ``max_add_to_cart_order`` and the cumulative days ``CD``."""
    scale = F.col("add_to_cart_order") / F.col("max_add_to_cart_order")
    agg = details.groupBy("user_id", "product_id").agg(
        F.coalesce(F.sum("reordered"), F.lit(0)).cast("bigint").alias("user_product_reordered_past"),
        F.avg(scale).alias("user_product_ave_add_to_cart_order_scale"),
        F.avg(GAP).alias("_avg_gap"),
        F.max("order_number").alias("user_product_most_recent_order"),
        F.max_by(CD, "order_number").alias(CD),
        F.avg("add_to_cart_order").alias("user_product_ave_add_to_cart_order"))
    # products bought only in a first order have no gap: use CD.
    return (agg.withColumn("user_product_ave_days_since_prior_order",
                           F.coalesce(F.col("_avg_gap"), F.col(CD)))
            .drop("_avg_gap"))


def user_base_features(order_tbl: DataFrame) -> DataFrame:
    """F2, F3, F5 and the user's total days (A10: line -> order -> user)."""
    return order_tbl.groupBy("user_id").agg(
        F.count("order_id").cast("bigint").alias("user_total_order"),
        F.avg("n_lines").alias("user_cart_size"),
        F.sum("n_lines").cast("bigint").alias("user_total_product"),
        F.avg(GAP).alias("user_days_since_last_order_mean"),
        F.stddev_samp(GAP).alias("user_days_since_last_order_std"),
        F.avg(weekend_flag("order_dow")).alias("user_likely_dow"),
        F.coalesce(F.sum(GAP), F.lit(0.0)).alias("days_since_first_order"))


def user_uniq_products(user_products: DataFrame) -> DataFrame:
    """Distinct products per user = rows of the (user, product)
    table per user (count distinct without a second distinct shuffle)."""
    return user_products.groupBy("user_id").agg(
        F.count(F.lit(1)).cast("bigint").alias("user_total_uniq_product"))


def user_features(order_tbl: DataFrame, user_products: DataFrame) -> DataFrame:
    """One row per user with prior orders."""
    base = user_base_features(order_tbl)
    uniq = user_uniq_products(user_products)
    return (base.join(uniq, "user_id", "left")
            .withColumn("user_uniq_prod_over_total_prod",
                        safe_div("user_total_uniq_product", "user_total_product")))


def product_features(prior_lines: DataFrame) -> DataFrame:
    """F6-F7 over all prior lines (every user, not only current ones)."""
    pf = prior_lines.groupBy("product_id").agg(
        F.count("order_id").cast("bigint").alias("product_total_orders"),
        F.avg("add_to_cart_order").alias("product_avg_add_to_cart_order"))
    # Distinct orders overall, a scalar subquery (one row, no join).
    n_orders = prior_lines.select(F.count_distinct("order_id")).scalar()
    return pf.withColumn("product_percent_order_containing_product",
                         safe_div(F.col("product_total_orders"), n_orders))


def current_attributes(current_orders: DataFrame) -> DataFrame:
    """the current order's gap and hour per user (one current order per
    user; max is the deterministic 'first')."""
    return current_orders.groupBy("user_id").agg(
        F.max(GAP).alias("current_days_since_prior_order"),
        F.max("order_hour_of_day").alias("order_hour_of_day"))


def current_labels(current_lines: DataFrame, orders: DataFrame) -> DataFrame:
    """(user, product, reordered) of the current order lines (J1 + P1)."""
    return (current_lines.select("order_id", "product_id", "reordered")
            .join(orders.select("order_id", "user_id"), "order_id", "left")
            .select("user_id", "product_id", F.col("reordered").alias("_label")))


def label_candidates(user_products: DataFrame, labels: DataFrame) -> DataFrame:
    """reordered = the current line's flag, 0 when the product is not in
    the current order."""
    return (user_products.join(labels, ["user_id", "product_id"], "left")
            .withColumn("reordered", F.coalesce(F.col("_label"), F.lit(0)).cast("int"))
            .drop("_label"))


def user_product_rates(reordered_past: Column, total_order: Column,
                       days_since_first: Column) -> tuple[Column, Column]:
    """percent of the user's orders with the product, average days per
    purchase of the product."""
    n = reordered_past + 1
    return (safe_div(n, total_order), safe_div(days_since_first, n))


def current_order_features(cd: Column, current_gap: Column, avg_days_per_order: Column,
                           gap_mean: Column, gap_std: Column, total_order: Column,
                           most_recent: Column) -> dict[str, Column]:
    """F15-F18 as column expressions (the reference's row-wise function).

    * days since the product was last bought = cd + current gap, 0 -> 0.5;
    * its ratio to the average days per purchase, denominator 0 -> 0.5
      (the average column itself is left as it is);
    * gap deviation (gap - mean) / std, std 0 or missing -> 99999;
    * same-day flag: current gap 0 and the product in the newest order.
    """
    since = zero_to_half(cd + current_gap)
    ratio = since / zero_to_half(avg_days_per_order)
    dev = F.when(gap_std != 0, (current_gap - gap_mean) / gap_std)
    same_day = F.when((current_gap == 0) & (total_order == most_recent), 1).otherwise(0)
    return {
        "current_order_days_since_last_product_purchase": since,
        "current_order_since_last_product_purchase_vs_average_purchase_gap": ratio,
        "current_order_gap_deviation": F.coalesce(dev, F.lit(NO_SPREAD)),
        "current_same_day_order": same_day.cast("int"),
    }
