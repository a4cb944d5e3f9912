"""Order-level tables and the order-line / order joins.

``order_table`` is the one order-level table every user feature is derived
from: one row per prior order that has at least one line, with its line
count and largest cart position, computed once (partial aggregation by
order_id, so a huge order never lands whole in one task).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rebuy.functions.columns import FIRST_ORDER_DAYS
from rebuy.operators.prefix_sum import running_sum_by_number

GAP = "days_since_prior_order"


def filter_not_test(orders: DataFrame) -> DataFrame:
    """P5: drop the hidden test set; NULL eval_set rows are kept (pandas
    ``~(col == 'test')`` keeps them)."""
    return orders.filter(~F.col("eval_set").eqNullSafe("test"))


def order_details(lines: DataFrame, orders: DataFrame) -> DataFrame:
    """Order lines left-joined with their order's attributes."""
    return lines.join(orders.drop("eval_set"), "order_id", "left")


def order_stats(lines: DataFrame) -> DataFrame:
    """Per order: line count and largest cart position."""
    return lines.groupBy("order_id").agg(
        F.count("product_id").alias("n_lines"),
        F.max("add_to_cart_order").alias("max_add_to_cart_order"))


def order_table(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """One row per order of ``orders`` that has >= 1 line in ``lines``."""
    return (orders.select("order_id", "user_id", "order_number", "order_dow",
                          "order_hour_of_day", GAP)
            .join(order_stats(lines), "order_id", "inner"))


def cumulative_days(order_tbl: DataFrame, block_size: int = 4096) -> DataFrame:
    """Per user, newest order first, the running sum of gaps including
    the order's own gap; pandas ``cumsum`` leaves NULL where the gap is NULL.
    Adds ``cumulative_days_since_nth_order``."""
    d = running_sum_by_number(order_tbl, ["user_id"], "order_number",
                              {GAP: "_run_gap"}, descending=True, block_size=block_size)
    return (d.withColumn("cumulative_days_since_nth_order",
                         F.when(F.col(GAP).isNull(), F.lit(None).cast("double"))
                         .otherwise(F.col("_run_gap")))
            .drop("_run_gap"))


def days_before_last(order_tbl: DataFrame, block_size: int = 4096) -> DataFrame:
    """The running gap sum from the newest order down to each
    order, inclusive of its own gap; where that gap is NULL (a first order)
    the previous running sum plus 7 days.  Forward fill is per user, so a
    user with a single order gets 0 + 7.  Adds
    ``user_product_days_before_last_product_order`` (named for its later use
    as the value at a product's most recent order)."""
    d = running_sum_by_number(order_tbl, ["user_id"], "order_number",
                              {GAP: "_run_gap"}, descending=True, block_size=block_size)
    cd = (F.coalesce(F.col("_run_gap"), F.lit(0.0))
          + F.when(F.col(GAP).isNull(), F.lit(FIRST_ORDER_DAYS)).otherwise(F.lit(0.0)))
    return d.withColumn("user_product_days_before_last_product_order", cd).drop("_run_gap")


def current_orders(orders: DataFrame, current_lines: DataFrame) -> DataFrame:
    """Orders that have lines in the current (train / holdout) line table."""
    return orders.join(current_lines.select("order_id"), "order_id", "left_semi")


def prior_details(prior_lines: DataFrame, order_tbl: DataFrame) -> DataFrame:
    """Prior lines with user, order number, gap, the order's largest cart
    position and the order's cumulative days.  Lines whose order is unknown
    would get a NULL user and be dropped by every per-user group, so an
    inner join is the same thing."""
    return prior_lines.join(order_tbl, "order_id", "inner")
