"""the per-(user, product) feature table.

Plan shape (no Python on the rows; [T] = stored once as Parquet, because
several branches or the train and test sides read it):

  prior lines --groupBy(order_id)--> order stats --join orders--> order table [T]
  order table --blocked running sum per user--> cumulative days (W2/W3)
  prior lines --join(order_id) order table + days--> details
  details --groupBy(user, product)--> user-product table [T]
  order table, user-product table --groupBy(user)--> user table
  prior lines --groupBy(product)--> product features
  user-product --left join labels (user, product)--> --join current orders (user)-->
      --left join user table (user)--> candidate rows [T]
  candidate rows --groupBy(product, label)--> bin fit (product-sized) [T]
  candidate rows --join per-product features + bins (small: broadcast)--> rows

Shuffles of line-sized data: the lines by order_id (to meet their order),
the details by (user, product) after partial aggregation, and the
candidates by (user, product) and by user.  Bins are fitted on the train rows
only and applied to both sides.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rebuy.operators import features as fe
from rebuy.operators import orders as od
from rebuy.operators.binning import SupervisedBinner, SupervisedBinnerModel
from rebuy.plans.stash import stash

KEYS = ["user_id", "product_id"]
LABEL = "reordered"

# Final feature columns of the production table, in the reference's order.
FEATURES = [
    "user_product_reordered_past",
    "user_total_order", "user_cart_size", "user_total_product",
    "user_days_since_last_order_mean", "user_total_uniq_product",
    "user_uniq_prod_over_total_prod",
    "product_total_orders", "product_avg_add_to_cart_order",
    "product_percent_order_containing_product",
    "user_product_ave_add_to_cart_order_scale",
    "user_product_ave_days_since_prior_order",
    "user_product_ordered_last_n_order",
    "user_product_percent_order_containing_product",
    "user_product_ave_day_per_product_order",
    "current_days_since_prior_order",
    "current_order_days_since_last_product_purchase",
    "current_order_since_last_product_purchase_vs_average_purchase_gap",
    "current_order_gap_deviation", "current_same_day_order",
    "product_dept_bin", "product_aisle_bin",
]

# Model-selection variant: three more features that were tried and dropped.
NOTEBOOK_FEATURES = [
    "user_product_reordered_past",
    "user_total_order", "user_cart_size", "user_total_product",
    "user_days_since_last_order_mean", "user_likely_dow",
    "user_total_uniq_product", "user_uniq_prod_over_total_prod",
    "product_total_orders", "product_avg_add_to_cart_order",
    "product_percent_order_containing_product",
    "user_product_ave_add_to_cart_order",
    "user_product_ave_add_to_cart_order_scale",
    "user_product_ave_days_since_prior_order",
    "user_product_ordered_last_n_order",
    "user_product_percent_order_containing_product",
    "user_product_ave_day_per_product_order",
    "current_days_since_prior_order",
    "current_order_days_since_last_product_purchase",
    "current_order_since_last_product_purchase_vs_average_purchase_gap",
    "current_order_gap_deviation", "current_same_day_order",
    "product_dept_bin", "product_aisle_bin", "current_order_hod",
]
WEAK_FEATURES = ["current_order_hod", "user_likely_dow", "user_product_ave_add_to_cart_order"]


@dataclass
class PriorAggregates:
    order_table: DataFrame      # one row per prior order, with cumulative days
    user_products: DataFrame    # one row per (user, product) bought before
    users: DataFrame            # one row per user with prior orders
    products: DataFrame         # one row per product in the prior lines


def prior_aggregates(orders: DataFrame, prior_lines: DataFrame, block_size: int = 4096,
                     mode: str = "table") -> PriorAggregates:
    """Every prior-derived aggregate.  Two of them have several readers and
    are stored (``mode``: see ``rebuy.plans.stash``): the order table feeds the
    user table and the cumulative days, the user-product table feeds the
    candidates and the distinct-product count.  With mode ``none`` nothing
    runs before the caller's action."""
    base = stash(od.order_table(orders, prior_lines), mode)
    otbl = od.days_before_last(base, block_size)
    up = stash(fe.user_product_aggregates(od.prior_details(prior_lines, otbl)), mode)
    return PriorAggregates(otbl, up, fe.user_features(base, up), fe.product_features(prior_lines))


def user_product_keys(orders: DataFrame, prior_lines: DataFrame) -> DataFrame:
    """The rows of ``PriorAggregates.user_products`` by their keys alone: counts and
    bins read no feature, so their lines need neither order statistics nor days."""
    of = orders.filter("user_id is not null and order_number is not null").select("order_id", "user_id")
    return prior_lines.select("order_id", "product_id").join(of, "order_id").select(*KEYS).distinct()


def labelled_candidates(orders: DataFrame, current_lines: DataFrame, user_products: DataFrame) -> DataFrame:
    """(user_id, product_id, reordered, order_hour_of_day) of every candidate:
    all that counts and bins need."""
    cur = fe.current_attributes(od.current_orders(orders, current_lines)).select("user_id", "order_hour_of_day")
    keys = user_products.select("user_id", "product_id")
    return fe.label_candidates(keys, fe.current_labels(current_lines, orders)).join(cur, "user_id")


def product_label_counts(cand: DataFrame, products: DataFrame) -> DataFrame:
    """(product_id, reordered, count, aisle_id, department_id): candidates
    reduced by partial aggregation before they meet the product dimension."""
    return (cand.groupBy("product_id", LABEL).count()
            .join(products.select("product_id", "aisle_id", "department_id"), "product_id", "left"))


def candidate_rows(orders: DataFrame, current_lines: DataFrame,
                   prior: PriorAggregates) -> DataFrame:
    """Every (user, product) a user with a current order bought before, with
    its label and all non-binned features (plus a few helper columns)."""
    cur_attr = fe.current_attributes(od.current_orders(orders, current_lines))
    labels = fe.current_labels(current_lines, orders)
    cand = fe.label_candidates(prior.user_products, labels)
    cand = cand.join(cur_attr, "user_id", "inner").join(prior.users, "user_id", "left")
    rp, tot = F.col("user_product_reordered_past"), F.col("user_total_order")
    pct, per_order = fe.user_product_rates(rp, tot, F.col("days_since_first_order"))
    cand = (cand
            .withColumn("user_product_ordered_last_n_order",
                        (tot - F.col("user_product_most_recent_order")).cast("bigint"))
            .withColumn("user_product_percent_order_containing_product", pct)
            .withColumn("user_product_ave_day_per_product_order", per_order))
    cur = fe.current_order_features(
        cd=F.col(fe.CD), current_gap=F.col("current_days_since_prior_order"),
        avg_days_per_order=F.col("user_product_ave_day_per_product_order"),
        gap_mean=F.col("user_days_since_last_order_mean"),
        gap_std=F.col("user_days_since_last_order_std"),
        total_order=tot, most_recent=F.col("user_product_most_recent_order"))
    for name, c in cur.items():
        cand = cand.withColumn(name, c)
    return cand


@dataclass
class BinModels:
    department: SupervisedBinnerModel
    aisle: SupervisedBinnerModel
    hour: SupervisedBinnerModel | None = None


def fit_bins(cand: DataFrame, products: DataFrame, with_hour: bool = False,
             mode: str = "table") -> BinModels:
    """B1-B3 fitted on labelled candidate rows.  The rows are reduced once
    to (product, label, count) by partial aggregation (a product-sized
    table); only that table meets the product dimension and feeds the
    counts and class totals of both maps."""
    per_product = stash(product_label_counts(cand, products), mode)
    dept = SupervisedBinner("department_id", "product_dept_bin", "department",
                            weightCol="count").fit(per_product)
    aisle = SupervisedBinner("aisle_id", "product_aisle_bin", "aisle",
                             weightCol="count").fit(per_product)
    hour = None
    if with_hour:
        per_hour = stash(cand.groupBy("order_hour_of_day", LABEL).count(), mode)
        hour = SupervisedBinner("order_hour_of_day", "current_order_hod", "hour",
                                weightCol="count").fit(per_hour)
    return BinModels(dept, aisle, hour)


def product_table(prior: PriorAggregates, products: DataFrame, bins: BinModels) -> DataFrame:
    """Product features + department / aisle bins, one row per product."""
    p = prior.products.join(
        products.select("product_id", "aisle_id", "department_id"), "product_id", "left")
    p = bins.department._transform(p, drop_key=True)
    return bins.aisle._transform(p, drop_key=True)


def feature_table(orders: DataFrame, prior_lines: DataFrame, current_lines: DataFrame,
                  products: DataFrame, notebook: bool = False,
                  bins: BinModels | None = None, prior: PriorAggregates | None = None,
                  mode: str = "table") -> tuple[DataFrame, BinModels]:
    """(user_id, product_id, reordered, features...) and the bins used."""
    prior = prior or prior_aggregates(orders, prior_lines, mode=mode)
    cand = stash(candidate_rows(orders, current_lines, prior), mode)
    if bins is None:
        bins = fit_bins(cand, products, with_hour=notebook, mode=mode)
    # One row per product: Spark broadcasts it while its measured size allows,
    # so the candidate rows are not shuffled again by product.
    out = cand.join(product_table(prior, products, bins), "product_id", "left")
    if notebook:
        out = out.join(bins.hour.mapping.select("order_hour_of_day", "current_order_hod"),
                       "order_hour_of_day", "left").drop("order_hour_of_day")
    cols = NOTEBOOK_FEATURES if notebook else FEATURES
    return out.select("user_id", "product_id", LABEL, *cols), bins


def train_test_tables(orders: DataFrame, prior_lines: DataFrame, train_lines: DataFrame,
                      test_lines: DataFrame, products: DataFrame, mode: str = "table",
                      ) -> tuple[DataFrame, DataFrame, BinModels]:
    """The production job: train rows (bins fitted here) and holdout rows
    (train bins applied, unseen categories NULL), sharing prior aggregates."""
    prior = prior_aggregates(orders, prior_lines, mode=mode)
    train, bins = feature_table(orders, prior_lines, train_lines, products, prior=prior, mode=mode)
    test, _ = feature_table(orders, prior_lines, test_lines, products, bins=bins, prior=prior,
                            mode=mode)
    return train, test, bins
