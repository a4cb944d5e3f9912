"""Query registry: one callable (spark, sf_dir) -> DataFrame per operator
of the survey, each over whole tables derived from the test data.

Doubles are rounded to 6 places and integers cast explicitly so the
results compare with the SQL oracles in ``rebuy.plans.oracle``.
"""

from __future__ import annotations

import hashlib
import math
import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rebuy.functions.columns import FINAL_THRESHOLD
from rebuy.operators import binning as bn
from rebuy.operators import eda
from rebuy.operators import evaluate as ev
from rebuy.operators import features as fe
from rebuy.operators import orders as od
from rebuy.operators import sampling as sp
from rebuy.plans import features as pf
from rebuy.session import scratch_path
from rebuy.sources.files import read_csv_table, write_csv
from rebuy.sources.testdata import BasketTables, basket_tables

# The holdout job's sizes as shares of the current orders and of the users,
# as the reference's 26,000 / 6,000 orders and 6,000 users are of its data;
# tables too small for five folds get at least the least sizes.
HOLDOUT_SHARES = dict(n_total=0.198, n_subset=0.0457, n_extra_users=0.0291)
HOLDOUT_LEAST = dict(n_total=60, n_subset=20, n_extra_users=20)
HOLDOUT_SEED = 42
EDA_SHARE = (30000, 1384617)    # the reference's sample of its current lines
K_FOLDS = 5
FOLD_SALT = "42"
SCORE = "user_product_percent_order_containing_product"   # deterministic score
CV_CUT = 0.5

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(name: str):
    def deco(fn):
        REGISTRY[name] = fn
        return fn
    return deco


def finish(df: DataFrame) -> DataFrame:
    """Round doubles to 6 places (both engines sum in different orders)."""
    cols = [F.round(F.col(f.name), 6).alias(f.name) if isinstance(f.dataType, T.DoubleType)
            else F.col(f.name) for f in df.schema.fields]
    return df.select(*cols)


_TABLES: dict = {}


def tables(spark: SparkSession, sf_dir: str) -> BasketTables:
    """Basket tables of a test-data folder, derived once per application and
    written as Parquet under the shared checkpoint folder; every query then
    plans over plain Parquet scans (as real basket input would be)."""
    key = (spark.sparkContext.applicationId, os.path.abspath(sf_dir))
    if key not in _TABLES:
        tag = hashlib.md5(repr(key).encode()).hexdigest()[:16]
        _TABLES[key] = basket_tables(spark, sf_dir, scratch_path(spark, f"basket_{tag}"))
    return _TABLES[key]


def prior(t: BasketTables) -> pf.PriorAggregates:
    """Lazy: a query plans, and reads, only what it names."""
    return pf.prior_aggregates(t.orders, t.prior, mode="none")


def candidates(t: BasketTables, p: pf.PriorAggregates | None = None) -> DataFrame:
    return pf.candidate_rows(t.orders, t.train, p or prior(t))


def holdout(t: BasketTables) -> sp.Holdout:
    base = {"n_total": t.train.select(F.count_distinct("order_id")).first()[0],
            "n_extra_users": od.filter_not_test(t.orders).select(F.count_distinct("user_id")).first()[0]}
    base["n_subset"] = base["n_total"]
    sizes = {k: max(HOLDOUT_LEAST[k], math.ceil(share * base[k])) for k, share in HOLDOUT_SHARES.items()}
    return sp.Holdout(t.orders, t.train, t.prior, **sizes, seed=HOLDOUT_SEED)


def scored(t: BasketTables) -> DataFrame:
    return candidates(t).select("user_id", "product_id", "reordered", F.col(SCORE).alias("score"))


# ---- scans / projections / filters ----------------------------------------

@query("scan_orders")
def q_scan_orders(spark, sf):
    """S1 + S2: the orders table written as CSV (header, no index) and
    scanned back with the declared schema; empty gap cells read as NULL."""
    t = tables(spark, sf)
    tag = hashlib.md5(os.path.abspath(sf).encode()).hexdigest()[:12]
    path = scratch_path(spark, f"orders_csv_{tag}")
    write_csv(t.orders, path)
    return finish(read_csv_table(spark, path, "orders"))


@query("scan_products")
def q_scan_products(spark, sf):
    """S1 + S2 over text cells: names with commas, quotes and doubled quotes
    survive the way out and back."""
    t = tables(spark, sf)
    tag = hashlib.md5(os.path.abspath(sf).encode()).hexdigest()[:12]
    path = scratch_path(spark, f"products_csv_{tag}")
    quoted = F.concat(F.lit('Bar, ""'), "product_name", F.lit('"" "Dark", Big'))
    write_csv(t.products.withColumn("product_name", F.when(F.col("product_id") % 2 == 0, quoted)
                                    .otherwise(F.col("product_name"))), path)
    return finish(read_csv_table(spark, path, "products"))


@query("scan_products_breaks")
def q_scan_products_breaks(spark, sf):
    """S1 + S2 over cells with line breaks, quotes and commas: records are cut by
    quote parity, so the file stays splittable."""
    t = tables(spark, sf)
    tag = hashlib.md5(os.path.abspath(sf).encode()).hexdigest()[:12]
    path = scratch_path(spark, f"products_breaks_{tag}")
    cell = F.concat(F.lit('a "b"\n'), "product_name", F.lit('\n\n,"c'))
    write_csv(t.products.withColumn("product_name", F.when(F.col("product_id") % 3 == 0, cell)
                                    .otherwise(F.col("product_name"))), path)
    return finish(read_csv_table(spark, path, "products"))


@query("scan_orders_inferred")
def q_scan_orders_inferred(spark, sf):
    """S1 without a declared schema: every column's type follows from all its cells."""
    t = tables(spark, sf)
    tag = hashlib.md5(os.path.abspath(sf).encode()).hexdigest()[:12]
    path = scratch_path(spark, f"orders_inferred_{tag}")
    write_csv(t.orders, path)
    return finish(read_csv_table(spark, path))


@query("filter_not_test")
def q_filter_not_test(spark, sf):
    return finish(od.filter_not_test(tables(spark, sf).orders))


@query("order_details")
def q_order_details(spark, sf):
    t = tables(spark, sf)
    return finish(od.order_details(t.prior, t.orders))


# ---- aggregations -----------------------------------------------------------

@query("reordered_past")
def q_reordered_past(spark, sf):
    t = tables(spark, sf)
    return fe.reorder_summary(od.order_details(t.prior, t.orders).filter(F.col("user_id").isNotNull()))


@query("user_orders")
def q_user_orders(spark, sf):
    """A2 / A10 first level: lines per (user, order) and the order's gap."""
    t = tables(spark, sf)
    o = od.order_table(t.orders, t.prior)
    return finish(o.select("user_id", "order_id", F.col("n_lines").alias("total_product"),
                           "days_since_prior_order"))


@query("user_gap_std")
def q_user_gap_std(spark, sf):
    t = tables(spark, sf)
    return finish(fe.user_base_features(od.order_table(t.orders, t.prior))
                  .select("user_id", "user_days_since_last_order_std"))


@query("user_uniq")
def q_user_uniq(spark, sf):
    t = tables(spark, sf)
    details = t.prior.join(t.orders.select("order_id", "user_id"), "order_id")
    return fe.user_uniq_products(details.select("user_id", "product_id").distinct())


@query("user_features")
def q_user_features(spark, sf):
    t = tables(spark, sf)
    return finish(prior(t).users.select(
        "user_id", "user_total_order", "user_cart_size", "user_total_product",
        "user_days_since_last_order_mean", "user_days_since_last_order_std",
        "user_total_uniq_product", "user_uniq_prod_over_total_prod"))


@query("user_likely_dow")
def q_user_likely_dow(spark, sf):
    t = tables(spark, sf)
    return finish(prior(t).users.select("user_id", "user_likely_dow"))


@query("product_features")
def q_product_features(spark, sf):
    return finish(fe.product_features(tables(spark, sf).prior))


@query("distinct_users")
def q_distinct_users(spark, sf):
    return sp.distinct_ids(od.filter_not_test(tables(spark, sf).orders), "user_id")


@query("dataset_shape")
def q_dataset_shape(spark, sf):
    """Rows and columns of each basket table and of the feature table."""
    t = tables(spark, sf)
    ft, _ = pf.feature_table(t.orders, t.prior, t.train, t.products)
    parts = []
    for name, df in [("orders", t.orders), ("order_products__prior", t.prior),
                     ("order_products__train", t.train), ("products", t.products),
                     ("feature_table", ft)]:
        parts.append(df.agg(F.count(F.lit(1)).cast("bigint").alias("n_rows"))
                     .select(F.lit(name).alias("table_name"), "n_rows",
                             F.lit(len(df.columns)).cast("int").alias("n_cols")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ---- windows ------------------------------------------------------------------

@query("cart_scale")
def q_cart_scale(spark, sf):
    """Cart position over the order's largest position."""
    t = tables(spark, sf)
    d = t.prior.join(od.order_stats(t.prior), "order_id")
    return finish(d.select("order_id", "product_id",
                           (F.col("add_to_cart_order") / F.col("max_add_to_cart_order"))
                           .alias("user_product_add_to_cart_order_scale")))


@query("cum_days")
def q_cum_days(spark, sf):
    t = tables(spark, sf)
    c = od.cumulative_days(od.order_table(t.orders, t.prior))
    return finish(c.select("user_id", "order_number", "cumulative_days_since_nth_order"))


@query("ffill_days")
def q_ffill_days(spark, sf):
    t = tables(spark, sf)
    return finish(prior(t).order_table.select(
        "user_id", "order_number", fe.CD))


# ---- joins / candidate construction -----------------------------------------

@query("valid_users_semi")
def q_valid_users_semi(spark, sf):
    """Prior (user, product) summary of users with a current order."""
    t = tables(spark, sf)
    summary = fe.reorder_summary(od.prior_details(t.prior, od.order_table(t.orders, t.prior)))
    users = od.current_orders(t.orders, t.train).select("user_id")
    return summary.join(users, "user_id", "left_semi")


@query("candidate_labels")
def q_candidate_labels(spark, sf):
    """F1 (J13 + J2): candidates with their label."""
    t = tables(spark, sf)
    return candidates(t).select("user_id", "product_id", "user_product_reordered_past", "reordered")


@query("with_product_features")
def q_with_product_features(spark, sf):
    t = tables(spark, sf)
    p = prior(t)
    c = pf.labelled_candidates(t.orders, t.train, p.user_products).select("user_id", "product_id", "reordered")
    return finish(c.join(p.products, "product_id", "left"))


@query("with_product_dim")
def q_with_product_dim(spark, sf):
    t = tables(spark, sf)
    c = pf.labelled_candidates(t.orders, t.train, prior(t).user_products).select("user_id", "product_id", "reordered")
    return c.join(t.products.select("product_id", "aisle_id", "department_id"), "product_id", "left")


@query("days_before_last")
def q_days_before_last(spark, sf):
    t = tables(spark, sf)
    return finish(prior(t).user_products.select(
        "user_id", "product_id", "user_product_most_recent_order", fe.CD))


@query("user_product_features")
def q_user_product_features(spark, sf):
    t = tables(spark, sf)
    p = prior(t)
    up = p.user_products.join(p.users.select("user_id", "user_total_order"), "user_id", "left")
    return finish(up.select(
        "user_id", "product_id", "user_product_ave_add_to_cart_order_scale",
        "user_product_ave_days_since_prior_order", "user_product_most_recent_order",
        (F.col("user_total_order") - F.col("user_product_most_recent_order")).cast("bigint")
        .alias("user_product_ordered_last_n_order"), fe.CD))


@query("user_product_avg_cart")
def q_user_product_avg_cart(spark, sf):
    t = tables(spark, sf)
    return finish(prior(t).user_products.select("user_id", "product_id",
                                                "user_product_ave_add_to_cart_order"))


@query("user_product_rates")
def q_user_product_rates(spark, sf):
    t = tables(spark, sf)
    p = prior(t)
    up = p.user_products.join(p.users, "user_id", "left")
    pct, per = fe.user_product_rates(F.col("user_product_reordered_past"),
                                     F.col("user_total_order"), F.col("days_since_first_order"))
    return finish(up.select("user_id", "product_id",
                            pct.alias("user_product_percent_order_containing_product"),
                            per.alias("user_product_ave_day_per_product_order")))


@query("current_order")
def q_current_order(spark, sf):
    t = tables(spark, sf)
    return finish(fe.current_attributes(od.current_orders(t.orders, t.train)))


CURRENT = ["current_order_days_since_last_product_purchase",
           "current_order_since_last_product_purchase_vs_average_purchase_gap",
           "current_order_gap_deviation", "current_same_day_order"]


@query("current_features")
def q_current_features(spark, sf):
    return finish(candidates(tables(spark, sf)).select(
        "user_id", "product_id", "current_days_since_prior_order", *CURRENT))


@query("gap_ratio")
def q_gap_ratio(spark, sf):
    return finish(candidates(tables(spark, sf)).select("user_id", "product_id", *CURRENT[:2]))


@query("same_day")
def q_same_day(spark, sf):
    return candidates(tables(spark, sf)).select("user_id", "product_id", "current_same_day_order")


# ---- binning ------------------------------------------------------------------

def _counts(spark, sf, key: str) -> DataFrame:
    """The class counts that ``features.fit_bins`` fits its maps on: one
    candidate join, reduced before it meets the product dimension."""
    t = tables(spark, sf)
    cand = pf.labelled_candidates(t.orders, t.train, pf.user_product_keys(t.orders, t.prior))
    if key == "order_hour_of_day":
        return bn.class_counts(cand.groupBy(key, "reordered").count(), key, weight="count")
    return bn.class_counts(pf.product_label_counts(cand, t.products), key, weight="count")


@query("dept_counts")
def q_dept_counts(spark, sf):
    return _counts(spark, sf, "department_id")


@query("dept_ratio")
def q_dept_ratio(spark, sf):
    counts = _counts(spark, sf, "department_id")
    return finish(bn.class_ratios(counts, fill_missing=False)
                  .select("department_id", "no_reorder", "reordered"))


@query("dept_bins")
def q_dept_bins(spark, sf):
    counts = _counts(spark, sf, "department_id")
    return finish(bn.bin_map(counts, "department_id", "department", "product_dept_bin"))


@query("bins_per_fold")
def q_bins_per_fold(spark, sf):
    """Department and aisle bins fitted without each user fold, from
    one count by (fold, category, label)."""
    t = tables(spark, sf)
    cand = sp.with_folds(candidates(t).select("user_id", "product_id", "reordered"), K_FOLDS, FOLD_SALT)
    rows = cand.groupBy("fold", "product_id", "reordered").count().join(t.products, "product_id")
    out = None
    for key, rule in (("department_id", "department"), ("aisle_id", "aisle")):
        m = bn.fold_bin_maps(rows, key, rule, "bin", K_FOLDS, weight="count")
        m = m.select(F.lit(rule).alias("category"), "fold", F.col(key).cast("long").alias("key"), "no_reorder", "reordered", "diff", "bin")
        out = m if out is None else out.unionByName(m)
    return finish(out)


@query("dept_diff_sorted")
def q_dept_diff_sorted(spark, sf):
    """L1: department diffs ranked descending, NULL last."""
    from pyspark.sql import Window
    counts = _counts(spark, sf, "department_id")
    r = bn.class_ratios(counts, fill_missing=False)
    w = Window.orderBy(F.desc_nulls_last("diff"), "department_id")
    return finish(r.select("department_id", "diff", F.row_number().over(w).cast("int").alias("rank")))


@query("aisle_freq")
def q_aisle_freq(spark, sf):
    counts = _counts(spark, sf, "aisle_id")
    return finish(bn.class_ratios(counts, fill_missing=True)
                  .select("aisle_id", "no_reorder", "reordered", "diff"))


@query("aisle_bins")
def q_aisle_bins(spark, sf):
    counts = _counts(spark, sf, "aisle_id")
    return finish(bn.bin_map(counts, "aisle_id", "aisle", "product_aisle_bin"))


@query("hod_bins")
def q_hod_bins(spark, sf):
    counts = _counts(spark, sf, "order_hour_of_day")
    return finish(bn.bin_map(counts, "order_hour_of_day", "hour", "current_order_hod"))


@query("apply_bins")
def q_apply_bins(spark, sf):
    t = tables(spark, sf)
    ft, _ = pf.feature_table(t.orders, t.prior, t.train, t.products)
    return ft.select("user_id", "product_id", "product_dept_bin", "product_aisle_bin")


@query("aisle_top_bottom")
def q_aisle_top_bottom(spark, sf):
    """L4 over the candidate-label aisle frequencies."""
    counts = _counts(spark, sf, "aisle_id")
    r = bn.class_ratios(counts, fill_missing=True).select("aisle_id", "no_reorder", "reordered", "diff")
    return finish(eda.top_bottom(r, "aisle_id", 10))


# ---- the feature table ----------------------------------------------------------

@query("feature_table")
def q_feature_table(spark, sf):
    t = tables(spark, sf)
    ft, _ = pf.feature_table(t.orders, t.prior, t.train, t.products)
    return finish(ft)


@query("feature_table_notebook")
def q_feature_table_notebook(spark, sf):
    t = tables(spark, sf)
    ft, _ = pf.feature_table(t.orders, t.prior, t.train, t.products, notebook=True)
    return finish(ft)


# ---- sampling / splits --------------------------------------------------------------

@query("sample_orders")
def q_sample_orders(spark, sf):
    return holdout(tables(spark, sf)).sample_ids


@query("sample_nested")
def q_sample_nested(spark, sf):
    return holdout(tables(spark, sf)).subset_ids


@query("holdout_ids")
def q_holdout_ids(spark, sf):
    return holdout(tables(spark, sf)).holdout_ids


@query("union_users")
def q_union_users(spark, sf):
    return holdout(tables(spark, sf)).all_user_ids


@query("holdout_train")
def q_holdout_train(spark, sf):
    return holdout(tables(spark, sf)).train_lines


@query("train_lines_anti")
def q_train_lines_anti(spark, sf):
    """Current lines not in the holdout (same rows as holdout_train)."""
    h = holdout(tables(spark, sf))
    return h.train_lines.select("order_id", "product_id")


@query("holdout_test")
def q_holdout_test(spark, sf):
    return holdout(tables(spark, sf)).test_lines


@query("holdout_subset")
def q_holdout_subset(spark, sf):
    return holdout(tables(spark, sf)).subset_lines


@query("holdout_subset_prior")
def q_holdout_subset_prior(spark, sf):
    return holdout(tables(spark, sf)).subset_prior_lines


@query("user_folds")
def q_user_folds(spark, sf):
    return sp.user_folds(candidates(tables(spark, sf)).select("user_id"), K_FOLDS, FOLD_SALT)


@query("user_folds_balanced")
def q_user_folds_balanced(spark, sf):
    return sp.user_folds_balanced(candidates(tables(spark, sf)).select("user_id"), K_FOLDS, FOLD_SALT)


def eda_sample(t: BasketTables) -> DataFrame:
    """An exact-size sample of the current order lines, the reference's share of them."""
    part, whole = EDA_SHARE
    return sp.exact_sample(t.train, ["order_id", "product_id"], -(-t.train.count() * part // whole), "42")


@query("sample_rows")
def q_sample_rows(spark, sf):
    return eda_sample(tables(spark, sf))


@query("eda_inner")
def q_eda_inner(spark, sf):
    t = tables(spark, sf)
    s = eda_sample(t)
    return s.join(t.products, "product_id", "inner")


# ---- evaluation on a deterministic score ------------------------------------------------

@query("threshold_predict")
def q_threshold_predict(spark, sf):
    return finish(ev.predict(scored(tables(spark, sf)), "score", FINAL_THRESHOLD))


@query("confusion_metrics")
def q_confusion_metrics(spark, sf):
    d = ev.predict(scored(tables(spark, sf)), "score", FINAL_THRESHOLD)
    return finish(ev.confusion_metrics(d, "reordered", "prediction"))


@query("roc_points")
def q_roc_points(spark, sf):
    return finish(ev.roc_points(ev.curve_counts(scored(tables(spark, sf)), "reordered", "score")))


@query("auc")
def q_auc(spark, sf):
    return finish(ev.auc(ev.curve_counts(scored(tables(spark, sf)), "reordered", "score")))


@query("pr_points")
def q_pr_points(spark, sf):
    return finish(ev.pr_points(ev.curve_counts(scored(tables(spark, sf)), "reordered", "score")))


@query("best_f1")
def q_best_f1(spark, sf):
    curve = ev.curve_counts(scored(tables(spark, sf)), "reordered", "score")
    return finish(ev.best_f1(ev.pr_points(curve)))


def _folded(spark, sf) -> DataFrame:
    return sp.with_folds(scored(tables(spark, sf)), K_FOLDS, FOLD_SALT)


@query("fold_metrics")
def q_fold_metrics(spark, sf):
    return finish(ev.fold_metrics(_folded(spark, sf), "reordered", "score", cut=CV_CUT))


@query("fold_summary")
def q_fold_summary(spark, sf):
    return finish(ev.fold_summary(ev.fold_metrics(_folded(spark, sf), "reordered", "score",
                                                  cut=CV_CUT)))


@query("curve_points")
def q_curve_points(spark, sf):
    return finish(ev.curve_points(_folded(spark, sf), "reordered", "score"))


# ---- EDA ----------------------------------------------------------------------------------

def _eda_freq(spark, sf, key):
    t = tables(spark, sf)
    s = eda_sample(t)
    names = t.departments if key == "department_id" else t.aisles
    return eda.category_frequency(s, t.products, names, key)


@query("eda_dept_freq")
def q_eda_dept_freq(spark, sf):
    return finish(_eda_freq(spark, sf, "department_id"))


@query("eda_aisle_top_bottom")
def q_eda_aisle_top_bottom(spark, sf):
    return finish(eda.top_bottom(_eda_freq(spark, sf, "aisle_id"), "aisle_id", 10))


def _register_ml() -> None:
    from rebuy.plans import ml_queries  # noqa: F401  (registers the model queries)


_register_ml()
