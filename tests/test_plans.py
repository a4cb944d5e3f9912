"""Plan checks on the flagship query: no Python on the rows, filters and
column pruning reach the scans, no un-partitioned window over big inputs."""

import re

import pytest

from rebuy.plans.queries import REGISTRY
from tests.conftest import SF001


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_feature_table_plan_has_no_python(spark):
    plan = _plan(REGISTRY["feature_table"](spark, SF001))
    assert not re.search(r"PythonUDF|BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas", plan)


def test_scans_are_pruned(spark):
    df = REGISTRY["product_features"](spark, SF001)
    plan = df._jdf.queryExecution().executedPlan().toString()
    # the prior lines are read with only the three columns the features use
    scans = [re.sub(r"#\d+L?", "", c) for c in re.findall(r"FileScan parquet \[([^\]]*)\]", plan)]
    assert scans and all(set(cols.split(",")) <= {"order_id", "product_id", "add_to_cart_order"}
                         for cols in scans), scans


def test_no_unpartitioned_window_on_lines(spark):
    plan = _plan(REGISTRY["feature_table"](spark, SF001))
    for line in plan.splitlines():
        if re.search(r"\bWindow \[", line):
            # every window is partitioned (a block or key partition spec), but
            # for the class totals over the category tables (one row per key)
            assert re.search(r"\], \[[^\]]+\], \[", line) or "sum(n0#" in line, line


@pytest.mark.parametrize("name", ["user_uniq", "user_features", "ffill_days", "dept_bins", "user_product_features"])
def test_prior_queries_are_lazy(spark, name):
    """Nothing runs before the action, and the candidate join of a bin query
    is planned once."""
    from rebuy.plans.queries import tables
    tables(spark, SF001)
    sc = spark.sparkContext
    sc.setJobGroup(f"lazy-{name}", name)
    try:
        df = REGISTRY[name](spark, SF001)
        assert not sc.statusTracker().getJobIdsForGroup(f"lazy-{name}")
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    if name == "dept_bins":
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("coalesce(_label") <= 1


def test_user_uniq_reads_only_its_columns(spark):
    plan = _plan(REGISTRY["user_uniq"](spark, SF001))
    for line in plan.splitlines():
        if "ReadSchema" in line:
            assert "add_to_cart_order" not in line and "days_since" not in line, line


def test_counts_read_keys_only(spark):
    """The class counts need (user, product) pairs: no order statistics, no running
    sums of gaps (windows), and only the columns of that join."""
    plan = _plan(REGISTRY["dept_counts"](spark, SF001))
    assert "Window" not in plan and "days_since" not in plan and "add_to_cart_order" not in plan


def test_user_product_keys_are_those_of_the_aggregates(spark):
    """Null users and order numbers, lines without an order, orders and lines that come twice."""
    from rebuy.plans.features import prior_aggregates, user_product_keys
    orders = spark.createDataFrame([(o, u, "prior", n, 0, 1, 2.0) for o, u, n in [
        (1, 7, 1), (1, 7, 1), (2, 7, 2), (3, None, 1), (4, 8, None), (5, 9, 1), (None, 9, 2)]],
        "order_id long, user_id long, eval_set string, order_number int, order_dow int, order_hour_of_day int, days_since_prior_order double")
    lines = spark.createDataFrame([(o, p, 1, 0) for o, p in [
        (1, 10), (1, 10), (1, 11), (2, 10), (3, 10), (4, 10), (5, 12), (5, None), (6, 10), (None, 10)]],
        "order_id long, product_id long, add_to_cart_order int, reordered int")
    want = prior_aggregates(orders, lines, mode="none").user_products.select("user_id", "product_id")
    got = user_product_keys(orders, lines)
    assert sorted(got.collect(), key=str) == sorted(want.collect(), key=str) and got.count() == 4
