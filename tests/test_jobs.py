"""The job steps end to end, from CSV files with quoted names."""

import os

import pytest
from pyspark.sql import functions as F

from rebuy.plans import jobs, ml_queries as mq, model as ml
from rebuy.plans.queries import tables
from rebuy.sources.files import read_csv_table, read_parquet_table, write_csv

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def folders(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("job")
    raw, work = str(root / "raw"), str(root / "work")
    t = tables(spark, SF001)
    quoted = F.concat(F.lit('Bar, ""'), "product_name", F.lit('"" "Dark", Big'))
    for name, df in (("orders", t.orders), ("order_products__prior", t.prior), ("order_products__train", t.train),
                     ("products", t.products.withColumn("product_name", quoted))):
        write_csv(df, os.path.join(raw, f"{name}.csv"))
    return raw, work


def test_quoted_names_survive(spark, folders):
    got = read_csv_table(spark, os.path.join(folders[0], "products.csv"), "products")
    want = {f'Bar, ""{r.product_name}"" "Dark", Big' for r in tables(spark, SF001).products.collect()}
    assert {r.product_name for r in got.collect()} == want


def test_plain_writers_quoting_is_read(spark, tmp_path):
    (tmp_path / "p.csv").write_text('product_id,product_name,aisle_id,department_id\n1,"Bar, ""70%"" Dark, Big",2,3\n')
    row = read_csv_table(spark, str(tmp_path / "p.csv"), "products").first()
    assert row.product_name == 'Bar, "70%" Dark, Big' and row.department_id == 3


def test_steps_end_to_end(spark, folders, monkeypatch):
    raw, work = folders
    monkeypatch.setattr(ml, "FINAL_GBT", {**ml.FINAL_GBT, "n_estimators": 3, "max_depth": 2})
    h = jobs.take_holdout(spark, raw, work, 60, 20, 20)
    jobs.prepare_dataset(spark, raw, work)
    metrics = jobs.train_and_score(spark, work).first()
    scores = read_parquet_table(spark, os.path.join(work, "result", "y_pred_prob"))
    users = {r.user_id for r in tables(spark, SF001).orders.join(h.holdout_ids, "order_id").collect()}
    assert {r.user_id for r in scores.select("user_id").distinct().collect()} <= users
    assert scores.count() == metrics.tp + metrics.fp + metrics.fn + metrics.tn
    assert scores.filter("probability_1 < 0 or probability_1 > 1").count() == 0
    gains = {r.feature_names: float(r.gain) for r in spark.read.option("header", True).csv(
        os.path.join(work, "result", "feature_importance_gain")).collect()}
    splits: dict = {}
    for r in spark.read.parquet(os.path.join(work, "result", "gbt_model", "nodes")).filter("feature is not null").collect():
        splits.setdefault(r.feature, []).append(r.gain)
    assert gains == pytest.approx({f: sum(g) / len(g) for f, g in splits.items()})
    jobs.select_model(spark, raw, work, grids={"tiny": [dict(max_depth=2)]},
                      base=dict(n_estimators=3, learning_rate=0.3), patience=2, k=2)
    assert spark.read.option("header", True).csv(os.path.join(work, "result", "grid_tiny")).count() == 1


def test_selection_is_the_references(spark, folders, monkeypatch):
    """Every search with the reference's own features and parameters."""
    raw, work = str(folders[0]), str(folders[1]) + "-select"
    jobs.take_holdout(spark, raw, work, 60, 20, 20)
    monkeypatch.setattr(jobs, "write_csv", lambda *a: None)
    ran, final = [], []
    monkeypatch.setattr(ml, "grid_search", lambda df, grid, base, k, features, patience, journal: ran.append(
        ([{**base, **p} for p in grid], features, k, patience)))

    def cross_validate(df, make, features, k, early_stop, patience):
        final.append((early_stop, features, k, patience))
        return ml.CVResult(spark.createDataFrame([(0, 1.0)], "fold int, f1 double"), None, [1])
    monkeypatch.setattr(ml, "cross_validate", cross_validate)
    jobs.select_model(spark, raw, work)
    weak = {"current_order_hod", "user_likely_dow", "user_product_ave_add_to_cart_order"}
    bins = {"product_dept_bin", "product_aisle_bin", "current_order_hod"}
    every = set(mq.pf.NOTEBOOK_FEATURES)
    rates = lambda a, n: [round(a + 0.01 * i, 2) for i in range(n)]     # noqa: E731
    tree = lambda lr, d, s, c: (30000, d, lr, s, 1, c)                  # noqa: E731
    want = [([tree(lr, d, 0.5, 0.3) for lr in rates(0.02, 5) for d in (4, 5, 6)], every - bins),
            ([tree(lr, d, 0.5, 0.3) for lr in rates(0.01, 6) for d in (4, 5, 6)], every),
            ([tree(lr, d, 0.5, 0.3) for lr in rates(0.01, 6) for d in (4, 5, 6)], every - weak),
            ([tree(0.01, 6, s / 10, c / 10) for s in range(3, 8) for c in range(3, 8)], every - weak)]
    names = ("n_estimators", "max_depth", "learning_rate", "subsample", "min_child_weight", "colsample_bytree")
    got = [([tuple(round(p[x], 6) for x in names) for p in points], set(features or every)) for points, features, *_ in ran]
    assert got == want and sum(len(points) for points, _ in got) == 76
    assert {r[2:] for r in ran} == {(5, 50)}
    assert [(tuple(p[x] for x in names), set(f), k, n) for p, f, k, n in final] == [
        (tree(0.01, 6, 0.3, 0.7), every - weak, 5, 50)]


def test_small_final_cv_is_written(spark, folders):
    raw, work = str(folders[0]), str(folders[1]) + "-final"
    jobs.take_holdout(spark, raw, work, 60, 20, 20)
    jobs.select_model(spark, raw, work, grids={}, final=dict(n_estimators=2, max_depth=2), patience=1, k=2)
    rows = spark.read.option("header", True).csv(os.path.join(work, "result", "final_cv")).collect()
    assert sorted(r.fold for r in rows) == ["0", "1"] and all(1 <= int(r.best_rounds) <= 2 for r in rows)
