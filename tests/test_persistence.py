import os
import tempfile

from rebuy.operators.binning import SupervisedBinner, SupervisedBinnerModel
from rebuy.operators.sampling import Holdout
from rebuy.plans import model as ml
from rebuy.plans.features import feature_table
from rebuy.sources.files import read_csv_table


def test_bin_map_round_trip(spark):
    d = spark.createDataFrame([(1, 1), (1, 0), (2, 0)], "department_id int, reordered int")
    m = SupervisedBinner("department_id", "product_dept_bin", "department").fit(d)
    path = os.path.join(tempfile.mkdtemp(prefix="rebuy-bins-"), "dept")
    m.save(path)
    back = SupervisedBinnerModel.load(spark, path, "department_id", "product_dept_bin")
    assert sorted(back.mapping.collect()) == sorted(m.mapping.collect())


def test_model_round_trip(spark, toy):
    ft, _ = feature_table(toy.orders, toy.prior, toy.train, toy.products, mode="none")
    model, feats = ml.fit_final(ft, n_estimators=2, max_depth=2)
    path = os.path.join(tempfile.mkdtemp(prefix="rebuy-model-"), "m")
    ml.save_model(spark, model, path)
    back = ml.load_model(spark, path)
    a = sorted(r.probability_1 for r in ml.holdout_scores(model, feats, ft).collect())
    b = sorted(r.probability_1 for r in ml.holdout_scores(back, feats, ft).collect())
    assert a == b
    assert back.features == feats


def test_holdout_csv_outputs(spark, toy):
    out = tempfile.mkdtemp(prefix="rebuy-holdout-")
    h = Holdout(toy.orders, toy.train, toy.prior, 2, 1, 1, mode="none")
    h.write(out)
    for name in ("train_order_products", "test_order_products", "subset_order_products",
                 "subset_prior_order_products"):
        df = read_csv_table(spark, os.path.join(out, name), "order_products__train")
        assert df.columns == ["order_id", "product_id", "add_to_cart_order", "reordered"]
    assert read_csv_table(spark, os.path.join(out, "train_order_products"),
                          "order_products__train").count() == h.train_lines.count()
