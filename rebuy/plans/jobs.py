"""The reference's three entry points as Spark jobs over basket CSV files
(``orders.csv``, ``order_products__prior.csv``, ``order_products__train.csv``,
``products.csv`` in ``raw_dir``):

1. ``take_holdout``  - holdout / train / subset line tables (CSV);
2. ``prepare_dataset`` - train and holdout feature tables (Parquet, split
   partitioned) and the bin maps;
3. ``train_and_score`` - the final boosted-tree model (Spark ML format),
   holdout probabilities (Parquet) and the thresholded metrics;
4. ``select_model`` - the reference's search grids in full (CSV per grid) and
   its final CV (CSV of fold metrics).

``python -m rebuy.plans.jobs {holdout,prepare,train,select} RAW_DIR WORK_DIR``
"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import DataFrame, SparkSession

from rebuy.functions.columns import FINAL_THRESHOLD
from rebuy.operators import evaluate as ev
from rebuy.operators.sampling import Holdout
from rebuy.plans import model as ml
from rebuy.plans.features import train_test_tables
from rebuy.plans.stash import stash
from rebuy.session import JOB_CONF
from rebuy.sources.files import (read_csv_table, read_feature_tables, write_csv,
                                 write_feature_tables, write_parquet)


def _raw(spark: SparkSession, raw_dir: str, name: str) -> DataFrame:
    return read_csv_table(spark, os.path.join(raw_dir, f"{name}.csv"), name)


def take_holdout(spark: SparkSession, raw_dir: str, work_dir: str, n_total: int = 26000,
                 n_subset: int = 6000, n_extra_users: int = 6000, seed: int = 42) -> Holdout:
    h = Holdout(_raw(spark, raw_dir, "orders"), _raw(spark, raw_dir, "order_products__train"),
                _raw(spark, raw_dir, "order_products__prior"), n_total, n_subset, n_extra_users, seed)
    h.write(os.path.join(work_dir, "data"))
    return h


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return read_csv_table(spark, path, "order_products__train")


def prepare_dataset(spark: SparkSession, raw_dir: str, work_dir: str) -> None:
    data = os.path.join(work_dir, "data")
    train, test, bins = train_test_tables(
        _raw(spark, raw_dir, "orders"), _raw(spark, raw_dir, "order_products__prior"),
        _lines(spark, os.path.join(data, "train_order_products")),
        _lines(spark, os.path.join(data, "test_order_products")),
        _raw(spark, raw_dir, "products"))
    write_feature_tables(train, test, os.path.join(data, "final_dataset"))
    bins.department.save(os.path.join(data, "bin_maps", "department"))
    bins.aisle.save(os.path.join(data, "bin_maps", "aisle"))


def train_and_score(spark: SparkSession, work_dir: str) -> DataFrame:
    train, test = read_feature_tables(spark, os.path.join(work_dir, "data", "final_dataset"))
    model, feats = ml.fit_final(train)
    ml.save_model(spark, model, os.path.join(work_dir, "result", "gbt_model"))
    scores = ml.holdout_scores(model, feats, test, FINAL_THRESHOLD)
    write_parquet(scores, os.path.join(work_dir, "result", "y_pred_prob"))
    write_csv(ml.feature_importance(model.nodes(spark)), os.path.join(work_dir, "result", "feature_importance_gain"))
    return ev.confusion_metrics(scores, "reordered", "prediction")


def select_model(spark: SparkSession, raw_dir: str, work_dir: str, grids: dict | None = None,
                 base: dict | None = None, patience: int = ml.EARLY_STOP_ROUNDS, k: int = 5,
                 final: dict | None = None) -> None:
    """Cross-validated search on the subset's notebook table, each
    grid with its own features and base parameters (the first runs before the
    bins exist, the last two without the weak features), then M12, the CV of the
    final parameters without the weak features.  ``grids``, ``base`` and
    ``final`` replace the reference's; grids without ``final`` run no final CV."""
    from rebuy.operators.sampling import with_folds
    from rebuy.plans import ml_queries as mq
    from rebuy.plans.features import feature_table
    data = os.path.join(work_dir, "data")
    table, _ = feature_table(_raw(spark, raw_dir, "orders"),
                             _lines(spark, os.path.join(data, "subset_prior_order_products")),
                             _lines(spark, os.path.join(data, "subset_order_products")),
                             _raw(spark, raw_dir, "products"), notebook=True)
    folded = stash(with_folds(table, k))
    for name, grid in (mq.REFERENCE_GRIDS if grids is None else grids).items():
        found = ml.grid_search(folded, grid, base or mq.GRID_BASES.get(name, mq.SELECTION_BASE), k,
                               mq.GRID_FEATURES.get(name), patience,
                               journal=os.path.join(work_dir, "result", f"journal_{name}"))
        write_csv(found, os.path.join(work_dir, "result", f"grid_{name}"))
    final = final or (mq.FINAL_CV if grids is None else None)
    if final:
        res = ml.cross_validate(folded, None, mq.STRONG, k, early_stop=final, patience=patience)
        rounds = spark.createDataFrame(list(enumerate(res.best_rounds)), "fold int, best_rounds int")
        write_csv(res.fold_metrics.join(rounds, "fold", "left"), os.path.join(work_dir, "result", "final_cv"))


def main() -> None:
    p = argparse.ArgumentParser()
    p.add_argument("step", choices=["holdout", "prepare", "train", "select"])
    p.add_argument("raw_dir")
    p.add_argument("work_dir")
    a = p.parse_args()
    builder = SparkSession.builder.appName("rebuy")
    for key, value in JOB_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    if a.step == "holdout":
        take_holdout(spark, a.raw_dir, a.work_dir)
    elif a.step == "prepare":
        prepare_dataset(spark, a.raw_dir, a.work_dir)
    elif a.step == "train":
        train_and_score(spark, a.work_dir).show()
    else:
        select_model(spark, a.raw_dir, a.work_dir)


if __name__ == "__main__":
    main()
