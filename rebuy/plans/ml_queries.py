"""Model-training queries (checked rows-only by the driver and by their own
tests; a trained model has no SQL equivalent).

Data follows the reference: the final model trains on the holdout job's
training lines and scores its holdout lines; model selection runs on the
holdout job's subset (subset current lines + the prior lines of its users
and the extra users), with the notebook's feature set.

The final model uses the reference's parameters unchanged (843 trees), and
model selection its own: up to 30,000 trees a fold, 50 rounds of patience, the
grids of 15 to 25 points (one query each).  The queries named ``*_probe`` are
small settings of the same machinery, kept for a quick look.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rebuy.functions.columns import FINAL_THRESHOLD, linspace
from rebuy.operators import evaluate as ev
from rebuy.operators import sampling as sp
from rebuy.plans import features as pf
from rebuy.plans import model as ml
from rebuy.plans.stash import stash
from rebuy.session import scratch_path
from rebuy.plans.queries import (FOLD_SALT, K_FOLDS, finish, holdout, query,
                                 tables)

# The reference's search grids (fixed values), in its order: 76 points.
REFERENCE_GRIDS = {
    "lr_depth": [dict(learning_rate=lr, max_depth=d) for lr in linspace(0.02, 0.06, 5) for d in (4, 5, 6)],
    "lr_depth_binned": [dict(learning_rate=lr, max_depth=d) for lr in linspace(0.01, 0.06, 6)
                        for d in (4, 5, 6)],
    "lr_depth_strong": [dict(learning_rate=lr, max_depth=d) for lr in linspace(0.01, 0.06, 6)
                        for d in (4, 5, 6)],
    "sub_col": [dict(subsample=s, colsample_bytree=c) for s in linspace(0.3, 0.7, 5)
                for c in linspace(0.3, 0.7, 5)],
}
SELECTION_BASE = dict(n_estimators=ml.EARLY_STOP_CAP, max_depth=3, learning_rate=0.1, subsample=0.5,
                      min_child_weight=1, colsample_bytree=0.3)
FINAL_CV = dict(n_estimators=ml.EARLY_STOP_CAP, max_depth=6, learning_rate=0.01, subsample=0.3,
                min_child_weight=1, colsample_bytree=0.7)
# The subsample x colsample grid searches around the depth and rate found before.
GRID_BASES = {"sub_col": dict(SELECTION_BASE, max_depth=6, learning_rate=0.01)}
# What the *_probe queries run instead (see the module doc).
PROBE = dict(n_estimators=20, max_depth=4, learning_rate=0.06, subsample=0.5,
             min_child_weight=1, colsample_bytree=0.3)
PROBE_PATIENCE = 5
PROBE_GRID = [dict(learning_rate=0.06, max_depth=4), dict(learning_rate=0.06, max_depth=6)]

_FINAL: dict = {}
_SELECTION: dict = {}


def production_tables(spark, sf):
    t = tables(spark, sf)
    h = holdout(t)
    train, test, _ = pf.train_test_tables(t.orders, t.prior, h.train_lines, h.test_lines, t.products)
    return train, test


def final_model(spark, sf):
    """The final model, fitted once per application, saved (S6) and loaded
    again by its three consumers."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _FINAL:
        train, test = production_tables(spark, sf)
        model, feats = ml.fit_final(train)
        path = scratch_path(spark, f"final-model-{uuid.uuid4().hex}")
        ml.save_model(spark, model, path)
        _FINAL[key] = (path, feats, stash(test))
    path, feats, test = _FINAL[key]
    return ml.load_model(spark, path), feats, test


def selection_table(spark, sf) -> DataFrame:
    """Notebook feature table on the model-selection subset, with folds: built
    once per application and stored."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _SELECTION:
        t = tables(spark, sf)
        h = holdout(t)
        ft, _ = pf.feature_table(t.orders, h.subset_prior_lines, h.subset_lines, t.products, notebook=True)
        _SELECTION[key] = stash(sp.with_folds(ft, K_FOLDS, FOLD_SALT))
    return _SELECTION[key]


@query("gbt_scores")
def q_gbt_scores(spark, sf):
    model, feats, test = final_model(spark, sf)
    return finish(ml.holdout_scores(model, feats, test, FINAL_THRESHOLD))


@query("gbt_holdout_metrics")
def q_gbt_holdout_metrics(spark, sf):
    model, feats, test = final_model(spark, sf)
    s = ml.holdout_scores(model, feats, test, FINAL_THRESHOLD)
    return finish(ev.confusion_metrics(s, "reordered", "prediction"))


@query("feature_importance")
def q_feature_importance(spark, sf):
    model, feats, _ = final_model(spark, sf)
    return finish(ml.feature_importance(model.nodes(spark)))


STAGES = [1, 50, ml.FINAL_GBT["n_estimators"]]


@query("gbt_staged_scores")
def q_gbt_staged_scores(spark, sf):
    """M4: probabilities at the tree limits 1, 50 and all, from one pass."""
    model, _, test = final_model(spark, sf)
    return finish(ml.staged_scores(model, test, STAGES))


@query("gbt_splits")
def q_gbt_splits(spark, sf):
    """M14's source: the split table of the saved final model."""
    model, _, _ = final_model(spark, sf)
    return finish(model.nodes(spark))


@query("standardized")
def q_standardized(spark, sf):
    """M2: scaler fitted on the training folds of fold 0, applied to every row."""
    df = selection_table(spark, sf)
    d, inputs = ml.prepare(df, ml.feature_columns(df))
    m = ml.PopulationScaler(inputs).fit(d.filter(F.col("fold") != 0))
    return finish(m.transform(d).select("user_id", "product_id", "fold", *inputs))


def _early_stop(spark, sf, params: dict, patience: int) -> DataFrame:
    df = selection_table(spark, sf)
    feats = ml.feature_columns(df)
    _, best, scores = ml.fit_early_stopped(df, feats, [ml.spec(params, feats, f) for f in range(K_FOLDS)], patience)
    out = [(f, i + 1, float(v), i + 1 == best[f]) for f, own in enumerate(scores) for i, v in enumerate(own)]
    return finish(spark.createDataFrame(out, "fold int, n_trees int, validation_auc double, best boolean"))


@query("gbt_early_stop")
def q_gbt_early_stop(spark, sf):
    """M5: validation AUC per boosting round of every fold, best count."""
    return _early_stop(spark, sf, FINAL_CV, ml.EARLY_STOP_ROUNDS)


@query("gbt_early_stop_probe")
def q_gbt_early_stop_probe(spark, sf):
    return _early_stop(spark, sf, {**FINAL_CV, "n_estimators": 100}, PROBE_PATIENCE)


@query("lr_baseline")
def q_lr_baseline(spark, sf):
    """M6 + M9: L2 logistic regression, standardised, 5-fold CV summary."""
    res = ml.cross_validate_logistic(selection_table(spark, sf), ["user_product_reordered_past"], k=K_FOLDS)
    return finish(res.summary)


@query("cv_metrics")
def q_cv_metrics(spark, sf):
    """M9: per-fold metrics of the L2 baseline on the full notebook features."""
    return finish(ml.cross_validate_logistic(selection_table(spark, sf), k=K_FOLDS).fold_metrics)


# The notebook's feature sets grow stage by stage; bins come after all of these.
BINNED = ["product_dept_bin", "product_aisle_bin", "current_order_hod"]
UNBINNED = [c for c in pf.NOTEBOOK_FEATURES if c not in BINNED]
USER_STAGE = [c for c in UNBINNED if c == "user_product_reordered_past"
              or c.startswith("user_") and not c.startswith("user_product_")]
STRONG = [c for c in pf.NOTEBOOK_FEATURES if c not in pf.WEAK_FEATURES]
# The columns a grid sees; the others see all.
GRID_FEATURES = {"lr_depth": UNBINNED, "lr_depth_strong": STRONG, "sub_col": STRONG}
L1_STAGES = {"user": USER_STAGE, "user_product": USER_STAGE + [c for c in UNBINNED if c.startswith("product_")],
             "all": UNBINNED}


@query("lr_l1_grid")
def q_lr_l1_grid(spark, sf):
    """M7: L1 logistic regression over C for the three feature stages, mean
    best F1 of each."""
    return finish(ml.logistic_grid(selection_table(spark, sf), L1_STAGES, ml.LR_C_GRID, k=K_FOLDS))


@query("rf_grid")
def q_rf_grid(spark, sf):
    """M8: random forest, 500 trees, min leaf 75, over the depths 30 to 50, with the
    depth of its deepest tree."""
    found = ml.forest_grid(selection_table(spark, sf), UNBINNED, ml.RF_GRID_DEPTHS, K_FOLDS)
    cols, rows, held = ("mean_best_f1", "std_best_f1", "mean_auc"), [], {}
    for depth, fitted, res in found:
        if fitted not in held:
            held[fitted] = res.summary.select(*cols).first()     # one row
        rows.append((depth, fitted, *held[fitted]))
    return finish(spark.createDataFrame(rows, "max_depth int, fitted_depth int, mean_best_f1 double, std_best_f1 double, mean_auc double"))


def _cv_gbt(spark, sf, params: dict, patience: int) -> DataFrame:
    df = selection_table(spark, sf).drop(*pf.WEAK_FEATURES)
    res = ml.cross_validate(df, None, k=K_FOLDS, early_stop=params, patience=patience)
    rounds = F.create_map(*[F.lit(x) for i, n in enumerate(res.best_rounds) for x in (i, n)])
    return finish(res.fold_metrics.withColumn("best_rounds", F.get(F.array(rounds), F.lit(0))[F.col("fold")]))


@query("cv_gbt")
def q_cv_gbt(spark, sf):
    """The final CV, early-stopped boosted trees without the three weak
    features, with the best round count of every fold."""
    return _cv_gbt(spark, sf, FINAL_CV, ml.EARLY_STOP_ROUNDS)


@query("cv_gbt_probe")
def q_cv_gbt_probe(spark, sf):
    return _cv_gbt(spark, sf, {**FINAL_CV, "n_estimators": PROBE["n_estimators"]}, PROBE_PATIENCE)


@query("cv_gbt_fold_bins")
def q_cv_gbt_fold_bins(spark, sf):
    """M10 with the department and aisle bins fitted without the fold they are
    tested on (B4 per fold)."""
    df = selection_table(spark, sf).drop(*pf.WEAK_FEATURES)
    feats = ml.feature_columns(df)
    keyed = df.join(tables(spark, sf).products.select("product_id", "department_id", "aisle_id"), "product_id", "left")
    bins = {c: b for c, b in {"product_dept_bin": ("department_id", "department"),
                              "product_aisle_bin": ("aisle_id", "aisle")}.items() if c in feats}
    return finish(ml.cross_validate_fold_bins(keyed, feats, bins, FINAL_CV, K_FOLDS).fold_metrics)


def _grid(spark, sf, grid: list[dict], base: dict, features=None, patience: int = ml.EARLY_STOP_ROUNDS) -> DataFrame:
    g = ml.grid_search(selection_table(spark, sf), grid, base, k=K_FOLDS, features=features, patience=patience)
    return finish(g.withColumn("best", F.col("rank") == 1))


def _register_grid(name: str) -> None:
    @query(f"grid_{name}")
    def q_grid(spark, sf):
        """M11 + L6: CV mean best F1 per point of one of the reference's grids."""
        return _grid(spark, sf, REFERENCE_GRIDS[name], GRID_BASES.get(name, SELECTION_BASE), GRID_FEATURES.get(name))


for _name in REFERENCE_GRIDS:
    _register_grid(_name)


@query("grid_search_probe")
def q_grid_search_probe(spark, sf):
    return _grid(spark, sf, PROBE_GRID, PROBE, patience=PROBE_PATIENCE)


def _ablation(spark, sf, params: dict, patience: int) -> DataFrame:
    df = selection_table(spark, sf)
    every = ml.feature_columns(df)
    sets = {"all": every, "without_weak": [c for c in every if c not in pf.WEAK_FEATURES]}
    specs = [ml.spec(params, f, fold) for f in sets.values() for fold in range(K_FOLDS)]
    models, rounds, _ = ml.fit_early_stopped(df, every, specs, patience)       # both sets grow together
    out = None
    for i, name in enumerate(sets):
        own = slice(i * K_FOLDS, (i + 1) * K_FOLDS)
        s = ml.boosted_result(df, models[own], rounds[own], every).summary
        s = s.select(F.lit(name).alias("features"), "mean_best_f1", "mean_auc")
        out = s if out is None else out.unionByName(s)
    return finish(out)


@query("ablation")
def q_ablation(spark, sf):
    """The same CV with and without the three weakest features."""
    return _ablation(spark, sf, FINAL_CV, ml.EARLY_STOP_ROUNDS)


@query("ablation_probe")
def q_ablation_probe(spark, sf):
    return _ablation(spark, sf, PROBE, PROBE_PATIENCE)
