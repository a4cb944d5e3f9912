import random

import pytest
from pyspark.sql import functions as F

from rebuy.operators import evaluate as ev
from rebuy.plans import model as ml
from rebuy.plans.features import feature_table


def test_forest_depth_is_never_clamped():
    with pytest.raises(ValueError):
        ml.random_forest(35)


@pytest.fixture(scope="module")
def planted(spark):
    rnd = random.Random(9)
    rows = []
    for u in range(60):
        for p in range(10):
            x = rnd.random()
            y = 1 if x + 0.3 * rnd.random() > 0.8 else 0
            rows.append((u, p, y, x, rnd.random(), None if rnd.random() < 0.1 else float(rnd.randint(-2, 2))))
    return spark.createDataFrame(
        rows, "user_id long, product_id long, reordered int, signal double, noise double, product_dept_bin double")


def test_gbt_learns_planted_signal(spark, planted):
    model, feats = ml.fit_final(planted, n_estimators=15, max_depth=3, learning_rate=0.3, subsample=1.0)
    s = ml.holdout_scores(model, feats, planted)
    assert s.filter((F.col("probability_1") < 0) | (F.col("probability_1") > 1)).count() == 0
    a = ev.auc(ev.curve_counts(s, "reordered", "probability_1")).first().auc
    assert a > 0.8
    nodes = [r for r in model.nodes(spark).collect() if r.feature is not None]
    imp = ml.feature_importance(model.nodes(spark)).collect()
    assert {r.feature_names for r in imp} == {r.feature for r in nodes}
    for r in imp:
        own = [n.gain for n in nodes if n.feature == r.feature_names]
        assert (r.gain, r.total_gain, r.splits) == (pytest.approx(sum(own) / len(own)), pytest.approx(sum(own)), len(own))
    assert imp[0].feature_names == "signal" and imp[0].feature_type == "Order"


def test_missing_indicator_added(planted):
    d, inputs = ml.prepare(planted, ["signal", "product_dept_bin"])
    assert "product_dept_bin_missing" in inputs
    assert d.filter(F.col("product_dept_bin").isNull()).count() == 0


def test_cross_validate_by_user(spark, planted):
    from rebuy.operators.sampling import with_folds
    df = with_folds(planted, 3)
    res = ml.cross_validate(df, lambda tr: ml.logistic(1.0, tr.count()), k=3, scale=True)
    rows = res.fold_metrics.collect()
    assert len(rows) == 3 and all(0.5 < r.auc <= 1 for r in rows)
    s = res.summary.first()
    assert s.folds == 3 and 0 <= s.mean_best_f1 <= 1


def test_early_stopped_cv(spark, planted):
    from rebuy.operators.sampling import with_folds
    df = with_folds(planted, 2)
    params = dict(n_estimators=12, max_depth=2, learning_rate=0.3, subsample=1.0, min_child_weight=1,
                  colsample_bytree=1.0)
    res = ml.cross_validate(df, None, k=2, early_stop=params, patience=3)
    assert len(res.best_rounds) == 2 and all(1 <= n <= 12 for n in res.best_rounds)


def test_grid_search_goes_on_from_its_journal(spark, planted, tmp_path, monkeypatch):
    """A search that dies after its first batch and starts anew gives the same
    ranking, without fitting finished points again."""
    from rebuy.operators.sampling import with_folds
    df = with_folds(planted, 2)
    base = dict(n_estimators=6, max_depth=2, learning_rate=0.3)
    grid = [dict(learning_rate=lr) for lr in (0.1, 0.3, 0.5)]
    whole = [tuple(r) for r in ml.grid_search(df, grid, base, 2, patience=3).collect()]
    fit, calls = ml.fit_early_stopped, []

    def dying(df, features, specs, patience):
        calls.append(len(specs))
        if len(calls) == 2:
            raise RuntimeError("the driver is gone")
        return fit(df, features, specs, patience)
    monkeypatch.setattr(ml, "fit_early_stopped", dying)
    path = str(tmp_path / "journal")
    with pytest.raises(RuntimeError):
        ml.grid_search(df, grid, base, 2, patience=3, journal=path, at_once=2)
    again = [tuple(r) for r in ml.grid_search(df, grid, base, 2, patience=3, journal=path, at_once=2).collect()]
    assert again == whole and calls == [4, 2, 2]
    with pytest.raises(ValueError):
        ml.grid_search(df, grid[::-1], base, 2, patience=3, journal=path)


def test_toy_feature_table_trains(spark, toy):
    ft, _ = feature_table(toy.orders, toy.prior, toy.train, toy.products, mode="none")
    model, feats = ml.fit_final(ft, n_estimators=3, max_depth=2)
    assert ml.holdout_scores(model, feats, ft).count() == 4


def test_population_scaler_matches_ddof0(spark):
    import statistics
    xs = [1.0, 2.0, 4.0, 7.0]
    d = spark.createDataFrame([(x, 5.0) for x in xs], "a double, b double")
    m = ml.PopulationScaler(["a", "b"]).fit(d)
    got = [r.a for r in m.transform(d).collect()]
    mu, sd = statistics.fmean(xs), statistics.pstdev(xs)
    assert got == pytest.approx([(x - mu) / sd for x in xs])
    assert {r.b for r in m.transform(d).collect()} == {0.0}      # zero spread: centred only
