import random

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from rebuy.operators import logistic as lo
from rebuy.plans import model as ml

COLUMNS = ("a", "b", "c", "flat")


@pytest.fixture(scope="module")
def rows(spark):
    rnd = random.Random(8)
    out = []
    for i in range(600):
        a, b, c = rnd.gauss(100, 3), rnd.random(), rnd.choice([0.0, 1.0, 5.0])
        y = float((a - 100) / 3 + 2 * b + rnd.gauss(0, 1) > 1)
        out.append((i, y, i % 3, a, b, c, 2.0))
    return spark.createDataFrame(out, "id long, label double, fold int, a double, b double, c double, flat double")


def spark_fit(rows, fit):
    train = rows.filter(F.col("fold") != fit.held_out) if fit.held_out is not None else rows
    scaled = ml.PopulationScaler(list(fit.columns)).fit(train).transform(train)
    d = VectorAssembler(inputCols=list(fit.columns), outputCol="features").transform(scaled)
    m = LogisticRegression(regParam=1.0 / (fit.C * train.count()), elasticNetParam=float(fit.l1), standardization=False,
                           maxIter=500, tol=1e-12).fit(d)
    return np.append(m.coefficients.toArray(), m.intercept)


def test_fits_agree_with_single_ones(rows):
    fits = [lo.Fit(cols, c, l1, fold) for cols in (COLUMNS, ("a", "c")) for c in (0.05, 1.0, 100.0) for l1 in (True, False)
            for fold in (None, 0, 2)]
    got, passes = lo.fit_all(rows.repartition(4), fits, "label")
    few, few_passes = lo.fit_all(rows, fits[:1], "label")
    assert passes < 25 and few_passes <= passes       # not by the number of fits
    for g in got[::2]:
        want = spark_fit(rows, g.fit)
        assert np.append(g.weights, g.bias) == pytest.approx(want, abs=1e-4)
    zero = next(g for g in got if g.fit.l1 and g.fit.C == 0.05 and len(g.fit.columns) == 4)
    assert zero.weights[3] == 0


def test_probabilities_in_the_columns_own_units(rows):
    fits = [lo.Fit(COLUMNS[:3], 1.0, False, f) for f in range(3)]
    got, _ = lo.fit_all(rows, fits, "label")
    scored = lo.probabilities(rows, got, ["id", "fold", "a", "b", "c"])
    assert scored.count() == 1800
    for r in scored.filter("id < 30").collect():
        m = got[r.model]
        z = (np.array([r.a, r.b, r.c]) - m.mean) / m.std @ m.weights + m.bias
        assert r.probability_1 == pytest.approx(1 / (1 + np.exp(-z)))
    own = lo.probabilities(rows, got, ["id", "fold"], own_fold_only=True)
    assert own.count() == 600 and own.filter("model <> fold").count() == 0


def test_separable_and_degenerate_tables(spark, rows):
    apart = rows.withColumn("label", (F.col("a") > 100).cast("double"))
    got, passes = lo.fit_all(apart, [lo.Fit(COLUMNS, 1e4, l1, f) for l1 in (True, False) for f in range(3)], "label")
    assert passes <= lo.MAX_STEPS and all(np.isfinite(g.weights).all() for g in got)
    one = rows.withColumn("label", F.lit(0.0))
    got, _ = lo.fit_all(one, [lo.Fit(COLUMNS, 1.0, False, None)], "label")
    assert lo.probabilities(one, got, ["id"]).filter("probability_1 > 0.01").count() == 0
    got, _ = lo.fit_all(rows.limit(0), [lo.Fit(COLUMNS)], "label")
    assert not got[0].weights.any()
    got, _ = lo.fit_all(rows, [lo.Fit((), 1.0, True)], "label")
    assert 1 / (1 + np.exp(-got[0].bias)) == pytest.approx(rows.agg(F.avg("label")).first()[0], abs=1e-6)


def test_grid_equals_single_cross_validations(spark, rows):
    """Every row of the grid is what a cross-validation of that point alone gives."""
    df = rows.select(F.col("id").alias("user_id"), F.lit(1).alias("product_id"), F.col("label").cast("int").alias("reordered"),
                     "fold", "a", "b", F.when(F.col("c") > 0, F.col("c")).alias("product_dept_bin"))
    stages = {"few": ["a"], "more": ["a", "b", "product_dept_bin"]}
    grid = {(r.stage, r.C): r for r in ml.logistic_grid(df, stages, [0.1, 10.0], k=3).collect()}
    assert len(grid) == 4
    for (stage, c), r in grid.items():
        one = ml.cross_validate_logistic(df, stages[stage], c, True, 3).summary.first()
        assert (r.mean_best_f1, r.std_best_f1, r.mean_auc) == pytest.approx((one.mean_best_f1, one.std_best_f1, one.mean_auc), abs=1e-6)
