import itertools
import random

import pytest
from pyspark.sql import functions as F

from rebuy.operators import evaluate as ev


def _df(spark, ys, ps):
    return spark.createDataFrame(list(zip(ys, ps)), "y int, p double")


def test_toy_auc_best_f1_confusion(spark):
    d = _df(spark, [1, 0, 1, 0], [.9, .8, .7, .1])
    curve = ev.curve_counts(d, "y", "p")
    assert ev.auc(curve).first().auc == pytest.approx(0.75)
    b = ev.best_f1(ev.pr_points(curve)).first()
    assert (b.f1, b.threshold, b.recall) == (pytest.approx(0.8), 0.7, 1.0)
    assert b.precision == pytest.approx(2 / 3)
    m = ev.confusion_metrics(ev.predict(d, "p", 0.2114), "y", "prediction").first()
    assert (m.tp, m.fp, m.fn, m.tn, m.accuracy) == (2, 1, 0, 1, 0.75)


def test_tie_auc(spark):
    curve = ev.curve_counts(_df(spark, [1, 0], [.5, .5]), "y", "p")
    assert ev.auc(curve).first().auc == pytest.approx(0.5)


def test_strict_threshold(spark):
    d = ev.predict(_df(spark, [1, 1], [0.2114, 0.2115]), "p", 0.2114)
    assert [r.prediction for r in d.orderBy("p").collect()] == [0, 1]


def _brute_auc(ys, ps):
    pos = [p for y, p in zip(ys, ps) if y == 1]
    neg = [p for y, p in zip(ys, ps) if y == 0]
    s = sum(1.0 if a > b else 0.5 if a == b else 0.0 for a, b in itertools.product(pos, neg))
    return s / (len(pos) * len(neg))


def test_auc_equals_pair_count_many_blocks(spark):
    rnd = random.Random(7)
    ys = [rnd.randint(0, 1) for _ in range(600)]
    ps = [round(rnd.random(), 2) for _ in range(600)]          # many ties
    curve = ev.curve_counts(_df(spark, ys, ps), "y", "p")
    assert ev.auc(curve).first().auc == pytest.approx(_brute_auc(ys, ps), abs=1e-12)


def test_auc_invariant_under_monotone_map(spark):
    rnd = random.Random(3)
    ys = [rnd.randint(0, 1) for _ in range(300)]
    ps = [rnd.random() for _ in range(300)]
    d = _df(spark, ys, ps)
    a1 = ev.auc(ev.curve_counts(d, "y", "p")).first().auc
    a2 = ev.auc(ev.curve_counts(d.withColumn("p", F.col("p") ** 3), "y", "p")).first().auc
    assert a1 == pytest.approx(a2)


def test_pr_curve_stops_at_full_recall(spark):
    d = _df(spark, [1, 0, 1, 0, 0], [.9, .8, .7, .2, .1])
    pts = ev.pr_points(ev.curve_counts(d, "y", "p")).orderBy(F.desc("threshold")).collect()
    assert [r.threshold for r in pts] == [.9, .8, .7, None]
    assert pts[-2].recall == 1.0
    assert (pts[-1].recall, pts[-1].precision) == (0.0, 1.0)
    first = ev.roc_points(ev.curve_counts(d, "y", "p")).filter("threshold is null").collect()
    assert [(r.fpr, r.tpr) for r in first] == [(0.0, 0.0)]


def test_fold_metrics_keys(spark):
    rows = [(f, y, p) for f in range(3) for y, p in [(1, .9), (0, .2), (1, .6), (0, .7)]]
    d = spark.createDataFrame(rows, "fold int, y int, p double")
    m = {r.fold: r for r in ev.fold_metrics(d, "y", "p").collect()}
    assert set(m) == {0, 1, 2}
    assert all(r.auc == pytest.approx(0.75) for r in m.values())
    s = ev.fold_summary(ev.fold_metrics(d, "y", "p")).first()
    assert s.folds == 3 and s.std_auc == pytest.approx(0.0)
