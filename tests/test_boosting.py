import math
import os
import pickle
import random
import shutil

import numpy as np
import pytest
from pyspark import RDD
from pyspark.sql import functions as F

from rebuy.operators import boosting as bo
from rebuy.operators import evaluate as ev

FEATURES = ["signal", "noise", "steps", "flat"]
KEYS = ["user_id", "product_id"]


@pytest.fixture(scope="module")
def rows(spark):
    rnd = random.Random(4)
    out = []
    for u in range(40):
        for p in range(10):
            x, s = rnd.random(), rnd.randint(-2, 2)
            y = int(x + 0.1 * s + 0.5 * rnd.random() > 0.9)
            out.append((u, p, y, u % 3, None if rnd.random() < 0.15 else x, rnd.random(), None if rnd.random() < 0.1 else float(s), 1.0))
    return spark.createDataFrame(out, "user_id long, product_id long, reordered int, fold int, signal double, noise double, steps double, flat double")


def brute(table, specs, cuts, trees):
    """Plain Python boosting over binned rows: nested (feature, bin, nulls left, left, right) or a leaf value."""
    scale = bo.SCALE
    out = []
    for spec in specs:
        use = [r for r in table if spec.held_out is None or r["fold"] != spec.held_out]
        margin = {id(r): 0.0 for r in table}
        grown = []
        for number in range(trees):
            grads = {}
            keep = bo.drawn(np.array([r["key"] for r in use], np.int64).view(np.uint64), spec.subsample, spec.seed, number)
            seen = [r for r, k in zip(use, keep) if k]
            for r in seen:
                p = 1 / (1 + np.exp(-np.float64(margin[id(r)])))
                grads[id(r)] = (float(np.rint((p - r["y"]) * scale)), float(np.rint(p * (1 - p) * scale)))
            columns = bo.columns_of(spec, FEATURES, number)

            def sums(rs):
                return sum(grads[id(r)][0] for r in rs) / scale, sum(grads[id(r)][1] for r in rs) / scale

            def grow(rs, depth):
                g, h = sums(rs)
                best = (bo.LEAST_GAIN, None)
                if depth < spec.max_depth and (depth == 0 or h >= 2 * spec.min_child_weight):
                    for f in columns:
                        for t in range(1, bo.MAX_BINS - 1):
                            for null_left in (False, True):
                                left = [r for r in rs if (r["x"][f] == 0 and null_left) or 0 < r["x"][f] <= t]
                                lg, lh = sums(left)
                                rg, rh = g - lg, h - lh
                                if min(lh, rh) < spec.min_child_weight:
                                    continue
                                lam = spec.reg_lambda
                                gain = lg ** 2 / (lh + lam) + rg ** 2 / (rh + lam) - g ** 2 / (h + lam)
                                if gain > best[0] + 1e-9:
                                    best = (gain, (int(f), t, null_left))
                if best[1] is None:
                    return -spec.learning_rate * g / (h + spec.reg_lambda)
                f, t, null_left = best[1]
                goes = [(r["x"][f] == 0 and null_left) or 0 < r["x"][f] <= t for r in rs]
                return (f, t, null_left, grow([r for r, a in zip(rs, goes) if a], depth + 1),
                        grow([r for r, a in zip(rs, goes) if not a], depth + 1))
            tree = grow(seen, 0)
            grown.append(tree)
            for r in table:
                node = tree
                while isinstance(node, tuple):
                    f, t, null_left, a, b = node
                    node = a if (r["x"][f] == 0 and null_left) or 0 < r["x"][f] <= t else b
                margin[id(r)] += node
        out.append(grown)
    return out


def nested(tree, n=0):
    if tree.feature[n] < 0:
        return float(tree.value[n])
    return (int(tree.feature[n]), int(tree.threshold[n]), bool(tree.null_left[n]), nested(tree, 2 * n + 1), nested(tree, 2 * n + 2))


def alike(a, b):
    if isinstance(a, tuple) != isinstance(b, tuple):
        return False
    if isinstance(a, tuple):
        return a[:3] == b[:3] and alike(a[3], b[3]) and alike(a[4], b[4])
    return a == pytest.approx(b, abs=1e-9)


SPECS = [bo.Spec(n_estimators=9, max_depth=3, learning_rate=0.4, subsample=0.7, colsample_bytree=0.8, seed=3),
         bo.Spec(n_estimators=9, max_depth=2, learning_rate=0.3, min_child_weight=4.0, held_out=1),
         bo.Spec(n_estimators=9, max_depth=3, learning_rate=0.3, subsample=0.5, held_out=2, allowed=("steps", "noise"))]


def plain(df, cuts):
    out = []
    for r in df.withColumn("key", F.xxhash64(*KEYS)).collect():
        x = [int(bo.binned(np.array([math.nan if r[f] is None else r[f]]), c)[0]) for f, c in zip(FEATURES, cuts)]
        out.append(dict(x=x, y=r["reordered"], fold=r["fold"], key=r["key"]))
    return out


@pytest.mark.parametrize("alone", [True, False])
def test_every_split_equals_brute_force(spark, rows, monkeypatch, alone):
    """Both ways of growing, and growing in several goes, give the trees of the plain trainer."""
    monkeypatch.setattr(bo, "MAX_BINS", 10)
    if not alone:
        monkeypatch.setattr(bo, "BLOCK_ROWS", 60)
    monkeypatch.setattr(bo, "STEP", 4)
    monkeypatch.setattr(bo, "LOCAL_STEP", 5)
    grown = bo.Boosting(rows.repartition(1 if alone else 5), FEATURES, "reordered", KEYS, SPECS, "fold", 10)
    assert grown.alone is alone
    grown.grow(2)
    grown.grow(100)
    want = brute(plain(rows, grown.cuts), SPECS, grown.cuts, 9)
    for got, tree in zip(grown.models, want):
        assert len(got) == 9
        assert all(alike(nested(a), b) for a, b in zip(got, tree))
    assert any(isinstance(t, tuple) for t in want[0]) and any(isinstance(t, tuple) for t in want[2])
    grown.close()


def test_dealing_does_not_matter(rows, monkeypatch):
    monkeypatch.setattr(bo, "BLOCK_ROWS", 50)
    trees, cuts = [], bo.cut_points(rows, FEATURES)
    for n in (3, 20):        # 20 parts are added in a tree of tasks
        b = bo.Boosting(rows.repartition(n), FEATURES, "reordered", KEYS, SPECS[:1], "fold", cuts=cuts)
        b.grow(3)
        trees.append([nested(t) for t in b.models[0]])
        assert not b.alone
    assert trees[0] == trees[1]


def test_sums_stay_with_the_executors(rows, monkeypatch):
    """What a distributed fit collects is splits, AUCs and a few ends, whatever the number of parts."""
    monkeypatch.setattr(bo, "BLOCK_ROWS", 50)
    specs = [bo.Spec(n_estimators=6, max_depth=4, held_out=f) for f in range(3)]
    b = bo.Boosting(rows.repartition(5), FEATURES, "reordered", KEYS, specs, "fold", cuts=bo.cut_points(rows, FEATURES))
    sent, collect = [], RDD.collect
    monkeypatch.setattr(RDD, "collect", lambda self: sent.append(collect(self)) or sent[-1])
    b.grow(6)
    b.staged_auc([0] * 3)
    assert not b.alone and len(sent) >= 6 * 4
    assert max(len(pickle.dumps(got)) for got in sent) < 10_000


def test_a_table_of_some_hundred_thousand_rows_grows_in_one_job(spark, monkeypatch):
    """No job per level: each ensemble grows in a task of its own, from blocks binned by many
    tasks, with the trees and AUCs that a fit dealt over tasks has."""
    df = spark.range(300_000, numPartitions=4).select(
        F.col("id").alias("user_id"), (F.col("id") % 7).alias("product_id"), (F.col("id") % 3).cast("int").alias("fold"),
        (F.xxhash64("id") % 50).cast("double").alias("signal"), (F.xxhash64("id", F.lit(1)) % 9).cast("double").alias("noise"),
        ((F.xxhash64("id") % 50 + F.xxhash64("id", F.lit(2)) % 30) > 0).cast("int").alias("reordered"))
    specs = [bo.Spec(n_estimators=3, max_depth=3, subsample=0.5, held_out=f) for f in (0, 1)] + [bo.Spec(n_estimators=2, max_depth=2)]
    two = ["signal", "noise"]
    cuts = bo.cut_points(df, two)
    sent, collect = [], RDD.collect
    monkeypatch.setattr(RDD, "collect", lambda self: sent.append(1) or collect(self))
    grown = bo.Boosting(df, two, "reordered", KEYS, specs, "fold", cuts=cuts)
    grown.grow(3)
    assert grown.alone and len(sent) == 1 and [len(m) for m in grown.models] == [3, 3, 2]
    monkeypatch.setattr(bo, "BLOCK_ROWS", 50_000)
    dealt = bo.Boosting(df, two, "reordered", KEYS, specs, "fold", cuts=cuts)
    dealt.grow(3)
    assert not dealt.alone
    assert [[nested(t) for t in m] for m in grown.models] == [[nested(t) for t in m] for m in dealt.models]
    for a, b in zip(grown.staged_auc([1, 0, 0])[:2], dealt.staged_auc([1, 0, 0])[:2]):
        assert a.tolist() == pytest.approx(b.tolist(), abs=1e-12) and len(a)
    grown.close()
    dealt.close()


def test_files_of_the_rows_may_go_away(spark, rows, monkeypatch):
    """A level's tasks get the newest tree only and map their rows from files; where these are gone,
    in the middle of a tree too, rows are laid down again and trees replayed: the same trees."""
    monkeypatch.setattr(bo, "BLOCK_ROWS", 50)
    specs = [bo.Spec(n_estimators=7, max_depth=4, learning_rate=0.4, subsample=0.8, min_child_weight=0.1, held_out=f) for f in (0, 1)]
    cuts, found = bo.cut_points(rows, FEATURES), []
    for lose in (False, True):
        b = bo.Boosting(rows.repartition(5), FEATURES, "reordered", KEYS, specs, "fold", cuts=cuts)
        assert not b.alone
        if lose:
            sent, summed = [], b._summed

            def losing(make, of, since, until, *join):
                sent.append([n - a for a, n in zip(since, until)])
                if len(sent) in (1, 10, 18, 30):        # the first level, others, and the AUC
                    b.laid.foreachPartition(lambda blocks: [shutil.rmtree(x.folder, ignore_errors=True) for x in blocks])
                return summed(make, of, since, until, *join)
            b._summed = losing
        aucs = [[], []]
        for _ in range(2):
            b.grow(4)
            for own, new in zip(aucs, b.staged_auc([len(a) for a in aucs])):
                own += new.tolist()
        if lose:
            levels = [n for n in sent if max(n) <= 1]
            assert len(sent) == 7 * 4 + 4 and len(levels) == 7 * 4        # all but the AUC's
        found.append(([[nested(t) for t in m] for m in b.models], aucs))
        folders = set(b.laid.map(lambda x: x.folder).collect())
        b.close()
        assert folders and not any(os.path.exists(f) for f in folders)
    assert found[0] == found[1] and [len(a) for a in found[0][1]] == [7, 7]


def test_staged_scores_equal_cut_models(rows):
    b = bo.Boosting(rows, FEATURES, "reordered", KEYS, [bo.Spec(n_estimators=12, max_depth=3)])
    b.grow(12)
    counts = [0, 1, 5, 12]
    staged = {(r.user_id, r.product_id): r.p for r in b.ensemble(0).probabilities(rows, counts, "p").collect()}
    for i, n in enumerate(counts):
        one = b.ensemble(0, n).probabilities(rows).collect()
        assert all(r.probability_1 == pytest.approx(staged[r.user_id, r.product_id][i], abs=1e-12) for r in one)
    assert {p[0] for p in staged.values()} == {0.5}
    with pytest.raises(ValueError):
        b.ensemble(0).probabilities(rows, [13])


def test_grid_points_are_scored_together(rows):
    """One pass scores every point's models, each on its own fold, as one by one; rows without a fold take no part."""
    from rebuy.plans import model as ml
    specs = [bo.Spec(n_estimators=n, max_depth=2, learning_rate=0.5, held_out=f) for n in (2, 7) for f in range(3)]
    b = bo.Boosting(rows, FEATURES, "reordered", KEYS, specs, "fold")
    b.grow(7)
    models = [b.ensemble(i) for i in range(6)]
    df = rows.withColumn("fold", F.when(F.col("user_id") > 1, F.col("fold")))
    got = sorted((r.model, r.label, r.probability_1) for r in bo.own_fold_probabilities(df, models, 3, "reordered").collect())
    want = sorted((i, float(r.reordered), r.probability_1) for i, m in enumerate(models)
                  for r in m.probabilities(df.filter(F.col("fold") == i % 3)).collect())
    assert got == want
    found = {r.point: r for r in ml.point_f1(df, models, 3).collect()}
    for p in range(2):
        one = ml.boosted_result(df, models[3 * p:3 * p + 3], [], FEATURES).summary.first()
        assert found[p].mean_best_f1 == pytest.approx(one.mean_best_f1) and found[p].std_best_f1 == pytest.approx(one.std_best_f1)
    b.close()


def test_staged_auc_and_stopping(rows, monkeypatch):
    monkeypatch.setattr(bo, "STEP", 6)
    specs = [bo.Spec(n_estimators=40, max_depth=2, learning_rate=0.5, held_out=f) for f in range(3)]
    b = bo.Boosting(rows, FEATURES, "reordered", KEYS, specs, "fold")
    best, scores = bo.grow_until_best(b, 5)
    for f in range(3):
        valid = rows.filter(F.col("fold") == f)
        for n in (1, 3, len(scores[f])):
            s = b.ensemble(f, n).probabilities(valid)
            assert ev.auc(ev.curve_counts(s, "reordered", "probability_1")).first().auc == pytest.approx(scores[f][n - 1], abs=2e-3)
        assert best[f] == bo.best_round(scores[f], 5)[0] and len(scores[f]) < 40
        assert scores[f][best[f] - 1] == max(scores[f][:best[f] + 5])


def test_best_round():
    scores = [0.5, 0.6, 0.7, 0.69, 0.7, 0.68, 0.9]
    assert bo.best_round(scores, 3) == (3, True)
    assert bo.best_round(scores, 5) == (7, False)
    assert bo.best_round([0.1, 0.2, 0.3], 3) == (3, False)
    assert bo.best_round([], 3) == (0, False)


def test_save_and_load(spark, rows, tmp_path):
    b = bo.Boosting(rows, FEATURES, "reordered", KEYS, SPECS[:1], "fold")
    b.grow(6)
    model = b.ensemble(0)
    model.save(spark, str(tmp_path / "m"))
    back = bo.Ensemble.load(spark, str(tmp_path / "m"))
    a, c = (sorted(r.probability_1 for r in m.probabilities(rows).collect()) for m in (model, back))
    assert a == c
    nodes = model.nodes(spark).collect()
    assert all((r.feature is None) == (r.gain is None) for r in nodes)
    assert sum(r.feature is not None for r in nodes) == sum(int((t.feature >= 0).sum()) for t in model.trees)


def test_awkward_tables(spark, rows):
    """One class only, an empty table, columns without a value, clashing names."""
    spec = bo.Spec(n_estimators=3, max_depth=2)
    good = rows.filter("reordered = 0").withColumn("x0", F.lit("x")).withColumn("y", F.lit("y")).withColumn("key", F.lit(1))
    b = bo.Boosting(good, FEATURES, "reordered", KEYS, [spec])
    b.grow(3)
    assert b.ensemble(0).probabilities(good).filter("probability_1 >= 0.5").count() == 0
    empty = bo.Boosting(rows.limit(0), FEATURES, "reordered", KEYS, [spec])
    empty.grow(3)
    assert {r.probability_1 for r in empty.ensemble(0).probabilities(rows).collect()} == {0.5}
    blank = rows.withColumn("signal", F.lit(None).cast("double"))
    b = bo.Boosting(blank, FEATURES, "reordered", KEYS, [spec])
    b.grow(2)
    assert b.ensemble(0).probabilities(blank).count() == 400
