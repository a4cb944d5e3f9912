import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rebuy.operators import boosting as bo
from rebuy.operators import forest as fo
from rebuy.operators.sampling import with_folds
from rebuy.plans import model as ml


def _gini_drop(n, p, nl, pl):
    def g(m, q):
        return m * 2 * (q / m) * (1 - q / m)
    return g(n, p) - g(nl, pl) - g(n - nl, p - pl)


def test_every_split_is_the_best_one():
    """Each node's split drops Gini impurity as much as any cut of any column that leaves
    both children their least copies; leaves give their share of class 1."""
    rng = np.random.default_rng(3)
    x = rng.integers(1, 20, (4, 600)).astype(np.uint8)
    y = (x[0] + x[1] + rng.integers(0, 12, 600) > 26).astype(np.uint8)
    w = rng.poisson(1, 600)
    t = fo.tree_of(x, y, w, (1, 2), 6, 15, 4, bo.MAX_BINS)
    at = {0: np.flatnonzero(w)}
    splits = 0
    for i in range(len(t.left)):
        r = at[i]
        n, p = w[r].sum(), (w * y)[r].sum()
        assert t.value[i] == pytest.approx(p / n) and n >= 15
        every = {}
        for f in range(4):
            for b in range(1, 20):
                lo = r[x[f, r] <= b]
                nl = w[lo].sum()
                if nl >= 15 and n - nl >= 15:
                    every[f, b] = _gini_drop(n, p, nl, (w * y)[lo].sum())
        if t.left[i] == i:
            continue
        splits += 1
        f, b = t.feature[i], t.threshold[i]
        assert every[f, b] == pytest.approx(max(every.values()))
        at[t.left[i]], at[t.left[i] + 1] = r[x[f, r] <= b], r[x[f, r] > b]
    assert splits > 5 and t.depth <= 6


def test_cut_off_tree_is_the_tree_of_that_depth():
    rng = np.random.default_rng(4)
    x = rng.integers(1, 40, (9, 2000)).astype(np.uint8)
    y = (rng.random(2000) < x[2] / 60).astype(np.uint8)
    w = fo.copies(rng.integers(0, 1 << 60, 2000).astype(np.uint64), 42, 0)
    assert 0.9 < w.mean() < 1.1 and 0.85 < w.var() < 1.15
    grow = lambda d: fo.tree_of(x, y, w, (42, 7), d, 5, 3, bo.MAX_BINS)      # noqa: E731
    deep = grow(50)
    sums = np.zeros((3, 2000))
    fo.add_values(deep, x, [2, 5, 50], sums)
    assert deep.depth > 5
    for i, d in enumerate((2, 5, 50)):
        own = np.zeros((1, 2000))
        fo.add_values(grow(d), x, [d], own)
        assert (own[0] == sums[i]).all()


@pytest.fixture(scope="module")
def rare(spark):
    """Class 1 is rare, so every leaf is of class 0 at the cut: their shares still rank rows."""
    rnd = random.Random(5)
    rows = []
    for u in range(80):
        for p in range(10):
            s = rnd.random()
            rows.append((u, p, int(rnd.random() < 0.3 * s * s), s, rnd.random(), None if rnd.random() < 0.1 else 1.0))
    return with_folds(spark.createDataFrame(
        rows, "user_id long, product_id long, reordered int, signal double, noise double, product_dept_bin double"), 2, "42")


def test_forests_of_a_grid_grow_without_spark_ml(spark, rare, monkeypatch):
    """Depths beyond Spark ML's are fitted too, and no forest of its own is."""
    def none(*a, **b):
        raise AssertionError("a block's forests are not Spark ML's")
    monkeypatch.setattr(ml, "random_forest", none)
    found = ml.forest_grid(rare, ["signal", "noise", "product_dept_bin"], [1, 35, 50], 2, n_trees=60, min_leaf=20)
    assert [d for d, _, _ in found] == [1, 35, 50] and found[0][1] == 1 and found[1][1:] == found[2][1:] and found[1][1] > 1
    s = found[2][2].summary.first()
    assert s.folds == 2 and 0.6 < s.mean_auc <= 1


def test_forest_scores_hold_the_fold_out_and_repeat(spark, rare):
    d, inputs = ml.prepare(rare, ["signal", "noise", "product_dept_bin"])
    cuts = bo.cut_points(d, inputs)

    def run(df):
        out, _ = fo.fold_scores(df, inputs, "label", ml.KEYS, "fold", 2, 60, 20, [3, 50], cuts=cuts)
        return out
    a, b = run(d), run(d.repartition(5, "product_id"))
    rows = lambda x: sorted((r[0], r[1], r[2], *(round(p, 9) for p in r[3])) for r in x.collect())      # noqa: E731
    assert rows(a) == rows(b) and a.count() == 2 * d.count()
    assert a.filter("forall(probabilities, p -> p between 0 and 1)").count() == a.count()
    # labels of the fold held out teach nothing
    other = run(d.withColumn("label", F.when(F.col("fold") == 0, 1.0 - F.col("label")).otherwise(F.col("label"))))
    own = lambda x: sorted(tuple(r.probabilities) for r in x.filter("model = 0 and fold = 0").collect())      # noqa: E731
    assert np.allclose(own(a), own(other))


def test_tables_of_more_than_a_block_are_left_to_spark_ml(spark, rare, monkeypatch):
    monkeypatch.setattr(bo, "BLOCK_ROWS", 100)
    found = ml.forest_grid(rare, ["signal", "noise"], [30, 35], 2, n_trees=3, min_leaf=20)
    assert [d for d, _, _ in found] == [30, 35] and len(found[0][2].models) == 2


def test_a_table_in_parts_has_the_forests_of_a_whole_one(spark, rare, monkeypatch):
    """Results do not depend on how many parts or blocks the table's size makes of it."""
    def run(rows_of_a_part):
        monkeypatch.setattr(bo, "BLOCK_ROWS", rows_of_a_part)
        monkeypatch.setattr(bo, "PART_ROWS", rows_of_a_part)
        monkeypatch.setattr(fo, "PART_ROWS", rows_of_a_part)
        found = ml.forest_grid(rare, ["signal", "noise", "product_dept_bin"], [1, 35, 50], 2, n_trees=60, min_leaf=20)
        return [(d, own, *[round(v, 9) for v in res.summary.select("folds", "mean_best_f1", "mean_auc").first()]) for d, own, res in found]

    def none(*a, **b):
        raise AssertionError("no table is left to another library")
    monkeypatch.setattr(ml, "random_forest", none)
    whole = run(1 << 20)
    assert run(100) == whole and [d for d, *_ in whole] == [1, 35, 50]
    assert ml.forest_grid(rare, ["signal"], [3], 2, n_trees=3, min_leaf=20)[0][2].models[1] == fo.Forest(1, 3, 3)


def test_a_tree_over_parts_on_disk_and_by_few_nodes(monkeypatch):
    rng = np.random.default_rng(6)
    x = rng.integers(0, 40, (6, 3000)).astype(np.uint8)
    y = (rng.random(3000) < x[2] / 60).astype(np.uint8)
    w = rng.poisson(1, 3000)
    whole = fo.tree_of(x, y, w, (42, 7), 50, 5, 3, bo.MAX_BINS)
    monkeypatch.setattr(fo, "NODES", 3)
    disk = fo.Disk()
    parts = [(x[:, a:b], y[a:b], w[a:b]) for a, b in ((0, 0), (0, 1000), (1000, 1700), (1700, 3000))]
    some = fo.tree_over(iter(parts), (42, 7), 50, 5, 3, bo.MAX_BINS, lambda i, *a: tuple(disk.put(f"{i}.{c}", v) for c, v in enumerate(a)))
    disk.close()
    assert whole.depth == some.depth > 5 and all((getattr(whole, c) == getattr(some, c)).all() for c in ("feature", "threshold", "left", "value"))
