import pytest
from pyspark.sql import functions as F

from rebuy.functions.columns import aisle_bin, dept_bin, hod_bin
from rebuy.operators.binning import SupervisedBinner, class_counts, class_ratios

DEPT = [(0.02, 2), (0.019, 1), (0.0, 1), (-0.01, -1), (-0.011, -2), (-0.02, -2), (-0.021, -3), (None, 0)]
AISLE = [(0.001, 2), (0.0009, 1), (0.0, 1), (-0.0009, -1), (-0.001, -2)]
HOUR = [(0.0, 1), (-0.1, -1), (None, 0)]


@pytest.mark.parametrize("fn,cases", [(dept_bin, DEPT), (aisle_bin, AISLE), (hod_bin, HOUR)])
def test_bin_boundaries(spark, fn, cases):
    d = spark.createDataFrame([(v,) for v, _ in cases], "diff double")
    got = [r.b for r in d.select(fn("diff").alias("b")).collect()]
    assert got == [b for _, b in cases]


def test_missing_class_null_vs_zero(spark):
    # key 3 appears only with label 0
    d = spark.createDataFrame([(1, 1), (1, 0), (2, 1), (3, 0), (None, 1)], "k int, reordered int")
    c = class_counts(d, "k")
    dept_like = {r.k: r for r in class_ratios(c, fill_missing=False).collect()}
    aisle_like = {r.k: r for r in class_ratios(c, fill_missing=True).collect()}
    assert dept_like[3].reordered is None and dept_like[3].diff is None
    assert aisle_like[3].reordered == 0.0
    assert aisle_like[3].diff == pytest.approx(-0.5)
    assert set(dept_like) == {1, 2, 3}          # NULL key dropped


def test_binner_unseen_key_is_null(spark):
    fit = spark.createDataFrame([(1, 1), (1, 0), (2, 1)], "k int, reordered int")
    m = SupervisedBinner("k", "b", "department").fit(fit)
    out = {r.k: r.b for r in m.transform(spark.createDataFrame([(1,), (9,)], "k int")).collect()}
    assert out[9] is None and out[1] is not None


def test_weighted_fit_equals_unweighted(spark):
    rows = [(k, y) for k, y, n in [(1, 1, 3), (1, 0, 5), (2, 0, 4), (3, 1, 2)] for _ in range(n)]
    d = spark.createDataFrame(rows, "k int, reordered int")
    w = d.groupBy("k", "reordered").count()
    a = SupervisedBinner("k", "b", "aisle").fit(d).mapping.orderBy("k").collect()
    b = SupervisedBinner("k", "b", "aisle", weightCol="count").fit(w).mapping.orderBy("k").collect()
    assert a == b


def test_fold_maps_equal_fits_without_the_fold(spark):
    """By subtraction, or fitted anew on the other folds' rows: the same maps."""
    import random
    from rebuy.operators import binning as bn
    rnd = random.Random(2)
    rows = [(rnd.randrange(3), rnd.randrange(8), int(rnd.random() < 0.4)) for _ in range(500)] + [(1, 99, 1), (2, None, 1)]
    df = spark.createDataFrame(rows, "fold int, aisle_id int, reordered int")
    for rule in ("aisle", "department"):
        maps = bn.fold_bin_maps(df, "aisle_id", rule, "bin", 3)
        got = sorted(map(tuple, maps.collect()), key=str)
        want = []
        for f in range(3):
            counts = bn.class_counts(df.filter(f"fold <> {f}"), "aisle_id")
            want += [(f, *r) for r in bn.bin_map(counts, "aisle_id", rule, "bin").collect()]
        assert got == sorted(want, key=str)
    wide = bn.with_fold_bins(df, maps, "aisle_id", "bin", 3)
    by = {(r.fold, r.aisle_id): r.bin for r in maps.collect()}
    for r in wide.collect():
        assert [r.bin_f0, r.bin_f1, r.bin_f2] == [by.get((f, r.aisle_id)) for f in range(3)]
    assert wide.filter("aisle_id = 99 and bin_f1 is not null").count() == 0
