import hashlib

from pyspark.sql import functions as F

from rebuy.operators.sampling import Holdout, exact_sample, user_folds


def _brute(ids, n, salt):
    return sorted(ids, key=lambda i: (hashlib.md5(f"{i}#{salt}".encode()).hexdigest(), i))[:n]


def test_exact_sample_matches_brute_force(spark):
    ids = list(range(0, 5000, 3))
    d = spark.createDataFrame([(i,) for i in ids], "order_id long")
    for n in (1, 17, 500, len(ids), len(ids) + 10):
        got = sorted(r.order_id for r in exact_sample(d, ["order_id"], n, "42").collect())
        assert got == sorted(_brute(ids, n, "42"))


def test_holdout_invariants(spark, toy):
    h = Holdout(toy.orders, toy.train, toy.prior, n_total=2, n_subset=1, n_extra_users=1, seed=42)
    sample = {r.order_id for r in h.sample_ids.collect()}
    sub = {r.order_id for r in h.subset_ids.collect()}
    hold = {r.order_id for r in h.holdout_ids.collect()}
    assert len(sample) == 2 and len(sub) == 1 and sub <= sample and hold == sample - sub
    train = {r.order_id for r in h.train_lines.collect()}
    test = {r.order_id for r in h.test_lines.collect()}
    assert not train & test and sub <= train
    total = toy.train.count()
    assert h.train_lines.count() + h.test_lines.count() == total


def test_folds_partition_users(spark, toy):
    f = user_folds(toy.orders, k=5)
    rows = f.collect()
    assert len(rows) == toy.orders.select("user_id").distinct().count()
    assert all(0 <= r.fold < 5 for r in rows)
    assert f.groupBy("user_id").count().filter(F.col("count") > 1).count() == 0


def test_hash_rank_and_balanced_folds(spark):
    from rebuy.operators.sampling import hash_rank, user_folds_balanced
    ids = list(range(1, 2000, 7))
    d = spark.createDataFrame([(i,) for i in ids], "user_id long")
    order = sorted(ids, key=lambda i: (hashlib.md5(f"{i}#42".encode()).hexdigest(), i))
    got = {r.user_id: r.hash_rank for r in hash_rank(d, ["user_id"], "42").collect()}
    assert got == {u: p + 1 for p, u in enumerate(order)}
    sizes = [r["count"] for r in user_folds_balanced(d, 5).groupBy("fold").count().collect()]
    assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1
