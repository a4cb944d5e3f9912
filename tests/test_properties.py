"""Property tests (hypothesis) for the exact sample and the AUC."""

import hashlib
import itertools

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from rebuy.operators import evaluate as ev
from rebuy.operators.sampling import exact_sample

SETTINGS = settings(max_examples=8, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(ids=st.sets(st.integers(0, 10**9), min_size=1, max_size=300), n=st.integers(1, 320),
       salt=st.sampled_from(["42", "7/subset", "x"]))
def test_exact_sample_is_smallest_hashes(spark, ids, n, salt):
    d = spark.createDataFrame([(i,) for i in ids], "order_id long")
    got = sorted(r.order_id for r in exact_sample(d, ["order_id"], n, salt).collect())
    want = sorted(sorted(ids, key=lambda i: (hashlib.md5(f"{i}#{salt}".encode()).hexdigest(), i))[:n])
    assert got == want


@SETTINGS
@given(rows=st.lists(st.tuples(st.integers(0, 1), st.integers(0, 20)), min_size=2, max_size=200))
def test_auc_is_pair_probability(spark, rows):
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    if not pos or not neg:
        return
    want = sum(1.0 if a > b else 0.5 if a == b else 0.0
               for a, b in itertools.product(pos, neg)) / (len(pos) * len(neg))
    d = spark.createDataFrame([(y, s / 20.0) for y, s in rows], "y int, p double")
    got = ev.auc(ev.curve_counts(d, "y", "p")).first().auc
    assert abs(got - want) < 1e-12


@SETTINGS
@given(rows=st.lists(st.tuples(st.integers(0, 3), st.one_of(st.none(), st.integers(-5, 9))),
                     min_size=1, max_size=120),
       block=st.integers(1, 9), descending=st.booleans())
def test_blocked_running_sum_equals_window(spark, rows, block, descending):
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    from rebuy.operators.prefix_sum import running_sum_by_number
    data = [(u, i + 1, None if v is None else float(v)) for i, (u, v) in enumerate(rows)]
    d = spark.createDataFrame(data, "u int, k int, v double")
    o = F.desc("k") if descending else F.asc("k")
    w = Window.partitionBy("u").orderBy(o).rowsBetween(Window.unboundedPreceding, 0)
    want = {(r.u, r.k): r.s for r in d.withColumn("s", F.sum("v").over(w)).collect()}
    got = running_sum_by_number(d, ["u"], "k", {"v": "s"}, descending=descending, block_size=block)
    assert {(r.u, r.k): r.s for r in got.collect()} == want
