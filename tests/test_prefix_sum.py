import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from rebuy.operators.prefix_sum import running_sum_by_number, running_sum_by_value


@pytest.mark.parametrize("descending", [False, True])
def test_blocked_equals_plain_window(spark, descending):
    rnd = random.Random(11)
    rows = []
    for u in range(4):
        n = [1, 5, 40, 300][u]            # one hot user
        for k in range(1, n + 1):
            rows.append((u, k, None if rnd.random() < 0.1 else float(rnd.randint(0, 9))))
    d = spark.createDataFrame(rows, "u int, k int, v double")
    o = F.desc("k") if descending else F.asc("k")
    w = Window.partitionBy("u").orderBy(o).rowsBetween(Window.unboundedPreceding, 0)
    want = {(r.u, r.k): r.s for r in d.withColumn("s", F.sum("v").over(w)).collect()}
    got = running_sum_by_number(d, ["u"], "k", {"v": "s"}, descending=descending, block_size=7)
    got = {(r.u, r.k): r.s for r in got.collect()}
    assert got == want


def test_value_blocks_global(spark):
    rnd = random.Random(5)
    rows = [(rnd.random(), rnd.randint(0, 3)) for _ in range(500)]
    d = spark.createDataFrame(rows, "x double, v long")
    w = Window.orderBy(F.desc("x")).rowsBetween(Window.unboundedPreceding, 0)
    want = {r.x: r.s for r in d.withColumn("s", F.sum("v").over(w)).collect()}
    got = running_sum_by_value(d, [], "x", {"v": "s"}, descending=True)
    assert {r.x: r.s for r in got.collect()} == want
