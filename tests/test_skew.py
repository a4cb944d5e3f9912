"""A basket where one user holds a third of all orders: the blocked running
sums give the same features as one block per user, and the same cumulative
days as a plain per-user window (the formulation that would put the hot user
into one task)."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from rebuy.plans.features import prior_aggregates
from rebuy.sources import schemas


def _skewed(spark):
    rnd = random.Random(4)
    orders, lines, oid = [], [], 0
    for u, n in [(0, 300)] + [(u, rnd.randint(1, 12)) for u in range(1, 60)]:
        for k in range(1, n + 1):
            oid += 1
            gap = None if k == 1 else float(rnd.randint(0, 30))
            orders.append((oid, u, "prior", k, rnd.randint(0, 6), rnd.randint(0, 23), gap))
            for pos, p in enumerate(rnd.sample(range(40), rnd.randint(1, 6)), start=1):
                lines.append((oid, p, pos, int(rnd.random() < 0.4)))
    return (spark.createDataFrame(orders, schemas.ORDERS),
            spark.createDataFrame(lines, schemas.ORDER_PRODUCTS))


def test_hot_user_blocked_equals_unblocked(spark):
    orders, lines = _skewed(spark)
    assert orders.filter("user_id = 0").count() * 3 >= orders.count()
    small = prior_aggregates(orders, lines, block_size=7, mode="none")
    big = prior_aggregates(orders, lines, block_size=1 << 20, mode="none")
    cols = ["user_id", "product_id", "user_product_days_before_last_product_order",
            "user_product_ave_days_since_prior_order", "user_product_most_recent_order"]
    assert sorted(small.user_products.select(*cols).collect()) == \
        sorted(big.user_products.select(*cols).collect())
    # plain per-user window, newest order first, +7 on the first order
    w = (Window.partitionBy("user_id").orderBy(F.desc("order_number"))
         .rowsBetween(Window.unboundedPreceding, 0))
    plain = orders.withColumn("cd", F.coalesce(F.sum("days_since_prior_order").over(w), F.lit(0.0))
                              + F.when(F.col("days_since_prior_order").isNull(), 7.0).otherwise(0.0))
    want = {(r.user_id, r.order_number): r.cd for r in plain.collect()}
    got = {(r.user_id, r.order_number): r.user_product_days_before_last_product_order
           for r in small.order_table.collect()}
    assert got == want
