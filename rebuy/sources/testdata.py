"""Adapter: derive the basket tables from the driver's TPC-H-like tables.

The reference consumes order history (orders, order lines, products,
departments, aisles).  The test data has lineitem / orders / part, so:

* department = one id per distinct ``p_type`` (dense rank), aisle = the
  number in ``p_brand``; product = aisle x 10 + department (150 products, so
  repeat purchases are frequent enough to learn from);
* an order line = (order, product) with the smallest line number, the cart
  position is the row number of that line number inside the order;
* orders without any line are dropped *before* numbering, so each user's
  ``order_number`` runs 1..n without holes;
* ``order_number`` follows order date (ties by order id), the gap is the
  day difference to the previous order (NULL on the first order);
* the last order of each user is its current order: ``test`` when
  ``user_id % 10 = 9`` (the hidden set, removed by the holdout job) else
  ``train``; every other order is ``prior``;
* ``reordered`` = the user bought the product in an earlier order.

The adapter is test glue; the library itself only needs the basket tables.
"""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rebuy.sources.files import read_parquet_table


@dataclass
class BasketTables:
    orders: DataFrame
    prior: DataFrame          # order_products__prior
    train: DataFrame          # order_products__train (current orders)
    products: DataFrame
    departments: DataFrame
    aisles: DataFrame


def _raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_parquet_table(spark, os.path.join(sf_dir, f"{name}.parquet"))


def product_map(part: DataFrame) -> DataFrame:
    """p_partkey -> product / aisle / department ids and names."""
    types = part.select("p_type").distinct()
    # Ranking the distinct part types (a bounded dimension) needs one ordered
    # pass over that tiny table only.
    dept = types.select(
        "p_type",
        F.dense_rank().over(Window.orderBy("p_type")).cast("int").alias("department_id"))
    aisle_id = F.expr("cast(substring(p_brand, 7) as int)")
    return (part.select("p_partkey", "p_brand", "p_type")
            .join(dept, "p_type")
            .withColumn("aisle_id", aisle_id)
            .withColumn("product_id",
                        (F.col("aisle_id") * 10 + F.col("department_id")).cast("bigint")))


def basket_tables(spark: SparkSession, sf_dir: str, path: str) -> BasketTables:
    """The basket tables of a test-data folder, written as Parquet under ``path``
    and read back (the shape real input arrives in).

    Each step is derived once: the lines of every order by one shuffle on the
    order, the orders with their baskets by one on the user, stored once, and
    prior and current lines by one write, a folder each."""
    def kept(df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{path}/{name}")
        return spark.read.schema(df.schema).parquet(f"{path}/{name}")

    pmap = product_map(_raw(spark, sf_dir, "part"))
    lineitem = _raw(spark, sf_dir, "lineitem")
    orders_raw = _raw(spark, sf_dir, "orders")

    pmap = kept(pmap, "product_map")
    products = kept(pmap.select(
        "product_id",
        F.concat(F.col("p_brand"), F.lit(" "), F.col("p_type")).alias("product_name"),
        "aisle_id", "department_id").distinct(), "products")
    departments = kept(pmap.select("department_id", F.col("p_type").alias("department")).distinct(), "departments")
    aisles = kept(pmap.select("aisle_id", F.col("p_brand").alias("aisle")).distinct(), "aisles")

    # (order, product) lines; keep the first line number of each pair.  Rows meet by
    # order at once and an order goes on as one row, with its products by position: no
    # more than the distinct products, however many lines it has.
    baskets = (lineitem.select("l_orderkey", "l_partkey", "l_linenumber")
               .filter("l_orderkey is not null")
               .join(pmap.select("p_partkey", F.col("product_id").cast("int").alias("product_id")),
                     F.col("l_partkey") == F.col("p_partkey"))
               .select(F.col("l_orderkey").alias("order_id"), "product_id", "l_linenumber")
               .repartition("order_id")
               .groupBy("order_id", "product_id")
               .agg(F.min("l_linenumber").alias("ln"))
               .groupBy("order_id")
               .agg(F.transform(F.sort_array(F.collect_list(F.struct("ln", "product_id"))),
                                lambda e: e["product_id"]).alias("basket")))

    o = (orders_raw.select(F.col("o_orderkey").alias("order_id"),
                           F.col("o_custkey").alias("user_id"),
                           F.col("o_orderdate").cast("date").alias("d"))
         .join(baskets, "order_id"))
    w = Window.partitionBy("user_id").orderBy("d", "order_id")
    o = (o.withColumn("order_number", F.row_number().over(w).cast("int"))
         .withColumn("days_since_prior_order",
                     F.datediff(F.col("d"), F.lag("d").over(w)).cast("double"))
         .withColumn("n_orders", F.count(F.lit(1)).over(Window.partitionBy("user_id"))))
    numbered = kept(o.select(
        "order_id", "user_id",
        F.when(F.col("order_number") == F.col("n_orders"),
               F.when(F.col("user_id") % 10 == 9, "test").otherwise("train"))
        .otherwise("prior").alias("eval_set"),
        "order_number",
        (F.dayofweek("d") - 1).cast("int").alias("order_dow"),
        (F.col("order_id") % 24).cast("int").alias("order_hour_of_day"),
        "days_since_prior_order", "basket"), "orders")
    orders = numbered.drop("basket")

    lu = numbered.select("order_id", "user_id", "order_number", "eval_set", F.posexplode("basket").alias("place", "product_id"))
    first = F.min("order_number").over(Window.partitionBy("user_id", "product_id"))
    lu = lu.withColumn("reordered", (F.col("order_number") > first).cast("int"))
    cols = ["order_id", "product_id", "add_to_cart_order", "reordered"]
    lu = lu.filter(F.col("eval_set") != "test").select(
        "order_id", F.col("product_id").cast("bigint").alias("product_id"),
        (F.col("place") + 1).cast("int").alias("add_to_cart_order"), "reordered", "eval_set")
    lu.write.mode("overwrite").partitionBy("eval_set").parquet(f"{path}/order_products")
    lu = lu.select(*cols)

    def split(name: str) -> DataFrame:
        at = f"{path}/order_products/eval_set={name}"
        spark.createDataFrame([], lu.schema).write.mode("append").parquet(at)        # the folder, should no line be of that split
        return spark.read.schema(lu.schema).parquet(at)
    return BasketTables(orders, split("prior"), split("train"), products, departments, aisles)
