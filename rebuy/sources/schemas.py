"""Declared schemas of the basket tables (no schema inference: inference
costs a full extra pass over the input)."""

from pyspark.sql import types as T

ORDERS = T.StructType([
    T.StructField("order_id", T.LongType(), False),
    T.StructField("user_id", T.LongType(), False),
    T.StructField("eval_set", T.StringType(), True),
    T.StructField("order_number", T.IntegerType(), False),
    T.StructField("order_dow", T.IntegerType(), True),
    T.StructField("order_hour_of_day", T.IntegerType(), True),
    T.StructField("days_since_prior_order", T.DoubleType(), True),
])

ORDER_PRODUCTS = T.StructType([
    T.StructField("order_id", T.LongType(), False),
    T.StructField("product_id", T.LongType(), False),
    T.StructField("add_to_cart_order", T.IntegerType(), False),
    T.StructField("reordered", T.IntegerType(), False),
])

PRODUCTS = T.StructType([
    T.StructField("product_id", T.LongType(), False),
    T.StructField("product_name", T.StringType(), True),
    T.StructField("aisle_id", T.IntegerType(), False),
    T.StructField("department_id", T.IntegerType(), False),
])

DEPARTMENTS = T.StructType([
    T.StructField("department_id", T.IntegerType(), False),
    T.StructField("department", T.StringType(), True),
])

AISLES = T.StructType([
    T.StructField("aisle_id", T.IntegerType(), False),
    T.StructField("aisle", T.StringType(), True),
])

BY_NAME = {
    "orders": ORDERS,
    "order_products__prior": ORDER_PRODUCTS,
    "order_products__train": ORDER_PRODUCTS,
    "products": PRODUCTS,
    "departments": DEPARTMENTS,
    "aisles": AISLES,
}
