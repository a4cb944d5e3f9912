"""Pinned toy basket (hand-computed expectations in FIXTURES.md section 3).

User 1: order 1 (no gap) A(1) B(2); order 2 (gap 3) A(1) C(2);
order 3 (gap 4) B(1) A(2); current order gap 0 with A, D.
User 2: order 1 (no gap) B(1); current order gap 5 with D.
"""

from rebuy.sources import schemas
from rebuy.sources.testdata import BasketTables

A, B, C, D = 1, 2, 3, 4

ORDERS = [
    # order_id, user_id, eval_set, order_number, dow, hour, gap
    (11, 1, "prior", 1, 0, 8, None),
    (12, 1, "prior", 2, 3, 9, 3.0),
    (13, 1, "prior", 3, 5, 10, 4.0),
    (14, 1, "train", 4, 1, 11, 0.0),
    (21, 2, "prior", 1, 2, 12, None),
    (22, 2, "train", 2, 6, 13, 5.0),
]
PRIOR = [
    (11, A, 1, 0), (11, B, 2, 0),
    (12, A, 1, 1), (12, C, 2, 0),
    (13, B, 1, 1), (13, A, 2, 1),
    (21, B, 1, 0),
]
TRAIN = [(14, A, 1, 1), (14, D, 2, 0), (22, D, 1, 0)]
PRODUCTS = [(A, "a", 1, 1), (B, "b", 1, 2), (C, "c", 2, 1), (D, "d", 2, 2)]


def toy_tables(spark) -> BasketTables:
    return BasketTables(
        orders=spark.createDataFrame(ORDERS, schemas.ORDERS),
        prior=spark.createDataFrame(PRIOR, schemas.ORDER_PRODUCTS),
        train=spark.createDataFrame(TRAIN, schemas.ORDER_PRODUCTS),
        products=spark.createDataFrame(PRODUCTS, schemas.PRODUCTS),
        departments=spark.createDataFrame([(1, "d1"), (2, "d2")], schemas.DEPARTMENTS),
        aisles=spark.createDataFrame([(1, "a1"), (2, "a2")], schemas.AISLES),
    )
