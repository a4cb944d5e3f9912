"""The adapter of ``rebuy.sources.testdata`` written once more as DuckDB
SQL, so every oracle query is self-contained SQL over the raw test views.
It is a CTE prefix: ``WITH <ADAPTER>, ... SELECT ...``.  Views: b_orders,
b_prior, b_train, b_products, b_departments, b_aisles."""

ADAPTER = """
b_dept AS (
  SELECT p_type, CAST(dense_rank() OVER (ORDER BY p_type) AS INTEGER) AS department_id
  FROM (SELECT DISTINCT p_type FROM part) t),
b_pmap AS (
  SELECT p.p_partkey, p.p_brand, p.p_type, d.department_id,
         CAST(substring(p.p_brand, 7) AS INTEGER) AS aisle_id,
         CAST(CAST(substring(p.p_brand, 7) AS INTEGER) * 10 + d.department_id AS BIGINT) AS product_id
  FROM part p JOIN b_dept d ON p.p_type = d.p_type),
b_products AS (
  SELECT DISTINCT product_id, concat(p_brand, ' ', p_type) AS product_name, aisle_id, department_id
  FROM b_pmap),
b_departments AS (SELECT DISTINCT department_id, p_type AS department FROM b_pmap),
b_aisles AS (SELECT DISTINCT aisle_id, p_brand AS aisle FROM b_pmap),
b_ol AS (
  SELECT l.l_orderkey AS order_id, m.product_id, min(l.l_linenumber) AS ln
  FROM lineitem l JOIN b_pmap m ON l.l_partkey = m.p_partkey
  GROUP BY l.l_orderkey, m.product_id),
b_lines AS (
  SELECT order_id, product_id,
         CAST(row_number() OVER (PARTITION BY order_id ORDER BY ln, product_id) AS INTEGER) AS add_to_cart_order
  FROM b_ol),
b_o AS (
  SELECT o_orderkey AS order_id, o_custkey AS user_id, CAST(o_orderdate AS DATE) AS d
  FROM orders WHERE o_orderkey IN (SELECT order_id FROM b_ol)),
b_o2 AS (
  SELECT order_id, user_id, d,
         CAST(row_number() OVER (PARTITION BY user_id ORDER BY d, order_id) AS INTEGER) AS order_number,
         CAST(datediff('day', lag(d) OVER (PARTITION BY user_id ORDER BY d, order_id), d) AS DOUBLE)
           AS days_since_prior_order,
         count(*) OVER (PARTITION BY user_id) AS n_orders
  FROM b_o),
b_orders AS (
  SELECT order_id, user_id,
         CASE WHEN order_number = n_orders
              THEN CASE WHEN user_id % 10 = 9 THEN 'test' ELSE 'train' END
              ELSE 'prior' END AS eval_set,
         order_number,
         CAST(dayofweek(d) AS INTEGER) AS order_dow,
         CAST(order_id % 24 AS INTEGER) AS order_hour_of_day,
         days_since_prior_order
  FROM b_o2),
b_lu AS (
  SELECT l.order_id, l.product_id, l.add_to_cart_order, o.eval_set,
         CAST(CASE WHEN o.order_number > min(o.order_number) OVER (PARTITION BY o.user_id, l.product_id)
                   THEN 1 ELSE 0 END AS INTEGER) AS reordered
  FROM b_lines l JOIN b_orders o ON l.order_id = o.order_id),
b_prior AS (SELECT order_id, product_id, add_to_cart_order, reordered FROM b_lu WHERE eval_set = 'prior'),
b_train AS (SELECT order_id, product_id, add_to_cart_order, reordered FROM b_lu WHERE eval_set = 'train')
"""


def with_adapter(*ctes: str, select: str) -> str:
    """``WITH <adapter>, <ctes...> <select>``."""
    parts = [ADAPTER.strip()] + [c.strip() for c in ctes]
    return "WITH " + ",\n".join(parts) + "\n" + select.strip()
