"""DuckDB oracle SQL for every query in ``rebuy.plans.queries`` that has a
SQL equivalent.  Written independently of the DataFrame code: plain SQL
windows and aggregates over the adapter CTE (``rebuy.plans.adapter_sql``).
Doubles rounded to 6 places, integers cast to the Spark types."""

from __future__ import annotations

from rebuy.plans.adapter_sql import with_adapter

R = "round({0}, 6) AS {1}"

ORDER_TABLE = [
    """o_stats AS (SELECT order_id, count(product_id) AS n_lines,
                          max(add_to_cart_order) AS max_pos
                   FROM b_prior GROUP BY order_id)""",
    """o_tbl AS (SELECT o.order_id, o.user_id, o.order_number, o.order_dow,
                        o.order_hour_of_day, o.days_since_prior_order, s.n_lines, s.max_pos
                 FROM b_orders o JOIN o_stats s ON o.order_id = s.order_id)""",
    """o_run AS (SELECT *, sum(days_since_prior_order) OVER (
                     PARTITION BY user_id ORDER BY order_number DESC
                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run_gap
                 FROM o_tbl)""",
    """o_cd AS (SELECT *, coalesce(run_gap, 0)
                       + CASE WHEN days_since_prior_order IS NULL THEN 7 ELSE 0 END AS cd
                FROM o_run)""",
]

PRIOR_AGGS = ORDER_TABLE + [
    """det AS (SELECT p.order_id, p.product_id, p.add_to_cart_order, p.reordered, o.user_id,
                      o.order_number, o.days_since_prior_order, o.max_pos, o.cd
               FROM b_prior p JOIN o_cd o ON p.order_id = o.order_id)""",
    """up AS (SELECT user_id, product_id,
                     CAST(coalesce(sum(reordered), 0) AS BIGINT) AS user_product_reordered_past,
                     avg(add_to_cart_order / max_pos) AS user_product_ave_add_to_cart_order_scale,
                     avg(days_since_prior_order) AS avg_gap,
                     max(order_number) AS user_product_most_recent_order,
                     arg_max(cd, order_number) AS cd,
                     avg(add_to_cart_order) AS user_product_ave_add_to_cart_order
              FROM det GROUP BY user_id, product_id)""",
    """usr0 AS (SELECT user_id, count(order_id) AS user_total_order,
                       avg(n_lines) AS user_cart_size,
                       CAST(sum(n_lines) AS BIGINT) AS user_total_product,
                       avg(days_since_prior_order) AS user_days_since_last_order_mean,
                       stddev_samp(days_since_prior_order) AS user_days_since_last_order_std,
                       avg(CASE WHEN order_dow < 2 THEN 1 ELSE 0 END) AS user_likely_dow,
                       coalesce(sum(days_since_prior_order), 0) AS days_since_first_order
                FROM o_tbl GROUP BY user_id)""",
    """usr AS (SELECT u.*, q.n_uniq AS user_total_uniq_product,
                      q.n_uniq / u.user_total_product AS user_uniq_prod_over_total_prod
               FROM usr0 u LEFT JOIN (SELECT user_id, count(*) AS n_uniq FROM up GROUP BY user_id) q
                 ON u.user_id = q.user_id)""",
    """pf AS (SELECT product_id, count(order_id) AS product_total_orders,
                     avg(add_to_cart_order) AS product_avg_add_to_cart_order,
                     count(order_id) / (SELECT count(DISTINCT order_id) FROM b_prior)
                       AS product_percent_order_containing_product
              FROM b_prior GROUP BY product_id)""",
]

CANDIDATES = PRIOR_AGGS + [
    """cur AS (SELECT user_id, max(days_since_prior_order) AS current_days_since_prior_order,
                      max(order_hour_of_day) AS order_hour_of_day
               FROM b_orders WHERE order_id IN (SELECT order_id FROM b_train) GROUP BY user_id)""",
    """lab AS (SELECT o.user_id, t.product_id, t.reordered
               FROM b_train t LEFT JOIN b_orders o ON t.order_id = o.order_id)""",
    """c0 AS (SELECT up.*, CAST(coalesce(lab.reordered, 0) AS INTEGER) AS reordered,
                     cur.current_days_since_prior_order, cur.order_hour_of_day
              FROM up LEFT JOIN lab ON up.user_id = lab.user_id AND up.product_id = lab.product_id
              JOIN cur ON up.user_id = cur.user_id)""",
    """c1 AS (SELECT c0.*, u.user_total_order, u.user_cart_size, u.user_total_product,
                     u.user_days_since_last_order_mean, u.user_days_since_last_order_std,
                     u.user_likely_dow, u.user_total_uniq_product, u.user_uniq_prod_over_total_prod,
                     coalesce(c0.avg_gap, c0.cd) AS user_product_ave_days_since_prior_order,
                     CAST(u.user_total_order - c0.user_product_most_recent_order AS BIGINT)
                       AS user_product_ordered_last_n_order,
                     (c0.user_product_reordered_past + 1) / u.user_total_order
                       AS user_product_percent_order_containing_product,
                     u.days_since_first_order / (c0.user_product_reordered_past + 1)
                       AS user_product_ave_day_per_product_order
              FROM c0 LEFT JOIN usr u ON c0.user_id = u.user_id)""",
    """c2 AS (SELECT *, CASE WHEN cd + current_days_since_prior_order = 0 THEN 0.5
                            ELSE cd + current_days_since_prior_order END
                          AS current_order_days_since_last_product_purchase
              FROM c1)""",
    """cand AS (SELECT *,
                  current_order_days_since_last_product_purchase
                    / CASE WHEN user_product_ave_day_per_product_order = 0 THEN 0.5
                           ELSE user_product_ave_day_per_product_order END
                    AS current_order_since_last_product_purchase_vs_average_purchase_gap,
                  coalesce(CASE WHEN user_days_since_last_order_std <> 0 THEN
                             (current_days_since_prior_order - user_days_since_last_order_mean)
                             / user_days_since_last_order_std END, 99999.0)
                    AS current_order_gap_deviation,
                  CAST(CASE WHEN current_days_since_prior_order = 0
                             AND user_total_order = user_product_most_recent_order
                            THEN 1 ELSE 0 END AS INTEGER) AS current_same_day_order
                FROM c2)""",
]

DIMS = CANDIDATES + [
    """cdim AS (SELECT c.product_id, c.reordered, c.order_hour_of_day, p.aisle_id, p.department_id
                FROM cand c LEFT JOIN b_products p ON c.product_id = p.product_id)""",
]


def _counts(name: str, key: str, src: str) -> str:
    return f"""{name} AS (SELECT {key}, CAST(sum(CASE WHEN reordered = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n0,
                          CAST(sum(CASE WHEN reordered = 1 THEN 1 ELSE 0 END) AS BIGINT) AS n1
                   FROM {src} WHERE {key} IS NOT NULL GROUP BY {key})"""


def _ratios(name: str, key: str, counts: str, fill: bool) -> str:
    def r(n):
        e = f"CASE WHEN {n} > 0 THEN {n} / (SELECT sum({n}) FROM {counts}) END"
        return f"coalesce({e}, 0.0)" if fill else e
    return f"""{name} AS (SELECT {key}, n0, n1, {r('n0')} AS no_reorder, {r('n1')} AS reordered
                   FROM {counts})"""


DEPT_BIN = """CAST(CASE WHEN diff >= 0.02 THEN 2 WHEN diff >= 0 THEN 1 WHEN diff >= -0.01 THEN -1
                   WHEN diff >= -0.02 THEN -2 WHEN diff < -0.02 THEN -3 ELSE 0 END AS INTEGER)"""
AISLE_BIN = """CAST(CASE WHEN diff >= 0.001 THEN 2 WHEN diff <= -0.001 THEN -2 WHEN diff >= 0 THEN 1
                    WHEN diff < 0 THEN -1 ELSE 0 END AS INTEGER)"""
HOD_BIN = "CAST(CASE WHEN diff >= 0 THEN 1 WHEN diff < 0 THEN -1 ELSE 0 END AS INTEGER)"

BINS = DIMS + [
    _counts("dcnt", "department_id", "cdim"),
    _ratios("drat", "department_id", "dcnt", False),
    "ddiff AS (SELECT *, reordered - no_reorder AS diff FROM drat)",
    f"dmap AS (SELECT department_id, no_reorder, reordered, diff, {DEPT_BIN} AS product_dept_bin FROM ddiff)",
    _counts("acnt", "aisle_id", "cdim"),
    _ratios("arat", "aisle_id", "acnt", True),
    "adiff AS (SELECT *, reordered - no_reorder AS diff FROM arat)",
    f"amap AS (SELECT aisle_id, no_reorder, reordered, diff, {AISLE_BIN} AS product_aisle_bin FROM adiff)",
    _counts("hcnt", "order_hour_of_day", "cdim"),
    _ratios("hrat", "order_hour_of_day", "hcnt", False),
    "hdiff AS (SELECT *, reordered - no_reorder AS diff FROM hrat)",
    f"hmap AS (SELECT order_hour_of_day, no_reorder, reordered, diff, {HOD_BIN} AS current_order_hod FROM hdiff)",
    """ft AS (SELECT c.*, pf.product_total_orders, pf.product_avg_add_to_cart_order,
                     pf.product_percent_order_containing_product,
                     dmap.product_dept_bin, amap.product_aisle_bin, hmap.current_order_hod
              FROM cand c
              LEFT JOIN pf ON c.product_id = pf.product_id
              LEFT JOIN b_products p ON c.product_id = p.product_id
              LEFT JOIN dmap ON p.department_id = dmap.department_id
              LEFT JOIN amap ON p.aisle_id = amap.aisle_id
              LEFT JOIN hmap ON c.order_hour_of_day = hmap.order_hour_of_day)""",
]

FEATURES = [
    "user_product_reordered_past", "user_total_order", "user_cart_size", "user_total_product",
    "user_days_since_last_order_mean", "user_total_uniq_product", "user_uniq_prod_over_total_prod",
    "product_total_orders", "product_avg_add_to_cart_order",
    "product_percent_order_containing_product", "user_product_ave_add_to_cart_order_scale",
    "user_product_ave_days_since_prior_order", "user_product_ordered_last_n_order",
    "user_product_percent_order_containing_product", "user_product_ave_day_per_product_order",
    "current_days_since_prior_order", "current_order_days_since_last_product_purchase",
    "current_order_since_last_product_purchase_vs_average_purchase_gap",
    "current_order_gap_deviation", "current_same_day_order", "product_dept_bin", "product_aisle_bin",
]
NOTEBOOK_EXTRA = ["user_likely_dow", "user_product_ave_add_to_cart_order", "current_order_hod"]
DOUBLES = {
    "user_cart_size", "user_days_since_last_order_mean", "user_uniq_prod_over_total_prod",
    "product_avg_add_to_cart_order", "product_percent_order_containing_product",
    "user_product_ave_add_to_cart_order_scale", "user_product_ave_days_since_prior_order",
    "user_product_percent_order_containing_product", "user_product_ave_day_per_product_order",
    "current_days_since_prior_order", "current_order_days_since_last_product_purchase",
    "current_order_since_last_product_purchase_vs_average_purchase_gap",
    "current_order_gap_deviation", "user_likely_dow", "user_product_ave_add_to_cart_order",
    "user_days_since_last_order_std", "cd", "no_reorder", "reordered_ratio", "diff",
}


def _sel(cols: list[str], prefix: str = "") -> str:
    out = []
    for c in cols:
        out.append(R.format(prefix + c, c) if c in DOUBLES else prefix + c)
    return ", ".join(out)


# ---- sampling --------------------------------------------------------------------

# Holdout sizes: shares of the current orders and of the users, with least sizes.
N_TOTAL = "(SELECT greatest(60, CAST(ceil(0.198 * count(*)) AS BIGINT)) FROM recent)"
N_SUBSET = "(SELECT greatest(20, CAST(ceil(0.0457 * count(*)) AS BIGINT)) FROM recent)"
N_USERS = "(SELECT greatest(20, CAST(ceil(0.0291 * count(*)) AS BIGINT)) FROM uids)"


def _md5(cols: list[str], salt: str) -> str:
    parts = " || '#' || ".join(f"CAST({c} AS VARCHAR)" for c in cols)
    return f"md5({parts} || '#' || '{salt}')"


def holdout_ctes(n_total=N_TOTAL, n_subset=N_SUBSET, n_extra_users=N_USERS, seed=42) -> list[str]:
    return [
        "ont AS (SELECT * FROM b_orders WHERE eval_set IS DISTINCT FROM 'test')",
        "recent AS (SELECT DISTINCT order_id FROM b_train)",
        f"samp AS (SELECT order_id FROM recent ORDER BY {_md5(['order_id'], str(seed))}, order_id LIMIT {n_total})",
        f"sub AS (SELECT order_id FROM samp ORDER BY {_md5(['order_id'], f'{seed}/subset')}, order_id LIMIT {n_subset})",
        "hold AS (SELECT order_id FROM samp WHERE order_id NOT IN (SELECT order_id FROM sub))",
        "uids AS (SELECT DISTINCT user_id FROM ont)",
        f"extra AS (SELECT user_id FROM uids ORDER BY {_md5(['user_id'], f'{seed}/users')}, user_id LIMIT {n_extra_users})",
        "subu AS (SELECT user_id FROM ont WHERE order_id IN (SELECT order_id FROM sub))",
        "allu AS (SELECT user_id FROM extra UNION SELECT user_id FROM subu)",
    ]


HOLD = holdout_ctes()
SAMPLE_ROWS = [f"srows AS (SELECT * FROM b_train ORDER BY {_md5(['order_id', 'product_id'], '42')}, order_id, product_id "
               "LIMIT (SELECT (count(*) * 30000 + 1384616) // 1384617 FROM b_train))"]

# ---- evaluation on the deterministic score --------------------------------------------

SCORED = CANDIDATES + [
    """sc AS (SELECT user_id, product_id, reordered,
                     user_product_percent_order_containing_product AS score FROM cand)""",
    """grp AS (SELECT score AS threshold, CAST(sum(CASE WHEN reordered = 1 THEN 1 ELSE 0 END) AS BIGINT) AS pos,
                      CAST(sum(CASE WHEN reordered = 0 THEN 1 ELSE 0 END) AS BIGINT) AS neg
               FROM sc GROUP BY score)""",
    """crv AS (SELECT threshold, pos, neg,
                      sum(pos) OVER (ORDER BY threshold DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tps,
                      sum(neg) OVER (ORDER BY threshold DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fps,
                      (SELECT sum(pos) FROM grp) AS P, (SELECT sum(neg) FROM grp) AS N
               FROM grp)""",
    """pr AS (SELECT threshold, tps / (tps + fps) AS precision, tps / P AS recall
              FROM crv WHERE tps - pos < P)""",
]

FOLD_HASH = "CAST(CAST(('0x' || substr(md5(CAST(user_id AS VARCHAR) || '#42'), 1, 8)) AS BIGINT) % 5 AS INTEGER)"

FOLDED = CANDIDATES + [
    f"""fsc AS (SELECT user_id, product_id, reordered,
                      user_product_percent_order_containing_product AS score, {FOLD_HASH} AS fold
               FROM cand)""",
    """fgrp AS (SELECT fold, score AS threshold,
                       CAST(sum(CASE WHEN reordered = 1 THEN 1 ELSE 0 END) AS BIGINT) AS pos,
                       CAST(sum(CASE WHEN reordered = 0 THEN 1 ELSE 0 END) AS BIGINT) AS neg
                FROM fsc GROUP BY fold, score)""",
    """fcrv AS (SELECT fold, threshold, pos, neg,
                       sum(pos) OVER (PARTITION BY fold ORDER BY threshold DESC
                                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tps,
                       sum(neg) OVER (PARTITION BY fold ORDER BY threshold DESC
                                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fps,
                       sum(pos) OVER (PARTITION BY fold) AS P, sum(neg) OVER (PARTITION BY fold) AS N
                FROM fgrp)""",
    """fpr AS (SELECT fold, threshold, tps / (tps + fps) AS precision, tps / P AS recall
               FROM fcrv WHERE tps - pos < P)""",
    """ff1 AS (SELECT fold, threshold, recall, precision, 2 * recall * precision / (recall + precision) AS f1
               FROM fpr WHERE recall <> 0 AND precision <> 0)""",
    """fconf AS (SELECT fold,
                   sum(CASE WHEN reordered = 1 AND score > 0.5 THEN 1 ELSE 0 END) AS tp,
                   sum(CASE WHEN reordered = 0 AND score > 0.5 THEN 1 ELSE 0 END) AS fp,
                   sum(CASE WHEN reordered = 1 AND NOT score > 0.5 THEN 1 ELSE 0 END) AS fn,
                   sum(CASE WHEN reordered = 0 AND NOT score > 0.5 THEN 1 ELSE 0 END) AS tn
                 FROM fsc GROUP BY fold)""",
    """fconf2 AS (SELECT fold, tp, fp, fn, tn,
                    (SELECT sum(tp) FROM fconf) - tp AS ttp, (SELECT sum(fp) FROM fconf) - fp AS tfp,
                    (SELECT sum(fn) FROM fconf) - fn AS tfn
                  FROM fconf)""",
    """fprf AS (SELECT fold, (tp + tn) / (tp + fp + fn + tn) AS accuracy,
                  coalesce(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) END, 0.0) AS precision,
                  coalesce(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) END, 0.0) AS recall,
                  coalesce(CASE WHEN ttp + tfp > 0 THEN ttp / (ttp + tfp) END, 0.0) AS tprec,
                  coalesce(CASE WHEN ttp + tfn > 0 THEN ttp / (ttp + tfn) END, 0.0) AS trec
                FROM fconf2)""",
    """fm AS (SELECT f.fold, f.accuracy, f.recall, f.precision,
                 coalesce(CASE WHEN f.precision + f.recall > 0
                               THEN 2 * f.precision * f.recall / (f.precision + f.recall) END, 0.0) AS f1,
                 coalesce(CASE WHEN f.tprec + f.trec > 0
                               THEN 2 * f.tprec * f.trec / (f.tprec + f.trec) END, 0.0) AS train_f1,
                 a.auc, b.best_f1
              FROM fprf f
              LEFT JOIN (SELECT fold, sum(neg * (2 * tps - pos)) / (2.0 * max(P) * max(N)) AS auc
                         FROM fcrv GROUP BY fold) a ON f.fold = a.fold
              LEFT JOIN (SELECT fold, max(f1) AS best_f1 FROM ff1 GROUP BY fold) b ON f.fold = b.fold)""",
]

METRICS = ["accuracy", "recall", "precision", "f1", "auc", "best_f1", "train_f1"]


def _eda(key: str, names: str, name_col: str) -> list[str]:
    return SAMPLE_ROWS + [
        f"""ej AS (SELECT s.reordered, p.{key} FROM srows s JOIN b_products p ON s.product_id = p.product_id)""",
        _counts("ecnt", key, "ej"),
        _ratios("erat", key, "ecnt", True),
        f"""efreq AS (SELECT r.{key}, n.{name_col}, r.no_reorder, r.reordered,
                          r.reordered - r.no_reorder AS diff,
                          CAST(row_number() OVER (ORDER BY r.reordered - r.no_reorder DESC NULLS LAST, r.{key})
                               AS INTEGER) AS rank
                   FROM erat r LEFT JOIN {names} n ON r.{key} = n.{key})""",
    ]


def _top_bottom(src: str, key: str, cols: list[str]) -> str:
    c = ", ".join(cols)
    return f"""SELECT {_sel(cols)}, side, pos FROM (
      SELECT {c}, 'top' AS side,
             CAST(row_number() OVER (ORDER BY diff DESC, {key} ASC) AS INTEGER) AS pos
      FROM {src} WHERE diff IS NOT NULL
      UNION ALL
      SELECT {c}, 'bottom' AS side,
             CAST(row_number() OVER (ORDER BY diff ASC, {key} DESC) AS INTEGER) AS pos
      FROM {src} WHERE diff IS NOT NULL) t WHERE pos <= 10"""


def _orders_cols(p=""):
    return (f"{p}order_id, {p}user_id, {p}eval_set, {p}order_number, {p}order_dow, "
            f"{p}order_hour_of_day, round({p}days_since_prior_order, 6) AS days_since_prior_order")


def _orders_inferred() -> str:
    whole = ", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in ("order_id", "user_id", "order_number", "order_dow", "order_hour_of_day"))
    return f"{whole}, eval_set, CAST(round(days_since_prior_order, 6) AS DOUBLE) AS days_since_prior_order"


def _per_fold() -> str:
    """The bins of each fold from the rows of all others, fold by fold."""
    parts = []
    for rule, key, fill, expr in (("department", "department_id", False, DEPT_BIN), ("aisle", "aisle_id", True, AISLE_BIN)):
        for f in range(5):
            def ratio(n):
                e = f"CASE WHEN {n} > 0 THEN {n} / sum({n}) OVER () END"
                return f"coalesce({e}, 0.0)" if fill else e
            parts.append(f"""
                SELECT '{rule}' AS category, {f} AS fold, CAST(key AS BIGINT) AS key, round(no_reorder, 6) AS no_reorder,
                       round(reordered, 6) AS reordered, round(diff, 6) AS diff, {expr} AS bin
                FROM (SELECT *, reordered - no_reorder AS diff
                      FROM (SELECT key, {ratio('n0')} AS no_reorder, {ratio('n1')} AS reordered
                            FROM (SELECT {key} AS key, count(*) FILTER (reordered = 0) AS n0, count(*) FILTER (reordered = 1) AS n1
                                  FROM fcat WHERE fold <> {f} AND {key} IS NOT NULL GROUP BY {key})))""")
    return " UNION ALL ".join(parts)


# ---- M2: the notebook table of the model-selection subset, standardised ----------------

SUBSET = (HOLD + [
    "s_train AS (SELECT * FROM b_train WHERE order_id IN (SELECT order_id FROM sub))",
    """s_prior AS (SELECT * FROM b_prior WHERE order_id IN
                  (SELECT order_id FROM ont WHERE user_id IN (SELECT user_id FROM allu)))"""]
    + [c.replace("b_prior", "s_prior").replace("b_train", "s_train") for c in BINS])
NULLABLE = ["user_days_since_last_order_mean", "product_dept_bin", "product_aisle_bin", "current_order_hod"]
SCALED = [c for f in FEATURES + NOTEBOOK_EXTRA for c in ([f"{f}_missing", f] if f in NULLABLE else [f])]


def _raw_input(c: str) -> str:
    if c.endswith("_missing"):
        return f"CASE WHEN {c[:-8]} IS NULL THEN 1.0 ELSE 0.0 END"
    return f"coalesce(CAST({c} AS DOUBLE), 0.0)"


def _standardised(c: str) -> str:
    mean = f"(SELECT avg({c}) FROM inp WHERE fold <> 0)"
    spread = f"(SELECT stddev_pop({c}) FROM inp WHERE fold <> 0)"
    return f"round(({c} - {mean}) / CASE WHEN {spread} > 0 THEN {spread} ELSE 1.0 END, 6) AS {c}"


STANDARDISED = with_adapter(
    *SUBSET, f"inp AS (SELECT user_id, product_id, {FOLD_HASH} AS fold, "
             + ", ".join(f"{_raw_input(c)} AS {c}" for c in SCALED) + " FROM ft)",
    select="SELECT user_id, product_id, fold, " + ", ".join(map(_standardised, SCALED)) + " FROM inp")

SQL: dict[str, str] = {
    "standardized": STANDARDISED,
    "scan_orders": with_adapter(select=f"SELECT {_orders_cols()} FROM b_orders"),
    "scan_products": with_adapter(select="""
        SELECT product_id, CASE WHEN product_id % 2 = 0 THEN 'Bar, ""' || product_name || '"" "Dark", Big'
                                ELSE product_name END AS product_name, aisle_id, department_id FROM b_products"""),
    "scan_products_breaks": with_adapter(select="""
        SELECT product_id, CASE WHEN product_id % 3 = 0 THEN 'a "b"' || chr(10) || product_name || chr(10) || chr(10) || ',"c'
                                ELSE product_name END AS product_name, aisle_id, department_id FROM b_products"""),
    "scan_orders_inferred": with_adapter(select=f"SELECT {_orders_inferred()} FROM b_orders"),
    "filter_not_test": with_adapter(
        select=f"SELECT {_orders_cols()} FROM b_orders WHERE eval_set IS DISTINCT FROM 'test'"),
    "order_details": with_adapter(select="""
        SELECT l.order_id, l.product_id, l.add_to_cart_order, l.reordered, o.user_id, o.order_number,
               o.order_dow, o.order_hour_of_day, round(o.days_since_prior_order, 6) AS days_since_prior_order
        FROM b_prior l LEFT JOIN b_orders o ON l.order_id = o.order_id"""),
    "reordered_past": with_adapter(select="""
        SELECT o.user_id, l.product_id, CAST(coalesce(sum(l.reordered), 0) AS BIGINT) AS user_product_reordered_past
        FROM b_prior l JOIN b_orders o ON l.order_id = o.order_id GROUP BY o.user_id, l.product_id"""),
    "user_orders": with_adapter(*ORDER_TABLE, select="""
        SELECT user_id, order_id, n_lines AS total_product,
               round(days_since_prior_order, 6) AS days_since_prior_order FROM o_tbl"""),
    "user_gap_std": with_adapter(*PRIOR_AGGS, select=f"""
        SELECT user_id, {R.format('user_days_since_last_order_std', 'user_days_since_last_order_std')} FROM usr"""),
    "user_uniq": with_adapter(select="""
        SELECT o.user_id, count(DISTINCT p.product_id) AS user_total_uniq_product
        FROM b_prior p JOIN b_orders o ON p.order_id = o.order_id GROUP BY o.user_id"""),
    "user_features": with_adapter(*PRIOR_AGGS, select="SELECT user_id, " + _sel([
        "user_total_order", "user_cart_size", "user_total_product", "user_days_since_last_order_mean",
        "user_days_since_last_order_std", "user_total_uniq_product", "user_uniq_prod_over_total_prod"])
        + " FROM usr"),
    "user_likely_dow": with_adapter(*PRIOR_AGGS, select="SELECT user_id, " + _sel(["user_likely_dow"]) + " FROM usr"),
    "product_features": with_adapter(*PRIOR_AGGS, select="SELECT product_id, " + _sel([
        "product_total_orders", "product_avg_add_to_cart_order",
        "product_percent_order_containing_product"]) + " FROM pf"),
    "distinct_users": with_adapter(select="SELECT DISTINCT user_id FROM b_orders WHERE eval_set IS DISTINCT FROM 'test'"),
    "dataset_shape": with_adapter(*BINS, select="""
        SELECT 'orders' AS table_name, count(*) AS n_rows, CAST(7 AS INTEGER) AS n_cols FROM b_orders
        UNION ALL SELECT 'order_products__prior', count(*), CAST(4 AS INTEGER) FROM b_prior
        UNION ALL SELECT 'order_products__train', count(*), CAST(4 AS INTEGER) FROM b_train
        UNION ALL SELECT 'products', count(*), CAST(4 AS INTEGER) FROM b_products
        UNION ALL SELECT 'feature_table', count(*), CAST(25 AS INTEGER) FROM ft"""),
    "cart_scale": with_adapter(*ORDER_TABLE, select="""
        SELECT p.order_id, p.product_id, round(p.add_to_cart_order / s.max_pos, 6) AS user_product_add_to_cart_order_scale
        FROM b_prior p JOIN o_stats s ON p.order_id = s.order_id"""),
    "cum_days": with_adapter(*ORDER_TABLE, select="""
        SELECT user_id, order_number,
               round(CASE WHEN days_since_prior_order IS NULL THEN NULL ELSE run_gap END, 6)
                 AS cumulative_days_since_nth_order
        FROM o_run"""),
    "ffill_days": with_adapter(*ORDER_TABLE, select="""
        SELECT user_id, order_number, round(cd, 6) AS user_product_days_before_last_product_order FROM o_cd"""),
    "valid_users_semi": with_adapter(*PRIOR_AGGS, select="""
        SELECT user_id, product_id, user_product_reordered_past FROM up
        WHERE user_id IN (SELECT o.user_id FROM b_orders o WHERE o.order_id IN (SELECT order_id FROM b_train))"""),
    "candidate_labels": with_adapter(*CANDIDATES, select="""
        SELECT user_id, product_id, user_product_reordered_past, reordered FROM cand"""),
    "with_product_features": with_adapter(*CANDIDATES, select="SELECT c.user_id, c.product_id, c.reordered, " + _sel([
        "product_total_orders", "product_avg_add_to_cart_order", "product_percent_order_containing_product"], "pf.")
        .replace("pf.product_total_orders,", "pf.product_total_orders AS product_total_orders,")
        + " FROM cand c LEFT JOIN pf ON c.product_id = pf.product_id"),
    "with_product_dim": with_adapter(*CANDIDATES, select="""
        SELECT c.user_id, c.product_id, c.reordered, p.aisle_id, p.department_id
        FROM cand c LEFT JOIN b_products p ON c.product_id = p.product_id"""),
    "days_before_last": with_adapter(*PRIOR_AGGS, select="""
        SELECT up.user_id, up.product_id, up.user_product_most_recent_order,
               round(o.cd, 6) AS user_product_days_before_last_product_order
        FROM up LEFT JOIN o_cd o ON o.user_id = up.user_id AND o.order_number = up.user_product_most_recent_order"""),
    "user_product_features": with_adapter(*PRIOR_AGGS, select="""
        SELECT up.user_id, up.product_id,
               round(up.user_product_ave_add_to_cart_order_scale, 6) AS user_product_ave_add_to_cart_order_scale,
               round(coalesce(up.avg_gap, up.cd), 6) AS user_product_ave_days_since_prior_order,
               up.user_product_most_recent_order,
               CAST(u.user_total_order - up.user_product_most_recent_order AS BIGINT) AS user_product_ordered_last_n_order,
               round(up.cd, 6) AS user_product_days_before_last_product_order
        FROM up LEFT JOIN usr u ON up.user_id = u.user_id"""),
    "user_product_avg_cart": with_adapter(*PRIOR_AGGS, select="""
        SELECT user_id, product_id, round(user_product_ave_add_to_cart_order, 6) AS user_product_ave_add_to_cart_order
        FROM up"""),
    "user_product_rates": with_adapter(*PRIOR_AGGS, select="""
        SELECT up.user_id, up.product_id,
               round((up.user_product_reordered_past + 1) / u.user_total_order, 6)
                 AS user_product_percent_order_containing_product,
               round(u.days_since_first_order / (up.user_product_reordered_past + 1), 6)
                 AS user_product_ave_day_per_product_order
        FROM up LEFT JOIN usr u ON up.user_id = u.user_id"""),
    "current_order": with_adapter(*CANDIDATES, select="""
        SELECT user_id, round(current_days_since_prior_order, 6) AS current_days_since_prior_order,
               order_hour_of_day FROM cur"""),
    "current_features": with_adapter(*CANDIDATES, select="SELECT user_id, product_id, " + _sel([
        "current_days_since_prior_order", "current_order_days_since_last_product_purchase",
        "current_order_since_last_product_purchase_vs_average_purchase_gap",
        "current_order_gap_deviation", "current_same_day_order"]) + " FROM cand"),
    "gap_ratio": with_adapter(*CANDIDATES, select="SELECT user_id, product_id, " + _sel([
        "current_order_days_since_last_product_purchase",
        "current_order_since_last_product_purchase_vs_average_purchase_gap"]) + " FROM cand"),
    "same_day": with_adapter(*CANDIDATES, select="SELECT user_id, product_id, current_same_day_order FROM cand"),
    "dept_counts": with_adapter(*BINS, select="SELECT department_id, n0, n1 FROM dcnt"),
    "dept_ratio": with_adapter(*BINS, select="""
        SELECT department_id, round(no_reorder, 6) AS no_reorder, round(reordered, 6) AS reordered FROM drat"""),
    "dept_bins": with_adapter(*BINS, select="""
        SELECT department_id, round(no_reorder, 6) AS no_reorder, round(reordered, 6) AS reordered,
               round(diff, 6) AS diff, product_dept_bin FROM dmap"""),
    "dept_diff_sorted": with_adapter(*BINS, select="""
        SELECT department_id, round(diff, 6) AS diff,
               CAST(row_number() OVER (ORDER BY diff DESC NULLS LAST, department_id) AS INTEGER) AS rank
        FROM ddiff"""),
    "bins_per_fold": with_adapter(*CANDIDATES, f"""fcat AS (SELECT u.reordered, {FOLD_HASH} AS fold, p.department_id, p.aisle_id
        FROM cand u JOIN b_products p ON u.product_id = p.product_id)""", select=_per_fold()),
    "aisle_freq": with_adapter(*BINS, select="""
        SELECT aisle_id, round(no_reorder, 6) AS no_reorder, round(reordered, 6) AS reordered,
               round(diff, 6) AS diff FROM adiff"""),
    "aisle_bins": with_adapter(*BINS, select="""
        SELECT aisle_id, round(no_reorder, 6) AS no_reorder, round(reordered, 6) AS reordered,
               round(diff, 6) AS diff, product_aisle_bin FROM amap"""),
    "hod_bins": with_adapter(*BINS, select="""
        SELECT order_hour_of_day, round(no_reorder, 6) AS no_reorder, round(reordered, 6) AS reordered,
               round(diff, 6) AS diff, current_order_hod FROM hmap"""),
    "apply_bins": with_adapter(*BINS, select="SELECT user_id, product_id, product_dept_bin, product_aisle_bin FROM ft"),
    "aisle_top_bottom": with_adapter(*BINS, select=_top_bottom(
        "adiff", "aisle_id", ["aisle_id", "no_reorder", "reordered", "diff"])),
    "feature_table": with_adapter(*BINS, select="SELECT user_id, product_id, reordered, "
                                  + _sel(FEATURES) + " FROM ft"),
    "feature_table_notebook": with_adapter(*BINS, select="SELECT user_id, product_id, reordered, "
                                           + _sel(FEATURES + NOTEBOOK_EXTRA) + " FROM ft"),
    "sample_orders": with_adapter(*HOLD, select="SELECT order_id FROM samp"),
    "sample_nested": with_adapter(*HOLD, select="SELECT order_id FROM sub"),
    "holdout_ids": with_adapter(*HOLD, select="SELECT order_id FROM hold"),
    "union_users": with_adapter(*HOLD, select="SELECT user_id FROM allu"),
    "holdout_train": with_adapter(*HOLD, select="SELECT * FROM b_train WHERE order_id NOT IN (SELECT order_id FROM hold)"),
    "train_lines_anti": with_adapter(*HOLD, select="""
        SELECT order_id, product_id FROM b_train WHERE order_id NOT IN (SELECT order_id FROM hold)"""),
    "holdout_test": with_adapter(*HOLD, select="SELECT * FROM b_train WHERE order_id IN (SELECT order_id FROM hold)"),
    "holdout_subset": with_adapter(*HOLD, select="SELECT * FROM b_train WHERE order_id IN (SELECT order_id FROM sub)"),
    "holdout_subset_prior": with_adapter(*HOLD, select="""
        SELECT * FROM b_prior WHERE order_id IN
          (SELECT order_id FROM ont WHERE user_id IN (SELECT user_id FROM allu))"""),
    "user_folds": with_adapter(*CANDIDATES, select=f"SELECT user_id, {FOLD_HASH} AS fold FROM (SELECT DISTINCT user_id FROM cand) u"),
    "user_folds_balanced": with_adapter(*CANDIDATES, select=f"""
        SELECT user_id, CAST((row_number() OVER (ORDER BY {_md5(['user_id'], '42')}, user_id) - 1) % 5 AS INTEGER)
                 AS fold
        FROM (SELECT DISTINCT user_id FROM cand) u"""),
    "sample_rows": with_adapter(*SAMPLE_ROWS, select="SELECT * FROM srows"),
    "eda_inner": with_adapter(*SAMPLE_ROWS, select="""
        SELECT s.product_id, s.order_id, s.add_to_cart_order, s.reordered, p.product_name, p.aisle_id, p.department_id
        FROM srows s JOIN b_products p ON s.product_id = p.product_id"""),
    "threshold_predict": with_adapter(*SCORED, select="""
        SELECT user_id, product_id, reordered, round(score, 6) AS score,
               CAST(CASE WHEN score > 0.2114 THEN 1 ELSE 0 END AS INTEGER) AS prediction FROM sc"""),
    "confusion_metrics": with_adapter(*SCORED, "p AS (SELECT reordered, CASE WHEN score > 0.2114 THEN 1 ELSE 0 END AS yhat FROM sc)",
        """cm AS (SELECT CAST(sum(CASE WHEN reordered = 1 AND yhat = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp,
                        CAST(sum(CASE WHEN reordered = 0 AND yhat = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fp,
                        CAST(sum(CASE WHEN reordered = 1 AND yhat = 0 THEN 1 ELSE 0 END) AS BIGINT) AS fn,
                        CAST(sum(CASE WHEN reordered = 0 AND yhat = 0 THEN 1 ELSE 0 END) AS BIGINT) AS tn FROM p)""",
        """cm2 AS (SELECT *, coalesce(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) END, 0.0) AS precision,
                          coalesce(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) END, 0.0) AS recall FROM cm)""",
        select="""SELECT tp, fp, fn, tn, round((tp + tn) / (tp + fp + fn + tn), 6) AS accuracy,
                         round(precision, 6) AS precision, round(recall, 6) AS recall,
                         round(coalesce(CASE WHEN precision + recall > 0
                                             THEN 2 * precision * recall / (precision + recall) END, 0.0), 6) AS f1
                  FROM cm2"""),
    "roc_points": with_adapter(*SCORED, select="""
        SELECT round(threshold, 6) AS threshold, round(fps / N, 6) AS fpr, round(tps / P, 6) AS tpr FROM crv
        UNION ALL SELECT NULL, 0.0, 0.0"""),
    # the share of (positive, negative) pairs in the right order, from mean ranks
    "auc": with_adapter(*SCORED, """ranked AS (SELECT reordered, rank() OVER (ORDER BY score)
                                                  + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS r
                                           FROM sc WHERE score IS NOT NULL)""", select="""
        SELECT round((sum(r) FILTER (reordered = 1) - np * (np + 1) / 2.0) / (np * nn), 6) AS auc
        FROM ranked, (SELECT count(*) FILTER (reordered = 1) AS np, count(*) FILTER (reordered = 0) AS nn FROM ranked) c
        GROUP BY np, nn"""),
    "pr_points": with_adapter(*SCORED, select="""
        SELECT round(threshold, 6) AS threshold, round(precision, 6) AS precision, round(recall, 6) AS recall FROM pr
        UNION ALL SELECT NULL, 1.0, 0.0"""),
    "best_f1": with_adapter(*SCORED, """f1s AS (SELECT threshold, recall, precision,
                                               2 * recall * precision / (recall + precision) AS f1
                                        FROM pr WHERE recall <> 0 AND precision <> 0)""", select="""
        SELECT round(f1, 6) AS f1, round(threshold, 6) AS threshold, round(recall, 6) AS recall,
               round(precision, 6) AS precision
        FROM f1s ORDER BY f1 DESC, threshold DESC, recall DESC, precision DESC LIMIT 1"""),
    "fold_metrics": with_adapter(*FOLDED, select="SELECT fold, " + ", ".join(
        f"round({m}, 6) AS {m}" for m in METRICS) + " FROM fm"),
    "fold_summary": with_adapter(*FOLDED, select="SELECT count(*) AS folds, " + ", ".join(
        f"round(avg({m}), 6) AS mean_{m}, round(stddev_pop({m}), 6) AS std_{m}" for m in METRICS) + " FROM fm"),
    "curve_points": with_adapter(*FOLDED, select="""
        SELECT fold, 'roc' AS series, round(fps / N, 6) AS x, round(tps / P, 6) AS y FROM fcrv
        UNION ALL SELECT DISTINCT fold, 'roc', 0.0, 0.0 FROM fcrv
        UNION ALL SELECT fold, 'pr', round(recall, 6), round(precision, 6) FROM fpr
        UNION ALL SELECT DISTINCT fold, 'pr', 0.0, 1.0 FROM fcrv
        UNION ALL SELECT fold, 'f1', round(threshold, 6), round(f1, 6) FROM ff1"""),
    "eda_dept_freq": with_adapter(*_eda("department_id", "b_departments", "department"), select="""
        SELECT department_id, department, round(no_reorder, 6) AS no_reorder, round(reordered, 6) AS reordered,
               round(diff, 6) AS diff, rank, round(no_reorder * 100, 6) AS no_reorder_pct,
               round(reordered * 100, 6) AS reordered_pct FROM efreq"""),
    "eda_aisle_top_bottom": with_adapter(*_eda("aisle_id", "b_aisles", "aisle"), select=_top_bottom(
        "efreq", "aisle_id", ["aisle_id", "aisle", "no_reorder", "reordered", "diff"])),
}
