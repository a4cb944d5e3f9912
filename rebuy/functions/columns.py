"""Scalar column expressions used by the feature, binning and evaluation
operators.  Everything here returns a ``Column`` built from
``pyspark.sql.functions`` so it stays inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "safe_div", "zero_to_half", "weekend_flag", "threshold_flag",
    "dept_bin", "aisle_bin", "hod_bin", "feature_type", "md5_key",
    "hash_fold", "linspace",
]

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference for equal results.
# Decision threshold of the final model (strict ">").
FINAL_THRESHOLD = 0.2114
# Department bin boundaries on diff = P(dept | reordered) - P(dept | not):
#   diff >= 0.02 -> 2; 0 <= diff < 0.02 -> 1; -0.01 <= diff < 0 -> -1;
#   -0.02 <= diff < -0.01 -> -2; diff < -0.02 -> -3; diff missing -> 0.
DEPT_BIN_EDGES = (0.02, 0.0, -0.01, -0.02)
# Aisle bin boundaries (ratios missing in a class count as 0 first):
#   diff >= 0.001 -> 2; diff <= -0.001 -> -2; 0 <= diff < 0.001 -> 1;
#   -0.001 < diff < 0 -> -1.
AISLE_BIN_EDGE = 0.001
# Current-order hour bin: diff >= 0 -> 1; diff < 0 -> -1; missing -> 0.
# Zero guards of the current-order features: a zero gap becomes 0.5 days;
# the gap deviation with zero or missing spread becomes 99999.
ZERO_GAP = 0.5
NO_SPREAD = 99999.0
# Days added to the cumulative gap when the order has no prior gap (a week).
FIRST_ORDER_DAYS = 7.0
# Feature-name prefixes, tested in this order, and their types.
FEATURE_TYPES = (("user_product", "User-Product"), ("user_", "User"),
                 ("product", "Product"))
FEATURE_TYPE_DEFAULT = "Order"
# ---------------------------------------------------------------------------


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x



def safe_div(num, den) -> Column:
    """Division that yields NULL for a zero or NULL denominator (Spark 4 ANSI
    mode raises on x/0)."""
    return F.try_divide(_c(num), _c(den))


def zero_to_half(c) -> Column:
    """The reference's zero guard: 0 -> 0.5, everything else unchanged."""
    c = _c(c)
    return F.when(c == 0, F.lit(ZERO_GAP)).otherwise(c)


def weekend_flag(dow) -> Column:
    """Day-of-week 0 or 1 -> 1, else 0."""
    return (_c(dow) < 2).cast("int")


def threshold_flag(score, t: float = FINAL_THRESHOLD, strict: bool = True) -> Column:
    """Predicted class at threshold t (strict ``>`` by default)."""
    s = _c(score)
    return (s > F.lit(t) if strict else s >= F.lit(t)).cast("int")


def dept_bin(diff) -> Column:
    d = _c(diff)
    e2, e1, em1, em2 = DEPT_BIN_EDGES
    return (F.when(d >= e2, 2).when(d >= e1, 1).when(d >= em1, -1)
            .when(d >= em2, -2).when(d < em2, -3).otherwise(0)).cast("int")


def aisle_bin(diff) -> Column:
    d = _c(diff)
    e = AISLE_BIN_EDGE
    return (F.when(d >= e, 2).when(d <= -e, -2).when(d >= 0, 1)
            .when(d < 0, -1).otherwise(0)).cast("int")


def hod_bin(diff) -> Column:
    d = _c(diff)
    return F.when(d >= 0, 1).when(d < 0, -1).otherwise(0).cast("int")


def feature_type(name) -> Column:
    n = _c(name)
    expr = None
    for prefix, label in FEATURE_TYPES:
        expr = (F.when(n.startswith(prefix), label) if expr is None
                else expr.when(n.startswith(prefix), label))
    return expr.otherwise(FEATURE_TYPE_DEFAULT)



def md5_key(*cols, seed) -> Column:
    """Deterministic pseudo-random sort key: md5 of the ids and a salt.
    The same text is computable in any SQL engine with md5()."""
    parts = []
    for c in cols:
        parts += [_c(c).cast("string"), F.lit("#")]
    parts.append(F.lit(str(seed)))
    return F.md5(F.concat(*parts))


def hash_fold(c, k: int, seed) -> Column:
    """Fold number in [0, k): first 32 bits of md5(id#seed) modulo k."""
    h = F.conv(F.substring(md5_key(c, seed=seed), 1, 8), 16, 10).cast("bigint")
    return (h % F.lit(k)).cast("int")


def linspace(a: float, b: float, n: int) -> list[float]:
    """``np.linspace`` for a parameter grid (driver-side, n values)."""
    if n == 1:
        return [float(a)]
    return [a + i * (b - a) / (n - 1) for i in range(n)]
