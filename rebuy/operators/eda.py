"""EDA frequency tables.

Frequencies use the order line's own ``reordered`` flag (not the candidate
label).  Missing class ratios count as 0, diff = reordered - no_reorder,
ranked by diff descending (NULL last, ties by key).  The ranking runs over
the per-category table (one row per department or aisle), never over lines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rebuy.operators.binning import class_counts, class_ratios


def category_frequency(lines: DataFrame, products: DataFrame, names: DataFrame,
                       key: str, fill_missing: bool = True) -> DataFrame:
    """Per category: no_reorder, reordered (class shares), diff, rank and the
    category name (a real key join; the reference looked names up by
    position)."""
    per_product = lines.groupBy("product_id", "reordered").count()
    tagged = per_product.join(products.select("product_id", key), "product_id", "inner")
    ratios = class_ratios(class_counts(tagged, key, weight="count"), fill_missing)
    ranked = ratios.withColumn(
        "rank", F.row_number().over(Window.orderBy(F.desc_nulls_last("diff"), key)).cast("int"))
    # The percentages the reference plotted.
    return (ranked.join(names, key, "left")
            .select(key, names.columns[1], "no_reorder", "reordered", "diff", "rank",
                    (F.col("no_reorder") * 100).alias("no_reorder_pct"),
                    (F.col("reordered") * 100).alias("reordered_pct")))


def top_bottom(freq: DataFrame, key: str, n: int = 10) -> DataFrame:
    """L4: the n largest diffs (best first) and the n smallest (worst
    first); NULL diffs are never picked."""
    f = freq.filter(F.col("diff").isNotNull())
    top = f.orderBy(F.desc("diff"), F.asc(key)).limit(n)
    bottom = f.orderBy(F.asc("diff"), F.desc(key)).limit(n)
    w_top = Window.orderBy(F.desc("diff"), F.asc(key))
    w_bot = Window.orderBy(F.asc("diff"), F.desc(key))
    cols = [c for c in freq.columns if c not in ("rank", "no_reorder_pct", "reordered_pct")]
    return (top.select(*cols, F.lit("top").alias("side"), F.row_number().over(w_top).cast("int").alias("pos"))
            .unionByName(bottom.select(*cols, F.lit("bottom").alias("side"),
                                       F.row_number().over(w_bot).cast("int").alias("pos"))))
