"""Evaluation operators.

All metrics are aggregations; curves are running sums over the scores
grouped by distinct value (ties share one point, as the reference's curve
functions do), computed with the blocked running sum - never a window over
the whole table in one task.  ``keys`` (e.g. ``["fold"]``) evaluates many
groups in one pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rebuy.functions.columns import safe_div, threshold_flag
from rebuy.operators.prefix_sum import running_sum_by_value

METRICS = ["accuracy", "recall", "precision", "f1", "auc", "best_f1", "train_f1"]


def predict(df: DataFrame, score: str, t: float, strict: bool = True,
            out: str = "prediction") -> DataFrame:
    """Score -> 0/1 at threshold t (strict ``>`` by default)."""
    return df.withColumn(out, threshold_flag(score, t, strict))


def _counts(label: str, pred: str) -> list[Column]:
    y, p = F.col(label), F.col(pred)

    def n(c):
        return F.sum(F.when(c, 1).otherwise(0)).cast("bigint")
    return [n((y == 1) & (p == 1)).alias("tp"), n((y == 0) & (p == 1)).alias("fp"),
            n((y == 1) & (p == 0)).alias("fn"), n((y == 0) & (p == 0)).alias("tn")]


def _zero_div(a: Column, b: Column) -> Column:
    """a / b, 0 when b is 0 (the metric convention for empty classes)."""
    return F.coalesce(safe_div(a.cast("double"), b), F.lit(0.0))


def _prf(tp: Column, fp: Column, fn: Column) -> tuple[Column, Column, Column]:
    prec = _zero_div(tp, tp + fp)
    rec = _zero_div(tp, tp + fn)
    return prec, rec, _zero_div(2 * prec * rec, prec + rec)


def confusion_metrics(df: DataFrame, label: str, pred: str, keys: list[str] = ()) -> DataFrame:
    """V1 / V2: counts, accuracy, precision, recall, F1 (0 on an empty
    denominator)."""
    keys = list(keys)
    c = df.groupBy(*keys).agg(*_counts(label, pred))
    prec, rec, f1 = _prf(F.col("tp"), F.col("fp"), F.col("fn"))
    n = F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")
    return c.select(*keys, "tp", "fp", "fn", "tn",
                    _zero_div(F.col("tp") + F.col("tn"), n).alias("accuracy"),
                    prec.alias("precision"), rec.alias("recall"), f1.alias("f1"))


def curve_counts(df: DataFrame, label: str, score: str, keys: list[str] = ()) -> DataFrame:
    """Per (keys, distinct score): pos, neg, cumulative tps / fps from the
    highest score down, and the key's totals P, N."""
    keys = list(keys)
    y = F.col(label)
    g = (df.filter(F.col(score).isNotNull())
         .groupBy(*keys, F.col(score).cast("double").alias("threshold"))
         .agg(F.sum(F.when(y == 1, 1).otherwise(0)).cast("bigint").alias("pos"),
              F.sum(F.when(y == 0, 1).otherwise(0)).cast("bigint").alias("neg")))
    g = running_sum_by_value(g, keys, "threshold", {"pos": "tps", "neg": "fps"}, descending=True)
    if keys:
        tot = g.groupBy(*keys).agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
        return g.join(tot, keys, "inner")
    return (g.withColumn("P", g.select(F.sum("pos")).scalar())
            .withColumn("N", g.select(F.sum("neg")).scalar()))


def roc_points(curve: DataFrame, keys: list[str] = ()) -> DataFrame:
    """V3: (threshold, fpr, tpr) at every distinct score, and the point (0, 0)
    where nothing is predicted (threshold NULL)."""
    points = curve.select(*keys, "threshold",
                          safe_div(F.col("fps").cast("double"), F.col("N")).alias("fpr"),
                          safe_div(F.col("tps").cast("double"), F.col("P")).alias("tpr"))
    return points.unionByName(_end_row(curve, keys, fpr=0.0, tpr=0.0))


def _end_row(curve: DataFrame, keys: list[str], **values: float) -> DataFrame:
    """One row per key (per curve) with fixed values and no threshold."""
    keys = list(keys)
    groups = curve.select(*keys).distinct() if keys else curve.select(F.max("threshold").alias("t")).filter("t IS NOT NULL")
    return groups.select(*keys, F.lit(None).cast("double").alias("threshold"),
                         *[F.lit(v).alias(c) for c, v in values.items()])


def auc(curve: DataFrame, keys: list[str] = ()) -> DataFrame:
    """V4: trapezoid area under the ROC points (ties handled by grouping):
    each score group adds neg * (tps_before + tps_after) / 2, over P * N."""
    keys = list(keys)
    area = F.col("neg") * (2 * F.col("tps") - F.col("pos"))
    return curve.groupBy(*keys).agg(
        safe_div(F.sum(area).cast("double"),
                 2.0 * F.first("P").cast("double") * F.first("N").cast("double")).alias("auc"))


def pr_points(curve: DataFrame, keys: list[str] = ()) -> DataFrame:
    """V5: predict score >= t at every distinct t, highest t first, up to the
    first t that reaches full recall (later points are not part of the
    curve); and the closing point (recall 0, precision 1, threshold NULL)."""
    points = (curve.filter(F.col("tps") - F.col("pos") < F.col("P"))
              .select(*keys, "threshold",
                      safe_div(F.col("tps").cast("double"), F.col("tps") + F.col("fps")).alias("precision"),
                      safe_div(F.col("tps").cast("double"), F.col("P")).alias("recall")))
    return points.unionByName(_end_row(curve, keys, precision=1.0, recall=0.0))


def f1_points(pr: DataFrame, keys: list[str] = ()) -> DataFrame:
    """V6 series: F1 at every PR point with recall and precision non-zero."""
    r, p = F.col("recall"), F.col("precision")
    return (pr.filter((r != 0) & (p != 0))
            .select(*keys, "threshold", "recall", "precision",
                    (2 * r * p / (r + p)).alias("f1")))


def best_f1(pr: DataFrame, keys: list[str] = ()) -> DataFrame:
    """The point with the largest (f1, threshold, recall,
    precision) tuple."""
    keys = list(keys)
    best = F.max(F.struct("f1", "threshold", "recall", "precision")).alias("b")
    return (f1_points(pr, keys).groupBy(*keys).agg(best)
            .select(*keys, "b.f1", "b.threshold", "b.recall", "b.precision"))


def fold_metrics(df: DataFrame, label: str, score: str, fold: str = "fold",
                 cut: float = 0.5) -> DataFrame:
    """Per fold (validation rows = that fold): accuracy, recall, precision,
    F1 at ``cut``, AUC, best F1 over thresholds, and F1 on the other folds
    (the training rows).  One pass per metric family, no per-fold loop."""
    d = predict(df, score, cut)
    conf = confusion_metrics(d, label, "prediction", [fold])
    tot = conf.agg(*[F.sum(c).alias(f"all_{c}") for c in ("tp", "fp", "fn")])
    all_tp, all_fp, all_fn = (tot.select(F.col(f"all_{c}")).scalar() for c in ("tp", "fp", "fn"))
    _, _, train_f1 = _prf(all_tp - F.col("tp"), all_fp - F.col("fp"), all_fn - F.col("fn"))
    conf = conf.select(fold, "accuracy", "recall", "precision", "f1", train_f1.alias("train_f1"))
    curve = curve_counts(df, label, score, [fold])
    a = auc(curve, [fold])
    b = best_f1(pr_points(curve, [fold]), [fold]).select(fold, F.col("f1").alias("best_f1"))
    return conf.join(a, fold, "left").join(b, fold, "left")


def fold_summary(metrics: DataFrame) -> DataFrame:
    """Mean and population std of each fold metric."""
    aggs = []
    for m in METRICS:
        aggs += [F.avg(m).alias(f"mean_{m}"), F.stddev_pop(m).alias(f"std_{m}")]
    return metrics.agg(F.count(F.lit(1)).cast("bigint").alias("folds"), *aggs)


def curve_points(df: DataFrame, label: str, score: str, fold: str = "fold") -> DataFrame:
    """V8: the plotted series as rows (fold, series, x, y):
    roc (fpr, tpr), pr (recall, precision), f1 (threshold, f1)."""
    curve = curve_counts(df, label, score, [fold])
    roc = roc_points(curve, [fold]).select(fold, F.lit("roc").alias("series"),
                                            F.col("fpr").alias("x"), F.col("tpr").alias("y"))
    pr = pr_points(curve, [fold])
    prs = pr.select(fold, F.lit("pr").alias("series"), F.col("recall").alias("x"),
                    F.col("precision").alias("y"))
    f1 = f1_points(pr, [fold]).select(fold, F.lit("f1").alias("series"),
                                      F.col("threshold").alias("x"), F.col("f1").alias("y"))
    return roc.unionByName(prs).unionByName(f1)
