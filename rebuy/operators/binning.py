"""Supervised category binning.

diff(k) = P(key = k | label = 1) - P(key = k | label = 0); the bin of a key
is a step function of diff.  Fitting is a tiny aggregation (one row per
key); applying is a join against that map, unseen keys get NULL.

The fit accepts a pre-aggregated weight column so callers can shrink a huge
labelled table to (key, label, count) with partial aggregation first - the
feature table fits the department / aisle bins from per-product counts and
never joins its candidate rows to the product dimension twice.
"""

from __future__ import annotations

from pyspark.ml import Estimator, Model
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rebuy.functions.columns import aisle_bin, dept_bin, hod_bin, safe_div

RULES = {
    # name: (bin expression, fill a missing class ratio with 0 first)
    "department": (dept_bin, False),
    "aisle": (aisle_bin, True),
    "hour": (hod_bin, False),
}


def class_counts(df: DataFrame, key: str, label: str = "reordered",
                 weight: str | None = None) -> DataFrame:
    """Per non-NULL key, rows with label 0 (n0) and with label 1 (n1)."""
    w = F.col(weight) if weight else F.lit(1)
    return (df.filter(F.col(key).isNotNull())
            .groupBy(key)
            .agg(F.sum(F.when(F.col(label) == 0, w).otherwise(0)).cast("bigint").alias("n0"),
                 F.sum(F.when(F.col(label) == 1, w).otherwise(0)).cast("bigint").alias("n1")))


def class_ratios(counts: DataFrame, fill_missing: bool, by: list[str] = ()) -> DataFrame:
    """A12 + J9: per key, the share of each class's rows (full outer
    alignment of the two value_counts), within each group of ``by``.  A key
    absent from a class has a NULL ratio, or 0 with ``fill_missing``.  Adds
    no_reorder, reordered, diff."""
    # class totals over the category table (one row per key), in the same pass
    every = Window.partitionBy(*by)
    t0, t1 = F.sum("n0").over(every), F.sum("n1").over(every)

    def ratio(n: str, t: Column) -> Column:
        r = F.when(F.col(n) > 0, safe_div(F.col(n).cast("double"), t))
        return F.coalesce(r, F.lit(0.0)) if fill_missing else r

    return (counts.withColumn("no_reorder", ratio("n0", t0))
            .withColumn("reordered", ratio("n1", t1))
            .withColumn("diff", F.col("reordered") - F.col("no_reorder")))


def bin_map(counts: DataFrame, key: str, rule: str, out_col: str) -> DataFrame:
    """Key -> bin."""
    expr, fill = RULES[rule]
    r = class_ratios(counts, fill)
    return r.select(key, "no_reorder", "reordered", "diff", expr("diff").alias(out_col))


def apply_bin_map(df: DataFrame, bmap: DataFrame, key: str, out_col: str,
                  drop_key: bool = True) -> DataFrame:
    """Dictionary lookup, unseen key -> NULL (the map has one row
    per category; Spark broadcasts it by its measured size)."""
    out = df.join(bmap.select(key, out_col), key, "left")
    return out.drop(key) if drop_key else out


def fold_bin_maps(df: DataFrame, key: str, rule: str, out_col: str, folds: int, label: str = "reordered",
                  weight: str | None = None) -> DataFrame:
    """B1-B3 fitted without each fold: (fold, key, no_reorder, reordered, diff,
    ``out_col``) where the row of fold f is what the rows of all other folds
    give.  ``df`` has a ``fold`` column from 0.

    The table is counted once by (fold, key, label); a fold's training counts
    are the total minus its own, so no row is read again per fold.  A key that
    occurs in no training row of a fold has no row there (its bin is NULL)."""
    w = F.col(weight) if weight else F.lit(1)
    own = (df.filter(F.col(key).isNotNull()).groupBy("fold", key)
           .agg(F.sum(F.when(F.col(label) == 0, w).otherwise(0)).cast("bigint").alias("own0"),
                F.sum(F.when(F.col(label) == 1, w).otherwise(0)).cast("bigint").alias("own1")))
    total = own.groupBy(key).agg(F.sum("own0").alias("all0"), F.sum("own1").alias("all1"))
    every = total.withColumn("fold", F.explode(F.sequence(F.lit(0), F.lit(folds - 1))))
    counts = (every.join(own, ["fold", key], "left")
              .withColumn("n0", F.col("all0") - F.coalesce("own0", F.lit(0)))
              .withColumn("n1", F.col("all1") - F.coalesce("own1", F.lit(0)))
              .filter("n0 + n1 > 0").select("fold", key, "n0", "n1"))
    expr, fill = RULES[rule]
    r = class_ratios(counts, fill, ["fold"])
    return r.select("fold", key, "no_reorder", "reordered", "diff", expr("diff").alias(out_col))


def with_fold_bins(df: DataFrame, maps: DataFrame, key: str, out_col: str, folds: int) -> DataFrame:
    """Add ``out_col``_f0, _f1, ...: the row's bin by each fold's map, from one
    join on the key (one row per category).  The model that holds out fold f
    sees _f{f} only, in training and in validation."""
    wide = maps.groupBy(key).agg(*[F.max(F.when(F.col("fold") == f, F.col(out_col))).alias(f"{out_col}_f{f}") for f in range(folds)])
    return df.join(wide, key, "left")


class SupervisedBinner(Estimator):
    """Estimator: fits a key -> bin map from labelled (optionally weighted)
    rows.  ``rule`` is ``department``, ``aisle`` or ``hour``."""

    def __init__(self, keyCol: str, outputCol: str, rule: str,
                 labelCol: str = "reordered", weightCol: str | None = None):
        super().__init__()
        self.keyCol, self.outputCol, self.rule = keyCol, outputCol, rule
        self.labelCol, self.weightCol = labelCol, weightCol

    def _fit(self, dataset: DataFrame) -> "SupervisedBinnerModel":
        counts = class_counts(dataset, self.keyCol, self.labelCol, self.weightCol)
        return SupervisedBinnerModel(bin_map(counts, self.keyCol, self.rule, self.outputCol),
                                     self.keyCol, self.outputCol)


class SupervisedBinnerModel(Model):
    def __init__(self, mapping: DataFrame, keyCol: str, outputCol: str):
        super().__init__()
        self.mapping, self.keyCol, self.outputCol = mapping, keyCol, outputCol

    def _transform(self, dataset: DataFrame, drop_key: bool = False) -> DataFrame:
        return apply_bin_map(dataset, self.mapping, self.keyCol, self.outputCol, drop_key)

    def save(self, path: str) -> None:
        """The map as a small Parquet table."""
        self.mapping.write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str, keyCol: str, outputCol: str):
        return cls(spark.read.parquet(path), keyCol, outputCol)
