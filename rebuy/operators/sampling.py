"""Sampling and splits.

The reference draws unseeded ``np.random.choice`` samples.  Here a sample
is *the n rows with the smallest md5(id#salt)*: seeded, reproducible, the
same set in any SQL engine (``ORDER BY md5(...), id LIMIT n``), and exact.

It runs distributed without a global sort and without gathering n rows in
one task: the key of the n-th row is found by counting rows per 16 bits of
the hash (at most 65,536 counts), refined by the next 16 bits while the
bucket it falls in is still large; the sample is then one filter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rebuy.functions.columns import hash_fold, md5_key
from rebuy.operators.orders import filter_not_test
from rebuy.operators.prefix_sum import BLOCK, range_blocks

BITS = 4                  # hex digits counted at a time
EDGE_ROWS = 100_000       # a bucket of at most so many rows is ordered as it is


def _last_key(keyed: DataFrame, n: int) -> str | None:
    """The n-th smallest ``_k``, or None when there are no more than n rows."""
    prefix, need = "", n
    while True:
        rows = keyed.filter(F.col("_k").startswith(prefix)) if prefix else keyed
        counts = sorted((r["b"], r["n"]) for r in rows.groupBy(
            F.substring("_k", len(prefix) + 1, BITS).alias("b")).agg(F.count(F.lit(1)).alias("n")).collect())
        if not prefix and sum(c for _, c in counts) <= n:
            return None
        for bucket, count in counts:
            if need <= count:
                break
            need -= count
        prefix += bucket
        if count <= EDGE_ROWS or len(prefix) >= 32:
            edge = keyed.filter(F.col("_k").startswith(prefix)).select("_k").orderBy("_k").limit(need)
            return edge.agg(F.max("_k")).first()[0]


def exact_sample(df: DataFrame, id_cols: list[str], n: int, salt: str) -> DataFrame:
    """The n rows of ``df`` with the smallest md5(ids#salt).  ``df``
    rows must be unique on ``id_cols``."""
    if n <= 0:
        return df.limit(0)
    keyed = df.withColumn("_k", md5_key(*id_cols, seed=salt))
    last = _last_key(keyed, n)
    return df if last is None else keyed.filter(F.col("_k") <= last).drop("_k")


def hash_rank(df: DataFrame, id_cols: list[str], salt: str, out: str = "hash_rank") -> DataFrame:
    """1-based position of each row in md5(ids#salt) order (ties by ids): rows
    are dealt by key range, numbered inside their part and offset by the
    counts of the parts before (one row per part)."""
    d = range_blocks(df.withColumn("_k", md5_key(*id_cols, seed=salt)), ["_k", *id_cols])
    offs = d.groupBy(BLOCK).count().select(BLOCK, F.coalesce(
        F.sum("count").over(Window.orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    inner = F.row_number().over(Window.partitionBy(BLOCK).orderBy("_k", *id_cols))
    return (d.join(offs, BLOCK).withColumn(out, (F.col("_off") + inner).cast("bigint"))
            .drop("_k", BLOCK, "_off"))


def user_folds_balanced(df: DataFrame, k: int = 5, salt: str = "42") -> DataFrame:
    """X7, exact variant: users dealt round-robin in hash order, so fold
    sizes differ by at most one."""
    r = hash_rank(distinct_ids(df, "user_id"), ["user_id"], salt)
    return r.select("user_id", ((F.col("hash_rank") - 1) % k).cast("int").alias("fold"))


def distinct_ids(df: DataFrame, col: str) -> DataFrame:
    """``Series.unique()``."""
    return df.select(col).distinct()


def user_folds(df: DataFrame, k: int = 5, salt: str = "42") -> DataFrame:
    """(user_id, fold) with fold = md5(user#salt) mod k over the
    distinct users; every user in exactly one fold, sizes about equal."""
    return distinct_ids(df, "user_id").withColumn("fold", hash_fold("user_id", k, salt))


def with_folds(df: DataFrame, k: int = 5, salt: str = "42") -> DataFrame:
    """Adds the user's fold to each row (same hash, no join needed)."""
    return df.withColumn("fold", hash_fold("user_id", k, salt))


class Holdout:
    """The reference's holdout job as lazy DataFrames.

    * ``sample_ids``: n_total current order ids; ``subset_ids``: n_subset of
      those; ``holdout_ids``: the rest of the sample;
    * ``test_lines`` = current lines of holdout orders, ``train_lines`` = all
      other current lines (includes the subset), ``subset_lines``;
    * ``subset_prior_lines``: prior lines of every order (prior or current)
      of the subset's users plus n_extra_users random users.
    """

    def __init__(self, orders: DataFrame, current_lines: DataFrame, prior_lines: DataFrame,
                 n_total: int, n_subset: int, n_extra_users: int, seed: int = 42,
                 mode: str = "table"):
        from rebuy.plans.stash import stash
        self.orders = filter_not_test(orders)
        recent_ids = distinct_ids(current_lines, "order_id")
        # The id samples hold n rows by construction: materialise them once
        # so every split below reads them instead of re-deriving them.
        self.sample_ids = stash(exact_sample(recent_ids, ["order_id"], n_total, f"{seed}"), mode)
        self.subset_ids = stash(exact_sample(self.sample_ids, ["order_id"], n_subset,
                                             f"{seed}/subset"), mode)
        self.holdout_ids = self.sample_ids.join(self.subset_ids, "order_id", "left_anti")
        # The id sets are stored tables of known size: Spark broadcasts them
        # into the line and order scans while they are small.
        self.test_lines = current_lines.join(self.holdout_ids, "order_id", "left_semi")
        self.train_lines = current_lines.join(self.holdout_ids, "order_id", "left_anti")
        self.subset_lines = current_lines.join(self.subset_ids, "order_id", "left_semi")
        user_ids = distinct_ids(self.orders, "user_id")
        self.subset_user_ids = self.orders.join(self.subset_ids, "order_id", "left_semi").select("user_id")
        self.extra_user_ids = stash(exact_sample(user_ids, ["user_id"], n_extra_users,
                                                 f"{seed}/users"), mode)
        self.all_user_ids = self.extra_user_ids.union(self.subset_user_ids).distinct()
        prior_order_ids = self.orders.join(self.all_user_ids, "user_id", "left_semi").select("order_id")
        self.subset_prior_lines = prior_lines.join(prior_order_ids, "order_id", "left_semi")

    def write(self, path: str) -> None:
        """The four CSV outputs, no index column."""
        from rebuy.sources.files import write_csv
        write_csv(self.train_lines, f"{path}/train_order_products")
        write_csv(self.test_lines, f"{path}/test_order_products")
        write_csv(self.subset_lines, f"{path}/subset_order_products")
        write_csv(self.subset_prior_lines, f"{path}/subset_prior_order_products")
