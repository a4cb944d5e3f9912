"""Skew-safe running sums (cumulative sums in a given order).

A plain ``Window.partitionBy(key).orderBy(o)`` puts a whole key group into
one task, and an un-partitioned window puts the whole table into one task.
Both break when one key holds a third of the rows.  Here the ordered rows are
cut into *blocks* of bounded size:

1. inside each (key, block) a windowed running sum (bounded task size);
2. block totals by ``groupBy`` (partial aggregation, no hot task);
3. a running sum over the block totals per key: that table has one row per
   block, so even a huge key group is only rows/block_size rows;
4. offsets joined back on (key, block).

Blocks come from the order value itself: ``floor(order / block_size)`` for
integral orders (order numbers), the parts of a range partitioning for
arbitrary doubles (scores).

NULL semantics follow SQL ``sum() OVER``: NULL values are skipped and the
result is NULL only while every value so far is NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = "_blk"


def _combine(local: Column, off: Column) -> Column:
    return F.when(local.isNull() & off.isNull(), F.lit(None)).otherwise(
        F.coalesce(local, F.lit(0)) + F.coalesce(off, F.lit(0)))


def running_sum_blocked(df: DataFrame, keys: list[str], order_cols: list[str],
                        values: dict[str, str], descending: bool,
                        block_col: str = BLOCK) -> DataFrame:
    """Inclusive running sums of ``values`` (input col -> output col) within
    ``keys`` in ``order_cols`` order, given a ``block_col`` that is monotone
    in that order.  Returns df plus the output columns (block col dropped)."""
    def order(c):
        return F.col(c).desc() if descending else F.col(c).asc()

    w_local = (Window.partitionBy(*keys, block_col)
               .orderBy(*[order(c) for c in order_cols])
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    d = df
    for src, dst in values.items():
        d = d.withColumn(f"_loc_{dst}", F.sum(src).over(w_local))
    totals = d.groupBy(*keys, block_col).agg(
        *[F.sum(src).alias(f"_tot_{dst}") for src, dst in values.items()])
    w_blocks = (Window.partitionBy(*keys).orderBy(order(block_col))
                .rowsBetween(Window.unboundedPreceding, -1))
    offsets = totals.select(
        *keys, block_col,
        *[F.sum(f"_tot_{dst}").over(w_blocks).alias(f"_off_{dst}") for dst in values.values()])
    out = d.join(offsets, [*keys, block_col], "inner")
    for dst in values.values():
        out = out.withColumn(dst, _combine(F.col(f"_loc_{dst}"), F.col(f"_off_{dst}")))
    drop = [block_col] + [f"_loc_{d}" for d in values.values()] + [f"_off_{d}" for d in values.values()]
    return out.drop(*drop)


def running_sum_by_number(df: DataFrame, keys: list[str], number_col: str,
                          values: dict[str, str], descending: bool = False,
                          block_size: int = 4096) -> DataFrame:
    """Running sums ordered by an integral column (e.g. order_number): block
    = floor(number / block_size), at most block_size rows per distinct number
    run per key."""
    d = df.withColumn(BLOCK, F.floor(F.col(number_col) / F.lit(block_size)))
    return running_sum_blocked(d, keys, [number_col], values, descending)


def range_blocks(df: DataFrame, order_cols: list[str]) -> DataFrame:
    """Adds BLOCK, the number of the key range a row was dealt to: Spark
    samples a bounded number of rows per partition for the ranges.  The rows
    are stored, so block numbers stay what they are when a task is retried."""
    from rebuy.plans.stash import stash
    return stash(df.repartitionByRange(*order_cols).withColumn(BLOCK, F.spark_partition_id()))


def running_sum_by_value(df: DataFrame, keys: list[str], order_col: str,
                         values: dict[str, str], descending: bool = False) -> DataFrame:
    """Running sums ordered by a double column with distinct values per key
    (e.g. scores grouped per distinct value)."""
    return running_sum_blocked(range_blocks(df, [order_col]), keys, [order_col], values, descending)
