"""Materialisation points.

A DataFrame used by several branches of a job is computed once and reused.
``table`` writes it as Parquet under the cluster's shared
``spark.checkpoint.dir`` and reads it back: it survives executor loss, cuts the
lineage, and its readers prune columns and push filters down.  Its
partitioning is not kept: a later join on the same key shuffles again.
``none`` leaves the plan lazy.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from rebuy.session import scratch_path

MODES = ("table", "none")


def stash(df: DataFrame, mode: str = "table") -> DataFrame:
    if mode == "none":
        return df
    if mode != "table":
        raise ValueError(f"stash mode must be one of {MODES}")
    path = scratch_path(df.sparkSession, f"stash-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
