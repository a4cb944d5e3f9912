"""Connected components of a link table by alternating large and small stars.

Every round is two grouped minima and two joins on Spark; each round's links
are written to the shared folder, so a lost executor costs at most one round.
Only a row count and a checksum reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rebuy.llm.shared import stored

MAX_ROUNDS = 60


def _large_star(e: DataFrame) -> DataFrame:
    n = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = n.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return (n.filter("b > a").join(least, "a")
            .select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b"))


def _small_star(e: DataFrame) -> DataFrame:
    n = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = n.groupBy("a").agg(F.min("b").alias("m"))
    hop = n.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return hop.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(a long, b long) links -> (node long, root long): root is the smallest
    node its node reaches.  Nodes without links do not appear; links with a
    null end and self-links are ignored; repeats do no harm."""
    e = stored(links.select(F.col("a").cast("long"), F.col("b").cast("long"))
               .filter("a <> b").distinct(), "links")
    before = None
    for _ in range(MAX_ROUNDS):
        mark = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark[0] == 0 or mark == before:
            return e.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = mark
        e = stored(_small_star(_large_star(e)), "stars")
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
