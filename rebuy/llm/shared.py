"""Helpers the operators share: stored tables, tiles, table reading."""

from __future__ import annotations

import os
import uuid

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rebuy.session import scratch_path


ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


ARROW_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 8 << 20      # Spark's own limit, 64 MB, times what Python makes of it is too much for a small worker


def on_workers(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver did
    (a cluster that has it installed needs nothing), and hand them Arrow
    batches of bounded size."""
    if spark.conf.get(ARROW_LIMIT, None) in ("67108864b", "64MB"):
        spark.conf.set(ARROW_LIMIT, str(BATCH_BYTES))
    env = spark.sparkContext.environment
    if ROOT not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, env.get("PYTHONPATH", "")]))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared ``spark.checkpoint.dir`` and
    read it back: lineage is cut, any executor can be lost afterwards, and
    readers still get column pruning."""
    path = scratch_path(df.sparkSession, f"llm/{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dropped(spark: SparkSession, path: str) -> None:
    """Remove a written table that nothing reads any more."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(columns: list[str], name: str) -> str:
    """``name``, with as many underscores as none of ``columns`` has it (whatever
    the case of its letters)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def hashed_sample(df: DataFrame, key: str, most: int, rows: int, seed: int) -> DataFrame:
    """At most ``most`` of the ``rows`` rows of ``df``, by a hash of ``key``.
    Each row first decides alone whether it may be drawn (twice the share
    wanted), so about 2 * most rows are ordered, not ``most`` of every task."""
    ticket = F.pmod(F.xxhash64(F.lit(seed), key), F.lit(1 << 30))
    share = min(1 << 30, -(-(1 << 30) * (2 * most + 64) // max(1, rows)))
    return df.filter(ticket < share).orderBy(ticket, key).limit(most)


def slices(batches, most_bytes: int = 1 << 22):
    """Arrow batches in slices of about ``most_bytes`` at most (a row is never
    cut), so that what Python makes of them stays small."""
    for b in batches:
        rows = max(1, int(b.num_rows * most_bytes // max(1, b.nbytes)))
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def coded_words(data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, pa.BinaryArray]:
    """Words data[edges[0]:edges[1]], data[edges[2]:edges[3]], ... -> (code of
    each, the different words by code)."""
    runs = pa.BinaryArray.from_buffers(pa.binary(), len(edges) - 1, [None, pa.py_buffer(edges.astype(np.int32)), pa.py_buffer(data)])
    coded = runs.take(pa.array(np.arange(0, len(edges) - 1, 2))).dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False), coded.dictionary


def word_hashes(words: pa.BinaryArray) -> np.ndarray:
    """64-bit FNV-1a hashes, all words' first bytes at once, then their second ones, and so on;
    long words by XXH64."""
    n = len(words)
    edge = np.frombuffer(words.buffers()[1], np.int32)[words.offset:words.offset + n + 1].astype(np.int64)
    data = np.frombuffer(words.buffers()[2] or b"", np.uint8)
    size = np.diff(edge)
    out = np.full(n, 0xCBF29CE484222325, np.uint64)
    todo = np.flatnonzero(size <= 64)
    for i in range(int(size[todo].max()) if len(todo) else 0):
        todo = todo[size[todo] > i]
        out[todo] = (out[todo] ^ data[edge[todo] + i]) * np.uint64(0x100000001B3)
    for i in np.flatnonzero(size > 64).tolist():
        out[i] = xxhash.xxh64_intdigest(data[edge[i]:edge[i + 1]].tobytes())
    return out ^ (out >> np.uint64(31))


def tiled(rows: DataFrame, keys: list[str], item: str, tile_rows: int) -> DataFrame:
    """Deal each group of ``keys`` into tiles of about ``tile_rows`` rows.

    A group of at most ``tile_rows`` rows is one tile (0, 0).  A larger group
    is salted into k parts by a hash of ``item`` and every pair of parts
    (i <= j) becomes a tile, so each pair of rows meets in at least one tile
    and no task ever holds more than about two parts, however hot the group.
    Groups with a single row have no pairs and go.  Adds ``part``, the part of
    the row itself, and ``i``, ``j``.
    """
    sizes = (rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
             .select(*keys, F.ceil(F.col("_n") / F.lit(tile_rows)).cast("int").alias("_k")))
    salt = F.pmod(F.xxhash64(F.lit("tile"), F.col(item)), F.col("_k")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("_k") - 1))
    return (rows.join(sizes, keys).withColumn("part", salt).withColumn("_o", other)
            .withColumn("i", F.least("part", "_o")).withColumn("j", F.greatest("part", "_o"))
            .drop("_k", "_o"))
