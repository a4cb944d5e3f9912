"""Embedding near-dedup: Euclidean p-stable hashing, then exact cosines.

Normalised vectors whose cosine is at least t lie within sqrt(2 - 2 t) of each
other.  The number of hashes a table joins follows from the rows of the
largest label (about ``BUCKET_ROWS`` unrelated rows a bucket), the number of
tables from the recall wanted for a pair just at the threshold.  Every pair
that shares a bucket is checked exactly; a pair in several tables counts in the
first only.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rebuy.llm.components import components
from rebuy.llm.pstable import buckets, by_dimension, collision, matrix, projections, slots, usable
from rebuy.llm.shared import stored, tiled

COSINE = 0.93
WIDTH = 2.0             # slot width over unit vectors
RECALL = 0.999          # aimed share of pairs found at the threshold itself
BUCKET_ROWS = 64
TILE_ROWS = 2048
SEED = 7


def plan(rows: int, cosine: float, recall: float, width: float = WIDTH) -> tuple[int, int]:
    """(hashes a table, tables) for the largest label's rows."""
    near, far = collision(math.sqrt(max(0.0, 2 - 2 * cosine)), width), collision(math.sqrt(2), width)
    k = max(4, math.ceil(math.log(max(1.0, rows / BUCKET_ROWS)) / -math.log(far)))
    p = near ** k
    return k, max(1, math.ceil(math.log(1 - recall) / math.log1p(-p))) if p < 1 else 1


def exact_cosine(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return (x * y).sum(axis=1) / np.sqrt((x * x).sum(axis=1) * (y * y).sum(axis=1))


def tile_links(ids: np.ndarray, copies: np.ndarray, x: np.ndarray, keys: np.ndarray, table: int,
               part: np.ndarray | None, cosine: float):
    """Pairs of one tile at ``cosine`` or more that no earlier table joins:
    per vector the rows it links with, and stars that hold the pairs together.
    part: 0 or 1 per row when only pairs across the two parts are due."""
    unit = x / np.sqrt((x * x).sum(axis=1))[:, None]
    n, found = len(ids), np.zeros(len(ids), np.int64)
    root = np.arange(n)
    for a in range(0, n, 64):
        sims = unit[a:a + 64] @ unit.T
        i, j = np.nonzero(sims >= cosine - 1e-9)
        i += a
        keep = i < j
        if part is not None:
            keep &= part[i] != part[j]
        i, j = i[keep], j[keep]
        edge = np.abs(sims[i - a, j] - cosine) < 1e-9
        if edge.any():
            keep = ~edge
            keep[edge] = exact_cosine(x[i[edge]], x[j[edge]]) >= cosine
            i, j = i[keep], j[keep]
        if table:
            fresh = ~(keys[i, :table] == keys[j, :table]).any(axis=1)
            i, j = i[fresh], j[fresh]
        found += np.bincount(i, copies[j], n).astype(np.int64) + np.bincount(j, copies[i], n).astype(np.int64)
        for p in np.unique(i).tolist():
            groups = np.unique(root[np.append(j[i == p], p)])
            if len(groups) > 1:
                root[np.isin(root, groups)] = groups[0]
    return found, root


def _dimension_links(reps: DataFrame, dim: int, cosine: float, recall: float, tile_rows: int) -> DataFrame:
    """(rep, n_links, root): partial counts and stars of one vector length."""
    most = reps.groupBy("label").count().agg(F.max("count")).first()[0]
    k, tables = plan(most, cosine, recall)

    def hash_rows(batches):
        g, b = projections(dim, k * tables, WIDTH, SEED)
        for batch in batches:
            x = matrix(batch.column("embedding"), dim)
            x /= np.sqrt((x * x).sum(axis=1))[:, None]
            keys = buckets(slots(x, g, b, WIDTH), tables)
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("rep", "copies", "label", "embedding")]
                + [pa.FixedSizeListArray.from_arrays(pa.array(keys.ravel()), tables).cast(pa.list_(pa.int32()))],
                ["rep", "copies", "label", "embedding", "keys"])

    kind = reps.schema["embedding"].dataType.simpleString()
    hashed = reps.select("rep", "copies", "label", "embedding").mapInArrow(
        hash_rows, f"rep long, copies long, label {reps.schema['label'].dataType.simpleString()}, "
                   f"embedding {kind}, keys array<int>")
    dealt = hashed.select("*", F.posexplode("keys").alias("t", "bucket"))

    def link(key, tab):
        t, i, j = key[0].as_py(), key[3].as_py(), key[4].as_py()
        ids = tab.column("rep").to_numpy()
        order = np.argsort(ids, kind="stable")
        tab = tab.take(pa.array(order))
        keys = matrix(tab.column("keys"), tables).astype(np.int32)
        part = None if i == j else (tab.column("part").to_numpy() == i)
        found, root = tile_links(ids[order], tab.column("copies").to_numpy(), matrix(tab.column("embedding"), dim),
                                 keys, t, part, cosine)
        hit = found > 0
        return pa.table({"rep": ids[order][hit], "n_links": found[hit], "root": ids[order][root[hit]]})

    tiles = tiled(dealt, ["t", "label", "bucket"], "rep", tile_rows)
    return (tiles.groupBy("t", "label", "bucket", "i", "j")
            .applyInArrow(link, "rep long, n_links long, root long"))


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, recall: float = RECALL,
                    tile_rows: int = TILE_ROWS) -> DataFrame:
    """One row per row of ``vectors`` (vec_id, embedding, label; other columns
    are ignored): vec_id, n_links, component_id, kept.

    Equal vectors of one label fold into one representative that carries their
    count, so a third of all rows being one vector costs one row.  Vectors that
    are null, zero or hold a null or non-finite component, and rows without a
    label, link with nothing: n_links 0, own component.  Vectors of different
    lengths never link.  A null vec_id counts as a linked vector but names no
    component unless nothing else does.  An empty table returns no rows."""
    v = vectors.select(F.col("vec_id").cast("long"), "embedding", "label")
    ok = usable("embedding") & F.col("label").isNotNull()
    zero = F.lit(0).cast(v.schema["embedding"].dataType.elementType)
    good = (v.filter(ok).withColumn("embedding", F.transform("embedding", lambda x: x + zero))   # -0.0 is 0.0
            .withColumn("h1", F.xxhash64("label", "embedding")).withColumn("h2", F.xxhash64(F.lit(SEED), "embedding", "label")))
    # equal vectors of a label: 128 bits and a number of their own
    reps = stored(good.groupBy("h1", "h2").agg(
        F.any_value("label").alias("label"), F.any_value("embedding").alias("embedding"),
        F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("least"))
        .withColumn("rep", F.monotonically_increasing_id()), "vectors")
    parts = [_dimension_links(reps.filter(F.size("embedding") == d), d, cosine, recall, tile_rows)
             for d in by_dimension(reps)]
    if not parts:
        return v.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"),
                        F.lit(True).alias("kept"))
    links = parts[0]
    for p in parts[1:]:
        links = links.unionByName(p)
    links = stored(links, "vector-links")
    roots = components(links.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    counts = links.groupBy("rep").agg(F.sum("n_links").alias("n_links"))
    of_rep = (reps.select("rep", "h1", "h2", "copies", "least").join(counts, "rep", "left")
              .join(roots.withColumnRenamed("node", "rep"), "rep", "left")
              .withColumn("root", F.coalesce("root", "rep")))
    least = of_rep.groupBy("root").agg(F.min("least").alias("component_id"))
    told = of_rep.join(least, "root").select(
        "h1", "h2", (F.coalesce("n_links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    linked = good.select("vec_id", "h1", "h2").join(told, ["h1", "h2"]).select("vec_id", "n_links", "component_id")
    alone = v.filter(~F.coalesce(ok, F.lit(False))).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
