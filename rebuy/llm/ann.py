"""Approximate nearest neighbours by inner product: multiprobe p-stable hashing.

The largest inner product becomes the smallest Euclidean distance when a vector
x gains the component sqrt(M^2 - |x|^2) (M: the largest norm) and a query gains
0.  Every row is indexed in ``tables`` tables of ``hashes`` quantised Gaussian
projections.  A query visits the buckets of a table in the order of their
estimated success: for a neighbour at cosine c its projection is normal around
c times the query's, with variance 1 - c^2, which gives each slot, and so each
bucket, a probability.  Visits go on until their sum reaches the share wanted
of one table.  Candidates of all tables are merged and ranked by exact inner
products in double precision.

c, and a lower bound on what can still enter a query's result, come from a
bounded sample of rows that every task holds; the sample's rows are candidates
themselves, so a query always finds min(top, sample) rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rebuy.llm.pstable import buckets, by_dimension, matrix, projections, slots, usable
from rebuy.llm.shared import hashed_sample, stored

TOP = 20
TABLES = 2
HASHES = 4
WIDTH = 1.5
SHARE = 0.78            # of a query's neighbours that one table should find
SAMPLE_ROWS = 8192
SAMPLE_BYTES = 1 << 24  # the sample is smaller where vectors are very long
TILE_ROWS = 4096
RARE = 0.005            # slots less likely than this are not probed
SEED = 11

_PHI = np.vectorize(lambda z: 0.5 * math.erfc(-z / math.sqrt(2)), otypes=[float])


def probes(f: np.ndarray, b: np.ndarray, c: float, width: float, share: float) -> np.ndarray:
    """Slots (rows: buckets, most likely first) of one table until their
    estimated success adds up to ``share`` of what the kept slots hold."""
    spread = math.sqrt(max(1 - c * c, 1e-6))
    choices, odds = [], None
    for fj, bj in zip(f, b):
        lo = math.floor((c * fj - 4 * spread + bj) / width)
        s = np.arange(lo, math.floor((c * fj + 4 * spread + bj) / width) + 1)
        edges = _PHI((np.append(s, s[-1] + 1) * width - bj - c * fj) / spread)
        p = np.diff(edges)
        keep = p > RARE
        choices.append(s[keep])
        odds = p[keep] if odds is None else np.multiply.outer(odds, p[keep])
    flat = odds.ravel()
    order = np.argsort(-flat, kind="stable")
    n = int(np.searchsorted(np.cumsum(flat[order]), share)) + 1
    at = np.unravel_index(order[:n], odds.shape)
    return np.stack([s[i] for s, i in zip(choices, at)], axis=1)


def inner(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Row-wise inner products; equal rows give equal sums wherever they lie."""
    return (q * x).sum(axis=1)


def _best(q: np.ndarray, ids: np.ndarray, score: np.ndarray, top: int) -> np.ndarray:
    """Indices of the ``top`` best of each q: larger score, then smaller id."""
    order = np.lexsort((ids, -score, q))
    first = np.searchsorted(q[order], q[order])
    return order[np.arange(len(order)) - first < top]


def _one_dimension(rows: DataFrame, asks: DataFrame, dim: int, top: int, tables: int, hashes: int,
                   width: float, share: float, sample_rows: int, tile_rows: int) -> DataFrame:
    """(query_id, vec_id, score) candidates for vectors of one length."""
    norm2 = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    n, most2 = rows.agg(F.count(F.lit(1)), F.max(norm2)).first()
    big = math.sqrt(most2) * (1 + 1e-9)
    held = min(sample_rows, max(top + 1, SAMPLE_BYTES // (8 * dim)))
    drawn = hashed_sample(rows.select("vec_id", "embedding"), "vec_id", held, n, SEED).toArrow()
    near_ids = drawn.column("vec_id").to_numpy()
    near = matrix(drawn.column("embedding"), dim)
    expect = max(1, math.ceil(top * len(near) / n))   # sample rank that stands for rank ``top``
    g, b = projections(dim + 1, tables * hashes, width, SEED)
    kind = rows.schema["embedding"].dataType.simpleString()
    ctx = rows.sparkSession.sparkContext.broadcast((near_ids, near, g, b))

    def index(batches):
        _, _, g, b = ctx.value
        for batch in batches:
            x = matrix(batch.column("embedding"), dim)
            more = np.sqrt(np.maximum(big * big - (x * x).sum(axis=1), 0))
            keys = buckets(slots(np.column_stack((x, more)) / big, g, b, width), tables)
            m, t = keys.shape
            at = pa.array(np.repeat(np.arange(m), t))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.tile(np.arange(t, dtype=np.int32), m)), pa.array(keys.view(np.uint32).ravel().astype(np.int64)),
                 batch.column("vec_id").take(at), batch.column("embedding").take(at)],
                ["t", "bucket", "vec_id", "embedding"])

    def ask(batches):
        near_ids, near, g, b = ctx.value
        for batch in batches:
            q, ids = matrix(batch.column("embedding"), dim), batch.column("vec_id").to_numpy()
            size = np.sqrt((q * q).sum(axis=1))
            floor, keys, found, scores = [], [], [], []
            for i in range(len(q)):
                other = np.nonzero(near_ids != ids[i])[0]
                s = inner(q[i][None, :], near[other])
                o = _best(np.zeros(len(s), np.int64), near_ids[other], s, top)
                found.append(near_ids[other][o]), scores.append(s[o])
                floor.append(float(s[o][-1]) if len(o) == top else -math.inf)
                c = float(s[o][min(expect, len(o)) - 1]) / (size[i] * big) if len(o) else 0.0
                f = (np.append(q[i], 0.0) / size[i]) @ g
                k = []
                for t in range(tables):
                    h = slice(t * hashes, (t + 1) * hashes)
                    p = probes(f[h], b[h], min(max(c, 0.0), 0.999), width, share)
                    k.append((t << 32) | buckets(p, 1)[:, 0].view(np.uint32).astype(np.int64))
                keys.append(np.concatenate(k))
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("embedding"), pa.array(floor, pa.float64()),
                 pa.array(keys, pa.list_(pa.int64())), pa.array(found, pa.list_(pa.int64())),
                 pa.array(scores, pa.list_(pa.float64()))],
                ["query_id", "embedding", "floor", "keys", "found", "scores"])

    def rank(key, left, right):
        x, ids = matrix(left.column("embedding"), dim), left.column("vec_id").to_numpy()
        q, own = matrix(right.column("embedding"), dim), right.column("query_id").to_numpy()
        floor, out = right.column("floor").to_numpy(), []
        for a in range(0, len(q) if len(x) else 0, 256):
            i, j = np.nonzero(q[a:a + 256] @ x.T >= floor[a:a + 256, None] - 1e-9 * big * big)
            i += a
            fresh = own[i] != ids[j]
            i, j = i[fresh], j[fresh]
            s = np.concatenate([inner(q[i[p:p + 65536]], x[j[p:p + 65536]]) for p in range(0, len(i), 65536)] or [[]])
            o = _best(i, ids[j], s, top)
            out.append((i[o], ids[j[o]], s[o]))
        i, found, scores = ([np.concatenate(c) for c in zip(*out)] if out else
                            [np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)])
        asker, begin = np.unique(i, return_index=True)      # sorted by query: one row each
        cuts = pa.array(np.append(begin, len(i)).astype(np.int32))
        return pa.table({"query_id": pa.array(own[asker]),
                         "found": pa.ListArray.from_arrays(cuts, pa.array(found)),
                         "scores": pa.ListArray.from_arrays(cuts, pa.array(scores.astype(np.float64)))})

    indexed = rows.select("vec_id", "embedding").mapInArrow(index, f"t int, bucket long, vec_id long, embedding {kind}")
    asked = stored(asks.select("vec_id", "embedding").mapInArrow(
        ask, f"query_id long, embedding {kind}, floor double, keys array<long>, found array<long>, "
             "scores array<double>"), "ann-queries")
    key = F.explode("keys").alias("key")
    visits = (asked.select("query_id", "embedding", "floor", key)
              .select("query_id", "embedding", "floor", F.shiftright("key", 32).cast("int").alias("t"),
                      F.col("key").bitwiseAND(0xFFFFFFFF).alias("bucket")))

    def parts(df, name):
        return df.groupBy("t", "bucket").agg(F.ceil(F.count(F.lit(1)) / F.lit(tile_rows)).cast("int").alias(name))
    sizes = stored(parts(indexed.select("t", "bucket"), "xs").join(parts(visits, "qs"), ["t", "bucket"]), "ann-buckets")
    span = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    left = (indexed.join(sizes, ["t", "bucket"]).withColumn("xi", F.pmod(F.xxhash64("vec_id"), F.col("xs")).cast("int"))
            .withColumn("qi", span("qs")).drop("xs", "qs"))
    right = (visits.join(sizes, ["t", "bucket"]).withColumn("qi", F.pmod(F.xxhash64("query_id"), F.col("qs")).cast("int"))
             .withColumn("xi", span("xs")).drop("xs", "qs"))
    group = ["t", "bucket", "xi", "qi"]
    met = left.groupBy(*group).cogroup(right.groupBy(*group)).applyInArrow(
        rank, "query_id long, found array<long>, scores array<double>")
    return (met.unionByName(asked.select("query_id", "found", "scores"))
            .select("query_id", F.explode(F.arrays_zip("found", "scores")).alias("r"))
            .select("query_id", F.col("r.found").alias("vec_id"), F.col("r.scores").alias("score")))


def nearest(vectors: DataFrame, is_query, top: int = TOP, tables: int = TABLES, hashes: int = HASHES,
            width: float = WIDTH, share: float = SHARE, sample_rows: int = SAMPLE_ROWS,
            tile_rows: int = TILE_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: the ``top`` nearest rows found for every
    row where the column ``is_query`` holds, by inner product.

    vectors: vec_id, embedding (other columns are ignored).  Vectors that are
    null, zero or hold null or non-finite components, and rows without vec_id,
    take no part.  Vectors meet only those of their own length.  Rows with one
    vec_id are one another's own: never each other's neighbours; as candidates
    they count once, with their best score.  Ties go to the smaller vec_id.
    Empty tables return no rows."""
    v = vectors.select(F.col("vec_id").cast("long"), "embedding").filter(F.col("vec_id").isNotNull() & usable("embedding"))
    out = None
    for dim in by_dimension(v):
        rows = v.filter(F.size("embedding") == dim)
        found = _one_dimension(rows, rows.filter(is_query), dim, top, tables, hashes, width, share,
                               sample_rows, tile_rows)
        out = found if out is None else out.unionByName(found)
    if out is None:
        out = v.select(F.col("vec_id").alias("query_id"), "vec_id", F.lit(0.0).alias("score")).limit(0)
    best = out.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
            .select("query_id", "rank", "vec_id", "score"))
