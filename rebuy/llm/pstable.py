"""Euclidean p-stable hashing: quantised Gaussian projections.

One hash is floor((g.x + b) / w) with Gaussian g and uniform b; two vectors at
distance c collide with the probability ``collision(c, w)``, which falls in c.
A table's bucket joins k hashes.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def collision(c: float, w: float) -> float:
    """Probability that one hash of width w joins two vectors at distance c."""
    if c <= 0:
        return 1.0
    r = w / c
    phi = 0.5 * math.erfc(r / math.sqrt(2))
    return 1 - 2 * phi - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


def projections(dim: int, hashes: int, width: float, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng([seed, dim])
    return rng.standard_normal((dim, hashes)), rng.random(hashes) * width


def slots(x: np.ndarray, g: np.ndarray, b: np.ndarray, width: float) -> np.ndarray:
    return np.floor((x @ g + b) / width).astype(np.int64)


def buckets(s: np.ndarray, tables: int) -> np.ndarray:
    """Slots (rows, tables * k) -> 32-bit bucket of every table."""
    rows, k = s.shape[0], s.shape[1] // tables
    h = np.zeros((rows, tables), np.uint64)
    parts = s.reshape(rows, tables, k).astype(np.uint64)
    for j in range(k):
        h = (h ^ parts[:, :, j]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return (h >> np.uint64(32)).astype(np.uint32).view(np.int32)


def usable(embedding: str) -> Column:
    """Neither null nor zero nor holding a null or non-finite component."""
    v = F.col(embedding)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return v.isNotNull() & finite & F.exists(v, lambda x: x != 0)


def matrix(column, dim: int) -> np.ndarray:
    """An Arrow list column of equal lengths as a float64 matrix."""
    flat = column.combine_chunks() if hasattr(column, "combine_chunks") else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def by_dimension(vectors: DataFrame, embedding: str = "embedding") -> list[int]:
    """The distinct lengths that usable vectors have."""
    return sorted(r[0] for r in vectors.select(F.size(embedding).alias("d")).distinct().collect())
