"""Many logistic regressions by shared passes.

A fit needs only sums over rows: the gradient, the Hessian and the loss at the
current coefficients, a matrix of features x features.  All fits of a search
(folds, feature sets, penalties, strengths) are advanced together, so a Newton
step of the whole search is one job over the rows; on the small matrices the
driver takes a proximal Newton step each (coordinate descent for L1, a linear
solve for L2).  The number of passes does not depend on the number of fits.

Features are standardised by each fit's own training rows, with population
standard deviations: their sums are taken once per fold, and a fit that holds
out a fold uses the total minus that fold.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rebuy.session import on_python_workers

MAX_STEPS = 100
TOLERANCE = 1e-7
BLOCK_ROWS = 1 << 16


@dataclass(frozen=True)
class Fit:
    """One regression: sum of log losses + (1 / C) times |w| (l1) or |w|^2 / 2
    over the standardised columns, the intercept free.  Rows of fold
    ``held_out`` teach nothing."""

    columns: tuple[str, ...]
    C: float = 1.0
    l1: bool = False
    held_out: int | None = None


@dataclass
class Fitted:
    """Coefficients by standardised column, and in the columns' own units."""

    fit: Fit
    weights: np.ndarray
    bias: float
    mean: np.ndarray
    std: np.ndarray

    def raw(self) -> tuple[np.ndarray, float]:
        w = self.weights / self.std
        return w, self.bias - float(w @ self.mean)


def _blocks(df: DataFrame, columns: list[str], label: str, fold: str | None):
    df = df.select(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(columns)],
                   F.col(label).cast("double").alias("y"), (F.col(fold).cast("int") if fold else F.lit(-1)).alias("fold"))
    n = len(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for a in range(0, b.num_rows, BLOCK_ROWS):
                s = b.slice(a, BLOCK_ROWS)
                x = np.stack([s.column(i).to_numpy(zero_copy_only=False) for i in range(n)], axis=1) if n else np.zeros((s.num_rows, 0))
                cols = (x, s.column("y").to_numpy(zero_copy_only=False), s.column("fold").to_numpy().astype(np.int64))
                yield pa.RecordBatch.from_arrays([pa.array([np.ascontiguousarray(c).tobytes()], pa.binary()) for c in cols], ["x", "y", "fold"])

    def arrays(r):
        y = np.frombuffer(r["y"])
        return np.frombuffer(r["x"]).reshape(len(y), n), y, np.frombuffer(r["fold"], np.int64)
    return df.mapInArrow(run, "x binary, y binary, fold binary").rdd.map(arrays)


def _added(rdd, make) -> dict:
    """Sum of make(block) -> {key: array} over all blocks."""
    def part(blocks):
        out: dict = {}
        for b in blocks:
            for k, v in make(b).items():
                out[k] = out[k] + v if k in out else v
        yield out

    def both(a, b):
        for k, v in b.items():
            a[k] = a[k] + v if k in a else v
        return a
    return rdd.mapPartitions(part).treeAggregate({}, both, both, depth=2)


def soft(x: float, t: float) -> float:
    return np.sign(x) * max(abs(x) - t, 0.0)


def proximal_step(w: np.ndarray, grad: np.ndarray, hess: np.ndarray, strength: float, l1: bool) -> np.ndarray:
    """The minimiser of the quadratic model at ``w`` (the last place is the
    intercept, which is free) plus the penalty."""
    n = len(w)
    if not l1:
        free = np.eye(n)
        free[-1, -1] = 0
        return w - np.linalg.solve(hess + strength * free + 1e-12 * np.eye(n), grad + strength * (free @ w))
    z, slope = w.copy(), grad.copy()            # slope: of the quadratic model at z
    diagonal = np.maximum(np.diag(hess), 1e-12)
    for _ in range(200):
        for _ in range(3):
            for j in range(n):
                new = z[j] - slope[j] / diagonal[j]
                if j < n - 1:
                    new = soft(new, strength / diagonal[j])
                if new != z[j]:
                    slope += (new - z[j]) * hess[:, j]
                    z[j] = new
        # where the signs are right already, the rest is a linear system
        sign = np.sign(z)
        sign[-1] = 0
        use = (z != 0) | (np.arange(n) == n - 1)
        exact = np.zeros(n)
        held = hess[np.ix_(use, use)]
        right = hess[use] @ w - grad[use] - strength * sign[use]
        exact[use] = np.linalg.lstsq(held, right, rcond=None)[0]
        at = grad + hess @ (exact - w)
        if (np.sign(exact[:-1]) == sign[:-1]).all() and (np.abs(at[:-1][~use[:-1]]) <= strength * (1 + 1e-9)).all():
            return exact
    return z


def fit_all(df: DataFrame, fits: list[Fit], label: str, fold: str | None = "fold") -> tuple[list[Fitted], int]:
    """Fit all of ``fits`` on ``df`` (no nulls in the columns): (fitted, passes
    over the rows)."""
    on_python_workers(df.sparkSession)
    columns = sorted({c for f in fits for c in f.columns})
    at = [np.array([columns.index(c) for c in f.columns], int) for f in fits]
    rows = _blocks(df, columns, label, fold).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        def moments(b):
            x, _, f = b
            return {int(k): np.concatenate(([np.sum(f == k)], x[f == k].sum(axis=0), (x[f == k] ** 2).sum(axis=0)))
                    for k in np.unique(f)}
        by_fold = _added(rows, moments)
        total = sum(by_fold.values()) if by_fold else np.zeros(1 + 2 * len(columns))
        scales = []
        for f, own in zip(fits, at):
            s = total - by_fold.get(f.held_out, 0) if f.held_out is not None else total
            n, m = max(s[0], 1.0), s[1:1 + len(columns)][own] / max(s[0], 1.0)
            var = np.maximum(s[1 + len(columns):][own] / n - m ** 2, 0)
            std = np.sqrt(np.where(var > 1e-12 * (m ** 2 + 1e-300), var, 0))
            scales.append((m, np.where(std > 0, std, 1.0)))

        w = [np.zeros(len(own) + 1) for own in at]
        best = [(np.inf, None)] * len(fits)         # objective and coefficients a step started from
        target: list[np.ndarray | None] = [None] * len(fits)
        open_, passes = set(range(len(fits))), 1
        while open_ and passes < MAX_STEPS:
            now = {i: w[i] for i in open_}

            def sums(b):
                x, y, f = b
                out = {}
                for i, wi in now.items():
                    use = np.ones(len(y), bool) if fits[i].held_out is None else f != fits[i].held_out
                    m, s = scales[i]
                    z = np.column_stack(((x[use][:, at[i]] - m) / s, np.ones(int(use.sum()))))
                    margin, own = z @ wi, y[use]
                    p = 1 / (1 + np.exp(-np.clip(margin, -500, 500)))
                    hess = (z * (p * (1 - p))[:, None]).T @ z
                    loss = np.logaddexp(0, margin).sum() - own @ margin
                    out[i] = np.concatenate(([loss], z.T @ (p - own), hess.ravel()))
                return out
            found = _added(rows, sums)
            passes += 1
            for i in sorted(open_):
                if i not in found:
                    open_.discard(i)
                    continue
                strength, v, n = 1.0 / fits[i].C, w[i], len(w[i])
                penalty = strength * (np.abs(v[:-1]).sum() if fits[i].l1 else (v[:-1] @ v[:-1]) / 2)
                value = found[i][0] + penalty
                before, origin = best[i]
                if value > before + 1e-9 * max(1.0, abs(before)):       # too far: half the way
                    w[i] = origin + (v - origin) / 2
                    if np.abs(w[i] - origin).max() < TOLERANCE:
                        w[i] = origin
                        open_.discard(i)
                    continue
                best[i] = (value, v)
                target[i] = proximal_step(v, found[i][1:1 + n], found[i][1 + n:].reshape(n, n), strength, fits[i].l1)
                if np.abs(target[i] - v).max() < TOLERANCE * max(1.0, np.abs(v).max()):
                    open_.discard(i)
                w[i] = target[i]
        return [Fitted(f, wi[:-1], float(wi[-1]), *s) for f, wi, s in zip(fits, w, scales)], passes
    finally:
        rows.unpersist()


def probabilities(df: DataFrame, fitted: list[Fitted], keep: list[str], own_fold_only: bool = False, fold: str = "fold") -> DataFrame:
    """``keep`` columns, ``model`` (a place in ``fitted``) and probability_1: a row
    per row and fit, from one pass; with ``own_fold_only`` only of fits that hold
    the row's fold out."""
    rows = []
    for i, m in enumerate(fitted):
        w, bias = m.raw()
        z = F.lit(bias)
        for c, v in zip(m.fit.columns, w.tolist()):
            if v:
                z = z + F.col(c).cast("double") * F.lit(v)
        p = F.struct(F.lit(i).alias("model"), (1 / (1 + F.exp(-z))).alias("probability_1"))
        rows.append(F.when(F.col(fold) == F.lit(m.fit.held_out), p) if own_fold_only else p)
    each = F.explode(F.filter(F.array(*rows), lambda s: s.isNotNull()))
    return df.select(*keep, each.alias("_scored")).select(*keep, "_scored.model", "_scored.probability_1")
