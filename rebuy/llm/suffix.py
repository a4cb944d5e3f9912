"""Suffix order of a block of texts, up to a bounded length, in numpy."""

from __future__ import annotations

import numpy as np


def dense(key: np.ndarray) -> np.ndarray:
    order = np.argsort(key)
    new = np.zeros(len(key), np.int64)
    sorted_key = key[order]
    new[1:] = sorted_key[1:] != sorted_key[:-1]
    rank = np.empty(len(key), np.int64)
    rank[order] = np.cumsum(new)
    return rank


def levels(first: np.ndarray, length: int, top: int) -> list[tuple[int, np.ndarray]]:
    """Prefix doubling: (h, rank of every position by its next h units), for
    h = length, 2 length, ... up to ``top``.  Positions whose h units run past
    their text have ranks of no meaning; readers stay inside."""
    out, h, rank, n = [(length, first)], length, first, len(first)
    while 2 * h <= top:
        nxt = np.zeros(n, np.int64)
        nxt[:n - h] = rank[h:] + 1
        rank, h = dense(rank * (n + 1) + nxt), 2 * h
        out.append((h, rank))
    return out


def common(lv: list[tuple[int, np.ndarray]], a: np.ndarray, b: np.ndarray, cap: int) -> np.ndarray:
    """Common prefix of the suffixes at a and b (each has ``cap`` units or
    more), in steps of the first level's length."""
    out = np.zeros(len(a), np.int64)
    for h, rank in reversed(lv):
        fits = out + h <= cap
        x, y = np.where(fits, a + out, a), np.where(fits, b + out, b)
        out += np.where(fits & (rank[x] == rank[y]), h, 0)
    return out


def window_order(first: np.ndarray, length: int, cap: int, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix order of the positions ``at`` by their next ``cap`` units, and
    the common prefix of each with the one before it (exact at ``cap``, below
    it in steps of ``length``).  ``first`` ranks positions by ``length`` units."""
    lv = levels(first, length, cap)
    h, rank = lv[-1]
    key = rank[at] * (len(first) + 1) + rank[at + (cap - h)]
    order = np.argsort(key)
    lcp = np.zeros(len(at), np.int64)
    a, b = order[:-1], order[1:]
    lcp[1:] = np.where(key[a] == key[b], cap, np.minimum(common(lv, at[a], at[b], cap), cap - 1))
    return order, lcp


def previous_factor(order: np.ndarray, lcp: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Longest previous factor of each entry of a suffix order.

    lcp[i]: common prefix of order[i - 1] and order[i]; place: text order of
    each suffix.  The best earlier match of a suffix is its previous or its
    next neighbour in suffix order with a smaller place; both are found by
    pointer jumping, carrying the smallest lcp passed on the way."""
    p = place[order]

    def nearest(p: np.ndarray, lcp: np.ndarray) -> np.ndarray:
        prev, low = np.arange(len(p)) - 1, lcp.copy()
        todo = np.nonzero(prev >= 0)[0]
        todo = todo[p[prev[todo]] >= p[todo]]
        while len(todo):
            q = prev[todo]
            low_q, prev_q = low[q], prev[q]
            low[todo], prev[todo] = np.minimum(low[todo], low_q), prev_q
            todo = todo[prev_q >= 0]
            todo = todo[p[prev[todo]] >= p[todo]]
        low[prev < 0] = 0
        return low

    left = nearest(p, lcp)
    back = np.concatenate(([0], lcp[1:][::-1])) if len(lcp) else lcp
    right = nearest(p[::-1], back)[::-1]
    out = np.empty(len(p), np.int64)
    out[order] = np.maximum(left, right)
    return out
