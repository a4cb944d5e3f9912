"""Substring dedup: relative Lempel-Ziv parsing over the words of texts.

A word goes when a window of ``win`` consecutive words that covers it occurs
anywhere else, in another text or elsewhere in its own; every copy goes.
``passages`` narrows the corpus to segments that repeat.  Each shard of those
is a reference block, indexed by its suffix order; every segment is parsed
greedily into the longest factors that other segments of the block hold.
Factors of ``win`` words or more are duplicate spans; a greedy cut may fall
inside a repeated window, so the windows across each factor boundary are looked
up in the index too.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from rebuy.llm import passages as ps
from rebuy.llm.shared import slices
from rebuy.llm.suffix import dense, window_order

WIN_WORDS = 35
GRAM_WORDS = 8


def _units(win: int) -> ps.Units:
    return ps.Units(win, min(GRAM_WORDS, max(1, win // 4)), words=True)


def longest_elsewhere(ids: np.ndarray, at: np.ndarray, seg: np.ndarray, win: int) -> np.ndarray:
    """Longest match (at most ``win`` units) of the windows that begin at
    ``at`` with a window of another segment of the block.  In suffix order it
    is one of the two nearest entries of another segment."""
    order, lcp = window_order(dense(ids), 1, win, at)
    seg, n = seg[order], len(order)

    def nearest(seg: np.ndarray, lcp: np.ndarray) -> np.ndarray:
        # inside a stretch of one segment the bound to the stretch's own
        # predecessor is the smallest lcp since the stretch began
        out = lcp.copy()
        same = np.zeros(n, bool)
        same[1:] = seg[1:] == seg[:-1]
        for i in np.nonzero(same)[0].tolist():
            out[i] = min(out[i], out[i - 1])
        return out

    back = np.concatenate(([0], lcp[1:][::-1]))
    best = np.maximum(nearest(seg, lcp), nearest(seg[::-1], back)[::-1])
    out = np.empty(n, np.int64)
    out[order] = best
    return out


def parse(length: list[int], win: int) -> list[int]:
    """Greedy factors over ``length`` (longest match at each position): starts
    of the windows that are repeated."""
    out, p, run = [], 0, len(length)
    while p < run:
        f = max(1, length[p])
        if f >= win:
            out.append(p)
            p += 1          # the factor goes on: its next window follows
            continue
        # windows that begin inside this factor cross its end
        out.extend(i for i in range(p + 1, min(p + f, run)) if length[i] >= win)
        p += f
    return out


def _compare(win: int):
    def compare(t: pa.Table) -> pa.Table:
        run, s = t.column("run").to_numpy(), t.column("s").to_numpy()
        names: dict[bytes, int] = {}
        words = [[names.setdefault(w, len(names)) for w in x.split()] for x in t.column("text").to_pylist()]
        sizes = np.array([len(w) for w in words])
        begin = np.cumsum(sizes) - sizes
        ids = np.fromiter((i for w in words for i in w), np.int64, int(sizes.sum()))
        which = np.repeat(np.arange(len(words)), run)
        head = np.cumsum(run) - run
        at = begin[which] + np.arange(len(which)) - head[which]
        length = longest_elsewhere(ids, at, which, win)
        gone = np.asarray(t.column("gone"))
        row, start = [], []
        for j in np.nonzero(~gone)[0]:
            found = parse(length[head[j]:head[j] + run[j]].tolist(), win)
            row += [j] * len(found)
            start += found
        row = np.array(row, np.int64)
        row, a, n = ps._merge(row, s[row] + np.array(start, np.int64), np.ones(len(row), np.int64))
        return pa.table({"doc_id": t.column("doc_id").take(pa.array(row)),
                         "thash": t.column("thash").to_numpy()[row], "s": a, "run": n})
    return compare


def repeated_starts(docs: DataFrame, win: int = WIN_WORDS) -> DataFrame:
    """Per text (doc_id, thash): array of (s, run), the first words of windows
    that occur more than once."""
    u = _units(win)
    marks = ps.marks_of(docs, u, keep_first=False)

    def cut(text, runs):
        a, b = ps.word_bounds(np.frombuffer(text, np.uint8))
        return [text[a[s]:b[s + run + win - 2]] for s, run in runs]

    def windows(text, run):
        w = text.split()
        return [b" ".join(w[o:o + win]) for o in range(run)]

    segs = ps.segment_texts(docs, marks, cut)
    found = ps.shards(segs, _compare(win)).unionByName(ps.hot_windows(segs, windows, keep_first=False))
    return ps.repeated_runs(marks, found)


def dedup(docs: DataFrame, win: int = WIN_WORDS, with_text: bool = False) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text; other columns are ignored):
    doc_id, n_words, n_removed, kept_sha256 and, on request, the kept words
    joined by one space as ``kept``.

    Null text has no words.  Equal rows are copies of each other.  Null doc_ids
    are an ordinary value.  An empty table returns no rows."""
    def render(batches):
        for b in slices(batches):
            out = {k: [] for k in _RESULT.names}
            for d in b.to_pylist():
                x, y = ps.covered(d["runs"], win)
                sha, n, kept = hashlib.sha256(), 0, []
                removed, any_kept = 0, False
                for chunk in ps.chunks(d["text"].encode(), 1 << 22):
                    words = chunk.split()
                    m = len(words)
                    if len(x):
                        keep = np.ones(m, bool)
                        for p, q in zip(x[(y > n) & (x < n + m)], y[(y > n) & (x < n + m)]):
                            keep[max(0, p - n):q - n] = False
                        removed += m - int(keep.sum())
                        words = [w for w, k in zip(words, keep.tolist()) if k]
                    n += m
                    if words:
                        part = (b" " if any_kept else b"") + b" ".join(words)
                        sha.update(part)
                        any_kept = True
                        if with_text:
                            kept.append(part)
                row = (d["doc_id"], n, removed, sha.hexdigest(), b"".join(kept).decode() if with_text else None)
                for k, v in zip(_RESULT.names, row):
                    out[k].append(v)
            yield pa.RecordBatch.from_pydict(out, schema=_RESULT)

    out = ps.on_text(docs, repeated_starts(docs, win), "left").mapInArrow(
        render, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string")
    return out if with_text else out.drop("kept")


_RESULT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
                     ("kept_sha256", pa.string()), ("kept", pa.string())])
