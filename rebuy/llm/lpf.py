"""Suffix-array dedup: longest-previous-factor arrays over the bytes of texts.

A byte goes when a ``min_bytes``-long string that covers it also starts
earlier: in a text of smaller doc_id, or earlier in the same text.  Strings are
judged on the input.  ``passages`` narrows the corpus to segments that repeat;
shards of those are sorted into suffix order (prefix doubling), and the longest
previous factor of each window start comes from its previous and next smaller
place in that order.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rebuy.llm import passages as ps
from rebuy.llm.shared import slices
from rebuy.llm.suffix import dense, previous_factor, window_order

MIN_BYTES = 100
GRAM_BYTES = 24


def _units(min_bytes: int) -> ps.Units:
    return ps.Units(min_bytes, min(GRAM_BYTES, max(1, min_bytes // 4)), words=False)


def earlier_starts(texts: list[bytes], run: np.ndarray, place: np.ndarray, cap: int) -> np.ndarray:
    """For every window start (segment by segment): does its ``cap``-byte
    string have an earlier place among these segments?  ``place`` ranks the
    window starts in text order."""
    sizes = np.array([len(t) for t in texts])
    begin = np.cumsum(sizes) - sizes
    data = np.frombuffer(b"".join(texts) + bytes(8), np.uint8)
    n = len(data) - 8
    h = min(8, cap)
    first = np.zeros(n, np.uint64)
    for j in range(h):
        first = (first << np.uint64(8)) | data[j:j + n]
    which = np.repeat(np.arange(len(texts)), run)
    at = begin[which] + np.arange(len(which)) - np.repeat(np.cumsum(run) - run, run)
    order, lcp = window_order(dense(first), h, cap, at)
    return previous_factor(order, lcp, place) >= cap


def _compare(cap: int):
    def compare(t: pa.Table) -> pa.Table:
        run, s = t.column("run").to_numpy(), t.column("s").to_numpy()
        ids, thash = t.column("doc_id"), t.column("thash").to_numpy()
        which = np.repeat(np.arange(len(run)), run)
        start = np.repeat(s, run) + np.arange(len(which)) - np.repeat(np.cumsum(run) - run, run)
        null = np.asarray(ids.is_null())
        filled = ids.fill_null(0).to_numpy()
        order = np.lexsort((thash, filled, null))
        new = np.zeros(len(order), np.int64)
        for x in (null, filled, thash):
            new[1:] |= x[order[1:]] != x[order[:-1]]
        doc = np.empty(len(order), np.int64)
        doc[order] = np.cumsum(new)
        place = dense(doc[which] * (int(start.max()) + 1) + start)
        hit = earlier_starts(t.column("text").to_pylist(), run, place, cap)
        row, a, n = ps._merge(which[hit], start[hit], np.ones(int(hit.sum()), np.int64))
        return pa.table({"doc_id": ids.take(pa.array(row)), "thash": thash[row], "s": a, "run": n})
    return compare


def removed_starts(docs: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """Per text (doc_id, thash): array of (s, run), the starts of strings that
    also start earlier."""
    u = _units(min_bytes)
    marks = ps.marks_of(docs, u, keep_first=True)

    def cut(text, runs):
        return [text[s:s + run - 1 + min_bytes] for s, run in runs]

    segs = ps.segment_texts(docs, marks, cut)
    found = ps.shards(segs, _compare(min_bytes)).unionByName(
        ps.hot_windows(segs, lambda t, run: [t[o:o + min_bytes] for o in range(run)], keep_first=True))
    return ps.repeated_runs(marks, found)


def dedup(docs: DataFrame, min_bytes: int = MIN_BYTES, with_text: bool = False) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text; other columns are ignored):
    doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, on request, the kept
    bytes as ``kept``.

    Null text counts as empty; null doc_id comes after every other.  Rows with
    one doc_id and different texts are ordered by a hash of their text; of
    fully equal rows one is first, the others its later copies.  An empty
    table returns no rows."""
    def render(batches):
        for b in slices(batches):
            out = {k: [] for k in _RESULT.names}
            for d in b.to_pylist():
                data = d["text"].encode()
                x, y = ps.covered(d["runs"], min_bytes)
                keep = b"".join(data[p:q] for p, q in zip([0, *y.tolist()], [*x.tolist(), len(data)])) \
                    if len(x) else data
                row = (d["doc_id"], d["thash"], len(data), len(data) - len(keep), len(x),
                       hashlib.sha256(keep).hexdigest(), keep if with_text else None)
                for k, v in zip(_RESULT.names, row):
                    out[k].append(v)
            yield pa.RecordBatch.from_pydict(out, schema=_RESULT)

    rows = ps.on_text(docs, removed_starts(docs, min_bytes), "left").mapInArrow(
        render, "doc_id long, thash long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    empty = hashlib.sha256(b"").hexdigest()
    later = (F.col("copy") > 1) & (F.col("n_bytes") >= min_bytes)
    cols = ["doc_id", "thash", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    if with_text:
        cols.append("kept")
    out = (rows.groupBy(*cols).agg(F.count(F.lit(1)).alias("copies"))
           .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
           .withColumn("n_removed", F.when(later, F.col("n_bytes")).otherwise(F.col("n_removed")))
           .withColumn("n_spans", F.when(later, F.lit(1)).otherwise(F.col("n_spans")))
           .withColumn("kept_sha256", F.when(later, F.lit(empty)).otherwise(F.col("kept_sha256"))))
    if with_text:
        out = out.withColumn("kept", F.when(later, F.lit(b"")).otherwise(F.col("kept")))
    return out.drop("thash", "copies", "copy")


_RESULT = pa.schema([("doc_id", pa.int64()), ("thash", pa.int64()), ("n_bytes", pa.int64()),
                     ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()),
                     ("kept", pa.binary())])
