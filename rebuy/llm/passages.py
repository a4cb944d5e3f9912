"""Repeated passages: which windows of a text occur more than once.

A window is ``win`` consecutive units (bytes or words) of one text.  Every
window is owned by its smallest ``k``-unit hash (ties: leftmost), a choice that
depends on its content alone, so equal windows have equal owners at equal
offsets.  Neighbouring windows with the same owner form one run; a run and the
text it spans is a *segment*.  Only segments travel, one row each:

1. map side, per batch: equal segments of one batch fold into one row, so a
   passage shared by a third of all rows yields one row a batch, not one a copy;
2. one shuffle by owner hash finds equal segments, and owners whose segments
   differ somewhere (``need``): only there must texts be compared;
3. the texts of those segments are fetched and compared shard by shard by the
   caller (suffix order); owners with more than ``HOT`` rows are compared window
   by window with a grouped minimum or count instead, which Spark combines
   map side, so no group has to fit in a task.

Segment equality rests on two 64-bit hashes and the length together.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rebuy.llm.shared import slices, stored

BLOCK = 1 << 17          # bytes of text hashed at a time
FOLD_BYTES = 1 << 23     # text whose equal segments are folded before they travel
INDEX_BITS = 20
HOT = 4096               # rows of one owner above which windows are grouped instead
OCCURRENCE = ("kind byte, dup byte, owner long, seg long, doc_id long, thash long, s long, run long")


def _table(seed: int, n: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _powers(base: int) -> np.ndarray:
    out = np.ones(1 << INDEX_BITS, np.uint64)
    out[1:] = base
    return np.multiply.accumulate(out)


class Roller:
    """Hashes of stretches of a sequence, from prefix sums modulo 2^64."""

    base = 0x9E3779B97F4A7C15
    up: np.ndarray | None = None

    def __init__(self, values: np.ndarray):
        if Roller.up is None:
            Roller.up = _powers(Roller.base)
            Roller.down = _powers(pow(Roller.base, -1, 1 << 64))
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * Roller.up[:len(values)], out=self.sums[1:])

    def plain(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (self.sums[b] - self.sums[a]) * Roller.down[a]

    def stretch(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return _mix(self.plain(a, b))

    def grams(self, k: int) -> np.ndarray:
        n = len(self.sums) - k
        return _mix((self.sums[k:] - self.sums[:n]) * Roller.down[:n])


def _mix(h: np.ndarray) -> np.ndarray:
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    return h


BYTE_VALUES = _table(20240229, 256)
SPACE = np.isin(np.arange(256), [0x20, 9, 10, 11, 12, 13])


@dataclass(frozen=True)
class Units:
    """What a window is made of."""
    win: int
    k: int
    words: bool

    def values(self, data: np.ndarray) -> np.ndarray:
        if not self.words:
            return BYTE_VALUES[data]
        return word_hashes(data)

    def pieces(self, text: bytes) -> Iterator[tuple[int, bytes]]:
        """(position of the first unit, text): every window lies whole in one
        piece, and consecutive pieces share win - 1 units."""
        if len(text) <= 2 * BLOCK:
            yield 0, text
        elif not self.words:
            for p in range(0, len(text) - self.win + 1, BLOCK):
                yield p, text[p:p + BLOCK + self.win - 1]
        else:
            at, done, carry = 0, 0, b""
            for chunk in chunks(text):
                part = carry + chunk
                yield done, part
                words = part.split()
                carry = b" ".join(words[-(self.win - 1):]) + b" "
                done += max(0, len(words) - self.win + 1)


def chunks(text: bytes, size: int = BLOCK) -> Iterator[bytes]:
    """Cut at white space, about ``size`` bytes each."""
    at = 0
    while at < len(text):
        to = min(len(text), at + size)
        while to < len(text) and not SPACE[text[to]]:
            to += 1
        yield text[at:to]
        at = to


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~SPACE[data]
    step = np.diff(inside)
    return np.nonzero(step == 1)[0], np.nonzero(step == -1)[0]


def word_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of every word, over blocks of bytes: the sum of a word that goes on
    in later blocks is carried, so a word can have any length."""
    a, b = word_bounds(data)
    out = np.zeros(len(a), np.uint64)
    for p in range(0, len(data), BLOCK):
        block = data[p:p + BLOCK]
        i, j = np.searchsorted(b, p, "right"), np.searchsorted(a, p + len(block))     # words with bytes here
        if i < j:
            x, y = np.maximum(a[i:j], p), np.minimum(b[i:j], p + len(block))
            part = Roller(BYTE_VALUES[block]).plain(x - p, y - p)
            part[:1] *= np.uint64(pow(Roller.base, int(x[0] - a[i]), 1 << 64))        # the first may have begun before
            out[i:j] += part
    return _mix(out)


def _sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    n, have = len(x) - w + 1, 1
    while 2 * have <= w:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    return np.minimum(x[:n], x[w - have:w - have + n])


def segments(parts: list[tuple[int, int, bytes]], u: Units) -> tuple[np.ndarray, ...]:
    """parts: (row, first position, text).  -> row, s, run, owner hash, seg hash."""
    values = [u.values(np.frombuffer(t, np.uint8)) for _, _, t in parts]
    sizes = np.array([len(v) for v in values])
    all_values = np.concatenate(values)
    n = len(all_values)
    if n < u.win:
        return tuple(np.empty(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    roll = Roller(all_values)
    grams = roll.grams(u.k)
    low = np.uint64((1 << INDEX_BITS) - 1)
    key = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
    owner = (_sliding_min(key, u.win - u.k + 1) & low).astype(np.int64)
    begin = np.cumsum(sizes) - sizes
    valid = np.zeros(len(owner) + 1, bool)
    for b, size in zip(begin.tolist(), sizes.tolist()):
        valid[b:max(b, b + size - u.win + 1)] = True
    valid = valid[:-1]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | ~valid[:-1]
    last = np.ones(len(owner), bool)
    last[:-1] = new[1:] | ~valid[1:]
    s, e = np.nonzero(new & valid)[0], np.nonzero(last & valid)[0]
    part = np.searchsorted(begin, s, "right") - 1
    first, row = np.array([p[1] for p in parts]), np.array([p[0] for p in parts])
    return row[part], s - begin[part] + first[part], e - s + 1, grams[owner[s]], roll.stretch(s, e + u.win)


def _batch_rows(texts: list[bytes], u: Units) -> list[np.ndarray]:
    found, parts, size = [], [], 0
    for row, text in enumerate(texts):
        for first, piece in u.pieces(text):
            parts.append((row, first, piece))
            size += len(piece)
            if size >= BLOCK:
                found.append(segments(parts, u))
                parts, size = [], 0
    if parts:
        found.append(segments(parts, u))
    return [np.concatenate(x) for x in zip(*found)] if found else []


def _merge(row: np.ndarray, s: np.ndarray, run: np.ndarray) -> tuple[np.ndarray, ...]:
    """Join runs of window starts that touch (sorted by row and start)."""
    order = np.lexsort((s, row))
    row, s, run = row[order], s[order], run[order]
    head = np.ones(len(s), bool)
    head[1:] = (row[1:] != row[:-1]) | (s[1:] > s[:-1] + run[:-1])
    at = np.nonzero(head)[0]
    end = np.maximum.reduceat(s + run, at) if len(at) else s
    return row[at], s[at], end - s[at]


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text (null: empty) and a hash of it: rows with one doc_id are
    told apart, and ordered, by that hash."""
    return (docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
            .withColumn("thash", F.xxhash64("text")))


def occurrences(docs: DataFrame, u: Units, keep_first: bool) -> DataFrame:
    """One row per segment (kind 0), equal ones of a batch folded to the first;
    what the fold already proves repeated comes as runs of starts (kind 1)."""
    def run_batches(batches):
        for b in slices(batches, FOLD_BYTES):
            texts = [t.as_py() for t in b.column("text").cast(pa.large_binary())]
            got = _batch_rows(texts, u)
            if not got or not len(got[0]):
                continue
            row, s, run, owner, seg = got
            ids = b.column("doc_id")
            thash = b.column("thash").to_numpy()
            filled = ids.fill_null(np.iinfo(np.int64).max).to_numpy()
            rank = np.empty(len(texts), np.int64)
            rank[np.lexsort((thash, filled, ids.is_null().to_numpy(zero_copy_only=False)))] = np.arange(len(texts))
            order = np.lexsort((s, rank[row], seg, owner))
            row, s, run, owner, seg = (x[order] for x in (row, s, run, owner, seg))
            head = np.ones(len(s), bool)
            head[1:] = (owner[1:] != owner[:-1]) | (seg[1:] != seg[:-1]) | (run[1:] != run[:-1])
            group = np.cumsum(head) - 1
            if keep_first:      # equal rows of one doc_id are one text here
                h = np.nonzero(head)[0][group]
                head |= (filled[row] == filled[row[h]]) & (thash[row] == thash[row[h]]) & (s == s[h])
                gone, dup = ~head, np.zeros(len(s), bool)
            else:
                dup = np.bincount(group)[group] > 1
                gone = dup
            g_row, g_s, g_run = _merge(row[gone], s[gone], run[gone])
            n, m = int(head.sum()), len(g_row)
            at = np.concatenate((row[head], g_row))
            yield pa.RecordBatch.from_arrays([
                pa.array(np.repeat(np.array([0, 1], np.int8), [n, m])),
                pa.array(np.concatenate((dup[head].astype(np.int8), np.zeros(m, np.int8)))),
                pa.array(np.concatenate((owner[head].view(np.int64), thash[g_row]))),
                pa.array(np.concatenate((seg[head].view(np.int64) ^ run[head], np.zeros(m, np.int64)))),
                ids.take(pa.array(at)), pa.array(thash[at]),
                pa.array(np.concatenate((s[head], g_s))), pa.array(np.concatenate((run[head], g_run)))],
                ["kind", "dup", "owner", "seg", "doc_id", "thash", "s", "run"])
    return keyed(docs).mapInArrow(run_batches, OCCURRENCE)


def marked(occ: DataFrame, keep_first: bool) -> DataFrame:
    """Per text (doc_id, thash): its runs that are known repeated (``gone``)
    and its segments whose texts must be compared (``need``, ``hot``)."""
    same_owner = Window.partitionBy("owner")
    same_seg = Window.partitionBy("owner", "seg").orderBy(F.col("doc_id").asc_nulls_last(), "thash", "s")
    place = F.struct("doc_id", "thash", "s")
    # the window by owner comes first: its shuffle serves the one by segment too
    x = (occ.withColumn("differ", F.min("seg").over(same_owner) != F.max("seg").over(same_owner))
         .withColumn("rows", F.count(F.lit(1)).over(same_owner)))
    if keep_first:
        x = (x.withColumn("head", F.first(place).over(same_seg).eqNullSafe(place))
             .withColumn("gone", (F.col("kind") == 1) | ~F.col("head")))
    else:
        whole = same_seg.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        x = (x.withColumn("head", F.row_number().over(same_seg) == 1)
             .withColumn("gone", (F.col("kind") == 1) | (F.sum(F.lit(1) + F.col("dup")).over(whole) > 1)))
    x = (x.withColumn("need", (F.col("kind") == 0) & F.col("head") & F.col("differ"))
         .withColumn("hot", F.col("rows") > HOT))
    return (x.filter("gone or need").groupBy("doc_id", "thash")
            .agg(F.collect_list(F.struct("s", "run", "owner", "gone", "need", "hot")).alias("runs")))


def on_text(docs: DataFrame, by_text: DataFrame, how: str) -> DataFrame:
    """keyed(docs) joined with a table that has one row per (doc_id, thash)."""
    d = keyed(docs)
    t = by_text.withColumnRenamed("doc_id", "_id").withColumnRenamed("thash", "_hash")
    return d.join(t, d.doc_id.eqNullSafe(t["_id"]) & (d.thash == t["_hash"]), how).drop("_id", "_hash")


def segment_texts(docs: DataFrame, marks: DataFrame, cut: Callable[[bytes, list], list[bytes]]) -> DataFrame:
    """The text of every segment that must be compared."""
    def fetch(batches):
        for b in slices(batches):
            out = {k: [] for k in ("owner", "hot", "gone", "doc_id", "thash", "s", "run", "text")}
            for d in b.to_pylist():
                runs = d["runs"]
                for r, t in zip(runs, cut(d["text"].encode(), [(r["s"], r["run"]) for r in runs])):
                    for k in ("owner", "hot", "gone", "s", "run"):
                        out[k].append(r[k])
                    out["doc_id"].append(d["doc_id"]), out["thash"].append(d["thash"]), out["text"].append(t)
            yield pa.RecordBatch.from_pydict(out, schema=_SEGMENT)
    need = (marks.withColumn("runs", F.filter("runs", lambda r: r["need"])).filter("size(runs) > 0"))
    return on_text(docs, need, "inner").mapInArrow(
        fetch, "owner long, hot boolean, gone boolean, doc_id long, thash long, s long, run long, text binary")


_SEGMENT = pa.schema([("owner", pa.int64()), ("hot", pa.bool_()), ("gone", pa.bool_()), ("doc_id", pa.int64()),
                      ("thash", pa.int64()), ("s", pa.int64()), ("run", pa.int64()), ("text", pa.binary())])
SHARD_BYTES = 1 << 19


def shards(segs: DataFrame, compare: Callable[[pa.Table], pa.Table]) -> DataFrame:
    """Run ``compare`` over blocks of whole owners, about SHARD_BYTES each."""
    schema = "doc_id long, thash long, s long, run long"

    def blocks(batches):
        held: list[pa.RecordBatch] = []
        size, waiting = 0, None
        for b in slices(batches, SHARD_BYTES // 2):
            size += b.nbytes
            held.append(b)
            if size < SHARD_BYTES:
                continue
            t = pa.Table.from_batches(held)
            owner = t.column("owner").to_numpy()
            cut = int(np.searchsorted(owner, owner[-1]))      # the last owner may go on
            if cut:
                yield from compare(t.slice(0, cut)).to_batches()
            held = t.slice(cut).combine_chunks().to_batches()
            size = sum(x.nbytes for x in held)
        if held:
            yield from compare(pa.Table.from_batches(held)).to_batches()
    return (segs.filter("not hot").repartition("owner").sortWithinPartitions("owner")
            .mapInArrow(blocks, schema))


def hot_windows(segs: DataFrame, windows: Callable[[bytes, int], list[bytes]], keep_first: bool) -> DataFrame:
    """Owners with very many segments: one row per window, grouped by a
    128-bit hash of it; the first of each stays when ``keep_first``."""
    import hashlib

    def spread(batches):
        for b in slices(batches, SHARD_BYTES // 8):
            out = {k: [] for k in ("key", "doc_id", "thash", "s")}
            for d in b.to_pylist():
                for o, w in enumerate(windows(d["text"], d["run"])):
                    out["key"].append(hashlib.blake2b(w, digest_size=16).digest())
                    out["doc_id"].append(d["doc_id"]), out["thash"].append(d["thash"]), out["s"].append(d["s"] + o)
            yield pa.RecordBatch.from_pydict(out, schema=_WINDOW)
    rows = (segs.filter("hot").select("text", "run", "doc_id", "thash", "s")
            .mapInArrow(spread, "key binary, doc_id long, thash long, s long"))
    place = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "thash", "s")
    seen = rows.groupBy("key").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    hit = rows.join(seen, "key")
    if keep_first:
        hit = hit.filter(~F.col("first").eqNullSafe(place))
    return hit.select("doc_id", "thash", "s", F.lit(1).cast("long").alias("run"))


_WINDOW = pa.schema([("key", pa.binary()), ("doc_id", pa.int64()), ("thash", pa.int64()), ("s", pa.int64())])


def repeated_runs(marks: DataFrame, found: DataFrame) -> DataFrame:
    """All repeated window starts of each text, one row per (doc_id, thash)."""
    known = (marks.withColumn("runs", F.filter("runs", lambda r: r["gone"])).filter("size(runs) > 0")
             .select("doc_id", "thash", F.transform("runs", lambda r: F.struct(r["s"], r["run"])).alias("runs")))
    more = found.groupBy("doc_id", "thash").agg(F.collect_list(F.struct("s", "run")).alias("runs"))
    return (known.unionByName(more).groupBy("doc_id", "thash")
            .agg(F.flatten(F.collect_list("runs")).alias("runs")))


def covered(runs: list[dict] | None, win: int) -> tuple[np.ndarray, np.ndarray]:
    """Disjoint covered stretches [a, b) of units, from runs of window starts."""
    if not runs:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    s = np.array([r["s"] for r in runs])
    e = s + np.array([r["run"] for r in runs]) - 1 + win
    order = np.argsort(s, kind="stable")
    s, e = s[order], np.maximum.accumulate(e[order])
    head = np.ones(len(s), bool)
    head[1:] = s[1:] > e[:-1]
    at = np.nonzero(head)[0]
    return s[at], e[np.concatenate((at[1:] - 1, [len(s) - 1]))]


def marks_of(docs: DataFrame, u: Units, keep_first: bool) -> DataFrame:
    return stored(marked(occurrences(docs, u, keep_first), keep_first), "repeat-marks")
