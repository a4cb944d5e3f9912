"""SimHash near-dedup: fingerprints, a vantage-point forest, components.

A fingerprint has 64 bits; two link when at most ``max_bits`` of them differ.
One vantage-point tree over all 64 bits prunes almost nothing for unrelated
fingerprints: their distances to any vantage point are 32 +- 4, so a ball of
radius 4 straddles nearly every median.  The bits are therefore dealt into
``trees`` blocks with a vantage-point tree each.  Two fingerprints within
``max_bits`` are within radius floor(max_bits / trees) on at least one block,
and on a block that small the triangle bound does prune: a fingerprint goes to
both sides of a vantage radius only when it lies in the overlap band.  Shards
(leaves) hold their boundary overlap, so every linked pair meets in some shard,
where all 64 bits are compared exactly.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rebuy.llm.components import components
from rebuy.llm.shared import free_name, hashed_sample, slices, stored, tiled

SHINGLE_WORDS = 4
MAX_BITS = 4
TREES = 3
SAMPLE = 32768          # fingerprints that place vantage points (never all)
SHARD_ROWS = 2048       # aimed shard size; larger shards are tiled
HASH_SEED = 42
PIECE_BYTES = 1 << 22   # a long text is hashed piece by piece


def _pieces(data: bytes, n: int):
    """Lists of the words of ``data``, each begun with the n - 1 words before."""
    carry: list[bytes] = []
    at = 0
    while at < len(data):
        to = at + PIECE_BYTES
        while to < len(data) and data[to] not in b" \t\n\r\x0b\x0c":
            to += 1
        words = carry + data[at:to].split()
        yield words
        carry = words[-(n - 1):] if n > 1 else []
        at = to


def fingerprint(data: bytes, n: int = SHINGLE_WORDS) -> int:
    """Unsigned SimHash of a UTF-8 text; 0 when it has no word."""
    ones, total, first = np.zeros(64, np.int64), 0, None
    for words in _pieces(data.lower(), n):
        if len(words) < n:
            first = first if total else words
            continue
        text = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        begins = np.concatenate(([0], ends[:-1] + 1))
        digest = xxhash.xxh64_digest
        h = b"".join([digest(text[a:b], HASH_SEED) for a, b in
                      zip(begins[:len(words) - n + 1].tolist(), ends[n - 1:].tolist())])
        bits = np.unpackbits(np.frombuffer(h, np.uint8).reshape(-1, 8), axis=1)
        ones += np.add.reduceat(bits, np.arange(0, len(bits), 255), axis=0,
                                dtype=np.uint8).sum(axis=0, dtype=np.int64)
        total += len(bits)
    if not total:
        if not first:
            return 0
        return xxhash.xxh64_intdigest(b" ".join(first), HASH_SEED)
    return int.from_bytes(np.packbits(2 * ones > total).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, text) -> (doc_id long, fp long, carried longs): fp holds the
    64 bits."""
    def run(batches):
        for b in slices(batches):
            texts = b.column("text").cast(pa.large_binary())
            fps = [fingerprint(t.as_py() or b"", shingle_words) if t.is_valid else 0 for t in texts]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(np.array(fps, np.uint64).view(np.int64)), *map(b.column, carry)],
                ["doc_id", "fp", *carry])
    return (docs.select(F.col("doc_id").cast("long"), "text", *carry)
            .mapInArrow(run, "doc_id long, fp long" + "".join(f", {c} long" for c in carry)))


def _blocks(trees: int) -> list[int]:
    cuts = [64 * t // trees for t in range(trees + 1)]
    return [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(cuts, cuts[1:])]


def plant(sample: np.ndarray, mask: int, rows: int, shard_rows: int, seed: int) -> dict[str, np.ndarray]:
    """A vantage-point tree over one block: arrays vantage, radius, left,
    right (children; a negative child -c-1 is shard c)."""
    rng = np.random.default_rng(seed)
    vantage, radius, left, right = [], [], [], []
    shards = 0

    def node(points: np.ndarray) -> int:
        nonlocal shards
        d = np.empty(0)
        if len(points) >= 32 and len(points) / len(sample) * rows > shard_rows:
            v = points[rng.integers(len(points))]
            d = np.bitwise_count((points ^ v) & np.uint64(mask))
            mu = int(np.median(d))
            mu -= int(d.max() <= mu)
        if not len(d) or d.min() > mu:
            shards += 1
            return -shards
        k = len(vantage)
        vantage.append(v), radius.append(mu), left.append(0), right.append(0)
        left[k], right[k] = node(points[d <= mu]), node(points[d > mu])
        return k
    root = node(sample)
    return {"vantage": np.array(vantage, np.uint64), "radius": np.array(radius, np.int64),
            "left": np.array(left, np.int64), "right": np.array(right, np.int64), "root": np.array([root])}


def route(fps: np.ndarray, tree: dict[str, np.ndarray], mask: int, slack: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, shard) of every shard a fingerprint belongs to.  With slack
    r = a + b it goes inside when d <= mu + a and outside when d > mu - b, so
    two fingerprints within r on the block share a branch at every node."""
    a, b = slack // 2, slack - slack // 2
    row, at = np.arange(len(fps)), np.full(len(fps), tree["root"][0])
    done_row, done_at = [], []
    while len(row):
        end = at < 0
        done_row.append(row[end]), done_at.append(-at[end] - 1)
        row, at = row[~end], at[~end]
        if not len(row):
            break
        d = np.bitwise_count((fps[row] ^ tree["vantage"][at]) & np.uint64(mask)).astype(np.int64)
        inside, outside = d <= tree["radius"][at] + a, d > tree["radius"][at] - b
        row, at = (np.concatenate((row[inside], row[outside])),
                   np.concatenate((tree["left"][at[inside]], tree["right"][at[outside]])))
    return np.concatenate(done_row), np.concatenate(done_at)


def star_links(fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that hold together exactly what the pairs within ``max_bits``
    hold together: each group as a star.  The frontier is compared only with
    what no group has reached yet, so a dense group costs far less than its
    square and never yields its pairs."""
    rest = np.unique(fps)
    a, b = [], []
    while len(rest) > 1:
        root, front, rest = rest[0], rest[:1], rest[1:]
        while len(front) and len(rest):
            hit = np.zeros(len(rest), bool)
            for f in front:
                left = ~hit
                hit[left] = np.bitwise_count(rest[left] ^ f) <= max_bits
                if hit.all():
                    break
            front, rest = rest[hit], rest[~hit]
            a.append(front), b.append(np.full(len(front), root))
    none = np.empty(0, np.uint64)
    return (np.concatenate(a), np.concatenate(b)) if a else (none, none)


def fingerprint_links(fps: DataFrame, max_bits: int = MAX_BITS, trees: int = TREES,
                      sample: int = SAMPLE, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Distinct fingerprints (fp) -> links (a, b) with the same components
    as all pairs of at most ``max_bits`` differing bits."""
    rows = fps.count()
    drawn = np.array([r[0] for r in hashed_sample(fps.select("fp"), "fp", sample, rows, HASH_SEED).collect()],
                     np.int64).view(np.uint64)
    masks, slack = _blocks(trees), max_bits // trees
    forest = [plant(drawn, m, rows, shard_rows, t) for t, m in enumerate(masks)] if rows else []

    def deal(batches):
        for batch in batches:
            f = batch.column("fp").to_numpy().view(np.uint64)
            for t, tree in enumerate(forest):
                row, shard = route(f, tree, masks[t], slack)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(row), t, np.int32)), pa.array(shard.astype(np.int32)),
                     pa.array(f[row].view(np.int64))], ["tree", "shard", "fp"])

    def link(key, tab):
        a, b = star_links(np.asarray(tab.column("fp")).view(np.uint64), max_bits)
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    dealt = fps.select("fp").mapInArrow(deal, "tree int, shard int, fp long")
    return (tiled(dealt, ["tree", "shard"], "fp", 4 * shard_rows)
            .groupBy("tree", "shard", "i", "j").applyInArrow(link, "a long, b long"))


def _classes(heads: DataFrame, max_bits: int, trees: int, sample: int, shard_rows: int) -> DataFrame:
    """(fp, head) of distinct fingerprints -> (fp, first): the least head of
    the fingerprint's component."""
    roots = components(fingerprint_links(heads, max_bits, trees, sample, shard_rows))
    grouped = (heads.join(roots, heads.fp == roots.node, "left")
               .select("fp", "head", F.coalesce("root", "fp").alias("root")))
    least = grouped.groupBy("root").agg(F.min("head").alias("first"))
    return grouped.join(least, "root").select("fp", "first")


def near_duplicates(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
                    trees: int = TREES, sample: int = SAMPLE, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text; other columns are ignored):
    doc_id, fingerprint (16 hex digits), component_id.

    Null, empty and word-less texts have fingerprint zero and link like any
    other.  Repeated rows each return a row.  A component whose doc_ids are
    all null has component_id null.  An empty table returns no rows.
    """
    printed = stored(fingerprints(docs, shingle_words), "fingerprints")
    heads = stored(printed.groupBy("fp").agg(F.min("doc_id").alias("head")), "distinct-fingerprints")
    class_of = _classes(heads, max_bits, trees, sample, shard_rows)
    return (printed.join(class_of, "fp")
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                    F.col("first").alias("component_id")))


def keep_first(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
               trees: int = TREES, sample: int = SAMPLE, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row of every component of near duplicates, with all columns of
    ``docs``: the one of smallest doc_id (null last), then smallest row hash;
    of fully equal rows, one."""
    cols = docs.columns
    row = F.xxhash64(*cols)
    place = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "row")
    printed = stored(fingerprints(docs.select("doc_id", "text", row.alias("row")), shingle_words, ("row",)), "fingerprints")
    heads = stored(printed.groupBy("fp").agg(F.min(place).alias("head")), "distinct-fingerprints")
    own, first, doc = (free_name(cols, c) for c in ("_row", "_first", "_doc"))
    firsts = (_classes(heads, max_bits, trees, sample, shard_rows)
              .select(F.col("first.doc_id").alias(doc), F.col("first.row").alias(first)).distinct())
    kept = docs.withColumn(own, row)
    return (kept.join(firsts, (F.col(own) == F.col(first)) & F.col("doc_id").cast("long").eqNullSafe(F.col(doc)), "left_semi")
            .dropDuplicates([own, "doc_id"]).select(*cols))
