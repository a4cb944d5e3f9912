"""Mixing sources to target weights.

Each source's words, in document order, are packed into blocks of
``BLOCK_WORDS``, shorter ones where a source has fewer than ``LEAST_BLOCKS`` of
those (its words then still come near their target).  The output is a line of slots, ``SHARD_SLOTS`` to an output
shard, each filled with one block: a multinomial draw, seeded by the shard's
number, says how many slots of a shard each source gets.  A source's slots are
numbered across shards; slot q takes the block at place q of a pseudorandom
permutation of the source's blocks (a Feistel network with cycle walking),
modulo their number, so a block is used again only after all others were.
Drawn slots are joined with the blocks by index.

The draws miss a source's quota by chance; slots beyond it are handed to the
sources that fell short, so quotas hold exactly and none exceeds 3 times its
blocks.  Nothing but a row per source (at most ``MAX_SOURCES``) reaches the
driver.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rebuy.llm.passages import word_bounds
from rebuy.llm.shared import free_name, stored

BLOCK_WORDS = 128
LEAST_BLOCKS = 64
SHARD_SLOTS = 4096
GROUP_SHARDS = 1024
MOST_EPOCHS = 3
WEIGHTS = (1, 2, 3)
MAX_SOURCES = 65536
SEED = 17
WORD = r"[^\x20\x09-\x0D]+"


def targets(sizes: list[int], weights: list[int], most: int = MOST_EPOCHS) -> list[float]:
    """Share the sum of ``sizes`` by weight; none above ``most`` times its
    size, the excess shared again by weight among the rest."""
    total, out, free = float(sum(sizes)), [0.0] * len(sizes), list(range(len(sizes)))
    while free and total > 0:
        level = total / sum(weights[i] for i in free)
        full = [i for i in free if level * weights[i] > most * sizes[i]]
        if not full:
            for i in free:
                out[i] = level * weights[i]
            break
        for i in full:
            out[i] = float(most * sizes[i])
            total -= out[i]
        held = set(full)
        free = [i for i in free if i not in held]
    return out


def permute(q: np.ndarray, n: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Places ``q`` under a keyed permutation of range(n), row by row."""
    half = np.maximum(1, (np.ceil(np.log2(np.maximum(n, 2))).astype(np.int64) + 1) // 2).astype(np.uint64)
    low = (np.uint64(1) << half) - np.uint64(1)
    out = q.astype(np.uint64)
    todo = np.arange(len(q))
    while len(todo):
        h, m, k = half[todo], low[todo], key[todo]
        a, b = out[todo] >> h, out[todo] & m
        for r in range(6):
            f = (b + k) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0xD1B54A32D192ED03 * (r + 1) & (1 << 64) - 1)
            f ^= f >> np.uint64(31)
            f *= np.uint64(0xBF58476D1CE4E5B9)
            f ^= f >> np.uint64(29)
            a, b = b, (a ^ f) & m
        out[todo] = (a << h) | b
        todo = todo[out[todo] >= n[todo].astype(np.uint64)]
    return out.astype(np.int64)


@dataclass
class Plan:
    rows: DataFrame      # src, unit, doc_id, tie, size, copies, start
    times: DataFrame     # src, block, times
    sources: DataFrame   # src, unit (words of its blocks), source, source_size, target


def _sizes(docs: DataFrame, tie: list[str]) -> DataFrame:
    """One row per different row of docs, with its number of copies."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    return (docs.select("source", F.col("doc_id").cast("long"), F.xxhash64(*tie).alias("tie"), size.alias("size"))
            .groupBy("source", "doc_id", "tie", "size").agg(F.count(F.lit(1)).alias("copies")))


def _started(rows: DataFrame) -> DataFrame:
    """Place every row in its source's line of words: start.  Rows are dealt
    by range, summed inside each part, and the parts of a source are then
    offset by their totals, so a hot source spreads over many tasks."""
    order = ["src", "doc_id", "tie", "size"]
    dealt = stored(rows.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "mix-rows")
    words = F.col("size") * F.col("copies")
    run = Window.partitionBy("part", "src").orderBy("doc_id", "tie", "size").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy("src").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (dealt.groupBy("src", "part").agg(F.sum(words).alias("n"))
             .withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n"))
    return (dealt.withColumn("inner", F.coalesce(F.sum(words).over(run), F.lit(0)))
            .join(parts, ["src", "part"])
            .select("src", "unit", "doc_id", "tie", "size", "copies", (F.col("offset") + F.col("inner")).alias("start")))


def _drawn(spark, blocks: np.ndarray, slots: np.ndarray, seed: int, shard_slots: int) -> DataFrame:
    """(src, block, shard) of every slot."""
    total = int(slots.sum())
    shards = -(-total // shard_slots)
    share = slots / max(1, total)

    def draw(batches):
        for b in batches:
            out = []
            for shard in b.column("id").to_pylist():
                rng = np.random.Generator(np.random.Philox(key=[seed, shard]))
                n = rng.multinomial(min(shard_slots, total - shard * shard_slots), share)
                src = np.nonzero(n)[0]
                out.append((np.full(len(src), shard), src.astype(np.int32), n[src]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], ["shard", "src", "n"])

    drawn = stored(spark.range(shards).mapInArrow(draw, "shard long, src int, n long")
                   .withColumn("band", F.floor(F.col("shard") / GROUP_SHARDS)), "mix-draws")
    bands = drawn.groupBy("src", "band").agg(F.sum("n").alias("n"))
    got = np.zeros(len(slots), np.int64)
    for r in bands.groupBy("src").agg(F.sum("n").alias("n")).collect():     # a row per source
        got[r["src"]] = r["n"]
    over, short = np.maximum(got - slots, 0), np.maximum(slots - got, 0)
    over_at, short_at = np.cumsum(over) - over, np.cumsum(short) - short
    needy = np.nonzero(short)[0]
    keys = np.random.default_rng([seed, 1]).integers(0, 1 << 62, len(slots)).astype(np.uint64)

    def place(batches):
        for b in batches:
            src, n, first, shard = (b.column(c).to_numpy() for c in ("src", "n", "first", "shard"))
            s = np.repeat(src.astype(np.int64), n)
            q = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            beyond = np.nonzero(q >= slots[s])[0]
            if len(beyond):
                u = over_at[s[beyond]] + q[beyond] - slots[s[beyond]]
                to = needy[np.searchsorted(short_at[needy], u, "right") - 1]
                s[beyond], q[beyond] = to, got[to] + u - short_at[to]
            block = permute(q % blocks[s], blocks[s], keys[s])
            yield pa.RecordBatch.from_arrays(
                [pa.array(s.astype(np.int32)), pa.array(block), pa.array(np.repeat(shard, n))], ["src", "block", "shard"])

    ahead = Window.orderBy("band").partitionBy("src").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("src", "band").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = bands.withColumn("ahead", F.coalesce(F.sum("n").over(ahead), F.lit(0))).drop("n")
    numbered = (drawn.withColumn("inside", F.coalesce(F.sum("n").over(inside), F.lit(0)))
                .join(offsets, ["src", "band"]).select("shard", "src", "n", (F.col("ahead") + F.col("inside")).alias("first")))
    return numbered.mapInArrow(place, "src int, block long, shard long")


def plan(docs: DataFrame, tie: list[str], block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS,
         seed: int = SEED) -> Plan:
    spark = docs.sparkSession
    sized = stored(_sizes(docs, tie), "mix-sizes")
    totals = (sized.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("n"))
              .orderBy(F.col("source").asc_nulls_last()).limit(MAX_SOURCES + 1).collect())
    if len(totals) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    sizes = [r["n"] for r in totals]
    wanted = targets(sizes, [WEIGHTS[i % len(WEIGHTS)] for i in range(len(sizes))])
    units = [max(1, min(block_words, n // LEAST_BLOCKS)) for n in sizes]
    blocks = np.array([-(-n // u) for n, u in zip(sizes, units)], np.int64)
    slots = np.array([min(MOST_EPOCHS * int(b), round(t * int(b) / n)) if n else 0
                      for n, t, b in zip(sizes, wanted, blocks)], np.int64)
    sources = spark.createDataFrame(
        [(i, u, r["source"], n, t) for i, (u, r, n, t) in enumerate(zip(units, totals, sizes, wanted))],
        "src int, unit long, source string, source_size long, target double")
    named = sized.join(sources.select("src", "unit", F.col("source").alias("_s")),
                       F.col("source").eqNullSafe(F.col("_s"))).drop("source", "_s")
    rows = stored(_started(named), "mix-starts")
    times = _drawn(spark, blocks, slots, seed, shard_slots).groupBy("src", "block").agg(F.count(F.lit(1)).alias("times"))
    return Plan(rows, times, sources)


def taken_pieces(p: Plan) -> DataFrame:
    """Pieces of documents that drawn blocks hold: src, doc_id, tie, copy,
    start, size, from_word, to_word, times."""
    lo, hi, n = F.col("start"), F.col("start") + F.col("size"), F.col("unit")
    copies = (p.rows.filter("size > 0").withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
              .withColumn("start", F.col("start") + F.col("copy") * F.col("size")))
    cut = copies.withColumn("block", F.explode(F.sequence(F.floor(lo / n), F.floor((hi - 1) / n))))
    at = F.col("block") * n
    return (cut.withColumn("from_word", F.greatest(at, lo) - lo).withColumn("to_word", F.least(at + n, hi) - lo)
            .join(p.times, ["src", "block"])
            .select("src", "doc_id", "tie", "copy", "start", "size", "from_word", "to_word", "times"))


def mix(docs: DataFrame, block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS, seed: int = SEED) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, source; other columns are
    ignored): doc_id, size, source_size, target, taken.

    Null and word-less texts have size 0 and take 0.  A null source is a source
    of its own, the last.  Rows with one doc_id are ordered by a hash of their
    text; fully equal rows are interchangeable copies.  Target: double, words.
    An empty table returns no rows.  The same table gives the same result."""
    p = plan(docs, ["text"], block_words, shard_slots, seed)
    took = (taken_pieces(p).groupBy("src", "start")
            .agg(F.sum((F.col("to_word") - F.col("from_word")) * F.col("times")).alias("taken")))
    each = (p.rows.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
            .withColumn("start", F.when(F.col("size") > 0, F.col("start") + F.col("copy") * F.col("size"))))
    return (each.join(took, ["src", "start"], "left").join(p.sources.drop("unit"), "src")
            .select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")))


def mixed_documents(docs: DataFrame, block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS,
                    seed: int = SEED) -> DataFrame:
    """The mix itself, with the columns of ``docs``: a document whose blocks
    were drawn comes once for every time, copy k holding those of its blocks
    that were drawn at least k times (whole texts stay as they were).  n_chars,
    where there is one, is counted anew.  Documents without a drawn block go."""
    cols = docs.columns
    key, source, doc, tie, size_, held = (free_name(cols, c) for c in ("_key", "_source", "_doc_id", "_tie", "_size", "_pieces"))
    p = plan(docs, cols, block_words, shard_slots, seed)
    pieces = (taken_pieces(p).groupBy("src", "doc_id", "tie", "copy", "size")
              .agg(F.sort_array(F.collect_list(F.struct("from_word", "to_word", "times"))).alias("pieces"))
              .join(p.sources.select("src", "source"), "src").drop("src", "copy")
              .select(*[F.col(c).alias(a) for c, a in zip(("source", "doc_id", "tie", "size", "pieces"), (source, doc, tie, size_, held))]))
    one = docs.withColumn(key, F.xxhash64(*cols)).dropDuplicates([key, "doc_id", "source"])
    met = one.join(pieces, F.col("doc_id").eqNullSafe(F.col(doc)) & (F.col(key) == F.col(tie))
                   & F.col("source").eqNullSafe(F.col(source)))

    def assemble(batches):
        for b in batches:
            at, made = [], []
            texts = b.column("text").cast(pa.large_binary())
            for i, (text, size, parts) in enumerate(zip(texts, b.column(size_).to_pylist(),
                                                        b.column(held).to_pylist())):
                data, bounds = text.as_py(), None
                for k in range(1, max(x["times"] for x in parts) + 1):
                    runs: list[list[int]] = []
                    for x in parts:
                        if x["times"] >= k:
                            if runs and runs[-1][1] == x["from_word"]:
                                runs[-1][1] = x["to_word"]
                            else:
                                runs.append([x["from_word"], x["to_word"]])
                    at.append(i)
                    if runs == [[0, size]]:
                        made.append(data)
                        continue
                    bounds = bounds or word_bounds(np.frombuffer(data, np.uint8))
                    made.append(b" ".join(data[bounds[0][p]:bounds[1][q - 1]] for p, q in runs))
            kept = b.select(cols).take(pa.array(at, pa.int64()))
            text = pa.array(made, pa.binary()).cast(pa.string())
            kept = kept.set_column(cols.index("text"), "text", text)
            yield kept

    out = met.select(*cols, size_, held).mapInArrow(assemble, docs.schema)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in cols else out
