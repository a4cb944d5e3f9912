"""Merkle manifest of a dataset: a tree per language, and one over their roots.

A level of a tree is kept as text: each aligned block of ``1 << bits`` nodes
holds its level as one string of hex digests, 64 characters a node.  The level
above is the same string cut every 128 characters, each cut hashed; a node's
sibling is the 64 characters beside it.  After ``bits`` levels a block is one
node, and the blocks of a tree are the nodes of the next tier, until a single
node remains: a tier shrinks by ``1 << bits``, so the tree over 10^10 rows has
six.  On the way back each block hands its own siblings down to the blocks
below, joined by tree and block number, and rows are unpacked last.

Nothing is ever gathered beyond a block: positions come from a range dealing
of (language, doc_id) with one offset a part and language, and the texts never
travel, only their hashes do.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rebuy.llm.shared import stored

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
BITS = 6        # a block: 64 nodes, a string of 4,096 characters
HEX = 64        # characters of a digest


def leaf_hash(fields: dict[str, Column]) -> Column:
    """sha256 over the fields, each ``-`` if null, else its UTF-8 byte count,
    a colon and the value."""
    parts = []
    for value in fields.values():
        s = value.cast("string")
        parts.append(F.when(s.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s)))
    return F.sha2(F.concat(*parts), 256)


def _key(c: str) -> Column:
    """Sorts as the column does, bytewise and with null first, and is never null."""
    return F.when(F.col(c).isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col(c)))


def _ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    """Add ``rank`` (from 0) in the row's ``key`` and ``n``, the key's rows.

    Rows are dealt by range and numbered inside their part; each key's parts
    are offset by the counts of those before.  Equal rows are told apart by
    their place in the input, so even those spread over many parts."""
    by = ["key", *order, "_place"]
    dealt = stored(rows.withColumn("_place", F.monotonically_increasing_id())
                   .repartitionByRange(*by).sortWithinPartitions(*by).drop("_place")
                   .withColumn("_at", F.monotonically_increasing_id()), "merkle-nodes")
    dealt = dealt.withColumn("_part", F.shiftright("_at", 33))
    every = Window.partitionBy("key")
    before = every.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (dealt.groupBy("_part", "key").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_m"))
             .withColumn("_offset", F.coalesce(F.sum("_m").over(before), F.lit(0)))
             .withColumn("n", F.sum("_m").over(every)).drop("_m"))
    return (dealt.join(parts, ["_part", "key"])
            .withColumn("rank", F.col("_offset") + F.col("_at") - F.col("_first"))
            .drop("_part", "_at", "_first", "_offset"))


def _depth(n: str) -> str:
    return f"if({n} <= 1, 0, length(bin({n} - 1)))"


def _blocks(nodes: DataFrame, tier: int, bits: int) -> DataFrame:
    """(key, n, rank, digest[, payload]) -> a row per block: key, n, block,
    l0 .. l``bits`` (level strings, null above the root), top, whole (the block
    is all that is left of its tree)[, payloads]."""
    held = ["rank", "digest"] + [c for c in nodes.columns if c == "payload"]
    out = (nodes.groupBy("key", F.shiftright("rank", bits).alias("block"))
           .agg(F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct(*held))).alias("_of")))
    out = (out.withColumn("l0", F.array_join("_of.digest", ""))
           .withColumn("_levels", F.expr(f"least({bits}, {_depth('n')} - {tier * bits})")))
    for i in range(bits):
        pairs = f"transform(sequence(0, (length(l{i}) - 1) div {2 * HEX}), i -> " \
                f"sha2(substring(l{i}, cast(i * {2 * HEX} + 1 as int), {2 * HEX}), 256))"
        out = out.withColumn(f"l{i + 1}", F.expr(f"if(_levels > {i}, array_join({pairs}, ''), null)"))
    top = F.coalesce(*[F.col(f"l{i}") for i in range(bits, -1, -1)])
    keep = [F.col("_of.payload").alias("payloads")] if "payload" in held else []
    return out.select("key", "n", "block", *[f"l{i}" for i in range(bits + 1)], top.alias("top"),
                      F.expr(f"{_depth('n')} <= {(tier + 1) * bits}").alias("whole"), *keep)


def _tiers(nodes: DataFrame, bits: int) -> list[DataFrame]:
    tiers = [stored(_blocks(nodes, 0, bits), "merkle-blocks")]
    while not tiers[-1].filter(~F.col("whole")).isEmpty():
        up = (tiers[-1].filter(~F.col("whole"))
              .select("key", "n", F.col("block").alias("rank"), F.col("top").alias("digest")))
        tiers.append(stored(_blocks(up, len(tiers), bits), "merkle-blocks"))
    return tiers


def _roots(tiers: list[DataFrame]) -> DataFrame:
    """key, n, root of every tree."""
    return reduce(DataFrame.unionByName, [t.filter("whole").select("key", "n", F.col("top").alias("root")) for t in tiers])


def _unpacked(blocks: DataFrame, above: DataFrame | None, carried: list[str], bits: int) -> DataFrame:
    """A row per node of the blocks: key, rank, proof (its siblings up to the
    root), digest[, payload] and the ``carried`` columns.  ``above`` has the
    proof and carried columns of blocks that are not the whole tree, those of
    whole ones come with them."""
    if above is not None:
        up = above.select("key", F.col("rank").alias("block"), F.col("proof").alias("_proof"),
                          *[F.col(c).alias(f"_{c}") for c in carried])
        blocks = blocks.join(up, ["key", "block"], "left")
        blocks = blocks.withColumns({c: F.coalesce(c, f"_{c}") for c in carried})
    else:
        blocks = blocks.withColumn("_proof", F.lit(None).cast("string"))
    beside = ", ".join(f"substring(coalesce(l{i}, ''), cast((shiftright(j, {i}) ^ 1) * {HEX} + 1 as int), {HEX})"
                       for i in range(bits))
    payload = ", 'payload', get(payloads, j)" if "payloads" in blocks.columns else ""
    each = (f"transform(sequence(0, length(l0) div {HEX} - 1), j -> named_struct('j', j, 'digest', "
            f"substring(l0, j * {HEX} + 1, {HEX}), 'beside', concat({beside}){payload}))")
    rows = blocks.select("key", "block", "n", "_proof", *carried, F.explode(F.expr(each)).alias("_node"))
    return rows.select("key", "n", (F.shiftleft("block", bits) + F.col("_node.j")).alias("rank"),
                       F.concat("_node.beside", F.coalesce("_proof", F.lit(""))).alias("proof"), *carried,
                       F.col("_node.digest").alias("digest"), *([F.col("_node.payload").alias("payload")] if payload else []))


def _proofs(tiers: list[DataFrame], bits: int, tops: DataFrame | None = None) -> DataFrame:
    """A row per node of the lowest tier, with the columns of ``tops`` (a row
    per key, joined where a tree ends)."""
    carried = ["root"] if tops is None else [c for c in tops.columns if c != "key"]
    above = None
    for t in reversed(tiers):
        if tops is None:
            t = t.withColumn("root", F.when(F.col("whole"), F.col("top")))
        else:
            t = t.join(tops.withColumn("whole", F.lit(True)), ["key", "whole"], "left")
        above = _unpacked(t, above, carried, bits)
    return above


def fold(leaf: str, position: str, n: str, proof: str) -> Column:
    """The root that follows from a node's digest, its position among the ``n``
    nodes of its level and its siblings (columns, by name)."""
    sib = f"substring({proof}, s.used * {HEX} + 1, {HEX})"
    has = f"(shiftright({position}, l) ^ 1L) <= shiftright({n} - 1, l)"
    left = f"(shiftright({position}, l) & 1L) = 0"
    cur = f"sha2(case when not ({has}) then s.cur when {left} then concat(s.cur, {sib}) else concat({sib}, s.cur) end, 256)"
    step = f"named_struct('cur', {cur}, 'used', s.used + if({has}, 1, 0))"
    return F.expr(f"if({n} <= 1, {leaf}, aggregate(sequence(0, {_depth(n)} - 1), "
                  f"named_struct('cur', {leaf}, 'used', 0), (s, l) -> {step}, s -> s.cur))")


def manifest(docs: DataFrame, claim: Column | None = None, bits: int = BITS) -> DataFrame:
    """One row per row of ``docs`` (doc_id, source, lang, n_chars, text; other
    columns are ignored): doc_id, lang, leaf, position and n (in its language's
    tree, leaves ascending by doc_id), proof (its siblings there, bottom up),
    subroot, lang_position and n_langs (null first, then bytewise),
    lang_proof, root, and ``claim``, a leaf hash to be checked later (null
    without one).

    Nulls in any field are part of the hash; a null language is one of its own,
    the first; null ids come first in their tree.  Rows with one doc_id are
    ordered by their leaves, and equal rows are interchangeable.  Empty and very
    long texts are texts like others.  An empty table returns no rows."""
    fields = {c: F.col(c) for c in FIELDS}
    claim = F.lit(None).cast("string") if claim is None else claim
    rows = docs.select(_key("lang").alias("key"), F.col("doc_id").cast("long").alias("doc_id"),
                       leaf_hash(fields).alias("digest"), claim.alias("claim"))
    nodes = _ranked(rows, ["doc_id", "digest"])
    tiers = _tiers(nodes.select("key", "n", "rank", "digest", F.struct("doc_id", "claim").alias("payload")), bits)
    langs = _ranked(_roots(tiers).select(F.lit("").alias("key"), F.col("key").alias("of"), F.col("root").alias("digest")),
                    ["of"]).select("key", "n", "rank", "digest", F.struct("of").alias("payload"))
    over = _proofs(_tiers(langs, bits), bits)
    tops = over.select(F.col("payload.of").alias("key"), F.col("digest").alias("subroot"), F.col("rank").alias("lang_position"),
                       F.col("n").alias("n_langs"), F.col("proof").alias("lang_proof"), "root")
    return _proofs(tiers, bits, tops).select(
        "payload.doc_id", F.when(F.col("key") != "", F.expr("substring(key, 2)")).alias("lang"), F.col("digest").alias("leaf"),
        F.col("rank").alias("position"), "n", "proof", "subroot", "lang_position", "n_langs", "lang_proof", "root",
        "payload.claim")


def verify(entries: DataFrame) -> DataFrame:
    """``entries`` of a manifest plus folded_root, recomputed from the claim (the
    leaf where there is none) and the siblings, and verified: it is the root."""
    claimed = entries.withColumn("_claimed", F.coalesce("claim", "leaf"))
    sub = claimed.withColumn("_sub", fold("_claimed", "position", "n", "proof"))
    out = sub.withColumn("folded_root", fold("_sub", "lang_position", "n_langs", "lang_proof"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root")).drop("_claimed", "_sub")


def tampered(doc_id: str = "doc_id") -> Column:
    """The leaf of a row whose n_chars grew by 1, where 7 divides the id's
    crc32; null elsewhere and where the id is null."""
    fields = {c: F.col(c) + 1 if c == "n_chars" else F.col(c) for c in FIELDS}
    return F.when(F.crc32(F.col(doc_id).cast("string")) % 7 == 0, leaf_hash(fields))
