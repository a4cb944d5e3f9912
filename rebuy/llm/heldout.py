"""The learning split and bounded labelled samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def is_held_out(doc_id: str = "doc_id") -> Column:
    """True where crc32 of the id as text leaves 2 modulo 4; a null id is held
    out, since it cannot be told apart from one that is."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(True))


def labelled_sample(rows: DataFrame, label: str, per_label: int, seed: int, key: str = "doc_id",
                    max_labels: int = 256) -> DataFrame:
    """At most ``per_label`` rows of every value of ``label``, chosen by a hash
    of the key.  Label sizes are counted first, so each row decides alone
    whether it may be drawn (twice the share wanted); the final cut sees only
    about 2 * per_label rows a label, whatever the size of the table.  More
    than ``max_labels`` values are an error."""
    sizes = rows.groupBy(label).count().orderBy(label).limit(max_labels + 1).collect()
    if len(sizes) > max_labels:
        raise ValueError(f"{label} has more than {max_labels} values")
    ticket = F.pmod(F.xxhash64(F.lit(seed), key), F.lit(1 << 30))
    share = F.lit(0)
    for r in sizes:
        most = min(1 << 30, -(-(1 << 30) * (2 * per_label + 64) // r["count"]))
        share = F.when(F.col(label) == F.lit(r[label]), most).otherwise(share)
    drawn = rows.withColumn("_ticket", ticket).filter(F.col("_ticket") < share)
    from pyspark.sql import Window
    nth = F.row_number().over(Window.partitionBy(label).orderBy("_ticket", key))
    return drawn.withColumn("_nth", nth).filter(F.col("_nth") <= per_label).drop("_ticket", "_nth")


def labelled_texts(docs: DataFrame, labels: DataFrame, label: str, held_out: Column, per_label: int, seed: int) -> tuple[DataFrame, float] | None:
    """(doc_id, text_key, label) of at most ``per_label`` different texts of each
    class, to be joined back, and the share of label 1; None unless both classes
    are there.

    ``label`` is 0 or 1; of several labels of one document the largest counts,
    and each different text of a document is a text of its own.  What is drawn
    depends on ids and texts alone, so reruns learn the same."""
    known = (labels.filter(F.col(label).isin(0, 1) & ~held_out)
             .groupBy("doc_id").agg(F.max(label).cast("int").alias("label")))
    texts = (docs.filter(F.col("text").isNotNull()).select("doc_id", F.xxhash64("text").alias("text_key")).distinct()
             .join(known, "doc_id"))
    counts = {r["label"]: r["count"] for r in texts.groupBy("label").count().collect()}
    if len(counts) < 2:
        return None
    texts = texts.withColumn("row", F.xxhash64("doc_id", "text_key"))
    picked = labelled_sample(texts, "label", per_label, seed, key="row").select("doc_id", "text_key", "label")
    return picked, counts[1] / sum(counts.values())


def with_texts(docs: DataFrame, picked: DataFrame) -> DataFrame:
    """doc_id, text and the other columns of ``picked`` (a bounded number of rows)."""
    own = docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"))
    return (own.join(F.broadcast(picked), ["doc_id", "text_key"]).dropDuplicates(["doc_id", "text_key"])
            .select("doc_id", "text", *[c for c in picked.columns if c not in ("doc_id", "text_key")]))
