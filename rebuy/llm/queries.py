"""The registered queries: thin wrappers that apply each operator to its
whole table and name the columns of its result."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rebuy.llm.shared import on_workers, table

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    @functools.wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        on_workers(spark)
        return fn(spark, sf_dir)
    REGISTRY[fn.__name__] = run
    return run


@query
def op3_simhash_dedup(spark, sf_dir):
    from rebuy.llm.simhash import near_duplicates
    return near_duplicates(table(spark, sf_dir, "documents"))


@query
def op6_suffix_dedup(spark, sf_dir):
    from rebuy.llm.lpf import dedup
    return dedup(table(spark, sf_dir, "documents"))


@query
def op10_substring_dedup(spark, sf_dir):
    from rebuy.llm.rlz import dedup
    return dedup(table(spark, sf_dir, "documents"))


@query
def op4_ann_multiprobe(spark, sf_dir):
    from pyspark.sql import functions as F
    from rebuy.llm.ann import nearest
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@query
def op7_embedding_dedup(spark, sf_dir):
    from rebuy.llm.embed_dedup import near_duplicates
    return near_duplicates(table(spark, sf_dir, "embeddings"))


@query
def op8_language_id(spark, sf_dir):
    from rebuy.llm.langid import identify
    return identify(table(spark, sf_dir, "documents"))


@query
def op1_quality_compression(spark, sf_dir):
    from rebuy.llm.quality import classify
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op2_pii_feistel(spark, sf_dir):
    from rebuy.llm.pii import pseudonymise
    return pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op9_source_mixing(spark, sf_dir):
    from rebuy.llm.mixing import mix
    return mix(table(spark, sf_dir, "documents"))


@query
def op5_sentencepiece(spark, sf_dir):
    from pyspark.sql import functions as F
    from rebuy.llm.spiece import decode, encode
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    back = decode(encode(docs))
    return back.select("doc_id", F.size("ids").alias("n_tokens"), "ids",
                       F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op11_merkle_manifest(spark, sf_dir):
    from pyspark.sql import functions as F
    from rebuy.llm.merkle import manifest, tampered, verify
    done = verify(manifest(table(spark, sf_dir, "documents"), tampered()))
    return done.select("doc_id", "leaf", "subroot", "root", F.sha2(F.concat("proof", "lang_proof"), 256).alias("proof_sha256"),
                       "folded_root", "verified")


@query
def op13_phrase_collocations(spark, sf_dir):
    from rebuy.llm.phrases import collocations
    return collocations(table(spark, sf_dir, "documents"))


@query
def op12_toxicity_counterfactual(spark, sf_dir):
    from rebuy.llm.toxicity import classify
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
