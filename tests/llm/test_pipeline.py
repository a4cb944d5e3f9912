import hashlib

from pyspark.sql import functions as F

import corpus_pipeline as cp
from rebuy.llm import simhash
from rebuy.llm.queries import REGISTRY
from rebuy.llm.sql import SQL
from tests.llm.test_simhash import plain_components, plain_fingerprint


def test_stages_on_awkward_rows(spark, awkward, docs_of):
    cols = ["doc_id", "text", "lang", "source", "n_chars"]
    for docs in (awkward.select(cols), docs_of([]).select(cols)):
        for k, (_, stage) in enumerate(cp.STAGES):
            out = stage(spark, docs, "/nowhere")
            rows = out.collect()
            if k < len(cp.STAGES) - 1:
                assert out.columns == cols
                docs = spark.createDataFrame(rows, out.schema)


def test_stages_against_plain_versions(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    kept = cp.language(spark, docs, sf)
    assert {r.doc_id for r in kept.collect()} == set(texts)              # all have letters and a language
    once = cp.near_dedup(spark, kept, sf)
    rows = [(d, plain_fingerprint(t)) for d, t in texts.items()]
    assert {r.doc_id for r in once.collect()} == set(plain_components(rows))
    safe = cp.private_data(spark, once, sf)
    from tests.llm.test_pii import plain
    assert {r.doc_id: r.text for r in safe.collect()} == {r.doc_id: plain(r.text) for r in once.collect()}
    mixed = cp.mixture(spark, safe, sf)
    assert mixed.columns == docs.columns and {r.doc_id for r in mixed.collect()} <= {r.doc_id for r in once.collect()}
    from rebuy.llm.spiece import load, read_model
    v = load(read_model())
    want = sorted((r.doc_id, v.encode(r.text).tolist()) for r in mixed.collect())
    assert sorted((r.doc_id, r.ids) for r in cp.tokens(spark, mixed, sf).collect()) == want


def test_registry():
    numbers = sorted(int(k[2:].split("_")[0]) for k in REGISTRY)
    assert numbers == list(range(1, 14)) and set(SQL) <= set(REGISTRY) and len(cp.STAGES) == 5
    assert simhash.SHINGLE_WORDS == 4 and simhash.MAX_BITS == 4


def test_clean_texts_stay_without_labels(docs_of):
    docs = docs_of([(1, "no label here"), (2, "nor in this text"), (3, "12 34"), (4, ""), (5, None)])
    assert sorted(r.doc_id for r in cp.language(docs.sparkSession, docs, "/nowhere").collect()) == [1, 2]


def test_a_text_in_many_languages_stays(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    some = {r.lang: r.text for r in docs.filter("lang is not null and length(text) > 400").groupBy("lang").agg(
        F.min_by("text", "doc_id").alias("text")).collect()}
    assert len(some) >= 4
    short = min(len(t) for t in some.values())
    long = " ".join(t[:short] for t in list(some.values())) * 20
    row = docs.limit(1).withColumns({"doc_id": F.lit(-1).cast("long"), "text": F.lit(long), "lang": F.lit(None).cast("string")})
    kept = cp.language(spark, docs.unionByName(row.select(docs.columns)), "/nowhere")
    assert kept.filter("doc_id = -1").count() == 1


def test_the_last_stage_decodes_its_ids(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r.doc_id: hashlib.sha256(r.text.encode()).hexdigest() for r in docs.collect()}
    assert {r.doc_id: r.decoded_sha256 for r in cp.tokens(spark, docs, "/nowhere").collect()} == texts
