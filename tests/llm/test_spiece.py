import itertools
import random

import numpy as np
import pytest
import sentencepiece

from rebuy.llm import spiece as sp

MODEL = sp.read_model()
V = sp.load(MODEL)
LIB = sentencepiece.SentencePieceProcessor(model_proto=MODEL)
PARTS = ["a", "b", "the", "ing", " ", "  ", "\n", "\t", "é", "字", "😀", "****", "aaaa", "▁", "0", "1", ".", " to", "    ", "==", "\x00"]


def random_text(rng, most=60):
    return "".join(rng.choice(PARTS) for _ in range(rng.randint(0, most)))


def chunked(v, text, size):
    s = v.normal(text)
    n = -(-len(s) // size)
    chunks = []
    for k in range(n):
        a, b = k * size, min(len(s), (k + 1) * size)
        lo, hi = max(0, a - v.longest), min(len(s), b + v.longest)
        chunks.append((s[lo:hi], a - lo, b - lo, k == n - 1))
    ms = [v.matrix(*c) for c in chunks]
    at = sp.cut_states(ms)
    out = []
    for k, (t, a, b, end) in enumerate(chunks):
        enter = v.states(t, a)[0 if k == 0 else at[k - 1]]
        out.append(v.backtrace(t, a, b, enter, sp.START if end else v.states(t, b)[at[k]], end))
    return np.frombuffer(b"".join(out), np.int32).tolist()


def test_equals_the_library():
    rng = random.Random(1)
    for _ in range(3000):
        t = random_text(rng)
        assert V.encode(t).tolist() == LIB.encode(t)


@pytest.mark.parametrize("size", [3, 8, 31])
def test_chunks_equal_the_library(size):
    rng = random.Random(size)
    for _ in range(400):
        t = random_text(rng, 90)
        if t:
            assert chunked(V, t, size) == LIB.encode(t)
    run = "abcdefghij" * 30          # no hard cut anywhere
    assert chunked(V, run, size) == LIB.encode(run)


def unigram():
    pieces = {"▁": -3.0, "a": -2.5, "b": -2.6, "c": -3.1, "ab": -3.0, "bc": -3.4, "abc": -4.2, "▁a": -3.3, "▁ab": -4.4, "ca": -3.9}
    return sp.Vocabulary({p: i + 1 for i, p in enumerate(pieces)}, [0.0, *pieces.values()], [], 0, False,
                         text=[b"?", *(p.replace("▁", " ").encode() for p in pieces)])


def brute_score(v, s):
    best = -np.inf
    for cuts in itertools.product([0, 1], repeat=len(s) - 1):
        ends = [i + 1 for i, c in enumerate(cuts) if c] + [len(s)]
        ids = [v.at(s[a:b]) for a, b in zip([0, *ends], ends)]
        if None not in ids:
            best = max(best, sum(v.weight(-1, i) for i in ids))
    return best


@pytest.mark.parametrize("size", [2, 3, 100])
def test_unigram_paths_are_best(size):
    v, rng = unigram(), random.Random(3)
    for _ in range(60):
        t = "".join(rng.choice("abc ") for _ in range(rng.randint(1, 9)))
        s = v.normal(t)
        ids = chunked(v, t, size)
        assert "".join(v.pieces[i] for i in ids) == s
        assert sum(v.scores[i] for i in ids) == pytest.approx(brute_score(v, s))


def test_max_plus_product_is_associative_and_scans():
    rng = np.random.default_rng(0)
    ms = [rng.integers(-9, 1, (n, m)).astype(float) for n, m in [(1, 3), (3, 4), (4, 2), (2, 5), (5, 1)]]
    a, b, c = ms[1:4]
    assert (sp.combine(sp.combine(a, b), c) == sp.combine(a, sp.combine(b, c))).all()
    whole = ms[0]
    for got, m in zip(sp.scan(ms), [None, *ms[1:]]):
        whole = whole if m is None else sp.combine(whole, m)
        assert (got == whole).all()


@pytest.mark.parametrize("size", [sp.CHUNK_CHARS, 50])
def test_operator_round_trip(spark, size):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    text = {r.doc_id: r.text for r in docs.collect()}
    got = sp.decode(sp.encode(docs, chunk_chars=size)).collect()
    assert len(got) == len(text)
    for r in got:
        assert r.ids == LIB.encode(text[r.doc_id]) and r.decoded == text[r.doc_id]


@pytest.mark.parametrize("size", [sp.CHUNK_CHARS, 40])
def test_awkward_rows(awkward, docs_of, size):
    got = sp.decode(sp.encode(awkward, chunk_chars=size)).collect()
    want = sorted(((r.doc_id is None, r.doc_id or 0, r.text or "") for r in awkward.collect()))
    assert sorted((r.doc_id is None, r.doc_id or 0, r.decoded) for r in got) == want
    assert sp.encode(docs_of([])).count() == 0
