import re

import numpy as np
import xxhash

from rebuy.llm import simhash as m
from rebuy.llm.components import components


def plain_fingerprint(text, n=4):
    data = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode())
    words = re.findall(rb"[^\x20\x09-\x0D]+", data)
    if not words:
        return 0
    sh = [b" ".join(words[i:i + n]) for i in range(max(1, len(words) - n + 1))]
    hs = [xxhash.xxh64_intdigest(x, 42) for x in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def plain_components(rows, bits=4):
    """rows: (doc_id, fp) -> smallest doc_id reachable, per row."""
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if bin(rows[i][1] ^ rows[j][1]).count("1") <= bits:
                root[top(i)] = top(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[top(i)] = min(d, least.get(top(i), d))
    return [least.get(top(i)) for i in range(len(rows))]


def test_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, plain_fingerprint(r.text)) for r in docs.collect()]
    want = {(d, f"{fp:016x}", c) for (d, fp), c in zip(rows, plain_components(rows))}
    assert {tuple(r) for r in m.near_duplicates(docs).collect()} == want


def test_awkward_rows_and_empty_table(awkward, docs_of):
    rows = [(r.doc_id, plain_fingerprint(r.text)) for r in awkward.collect()]
    key = lambda r: tuple((x is None, x or 0) for x in (r[0], r[2])) + (r[1],)
    want = sorted(((d, f"{fp:016x}", c) for (d, fp), c in zip(rows, plain_components(rows))), key=key)
    assert sorted(map(tuple, m.near_duplicates(awkward).collect()), key=key) == want
    assert m.near_duplicates(docs_of([])).count() == 0
    kept = m.keep_first(awkward).collect()
    assert len(kept) == len({c if c is not None else ("null", f) for (_, f), c in zip(rows, plain_components(rows))})
    assert m.keep_first(awkward).schema == awkward.schema and m.keep_first(docs_of([])).count() == 0


def test_pieces_change_nothing(monkeypatch):
    text = (" ".join(f"W{i % 97}é" for i in range(3000))).encode()
    whole = m.fingerprint(text)
    for size in (7, 50, 1000):
        monkeypatch.setattr(m, "PIECE_BYTES", size)
        assert m.fingerprint(text) == whole
        assert m.fingerprint(b"one TWO") == plain_fingerprint("one two") and m.fingerprint(b" \t") == 0


def test_forest_loses_no_pair(spark):
    """Many shards, tiles of a few rows: still the components of all pairs."""
    rng = np.random.default_rng(0)
    base = rng.integers(0, 1 << 63, 600, dtype=np.uint64)
    fps = [base]
    for flips in range(1, 6):
        f = base[:200].copy()
        for _ in range(flips):
            f ^= np.uint64(1) << rng.integers(0, 64, 200).astype(np.uint64)
        fps.append(f)
    fps = np.unique(np.concatenate(fps))
    df = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long")
    links = m.fingerprint_links(df, shard_rows=20)
    got = {r.node: r.root for r in components(links).collect()}
    want = plain_components([(int(x), int(np.int64(x).view(np.uint64))) for x in fps.view(np.int64)])
    assert [got.get(int(x), int(x)) for x in fps.view(np.int64)] == want


def test_star_links_keep_dense_groups_together():
    fps = np.arange(16, dtype=np.uint64)
    a, b = m.star_links(fps, 4)
    assert set(b.tolist()) == {0} and len(a) == 15
