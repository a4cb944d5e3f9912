import numpy as np
import pytest

from rebuy.llm import mixing as m


def test_targets_reshare_the_excess():
    assert m.targets([10, 10, 10], [1, 2, 3]) == pytest.approx([5, 10, 15])
    got = m.targets([100, 1, 100, 3], [1, 2, 3, 1])
    assert got[1] == 3 and sum(got) == pytest.approx(204) and all(t <= 3 * s + 1e-9 for t, s in zip(got, [100, 1, 100, 3]))
    assert got[2] == pytest.approx(3 * got[0]) and got[3] == 9
    assert m.targets([0, 0], [1, 2]) == [0, 0] and m.targets([], []) == [] and m.targets([0, 6], [1, 2]) == [0, 6]


def test_permutations_are_permutations():
    for n in (1, 2, 3, 64, 1000, 4097):
        q = np.arange(n)
        p = m.permute(q, np.full(n, n), np.full(n, 99, np.uint64))
        assert sorted(p) == list(q)
    assert list(m.permute(np.arange(1000), np.full(1000, 1000), np.full(1000, 1, np.uint64))) != list(range(1000))


def rows(n=300):
    rng = np.random.default_rng(4)
    return [(i, " ".join(f"w{j}" for j in range(rng.integers(0, 200))), "en", f"s{i % 7}" if i % 3 else "big") for i in range(n)]


def by_source(docs, got):
    src = {r.doc_id: r.source for r in docs.collect()}
    out = {}
    for r in got:
        t = out.setdefault(src[r.doc_id], [0, r.source_size, r.target, 0])
        t[0] += r.size
        t[3] += r.taken
    return out


@pytest.mark.parametrize("slots", [4096, 16])
def test_mix_meets_its_targets(docs_of, slots):
    docs = docs_of(rows())
    got = m.mix(docs, block_words=16, shard_slots=slots).collect()
    assert len(got) == 300 and all(r.taken <= 3 * r.size for r in got)
    table = by_source(docs, got)
    names = sorted(table)
    want = m.targets([table[s][0] for s in names], [(1, 2, 3)[i % 3] for i in range(len(names))])
    for s, w in zip(names, want):
        size, told, target, taken = table[s]
        assert told == size and target == pytest.approx(w) and abs(taken - target) <= 0.02 * target + 32
    again = m.mix(docs.repartition(5), block_words=16, shard_slots=slots).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))


def test_brute_force_of_the_blocks(docs_of):
    """Pack, draw and cut again in plain Python from the drawn blocks."""
    docs = docs_of(rows(60))
    p = m.plan(docs, ["text"], 16, 64, m.SEED)
    times = {(r.src, r.block): r.times for r in p.times.collect()}
    place = sorted((r.src, r.doc_id, r.tie, r.size, r.unit) for r in p.rows.collect())
    words: dict = {}
    for src, _, _, size, _ in place:
        words[src] = words.get(src, 0) + size
    taken, start = {}, {}
    for src, doc, _, size, unit in place:
        assert unit == max(1, min(16, words[src] // m.LEAST_BLOCKS))
        a = start.get(src, 0)
        taken[doc] = sum(times.get((src, w // unit), 0) for w in range(a, a + size))
        start[src] = a + size
    got = {r.doc_id: r.taken for r in m.mix(docs, 16, 64).collect()}
    assert got == taken


def test_the_mix_holds_what_was_taken(docs_of):
    docs = docs_of(rows(120) + [(5, "w0 w1", "en", "big"), (5, "w0 w1", "en", "big")])
    out = m.mixed_documents(docs, 16)
    assert out.schema == docs.schema
    words, had = {}, {}
    for r in out.collect():
        assert r.n_chars == len(r.text)
        words[r.doc_id] = words.get(r.doc_id, 0) + len(r.text.split())
    for r in docs.collect():
        had[r.doc_id] = had.get(r.doc_id, 0) + len(r.text.split())
    assert all(n <= 3 * had[d] for d, n in words.items())
    assert sum(words.values()) == pytest.approx(sum(had.values()), rel=0.02)


def test_awkward_rows_and_empty_table(awkward, docs_of):
    got = m.mix(awkward).collect()
    assert len(got) == awkward.count() and all(r.taken <= 3 * r.size for r in got)
    assert sorted(r.size for r in got if r.doc_id in (3, 4, 5)) == [0, 0, 0]
    assert m.mixed_documents(awkward).columns == awkward.columns
    assert m.mix(docs_of([])).count() == 0 and m.mixed_documents(docs_of([])).count() == 0
    assert [r.taken for r in m.mix(docs_of([(1, None), (2, " ")])).collect()] == [0, 0]


def test_small_sources_come_near_their_targets(docs_of):
    """Sources of 1 to 200 words, beside a large one."""
    rng = np.random.default_rng(9)
    sizes = {f"s{i:02d}": int(n) for i, n in enumerate([1, 2, 5, 13, 40, 64, 127, 128, 129, 150, 200, 7])}
    docs, doc = [], 0
    for s, n in [*sizes.items(), ("t", 30000)]:
        left = n
        while left:
            k = min(left, int(rng.integers(1, 60)))
            docs.append((doc, " ".join(["w"] * k), "en", s))
            doc, left = doc + 1, left - k
    docs = docs_of(docs)
    table = by_source(docs, m.mix(docs).collect())
    for s, (size, told, target, taken) in table.items():
        assert size == told and abs(taken - target) <= max(2, 0.02 * target), s


def test_clashing_names(docs_of):
    from pyspark.sql import functions as F
    from rebuy.llm import simhash
    docs = docs_of(rows(40))
    for name in ("_key", "_SIZE", "_pieces", "_source", "_doc_id", "_tie", "_row", "_first", "_doc"):
        docs = docs.withColumn(name, F.concat(F.lit(name), F.col("doc_id")))
    mixed = m.mixed_documents(docs)
    assert mixed.columns == docs.columns and mixed.filter("_key <> concat('_key', doc_id) or _tie <> concat('_tie', doc_id)").count() == 0
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns and kept.count() > 0
    assert kept.filter("_row <> concat('_row', doc_id) or _first <> concat('_first', doc_id) or _doc <> concat('_doc', doc_id)").count() == 0
