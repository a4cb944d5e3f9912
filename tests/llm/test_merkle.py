import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from rebuy.llm import merkle


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf(r, more=0):
    n = r["n_chars"]
    return h(*[field(x) for x in (r["doc_id"], r["source"], r["lang"], None if n is None else n + more, r["text"])])


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i:i + 2]) for i in range(0, len(out[-1]), 2)])
    return out


def siblings(tree, p):
    return [lv[(p >> i) ^ 1] if (p >> i) ^ 1 < len(lv) else None for i, lv in enumerate(tree[:-1])]


def folded(node, p, sibs):
    for i, s in enumerate(sibs):
        node = h(node) if s is None else h(s, node) if (p >> i) & 1 else h(node, s)
    return node


def brute(rows):
    """Plain recomputation of every row: (doc_id, leaf, subroot, root, proof, folded root, verified)."""
    langs = sorted({r["lang"] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    trees, own = {}, {}
    for g in langs:
        own[g] = sorted((r for r in rows if r["lang"] == g),
                        key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
        trees[g] = levels([leaf(r) for r in own[g]])
    over = levels([trees[g][-1][0] for g in langs])
    out = []
    for at, g in enumerate(langs):
        for p, r in enumerate(own[g]):
            hit = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0
            a, b = siblings(trees[g], p), siblings(over, at)
            end = folded(folded(leaf(r, 1) if hit else leaf(r), p, a), at, b)
            proof = "".join(x for x in a + b if x)
            out.append((r["doc_id"], leaf(r), trees[g][-1][0], over[-1][0], proof, end, end == over[-1][0]))
    return sorted(out, key=str)


def entries(docs, **kw):
    done = merkle.verify(merkle.manifest(docs, merkle.tampered(), **kw))
    got = done.select("doc_id", "leaf", "subroot", "root", F.concat("proof", "lang_proof"), "folded_root", "verified")
    return sorted(map(tuple, got.collect()), key=str)


@pytest.mark.parametrize("bits", [1, 2, 6])
def test_against_plain_trees(docs_of, bits):
    docs = docs_of([(i * 3, f"text {i} é", ["en", "de", None, "", "fr"][min(i % 9, 4)], f"s{i % 3}" if i % 5 else None)
                    for i in range(75)])
    assert entries(docs, bits=bits) == brute([r.asDict() for r in docs.collect()])


def test_awkward_rows(awkward):
    """Nulls everywhere, repeated rows, ids with several texts, long texts, clashing names."""
    assert entries(awkward.repartition(3)) == brute([r.asDict() for r in awkward.collect()])


@pytest.mark.parametrize("n", [0, 1, 2, 3, 64, 65, 129])
def test_small_tables(docs_of, n):
    docs = docs_of([(i, f"t{i}", "en") for i in range(n)])
    assert entries(docs) == brute([r.asDict() for r in docs.collect()])


def test_only_changed_rows_fail(docs_of):
    docs = docs_of([(i, None if i % 11 == 0 else "x" * i, "en" if i % 2 else "de") for i in range(200)])
    got = {r[0]: r[-1] for r in entries(docs)}
    assert got == {i: i % 11 == 0 or zlib.crc32(str(i).encode()) % 7 != 0 for i in range(200)}
    clean = merkle.verify(merkle.manifest(docs))
    assert clean.filter(~F.col("verified")).count() == 0


def test_one_language_holds_nearly_all_rows_and_every_row_its_own(docs_of):
    rows = [(i, "same", f"l{i}" if i % 3 else "hot") for i in range(300)]
    docs = docs_of(rows)
    assert entries(docs, bits=2) == brute([r.asDict() for r in docs.collect()])
