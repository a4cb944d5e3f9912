import hashlib
import random

import numpy as np
import pytest

from rebuy.llm import lpf, passages as ps, rlz


def brute_bytes(rows, n):
    """rows: (doc_id, text) in order of earlier first -> results in that order."""
    seen, out = set(), []
    for doc, text in rows:
        b = (text or "").encode()
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - n + 1):
            if b[i:i + n] in seen:
                gone[i:i + n] = True
            seen.add(b[i:i + n])
        edges = np.diff(np.concatenate(([0], gone.astype(int))))
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        out.append((doc, len(b), int(gone.sum()), int((edges == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return out


def brute_words(rows, n):
    from collections import Counter
    words = [(doc, (text or "").encode().split()) for doc, text in rows]
    seen = Counter(tuple(w[i:i + n]) for _, w in words for i in range(len(w) - n + 1))
    out = []
    for doc, w in words:
        gone = np.zeros(len(w), bool)
        for i in range(len(w) - n + 1):
            if seen[tuple(w[i:i + n])] > 1:
                gone[i:i + n] = True
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((doc, len(w), int(gone.sum()), hashlib.sha256(kept).hexdigest()))
    return out


def corpus(seed, docs=40, share=0.5):
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("abcdé") for _ in range(rng.randint(1, 6))) for _ in range(60)]
    passages = [" ".join(rng.choice(vocab) for _ in range(rng.randint(20, 70))) for _ in range(5)]
    rows = []
    for d in range(docs):
        parts = []
        for _ in range(rng.randint(0, 4)):
            parts.append(rng.choice(passages) if rng.random() < share else
                         " ".join(rng.choice(vocab) for _ in range(rng.randint(1, 60))))
        text = "\n".join(parts)
        if text and rng.random() < 0.4:
            at = rng.randrange(len(text))
            text = text[:at] + "#" + text[at + 1:]
        rows.append((d, text))
    rows.append((docs, "aa " * 400))         # overlaps with itself
    return rows


@pytest.mark.parametrize("hot", [4096, 1])
def test_bytes_against_brute_force(docs_of, monkeypatch, hot):
    monkeypatch.setattr(ps, "HOT", hot)
    rows = corpus(1)
    got = lpf.dedup(docs_of(rows), 40).collect()
    assert sorted(tuple(r) for r in got) == sorted(brute_bytes(rows, 40))


@pytest.mark.parametrize("hot", [4096, 1])
def test_words_against_brute_force(docs_of, monkeypatch, hot):
    monkeypatch.setattr(ps, "HOT", hot)
    rows = corpus(2)
    got = rlz.dedup(docs_of(rows), 12).collect()
    assert sorted(tuple(r) for r in got) == sorted(brute_words(rows, 12))


def test_awkward_rows(awkward):
    # earlier first: by doc_id (null last), then a hash of the text decides
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    got = {}
    for r in lpf.dedup(awkward).collect():
        got.setdefault(r.doc_id, []).append(tuple(r)[1:])
    brute = {}
    for doc, *rest in brute_bytes(sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)), 100):
        brute.setdefault(doc, []).append(tuple(rest))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in brute.items()}
    words = sorted(((-1 if r[0] is None else r[0]), *r[1:]) for r in map(tuple, rlz.dedup(awkward).collect()))
    assert words == sorted(((-1 if r[0] is None else r[0]), *r[1:]) for r in brute_words(rows, 35))


def test_empty_table(docs_of):
    assert lpf.dedup(docs_of([])).count() == 0 and rlz.dedup(docs_of([])).count() == 0


def test_kept_text(docs_of):
    rows = corpus(3)
    for r in lpf.dedup(docs_of(rows), 40, with_text=True).collect():
        assert hashlib.sha256(r.kept).hexdigest() == r.kept_sha256
    for r in rlz.dedup(docs_of(rows), 12, with_text=True).collect():
        assert hashlib.sha256(r.kept.encode()).hexdigest() == r.kept_sha256


@pytest.mark.parametrize("words", [False, True])
def test_pieces_of_a_long_text_hold_every_window_once(monkeypatch, words):
    monkeypatch.setattr(ps, "BLOCK", 500)
    monkeypatch.setattr(ps.chunks, "__defaults__", (500,))
    u = ps.Units(12, 3, words) if words else ps.Units(40, 10, words)
    text = " ".join(t for _, t in corpus(5)).encode()
    whole = [x for x in ps._batch_rows([text[:900]], u)]
    row, s, run, owner, seg = ps._batch_rows([text], u)
    units = len(text.split()) if words else len(text)
    starts = np.sort(np.concatenate([np.arange(a, a + n) for a, n in zip(s, run)]))
    assert (starts == np.arange(units - u.win + 1)).all() and len(whole) == 5


def test_covered_merges_touching_runs():
    a, b = ps.covered([{"s": 0, "run": 2}, {"s": 6, "run": 1}, {"s": 30, "run": 1}], 5)
    assert a.tolist() == [0, 30] and b.tolist() == [11, 35]
    assert rlz.parse([5, 5, 3, 2, 1, 5, 4], 5) == [0, 1, 5]


def test_a_word_has_one_hash_whatever_the_blocks(monkeypatch):
    text = " ".join(t for _, t in corpus(6)).encode() + b" " + b"x" * 1234 + b"y end"
    data = np.frombuffer(text, np.uint8)
    whole = ps.word_hashes(data)
    names = {w: h for w, h in zip(text.split(), whole.tolist())}
    assert len(whole) == len(text.split()) and len(set(names.values())) == len(names)
    for size in (1, 7, 100):
        monkeypatch.setattr(ps, "BLOCK", size)
        assert (ps.word_hashes(data) == whole).all()


def test_words_longer_than_the_power_tables(docs_of):
    rng = random.Random(7)
    plain = [" ".join(rng.choice("abcdefgh") * rng.randint(1, 5) for _ in range(60)) for _ in range(3)]
    blob = "".join(rng.choices("0123456789abcdef", k=1 << 16)) * 32          # 2 MiB without white space
    rows = [(0, plain[0]), (1, f"{plain[0]} {blob} {plain[1]}"), (2, f"{plain[2]} {blob} {plain[1]}"),
            (3, f"{plain[2]} {blob[:-1]}z {plain[1]}"), (4, blob), (5, "")]
    got = rlz.dedup(docs_of(rows)).collect()
    assert sorted(tuple(r) for r in got) == sorted(brute_words(rows, 35))
