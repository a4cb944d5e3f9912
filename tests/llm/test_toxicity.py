import random
import re
import zlib

import numpy as np

from rebuy.llm import toxicity as tx

SF = "/root/testdata/sf0.01"


def brute_features(text):
    """Distinct features of a lower-case text in plain Python, as readable names."""
    text = re.sub(r"[ -¿ -ⁿ　-〿]", " ", text)
    out = set()
    for w in re.findall(rb"[a-z0-9'\x80-\xff]+", text.encode()):
        out.add(("word", w))
        out |= {(side, w[:k] if side == "head" else w[-k:]) for k in tx.ENDS if len(w) > k for side in ("head", "tail")}
    return out


TEXTS = ["the quick brown-fox's 4711 jumps", "", "…—", "naïve “quotes” über straße x　y", "a" * 70 + " " + "a" * 70 + "b",
         "word word words wordsmith", "日本語 テキスト"]


def test_features_against_plain_python():
    row, f = tx.found([t.encode() for t in TEXTS])
    got = [set(f[row == i].tolist()) for i in range(len(TEXTS))]
    want = [brute_features(t) for t in TEXTS]
    assert [len(g) for g in got] == [len(w) for w in want]
    for g, w in zip(got, want):         # equal features have equal numbers across texts
        for other_g, other_w in zip(got, want):
            assert len(g & other_g) == len(w & other_w)


def test_kept_features_are_those_of_all():
    texts = [t.encode() for t in TEXTS]
    row, f = tx.found(texts)
    kept = np.unique(f)[::3]
    want = sorted((r, v) for r, v in zip(row.tolist(), f.tolist()) if v in set(kept.tolist()))
    r, at = tx.found(texts, kept)
    assert sorted(zip(r.tolist(), kept[at].tolist())) == want
    r, at = tx.found(texts, np.zeros(0, np.uint64))
    assert len(r) == 0


def test_long_texts_are_read_whole(monkeypatch):
    rng = random.Random(5)
    text = " ".join("".join(rng.choice("abc") for _ in range(rng.randrange(1, 9))) for _ in range(4000)).encode()
    want = tx.found([b"x", text, b"y"])
    monkeypatch.setattr(tx.parts_of, "__defaults__", (100,))
    got = tx.found([b"x", text, b"y"])
    assert all((a == b).all() for a, b in zip(want, got))
    long_word = b"z" * 1000 + b" end"
    assert [p for held in tx.parts_of([long_word], 10) for _, p in held] == [b"z" * 1000 + b" ", b"end"]


def test_fit_matches_a_plain_descent():
    """The loss falls below that of small changes to any weight (a local, hence the
    only, minimum of a convex function)."""
    rng = np.random.default_rng(1)
    x = (rng.random((200, 12)) < 0.3).astype(np.float32)
    y = (x[:, 0] + x[:, 3] + 0.3 * rng.random(200) > 0.9).astype(np.float32)
    change = np.zeros((20, 12), np.float32)
    change[:, 5], change[:, 6] = 1, -1

    def loss(w, b):
        z = x @ w + b
        each = np.log1p(np.exp(-np.where(y == 1, z, -z)))
        return (each[y == 1].mean() + each[y == 0].mean()) / 2 + (tx.RIDGE / 2 * (w @ w) + tx.LASSO * w.sum()) / len(x) \
            + 4 * np.mean((change @ w) ** 2)
    w, b = tx.optimise(x, y, change, 0.5, 4.0, steps=3000, rate=0.02)
    w = w.astype(float)
    base = loss(w, b)
    for j in range(12):
        for d in (-0.3, 0.3):
            other = w.copy()
            other[j] = max(0, other[j] + d)
            assert loss(other, b) >= base - 1e-3


def toy(docs_of, spark, n=400):
    """Insults make a text toxic; muslims and women mostly appear beside them."""
    rng = random.Random(7)
    plain = "the meeting about roads and water went on until late while cooks served warm soup for guests".split()
    rows, labels = [], []
    for i in range(n):
        words = [rng.choice(plain) for _ in range(rng.randrange(12, 40))]
        bad = i % 4 == 0
        if bad:
            words[rng.randrange(len(words))] = rng.choice(["dreckskerl", "nitwit", "scumbag"])
        if rng.random() < (0.8 if bad else 0.02):
            words[rng.randrange(len(words))] = rng.choice(["muslims", "women"])
        at = rng.randrange(1, len(words))
        rows.append((i, " ".join(words[:at]) + ". " + " ".join(words[at:]), "en", "a"))
        labels.append((i, int(bad)))
    return docs_of(rows), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_counterfactuals_free_neutral_mentions(spark, docs_of):
    docs, labels = toy(docs_of, spark)
    neutral = [b"the muslims and women served warm soup for guests", b"women went to the meeting about water", b"muslims cooks"]
    insults = [b"the nitwit served soup", b"scumbag", b"what dreckskerl would"]
    fair, blunt = tx.fit(docs, labels), tx.fit(docs, labels, penalty=0.0)
    assert (fair.scores(neutral) < 0.2).all() and (fair.scores(insults) > 0.7).all()
    assert (blunt.scores(neutral[:1]) > 3 * fair.scores(neutral[:1])).all()
    for a, b in (("women", "men"), ("muslims", "people"), ("muslims", "jews")):
        p, q = fair.scores([f"the {a} served".encode(), f"the {b} served".encode()])
        assert abs(p - q) < 0.05


def test_counterfactual_pairs():
    got = list(tx.counterfactuals("the women left. it rained all day! muslims and jews sang\nshort"))
    assert len(got) == 3
    swapped = {a: b for _, a, b in got}
    b = swapped["the women left"]
    assert b != "the women left" and b.split()[1] in tx.GROUPS[2]
    b = swapped[" muslims and jews sang"].split()
    assert b[0] in tx.GROUPS[0] and b[2] in tx.GROUPS[0] and b[0] != "muslims" and b[2] != "jews"
    assert list(tx.counterfactuals("")) == [] and list(tx.counterfactuals("...\n")) == []


def test_held_out_texts(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    want = {r.doc_id: r.toxic for r in labels.collect()}
    got = tx.classify(docs, labels).collect()
    assert len(got) == docs.count() and all(r.predicted == int(r.score >= 0.7) and 0 <= r.score <= 1 for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    held = [r for r in got if r.held_out and want.get(r.doc_id) is not None]
    bad, good = ([r for r in held if want[r.doc_id] == c] for c in (1, 0))
    assert np.mean([r.predicted for r in good]) < 0.03
    assert np.mean([(a.score > b.score) + 0.5 * (a.score == b.score) for a in bad for b in good]) > 0.85


def test_labels_do_not_reach_scores_and_reruns_agree(spark, docs_of):
    docs, labels = toy(docs_of, spark)
    model = tx.fit(docs, labels)
    again = tx.fit(docs.repartition(7), labels.repartition(3))
    assert (model.kept == again.kept).all() and np.allclose(model.weights, again.weights) and np.isclose(model.bias, again.bias)
    a = {r.doc_id: r.score for r in tx.score(docs, model).collect()}
    b = {r.doc_id - 1: r.score for r in tx.score(docs.selectExpr("doc_id + 1 as doc_id", "text"), model).collect()}
    assert a == b


def test_awkward_rows(spark, awkward, docs_of):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.score for r in tx.classify(awkward, none).collect()} == {0.5}
    odd = spark.createDataFrame([(1, 0, "x"), (1, 1, "x"), (None, 1, "x"), (2, 0, "x"), (2, 0, "x"), (6, 7, "x"), (3, None, "x"), (7, 1, "x"),
                                 (9, 0, "x")], "doc_id long, toxic int, text string")
    got = tx.classify(awkward, odd).collect()
    assert len(got) == awkward.count() and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id in (3, 4, 5)}) == 1
    assert [r.held_out for r in got if r.doc_id is None] == [True, True]
    assert tx.classify(docs_of([]), odd).count() == 0
