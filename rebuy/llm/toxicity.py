"""Toxicity by a counterfactually regularised linear classifier.

A text is the set of its words, their first and their last 4 to 6 letters
(spelling variants and compounds share those).  Of these features the ``most``
that lean most surely towards toxic texts are kept; a logistic model over them is fitted
in numpy on a bounded number of labelled texts, whole ones.  Weights are never
negative: no amount of harmless text makes up for an insult.

The fit is regularised by counterfactuals: sentences of labelled texts that
mention a group of people, each beside itself with the term swapped for another
of its kind or for a neutral word, and one sentence a text in which a word gives
way to a term, beside itself with another.  The squared change of the score
across such a pair is part of the loss, so group terms that merely keep bad
company in the labels carry no weight of their own.

Learning reads the labelled texts in Spark tasks; the driver sees the counts of
the best features, the kept features of the drawn texts (``rows`` a class) and
of ``pairs`` sentence pairs, all bounded by parameters.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rebuy.llm.heldout import labelled_texts, with_texts
from rebuy.llm.shared import coded_words, slices, stored, word_hashes

CUT = 0.7
ROWS = 3000         # labelled texts of each class that are learned from
MOST = 3072         # features kept
PAIRS = 4000        # sentence pairs
LEAST_G = 25.0      # twice the log of how unlikely a feature's lean towards label 1 must be by chance
PENALTY = 4.0       # weight of the counterfactual term
RIDGE = 0.03        # by the number of texts learned from
LASSO = 0.03
STEPS = 400
SEED = 11
ENDS = (4, 5, 6)
BLOCK = 1 << 22

# Terms for groups of people, by kind; the last of each is neutral.
GROUPS = (
    ("muslims", "christians", "jews", "hindus", "buddhists", "sikhs", "atheists", "catholics", "people"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "sikh", "atheist", "catholic", "young"),
    ("women", "men", "girls", "boys", "mothers", "fathers", "persons"),
    ("woman", "man", "girl", "boy", "mother", "father", "person"),
    ("female", "male", "transgender", "nonbinary", "tall"),
    ("gay", "lesbian", "straight", "bisexual", "queer", "homosexual", "heterosexual", "friendly"),
    ("black", "white", "asian", "african", "latino", "arab", "european", "american", "mexican", "indian", "local"),
    ("immigrants", "refugees", "foreigners", "natives", "citizens", "neighbours"),
    ("deaf", "blind", "disabled", "autistic", "elderly", "old", "quiet"),
    ("frauen", "männer", "muslime", "christen", "juden", "ausländer", "flüchtlinge", "leute"),
    ("femmes", "hommes", "musulmans", "chrétiens", "juifs", "étrangers", "réfugiés", "gens"),
    ("mujeres", "hombres", "musulmanes", "cristianos", "judíos", "extranjeros", "refugiados", "gente"),
)


def word_mask(data: np.ndarray) -> np.ndarray:
    """Bytes of words in lower-case UTF-8: letters, digits, apostrophes and all
    beyond ASCII but spaces and signs of the Latin-1, general and CJK punctuation."""
    word = (data >= 0x80) | ((data >= 97) & (data <= 122)) | ((data >= 48) & (data <= 57)) | (data == 39)
    for head, low, size in (((0xC2,), 0xA0, 2), ((0xE2, 0x80), 0x80, 3), ((0xE2, 0x81), 0x80, 3), ((0xE3, 0x80), 0x80, 3)):
        at = np.flatnonzero(data[:len(data) - size + 1] == head[0])
        for j, b in enumerate(head[1:], 1):
            at = at[data[at + j] == b]
        at = at[data[at + len(head)] >= low]
        for j in range(size):
            word[at + j] = False
    return word


def word_features(names: pa.BinaryArray) -> np.ndarray:
    """Features of each word, 64-bit numbers (0: none): the word itself, its first
    and its last 4, 5 and 6 bytes where it is longer."""
    n = len(names)
    edge = np.frombuffer(names.buffers()[1], np.int32)[names.offset:names.offset + n + 1].astype(np.int64)
    data = np.frombuffer(names.buffers()[2] or b"", np.uint8)
    begin, size = edge[:-1], np.diff(edge)
    out = np.zeros((n, 1 + 2 * len(ENDS)), np.uint64)
    out[:, 0] = word_hashes(names) | np.uint64(1)
    for c, k in enumerate(ENDS):
        longer = np.flatnonzero(size > k)
        for side, start in ((1, begin[longer]), (2, edge[1:][longer] - k)):
            value = np.full(len(longer), side * 8 + k, np.uint64)      # up to 6 bytes are the number itself
            for i in range(k):
                value = (value << np.uint64(8)) | data[start + i]
            out[longer, 1 + 2 * c + side - 1] = value << np.uint64(1)
    return out


def parts_of(texts: list[bytes], most: int = BLOCK):
    """Groups of (row, bytes) of about ``most`` bytes; a long text is cut where a
    blank allows."""
    held: list[tuple[int, bytes]] = []
    size = 0
    for i, t in enumerate(texts):
        at = 0
        while at < len(t) or (at == 0 and not t):
            end = len(t)
            if end - at > most:
                gap = max(t.rfind(b" ", at, at + most), t.rfind(b"\n", at, at + most))
                gap = gap if gap > at else t.find(b" ", at + most)
                end = gap + 1 if gap > at else end
            held.append((i, t[at:end]))
            size += end - at
            at = end
            if size >= most:
                yield held
                held, size = [], 0
            if not t:
                break
    if held:
        yield held


def found(texts: list[bytes], kept: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, feature) of lower-case texts; with ``kept``, sorted features,
    only those, and as places in it."""
    rows, feats = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64 if kept is None else np.int64)]
    for held in parts_of(texts):
        data = np.frombuffer(b"\n".join(t for _, t in held) + b"\n", np.uint8)
        word = word_mask(data)
        edges = np.flatnonzero(np.diff(word.astype(np.int8), prepend=0, append=0))
        if not len(edges):
            continue
        code, names = coded_words(data, edges)
        own = word_features(names)
        sizes = np.array([len(t) + 1 for _, t in held], np.int64)
        row = np.array([i for i, _ in held], np.int64)[np.searchsorted(np.cumsum(sizes), edges[::2], "right")]
        if kept is not None:
            at = np.searchsorted(kept, own).clip(max=max(0, len(kept) - 1))
            hit = (kept[at] == own) & (own != 0) if len(kept) else np.zeros(own.shape, bool)
            code_hit = hit.any(axis=1)[code]
            row, code = row[code_hit], code[code_hit]
            own = np.where(hit, at, -1)
        pair = np.unique(np.stack([row, code], axis=1), axis=0) if len(row) else np.zeros((0, 2), np.int64)
        r = np.repeat(pair[:, 0], own.shape[1])
        f = own[pair[:, 1]].ravel()
        use = f != 0 if kept is None else f >= 0
        rows.append(r[use])
        feats.append(f[use])
    r, f = np.concatenate(rows), np.concatenate(feats)
    order = np.lexsort((f, r))
    r, f = r[order], f[order]
    first = np.ones(len(r), bool)
    first[1:] = (r[1:] != r[:-1]) | (f[1:] != f[:-1])
    return r[first], f[first]


class Model:
    """Sorted features, their weights and the bias."""

    def __init__(self, kept: np.ndarray, weights: np.ndarray, bias: float):
        use = weights > 0
        self.kept, self.weights, self.bias = kept[use], weights[use], bias

    def scores(self, texts: list[bytes]) -> np.ndarray:
        row, at = found(texts, self.kept)
        z = self.bias + np.bincount(row, self.weights[at], len(texts))
        return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def optimise(x: np.ndarray, y: np.ndarray, change: np.ndarray, prior: float, penalty: float, steps: int = STEPS,
             rate: float = 0.1) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise the class-balanced log loss, plus ``penalty``
    times the mean squared score change over the rows of ``change``."""
    w, bias = np.zeros(x.shape[1], np.float32), np.float32(0)
    share = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum())).astype(np.float32)
    m, v = np.zeros(len(w) + 1, np.float32), np.zeros(len(w) + 1, np.float32)
    for step in range(1, steps + 1):
        p = 1 / (1 + np.exp(-np.clip(x @ w + bias, -30, 30)))
        err = share * (p - y).astype(np.float32)
        g = x.T @ err + (RIDGE * w + LASSO) / len(x)
        if len(change):
            g += 2 * penalty / len(change) * (change.T @ (change @ w))
        g = np.append(g, err.sum()).astype(np.float32)
        m += 0.1 * (g - m)
        v += 0.001 * (g * g - v)
        move = rate * (1 - (step / (steps + 1)) ** 2) * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
        w = np.maximum(w - move[:-1], 0)
        bias -= move[-1]
    return w, float(bias) + float(np.log(prior / (1 - prior)))


KIND_OF = {t: (g, i) for g, terms in enumerate(GROUPS) for i, t in enumerate(terms[:-1])}
TERM = re.compile(r"(?<!\w)(?:" + "|".join(sorted(KIND_OF, key=len, reverse=True)) + r")(?!\w)")
SENTENCE = re.compile(r"[^.!?\n]+")


def counterfactuals(text: str):
    """(ticket, sentence, sentence with the group term swapped) of a lower-case
    text: each sentence with terms, and one more with a word made a term."""
    one: tuple[int, str] | None = None
    for m in SENTENCE.finditer(text):
        s = m.group()
        ticket = xxhash.xxh64_intdigest(s, SEED) >> 1
        if TERM.search(s):
            def swap(t, ticket=ticket):
                g, i = KIND_OF[t.group()]
                return GROUPS[g][(i + 1 + ticket % (len(GROUPS[g]) - 1)) % len(GROUPS[g])]
            yield ticket, s, TERM.sub(swap, s)
        elif (one is None or ticket < one[0]) and " " in s.strip():
            one = ticket, s
    if one:
        ticket, s = one
        words = s.split(" ")
        g = GROUPS[ticket % len(GROUPS)]
        at, i = ticket // 7 % len(words), ticket // 11 % len(g)
        a, b = ([*words[:at], g[j], *words[at + 1:]] for j in (i, (i + 1 + ticket // 13 % (len(g) - 1)) % len(g)))
        yield ticket, " ".join(a), " ".join(b)


def _low(docs: DataFrame) -> Column:
    return F.lower(F.coalesce("text", F.lit("")))


def is_held_out(doc_id: str = "doc_id") -> Column:
    """True where crc32 of the id as text leaves 1 modulo 3, and for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(True))


def _bytes(b: pa.RecordBatch) -> list[bytes]:
    return b.column("text").cast(pa.large_binary()).to_pylist()


def _telling(texts: DataFrame, most: int, n0: int, n1: int) -> np.ndarray:
    """The features that lean most surely towards label 1, sorted."""
    def run(batches):
        for b in slices(batches):
            label = b.column("label").to_numpy()
            row, f = found(_bytes(b))
            values, at = np.unique(f, return_inverse=True)
            bad = np.bincount(at, label[row], len(values)).astype(np.int64)
            every = np.bincount(at, minlength=len(values))
            yield pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(bad), pa.array(every - bad)], ["f", "n1", "n0"])
    counts = texts.mapInArrow(run, "f long, n1 long, n0 long").groupBy("f").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0"))
    every = F.col("n1") + F.col("n0")
    lean = sum(2 * F.col(c) * F.log(F.greatest(F.col(c), F.lit(1)) * (n0 + n1) / (every * n)) for c, n in (("n1", n1), ("n0", n0)))
    best = (counts.filter(F.col("n1") * n0 > F.col("n0") * n1).withColumn("g", lean)
            .filter(F.col("g") >= LEAST_G).orderBy(F.desc("g"), "f").limit(most))
    return np.sort(np.array([r["f"] for r in best.select("f").collect()], np.int64).view(np.uint64))


def fit(docs: DataFrame, labels: DataFrame, rows: int = ROWS, pairs: int = PAIRS, most: int = MOST,
        penalty: float = PENALTY) -> Model | None:
    """Learn from labelled texts that are not held out; None unless both classes
    are there."""
    drawn = labelled_texts(docs, labels, "toxic", is_held_out(), rows, SEED)
    if drawn is None:
        return None
    picked, prior = drawn
    texts = stored(with_texts(docs, picked).withColumn("text", _low(docs)), "toxic-texts")
    n = {r["label"]: r["count"] for r in texts.groupBy("label").count().collect()}
    kept = _telling(texts, most, n[0], n[1])

    def known(batches):
        for b in slices(batches):
            row, at = found(_bytes(b), kept)
            ends = np.searchsorted(row, np.arange(b.num_rows + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([b.column("label"), pa.ListArray.from_arrays(ends, pa.array(at.astype(np.int32)))],
                                             ["label", "at"])

    def swapped(batches):
        for b in slices(batches):
            trio = [t for text in b.column("text").to_pylist() for t in counterfactuals(text)]
            lists = []
            for side in (1, 2):
                row, at = found([t[side].encode() for t in trio], kept)
                ends = np.searchsorted(row, np.arange(len(trio) + 1)).astype(np.int32)
                lists.append(pa.ListArray.from_arrays(ends, pa.array(at.astype(np.int32))))
            yield pa.RecordBatch.from_arrays([pa.array([t[0] for t in trio], pa.int64()), *lists], ["ticket", "a", "b"])

    learn = texts.mapInArrow(known, "label int, at array<int>").collect()                # 2 * rows, ``most`` numbers each at most
    learn.sort(key=lambda r: (r["label"], r["at"]))
    both = (texts.mapInArrow(swapped, "ticket long, a array<int>, b array<int>").filter("a <> b")
            .orderBy("ticket", "a", "b").limit(pairs).collect())
    x = np.zeros((len(learn), len(kept)), np.float32)
    for i, r in enumerate(learn):
        x[i, r["at"]] = 1
    change = np.zeros((len(both), len(kept)), np.float32)
    for i, r in enumerate(both):
        change[i, r["a"]] += 1
        change[i, r["b"]] -= 1
    w, bias = optimise(x, np.array([r["label"] for r in learn], np.float32), change, prior, penalty)
    return Model(kept, w.astype(float), bias)


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, score for every row; null texts score as empty ones.  Without a
    model every score is 0.5."""
    ctx = docs.sparkSession.sparkContext.broadcast(model)       # a number per kept feature

    def run(batches):
        model = ctx.value
        for b in slices(batches, BLOCK):
            s = model.scores(_bytes(b)) if model else np.full(b.num_rows, 0.5)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(s)], ["doc_id", "score"])
    return docs.select(F.col("doc_id").cast("long"), _low(docs).alias("text")).mapInArrow(run, "doc_id long, score double")


def classify(docs: DataFrame, labels: DataFrame, cut: float = CUT, **fit_options) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text; other columns are ignored):
    doc_id, held_out, score, predicted.  ``labels``: doc_id, toxic.

    A null doc_id counts as held out.  Labels that are null or neither 0 nor 1
    teach nothing; of several labels of a document the largest counts, and each
    different text of a document is learned from.  Empty, null and wordless
    texts score the bias; very long ones are read whole.  With one class missing
    every score is 0.5; an empty table returns no rows."""
    out = score(docs, fit(docs, labels, **fit_options))
    return out.select("doc_id", is_held_out().alias("held_out"), "score", (F.col("score") >= cut).cast("int").alias("predicted"))
