"""Quality by compression: zstandard dictionaries of good and of bad text.

A window of text is compressed twice, with a dictionary built from good and
with one built from bad labelled windows.  The size difference (bad - good) is
normalised by the sizes' sum and by the window's length: positive when good
text explains the window better, and near zero by length where the window
hardly holds anything (one word over and over).  A text's windows, end to end,
give the mean, the least and the largest of both (junk may fill only a part of
a text).  A logistic fit on labelled texts, each measured with dictionaries it
had no part in, calibrates these into a probability.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rebuy.llm.heldout import is_held_out, labelled_texts, with_texts
from rebuy.llm.shared import slices, stored

WINDOW = 128
DICT_BYTES = 112640
ROWS = 2000             # labelled texts per class that are learned from
DICT_WINDOWS = 48       # windows of each that a dictionary may see, from hashed places
LEVEL = 3
CUT = 0.7
FEATURES = 6
SEED = 3


def pieces(text: bytes, size: int = WINDOW) -> list[bytes]:
    """Windows end to end; a short tail joins the window before it."""
    n = max(1, len(text) // size)
    return [text[i * size:(i + 1) * size] if i < n - 1 else text[i * size:] for i in range(n)]


class Model:
    """Two dictionaries and the calibration (mean, scale, weights, bias)."""

    def __init__(self, good: bytes, bad: bytes):
        self.good, self.bad = good, bad
        self.mean, self.scale = np.zeros(FEATURES), np.ones(FEATURES)
        self.weights, self.bias = np.zeros(FEATURES), 0.0

    def compressors(self):
        return [zstandard.ZstdCompressor(dict_data=_loaded(d), write_content_size=False, write_dict_id=False)
                for d in (self.good, self.bad)]

    def features(self, text: bytes, compressors) -> list[float]:
        good, bad = (c.compress for c in compressors)
        found = np.array([(len(good(w)), len(bad(w)), len(w)) for w in pieces(text)], float)
        size = np.maximum(found[:, 2], 1)
        diff = found[:, 1] - found[:, 0]
        out: list[float] = []
        for d in (diff / (found[:, 0] + found[:, 1]), diff / size):
            out += [float(np.average(d, weights=size)), float(d.min()), float(d.max())]
        return out

    def score(self, features: np.ndarray) -> np.ndarray:
        z = ((features - self.mean) / self.scale) @ self.weights + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -35, 35)))

    def calibrate(self, features: np.ndarray, label: np.ndarray, prior: float) -> None:
        """Newton steps for the logistic fit.  Classes were drawn in equal
        numbers; the bias is moved back to the share ``prior`` of label 1."""
        self.mean, self.scale = features.mean(axis=0), features.std(axis=0) + 1e-9
        x = np.column_stack(((features - self.mean) / self.scale, np.ones(len(features))))
        w = np.zeros(FEATURES + 1)
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -35, 35)))
            ridge = 1e-3 * (np.arange(FEATURES + 1) < FEATURES)
            step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge + 1e-9),
                                   x.T @ (label - p) - ridge * w)
            w += np.clip(step, -5, 5)
            if np.abs(step).max() < 1e-8:
                break
        drawn = label.mean()
        self.weights = w[:FEATURES]
        self.bias = w[FEATURES] + np.log(prior / (1 - prior)) - np.log(drawn / (1 - drawn))


def _loaded(content: bytes) -> zstandard.ZstdCompressionDict:
    d = zstandard.ZstdCompressionDict(content)
    d.precompute_compress(level=LEVEL)
    return d


def build_dictionary(samples: list[bytes]) -> bytes:
    """A zstandard dictionary of the windows; few or tiny windows serve as raw
    content instead, which the trainer would refuse."""
    try:
        return zstandard.train_dictionary(DICT_BYTES, samples, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICT_BYTES:] or b"........"


def hashed_windows(text: bytes, most: int, seed: int = SEED) -> list[bytes]:
    """At most ``most`` windows of a text, those whose place and content hash lowest."""
    cut = [w for w in pieces(text) if w]
    if len(cut) > most:
        order = sorted(range(len(cut)), key=lambda i: xxhash.xxh64_intdigest(b"%d|" % i + cut[i], seed))
        cut = [cut[i] for i in sorted(order[:most])]
    return cut


def fit(docs: DataFrame, labels: DataFrame, rows: int = ROWS, dict_windows: int = DICT_WINDOWS) -> Model | None:
    """Learn from labelled texts that are not held out, at most ``rows`` of each
    class and, for the dictionaries, ``dict_windows`` windows of each.

    The texts fall into two halves.  Each half is measured, whole and in Spark
    tasks, with the dictionaries of the other one, which calibrates; the model's
    own dictionaries are those of both.  The driver gets the windows and
    ``FEATURES`` numbers a text.  None unless both classes are there with two
    texts or more."""
    drawn = labelled_texts(docs, labels, "quality", is_held_out(), rows, SEED)
    if drawn is None:
        return None
    picked, prior = drawn
    spark, ids = docs.sparkSession, picked.collect()           # ids only, a bounded number
    ids.sort(key=lambda r: xxhash.xxh64_intdigest(f"{r['doc_id']}|{r['text_key']}", SEED))
    roles = []
    for c in (1, 0):
        own = [r for r in ids if r["label"] == c]
        if len(own) < 2:
            return None
        roles += [(r["doc_id"], r["text_key"], c, i % 2) for i, r in enumerate(own)]
    dealt = spark.createDataFrame(roles, "doc_id long, text_key long, label int, half int")
    texts = stored(with_texts(docs, dealt), "quality-texts")

    def windows(batches):
        for b in slices(batches):
            cut = [hashed_windows(t, dict_windows) for t in b.column("text").cast(pa.large_binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("label"), b.column("half"), pa.array(cut, pa.list_(pa.binary()))],
                                             ["label", "half", "w"])
    taught = texts.mapInArrow(windows, "label int, half int, w array<binary>").collect()

    def model_of(halves: tuple[int, ...]) -> Model:
        return Model(*(build_dictionary(sorted(bytes(w) for r in taught if r["label"] == c and r["half"] in halves for w in r["w"]))
                       for c in (1, 0)))
    ctx = spark.sparkContext.broadcast([model_of((1,)), model_of((0,))])        # by the half that they measure

    def measured(batches):
        models = ctx.value
        tools = [m.compressors() for m in models]
        for b in slices(batches):
            x = [models[h].features(t, tools[h]) for t, h in zip(b.column("text").cast(pa.large_binary()).to_pylist(),
                                                                 b.column("half").to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column("label"), pa.array(x, pa.list_(pa.float64()))], ["label", "x"])
    rest = texts.mapInArrow(measured, "label int, x array<double>").collect()
    rest.sort(key=lambda r: (r["label"], r["x"]))
    model = model_of((0, 1))
    model.calibrate(np.array([r["x"] for r in rest]), np.array([r["label"] for r in rest], float), prior)
    return model


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, score for every row; null and empty texts score as empty text.
    Without a model every score is 0.5."""
    ctx = docs.sparkSession.sparkContext.broadcast(model)    # two dictionaries of DICT_BYTES

    def run(batches):
        model = ctx.value
        tools = model.compressors() if model else None
        for b in slices(batches):
            texts = [t.as_py() or b"" for t in b.column("text").cast(pa.large_binary())]
            s = (model.score(np.array([model.features(t, tools) for t in texts]).reshape(-1, FEATURES))
                 if model else np.full(len(texts), 0.5))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(s)], ["doc_id", "score"])
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, score double")


def classify(docs: DataFrame, labels: DataFrame, cut: float = CUT) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text; other columns are ignored):
    doc_id, held_out, score, predicted.  ``labels``: doc_id, quality.  A null
    doc_id counts as held out; labels that are null or neither 0 nor 1 teach
    nothing; of several labels of a document the largest counts, and each
    different text of a document is a text of its own; an empty table returns no
    rows."""
    out = score(docs, fit(docs, labels))
    return out.select("doc_id", is_held_out().alias("held_out"), "score",
                      (F.col("score") >= cut).cast("int").alias("predicted"))
