"""Language ID: a byte convolutional network over fixed-length windows.

The network reads ``WINDOW`` bytes.  Filters of several widths slide over them
(one weight per filter, tap and byte value), the largest response of each
filter in the window is rectified, and a softmax layer turns those into
language probabilities.  It is trained in numpy by Adam on a bounded sample of
labelled texts.  A text is cut into windows end to end, the last one padded;
its score is the length-weighted mean of the windows' probabilities, so every
byte of every text counts and memory stays at one block of windows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rebuy.llm.heldout import is_held_out, labelled_sample
from rebuy.llm.shared import slices

WINDOW = 128
WIDTHS = (2, 3, 4)
FILTERS = 16            # of each width
TRAIN_ROWS = 1500       # labelled texts per language that the training may see
TRAIN_WINDOWS = 2       # windows of each
STEPS = 1500            # training steps of BATCH windows each, however many texts there are
BATCH = 64
SEED = 5
SURE = 0.5               # probability from which a window's language counts as known
BLOCK_WINDOWS = 512
CACHED_WINDOWS = 32     # windows whose responses are at hand at a time: 800 KB, which a core's cache holds
PAD = 0


class ByteCNN:
    """taps[w]: (w, 256, FILTERS) weights; dense: (all filters, languages)."""

    def __init__(self, langs: list[str], seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.langs = langs
        self.taps = [rng.normal(0, 0.3, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS]
        self.conv_bias = np.zeros(len(WIDTHS) * FILTERS, np.float32)
        self.dense = rng.normal(0, 0.2, (len(WIDTHS) * FILTERS, len(langs))).astype(np.float32)
        self.bias = np.zeros(len(langs), np.float32)

    def responses(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Largest response of each filter in each window, and where."""
        top, where = [], []
        for w, taps in zip(WIDTHS, self.taps):
            n = x.shape[1] - w + 1
            r = taps[0][x[:, :n]]
            for j in range(1, w):
                r += taps[j][x[:, j:j + n]]
            at = r.argmax(axis=1)
            top.append(np.take_along_axis(r, at[:, None, :], axis=1)[:, 0])
            where.append(at)
        return np.concatenate(top, axis=1), np.concatenate(where, axis=1)

    def train(self, x: np.ndarray, y: np.ndarray, steps: int = STEPS, batch: int = BATCH,
              rate: float = 0.01, seed: int = SEED) -> None:
        rng = np.random.default_rng(seed)
        params = [*self.taps, self.conv_bias, self.dense, self.bias]
        m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        order = np.empty(0, np.int64)
        for step in range(1, steps + 1):
            if len(order) < batch:
                order = np.concatenate((order, rng.permutation(len(x))))
            i, order = order[:batch], order[batch:]
            lr = rate * (1 - (step / (steps + 1)) ** 2)
            for p, g, mm, vv in zip(params, self._gradients(x[i], y[i]), m, v):
                mm += 0.1 * (g - mm)
                vv += 0.001 * (g * g - vv)
                p -= lr * (mm / (1 - 0.9 ** step)) / (np.sqrt(vv / (1 - 0.999 ** step)) + 1e-8)

    def _gradients(self, x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        top, where = self.responses(x)
        hidden = np.maximum(top + self.conv_bias, 0)
        p = softmax(hidden @ self.dense + self.bias)
        p[np.arange(len(y)), y] -= 1
        p /= len(y)
        back = (p @ self.dense.T) * (hidden > 0)
        grads, rows = [], np.arange(len(x))[:, None]
        for k, (w, taps) in enumerate(zip(WIDTHS, self.taps)):
            cols = slice(k * FILTERS, (k + 1) * FILTERS)
            g = np.zeros_like(taps)
            for j in range(w):
                seen = x[rows, where[:, cols] + j]          # the byte under tap j of each filter's best place
                flat = seen.astype(np.int64) * FILTERS + np.arange(FILTERS)
                g[j] = np.bincount(flat.ravel(), back[:, cols].ravel(), 256 * FILTERS).reshape(256, FILTERS)
            grads.append(g + 1e-5 * taps)
        return [*grads, back.sum(axis=0), hidden.T @ p + 1e-4 * self.dense, p.sum(axis=0)]

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Responses by byte pairs: what the first two bytes under all filters
        add, and what the next two (or one) under the wider ones add."""
        a, b = np.divmod(np.arange(65536), 256)
        first = np.concatenate([t[0][a] + t[1][b] for t in self.taps], axis=1)
        rest = np.concatenate([self.taps[1][2][a], self.taps[2][2][a] + self.taps[2][3][b]], axis=1)
        return np.ascontiguousarray(first), np.ascontiguousarray(rest)

    def probabilities(self, x: np.ndarray, tables) -> np.ndarray:
        """Language probabilities of each window (row) of bytes."""
        top = np.concatenate([self._tops(x[a:a + CACHED_WINDOWS], tables) for a in range(0, len(x), CACHED_WINDOWS)])
        return softmax(np.maximum(top + self.conv_bias, 0) @ self.dense + self.bias)

    def _tops(self, x: np.ndarray, tables) -> np.ndarray:
        """Largest response of each filter in each of a few windows."""
        first, rest = tables
        places = np.ascontiguousarray(x.T).astype(np.intp)
        pair = (places[:-1] << 8) | places[1:]
        r = first.take(pair, axis=0)                        # (WINDOW - 1, windows, all filters)
        more = rest.take(pair[2:], axis=0)
        n = len(more)
        f = FILTERS
        r[:n, :, f:] += more
        top = r[:n].max(axis=0)
        # the last places have no room for the wider filters
        np.maximum(top[:, :f], r[n:, :, :f].max(axis=0), out=top[:, :f])
        np.maximum(top[:, f:2 * f], self._last(x), out=top[:, f:2 * f])
        return top

    def _last(self, x: np.ndarray) -> np.ndarray:
        """The width-3 filters at the last place, which no pair table covers."""
        t = self.taps[1]
        return t[0][x[:, -3]] + t[1][x[:, -2]] + t[2][x[:, -1]]


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def windows(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of many texts end to end: (windows, text of each, its bytes)."""
    sizes = np.array([len(t) for t in texts], np.int64)
    counts = -(-sizes // WINDOW)
    x = np.full(int(counts.sum()) * WINDOW, PAD, np.uint8)
    begin = (np.cumsum(counts) - counts) * WINDOW
    for b, t in zip(begin.tolist(), texts):
        x[b:b + len(t)] = np.frombuffer(t, np.uint8)
    text = np.repeat(np.arange(len(texts)), counts)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)
    return x.reshape(-1, WINDOW), text, np.minimum(sizes[text] - nth * WINDOW, WINDOW)


def text_scores(model: ByteCNN, tables, texts: list[bytes], piece: int = 1 << 20) -> np.ndarray:
    """Mean probabilities of each text (rows); zeros for an empty one."""
    return shares(model, tables, texts, piece)[0]


def shares(model: ByteCNN, tables, texts: list[bytes], piece: int = 1 << 20) -> tuple[np.ndarray, np.ndarray]:
    """Mean probabilities of each text (rows) and the share of its bytes in
    windows with some language at ``SURE`` or more; zeros for an empty one."""
    total = np.zeros((len(texts), len(model.langs)))
    weight, sure = np.zeros(len(texts)), np.zeros(len(texts))
    held: list[tuple[int, bytes]] = []

    def flush() -> None:
        x, text, size = windows([t for _, t in held])
        row = np.array([i for i, _ in held])[text]
        for a in range(0, len(x), BLOCK_WINDOWS):
            s = slice(a, a + BLOCK_WINDOWS)
            p = model.probabilities(x[s], tables)
            sure[:] += np.bincount(row[s], size[s] * (p.max(axis=1) >= SURE), len(texts))
            p = p * size[s, None]
            for c in range(p.shape[1]):
                total[:, c] += np.bincount(row[s], p[:, c], len(texts))
            weight[:] += np.bincount(row[s], size[s], len(texts))
        held.clear()
    size = 0
    for i, t in enumerate(texts):
        for a in range(0, len(t), piece):
            held.append((i, t[a:a + piece]))
            size += len(held[-1][1])
            if size >= piece:
                flush()
                size = 0
    if held:
        flush()
    weight = np.maximum(weight, 1)
    return total / weight[:, None], sure / weight


def fit(docs: DataFrame, train_rows: int = TRAIN_ROWS, train_windows: int = TRAIN_WINDOWS,
        seed: int = SEED) -> ByteCNN | None:
    """Train on texts with a language that are not held out: at most
    ``train_rows`` texts a language and ``train_windows`` windows of each,
    taken at hashed places.  None when there is no such text."""
    rows = docs.filter(F.col("lang").isNotNull() & ~is_held_out() & F.col("text").rlike(r"\p{L}"))
    drawn = labelled_sample(rows.select("doc_id", "text", "lang"), "lang", train_rows, seed)
    room = F.greatest(F.length("text") - WINDOW, F.lit(1))
    cuts = [F.substring("text", (F.pmod(F.xxhash64(F.lit(seed + i), "doc_id"), room) + 1).cast("int"), F.lit(WINDOW))
            for i in range(train_windows)]
    got = drawn.select("lang", F.array(*cuts).alias("cuts")).toArrow().to_pylist()
    got = sorted(((r["lang"], c.encode()[:WINDOW]) for r in got for c in r["cuts"]), key=lambda r: r)
    if not got:
        return None
    langs = sorted({g for g, _ in got})
    model = ByteCNN(langs, seed)
    x, text, _ = windows([t or b" " for _, t in got])
    y = np.array([langs.index(g) for g, _ in got])
    model.train(x, y)
    return model


def _judge(model: ByteCNN | None, tables, texts: list[bytes], lettered: np.ndarray) -> tuple[list[str], np.ndarray]:
    names, scores = ["und"] * len(texts), np.zeros(len(texts))
    todo = np.nonzero(lettered)[0] if model else np.empty(0, np.int64)
    if len(todo):
        p = text_scores(model, tables, [texts[i] for i in todo])
        for i, k, s in zip(todo.tolist(), p.argmax(axis=1).tolist(), p.max(axis=1).tolist()):
            names[i], scores[i] = model.langs[k], min(1.0, s)
    return names, scores


def _lettered() -> Column:
    return F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))


def predict(docs: DataFrame, model: ByteCNN | None) -> DataFrame:
    """doc_id, lang_pred, score for every row of ``docs`` (doc_id, text).

    lang_pred is a learned language, or ``und`` with score 0 when the text is
    null or has no letter, or when nothing was learned."""
    ctx = docs.sparkSession.sparkContext.broadcast(model)    # a fixed number of weights

    def run(batches):
        model = ctx.value
        tables = model.pairs() if model else None
        for b in slices(batches):
            texts = [t.as_py() for t in b.column("text").cast(pa.large_binary())]
            names, scores = _judge(model, tables, texts, b.column("lettered").to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(names, pa.string()), pa.array(scores)], ["doc_id", "lang_pred", "score"])

    return (docs.select(F.col("doc_id").cast("long"), "text", _lettered().alias("lettered"))
            .mapInArrow(run, "doc_id long, lang_pred string, score double"))


def accepted(docs: DataFrame, model: ByteCNN | None, least_score: float) -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose text has a letter and
    either a language with at least ``least_score`` or, as texts in several
    languages do, a sure language in half of its bytes or more.  With no model
    nothing can be told apart, and every text that has a letter stays."""
    ctx = docs.sparkSession.sparkContext.broadcast(model)
    cols = docs.columns
    flag = "_lettered"
    while flag in cols:
        flag += "_"

    def run(batches):
        model = ctx.value
        tables = model.pairs() if model else None
        for b in slices(batches):
            texts = [t.as_py() for t in b.column("text").cast(pa.large_binary())]
            keep = b.column(flag).to_numpy(zero_copy_only=False).astype(bool)
            todo = np.nonzero(keep)[0]
            if model and len(todo):
                mean, sure = shares(model, tables, [texts[i] for i in todo])
                keep[todo] = (mean.max(axis=1).clip(max=1.0) >= least_score) | (sure >= 0.5)
            yield b.select(cols).filter(pa.array(keep))

    return docs.withColumn(flag, _lettered()).mapInArrow(run, docs.schema)


def identify(docs: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, lang; other columns are
    ignored): doc_id, held_out, lang_pred, score.  Learns as ``fit`` says.
    Null or letterless texts give ``und``; a null doc_id counts as held out;
    an empty table returns no rows."""
    out = predict(docs, fit(docs, train_rows))
    return out.select("doc_id", is_held_out().alias("held_out"), "lang_pred", "score")
