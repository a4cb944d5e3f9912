"""Gradient-boosted trees (binary logistic) by histograms, as Spark jobs.

Features are binned once by quantiles (bin 0: null, which goes left or right,
whichever gains more).  The binned rows stay with the executors, as blocks of
bytes; one job per tree level sums gradients and hessians by (node, feature,
bin) in the tasks next to the rows, a shuffle adds the sums of an ensemble, and
the tasks that receive them pick the splits: only these reach the driver.

Many ensembles grow together: folds and grid points share every job, so a
cross-validation of k folds takes as many jobs as one fit.  A table of at most
``BLOCK_ROWS`` rows (172 MB with its margins) is a single block, binned by many tasks:
it has nothing to add up between tasks, and a tree of it takes less time than the jobs
of its levels would.  Its ensembles grow up to ``LOCAL_STEP`` trees a job, each in a
task of its own, which also takes the AUC of the fold held out; there, of two sibling
nodes the lighter one is summed, the other is the rest of their parent.

Of a larger table each executor keeps the binned rows as files in its scratch space, with
what changes from job to job: margins, the rows of the tree that grows at their nodes, and
the sums of its last level.  A level's job sends only splits and trees to the tasks, which
map what they need, sum the lighter of two siblings and take the rest from their parent.
Files are replaced as a whole and name the tree and level they are of, so a retried task
finds the state it needs or makes it again.  Where files are gone (a lost executor, a task
that ran elsewhere) the blocks are laid down again from their checkpoint and all trees
are replayed on their rows.

Gradients are rounded to multiples of 2^-20 and summed as integers, rows are
drawn by a hash of their key: given the cuts (approximate quantiles), the trees
do not depend on how rows are dealt, and a retried task returns the very same sums.
A single block keeps the margins after its last tree, and is checkpointed with them every
``LOCAL_STEP`` trees.
"""

from __future__ import annotations

import contextlib
import os
import pickle
import shutil
import tempfile
import uuid
from collections.abc import Callable, Generator, Iterable, Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rebuy.session import ensure_checkpoint_dir, on_python_workers

MAX_BINS = 64
SCALE = float(1 << 20)      # gradients per unit
STEP = 25                   # trees between two looks at the AUC
LOCAL_STEP = 100            # trees between checkpoints of a single block
BLOCK_ROWS = 1 << 22        # of a table that is one block
PART_ROWS = 1 << 18         # of a block of a larger table
CHUNK = 1 << 14             # rows summed or sent down a tree at a time
LEAST_GAIN = 1e-6
CURVE_BINS = 4096


@dataclass(frozen=True)
class Spec:
    """Parameters of one ensemble.  Rows of fold ``held_out`` teach nothing;
    ``allowed`` are the features it may use (all, if none are named)."""

    n_estimators: int = 100
    max_depth: int = 6
    learning_rate: float = 0.3
    subsample: float = 1.0
    min_child_weight: float = 1.0
    colsample_bytree: float = 1.0
    reg_lambda: float = 1.0
    seed: int = 42
    held_out: int | None = None
    allowed: tuple[str, ...] = ()


@dataclass
class Tree:
    """Nodes in heap order (children of i: 2i + 1, 2i + 2).  feature -1: a leaf."""

    feature: np.ndarray
    threshold: np.ndarray       # bins up to it go left
    null_left: np.ndarray
    value: np.ndarray
    gain: np.ndarray
    cover: np.ndarray           # sum of hessians

    @classmethod
    def empty(cls, depth: int) -> "Tree":
        n = (2 << depth) - 1
        return cls(np.full(n, -1, np.int16), np.zeros(n, np.uint8), np.zeros(n, bool), np.zeros(n), np.zeros(n), np.zeros(n))

    def descend(self, x: np.ndarray, node: np.ndarray, rows: np.ndarray, levels: int) -> np.ndarray:
        """Where rows that are at ``node`` are ``levels`` further down; those at a leaf stay."""
        if not levels or not len(rows):
            return node
        n, every = len(self.feature), np.arange(256)
        right = np.where(every == 0, ~self.null_left[:, None], every > self.threshold[:, None])
        own = np.arange(n)[:, None]
        after = np.where(self.feature[:, None] < 0, own, 2 * own + 1 + right).ravel()     # by node and bin
        first = np.maximum(self.feature, 0).astype(np.int64) * x.shape[1]
        flat, out = x.reshape(-1), np.empty(len(rows), np.int64)
        for a in range(0, len(rows), CHUNK):
            r, at = rows[a:a + CHUNK], node[a:a + CHUNK]
            for _ in range(levels):
                cell = first.take(at)
                cell += r
                at = at << 8
                at += flat.take(cell)
                at = after.take(at)
            out[a:a + CHUNK] = at
        return out

    def depth(self) -> int:
        return (len(self.feature) + 1).bit_length() - 2

    def values(self, x: np.ndarray) -> np.ndarray:
        n = x.shape[1]
        splits = np.flatnonzero(self.feature >= 0)
        levels = int(splits[-1] + 1).bit_length() if len(splits) else 0
        return self.value.take(self.descend(x, np.zeros(n, np.int64), np.arange(n), levels))


@dataclass
class Block:
    """Binned rows: x (features, rows), label, key hash, fold.  A block with an owner is
    the whole table and holds that ensemble's margins (1, rows)."""

    name: str
    x: np.ndarray
    y: np.ndarray
    key: np.ndarray
    fold: np.ndarray
    margins: np.ndarray | None = None
    trees: int = 0              # those the margins hold
    owner: int = -1



def cut_points(df: DataFrame, features: list[str], max_bins: int = MAX_BINS) -> list[np.ndarray]:
    """Per feature the ascending values between bins: a row's bin is 1 plus the
    cuts below its value.  One pass; at most max_bins - 2 cuts a feature."""
    inner = max_bins - 2
    shares = [(i + 1) / (inner + 1) for i in range(inner)]
    got = df.approxQuantile(features, shares, 1.0 / (8 * max_bins)) if features else []
    return [np.unique(np.array(g, float)) for g in got]


def binned(values: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Bins of float values; NaN is null."""
    return np.where(np.isnan(values), 0, 1 + np.searchsorted(cuts, values, "left")).astype(np.uint8)


def _floats(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return column.cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)


def blocks_of(df: DataFrame, features: list[str], label: str, keys: list[str], cuts: list[np.ndarray], fold: str | None):
    """RDD of Blocks."""
    df = df.select(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(features)],
                   F.col(label).cast("double").alias("y"), F.xxhash64(*keys).alias("key"),
                   (F.col(fold).cast("int") if fold else F.lit(-1)).alias("fold"))

    part_rows = min(BLOCK_ROWS, PART_ROWS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def made():
            x, y, key, fold_ = (np.concatenate(c, axis=-1) for c in zip(*held))
            return pa.RecordBatch.from_arrays([pa.array([a.tobytes()], pa.binary()) for a in (x, y, key, fold_)], ["x", "y", "key", "fold"])
        for b in batches:
            x = np.stack([binned(_floats(b.column(i)), c) for i, c in enumerate(cuts)]) if cuts else np.zeros((0, b.num_rows), np.uint8)
            held.append((x, (_floats(b.column("y")) > 0.5).astype(np.uint8), b.column("key").to_numpy(),
                         b.column("fold").to_numpy().astype(np.int16)))
            if sum(len(h[1]) for h in held) >= part_rows:
                yield made()
                held.clear()
        if held:
            yield made()
    rows = df.mapInArrow(run, "x binary, y binary, key binary, fold binary").rdd
    n_features = len(features)

    def block(pair) -> Block:
        r, i = pair
        y = np.frombuffer(r["y"], np.uint8)
        x = np.frombuffer(r["x"], np.uint8).reshape(n_features, len(y))
        return Block(f"b{i}", x, y, np.frombuffer(r["key"], np.int64).view(np.uint64), np.frombuffer(r["fold"], np.int16))
    return rows.zipWithUniqueId().map(block)


def whole_of(owner: int, parts: list[Block]) -> Block:
    """The table as one block, which holds the margins of one ensemble."""
    parts = sorted(parts, key=lambda b: b.name)
    x, y, key, fold = (np.concatenate([getattr(b, c) for b in parts], axis=-1) for c in ("x", "y", "key", "fold"))
    return Block("all", x, y, key, fold, np.zeros((1, len(y))), owner=owner)


def drawn(key: np.ndarray, share: float, seed: int, tree: int) -> np.ndarray:
    """Which rows a tree sees: a hash of key, seed and tree number below the share."""
    if share >= 1:
        return np.ones(len(key), bool)
    h = key ^ np.uint64((seed * 0x9E3779B97F4A7C15 + tree * 0xD1B54A32D192ED03 + 1) & ((1 << 64) - 1))
    for shift, mult in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(mult)
    return (h ^ (h >> np.uint64(31))) < np.uint64(min((1 << 64) - 1, int(share * 2 ** 64)))


def columns_of(spec: Spec, features: list[str], tree: int) -> np.ndarray:
    """The features that a tree may split on, in order."""
    may = [i for i, f in enumerate(features) if not spec.allowed or f in spec.allowed]
    n = max(1, int(spec.colsample_bytree * len(may)))
    if n >= len(may):
        return np.array(may, np.int64)
    return np.sort(np.random.default_rng([spec.seed, tree]).choice(may, n, replace=False))


def gradients(margin: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    p = 1 / (1 + np.exp(-margin))
    return np.rint((p - y) * SCALE), np.rint(p * (1 - p) * SCALE)


@dataclass
class Level:
    """The sums that a growing tree asks for."""

    tree: Tree
    level: int
    columns: np.ndarray
    slot: np.ndarray            # of each node of the level, -1: not summed
    asked: list[int]            # the nodes that are summed
    nodes: list[int]            # those that may split


@dataclass
class Growing:
    """The rows of a block that a tree sees: their bins, gradients and nodes."""

    number: int
    rows: np.ndarray
    x: list[np.ndarray]         # of the tree's columns
    sums: tuple[np.ndarray, np.ndarray]
    node: np.ndarray
    level: int = 0

    def down(self, block: Block, ask: Level) -> "Growing":
        self.node = ask.tree.descend(block.x, self.node, self.rows, ask.level - self.level)
        self.level = ask.level
        return self


def started(block: Block, spec: Spec, number: int, ask: Level, margin: np.ndarray) -> Growing:
    """The rows that tree ``number`` sees, at its root."""
    use = drawn(block.key, spec.subsample, spec.seed, number)
    if spec.held_out is not None:
        use &= block.fold != spec.held_out
    rows = np.flatnonzero(use)
    return Growing(number, rows, [block.x[c].take(rows) for c in ask.columns], gradients(margin[rows], block.y[rows]),
                   np.zeros(len(rows), np.int64))


@dataclass
class Laid:
    """A block in files of an executor: where they are, no rows."""

    folder: str
    name: str

    def path(self, what: str) -> str:
        return f"{self.folder}/{self.name}.{what}"

    def column(self, name: str) -> np.ndarray:
        return np.asarray(np.load(self.path(f"{name}.npy"), mmap_mode="r"))

    def there(self) -> bool:
        return os.path.exists(self.path("fold.npy"))


def put_file(path: str, *arrays: np.ndarray) -> None:
    """Write a file as a whole: who reads it sees the old one, the new one or none.  The old
    one goes first, as file systems write out at once what takes the place of a file."""
    with open(f"{path}.{os.getpid()}", "wb") as f:
        for a in arrays:
            f.write(np.ascontiguousarray(a).data)
    with contextlib.suppress(FileNotFoundError):
        os.remove(path)
    os.replace(f"{path}.{os.getpid()}", path)


def _bytes(path: str) -> np.ndarray:
    try:
        return np.fromfile(path, np.uint8)
    except FileNotFoundError:
        return np.zeros(0, np.uint8)


def lay(run: str, blocks: Iterable[Block]) -> Iterator[Laid]:
    """Put blocks into this executor's files."""
    folder = f"{scratch()}/boosting-{run}"
    os.makedirs(folder, exist_ok=True)
    for b in blocks:
        to = Laid(folder, b.name)
        if not to.there():
            for c in ("x", "y", "key", "fold"):         # the last one tells that all are there
                at = to.path(f"{c}.{os.getpid()}.npy")
                np.save(at, getattr(b, c))
                os.replace(at, to.path(f"{c}.npy"))
        yield to


def margin_at(block: Laid, slot: str, turn: int, rows: int, number: int, first: int, trees: list[Tree], x: np.ndarray) -> np.ndarray | None:
    """Margins of ``x`` after ``number`` trees, of which ``trees`` are those from ``first`` on;
    None if neither files nor trees give them.  They are kept in two files that take turns."""
    for t in (turn, turn + 1):
        raw = _bytes(block.path(f"{slot}{t % 2}"))
        if len(raw) == 8 * (rows + 1) and first <= (done := int(raw[:8].view(np.int64)[0])) <= number:
            margin = raw[8:].view(np.float64)
            break
    else:
        if first:
            return None
        done, margin = 0, np.zeros(rows)
    for t in trees[done - first:number - first]:
        margin = margin + t.values(x)
    if done < number:
        put_file(block.path(f"{slot}{turn % 2}"), np.array([number]), margin)
    return margin


def growing_at(block: Laid, model: int, spec: Spec, number: int, ask: Level, first: int, trees: list[Tree]) -> Growing | None:
    """The rows of tree ``number``, at their nodes of the level, by their places among
    themselves; None if files and ``trees`` (from ``first`` on) do not give them."""
    rows_, nodes_ = block.path(f"r{model}"), block.path(f"n{model}")
    raw = _bytes(rows_) if ask.level else np.zeros(0, np.uint8)
    if len(raw) and raw[:8].view(np.int64)[0] == number:
        n = int(raw[8:16].view(np.int64)[0])
        sums, x = raw[16:16 + 8 * n].view(np.int32).reshape(2, n), raw[16 + 8 * n:].reshape(len(ask.columns), n)
        node, level = np.zeros(n, np.int64), 0
        own = _bytes(nodes_).view(np.int32)
        if len(own) == n + 2 and own[0] == number and own[1] <= ask.level:
            node, level = own[2:].astype(np.int64), int(own[1])
    else:
        if not block.there():
            return None
        every, y = block.column("x"), block.column("y")
        margin = margin_at(block, f"m{model}.", number, len(y), number, first, trees, every)
        if margin is None:
            return None
        begun = started(Block(block.name, every, y, block.column("key"), block.column("fold")), spec, number, ask, margin)
        n, node, level = len(begun.rows), begun.node, 0
        x = np.stack(begun.x) if begun.x else np.zeros((0, n), np.uint8)
        sums = np.stack(begun.sums).astype(np.int32)
        put_file(rows_, np.array([number, n]), sums, x)
    if ask.level > level:
        tree = replace(ask.tree, feature=np.where(ask.tree.feature < 0, -1, np.searchsorted(ask.columns, ask.tree.feature)))
        node = tree.descend(x, node, np.arange(n), ask.level - level)
        put_file(nodes_, np.array([number, ask.level], np.int32), node.astype(np.int32))
    return Growing(number, np.arange(n), list(x), tuple(sums.astype(float)), node, ask.level)


def level_here(part: int, blocks: list[Laid], model: int, spec: Spec, number: int, ask: Level, first: int, trees: list[Tree],
               bins: int) -> np.ndarray | None:
    """The sums of a level's nodes over the rows of some blocks; None if their files are gone."""
    path = f"{blocks[0].folder}/s{part}.{model}"
    raw = _bytes(path)
    of, level, found = pickle.loads(raw) if len(raw) else (-1, 0, {})
    if (of, level) != (number, ask.level):
        known = ask.level and (of, level) == (number, ask.level - 1)
        if not known:
            slot = np.full(1 << ask.level, -1, np.int64)
            slot[np.array(ask.nodes) - ((1 << ask.level) - 1)] = np.arange(len(ask.nodes))
            ask = replace(ask, slot=slot, asked=ask.nodes)
        sums = 0
        for b in blocks:
            seen = growing_at(b, model, spec, number, ask, first, trees)
            if seen is None:
                return None
            sums = sums + level_sums(seen, ask, bins)
        found = completed(ask, sums, found if known else {})
        put_file(path, np.frombuffer(pickle.dumps((number, ask.level, found)), np.uint8))
    return narrow(np.stack([found[n] for n in ask.nodes]))


def level_sums(seen: Growing, ask: Level, bins: int) -> np.ndarray:
    """(slots, columns, bins, 2) sums of gradients and hessians, integers."""
    slots, columns = len(ask.asked), len(ask.columns)
    out = np.zeros((2, columns, slots * bins))          # whole numbers below 2^53: sums are exact
    first = (1 << ask.level) - 1
    slot = np.where(seen.node >= first, ask.slot.take(np.maximum(seen.node - first, 0)), -1)
    rows = np.flatnonzero(slot >= 0)
    for a in range(0, len(rows), CHUNK):
        r = rows[a:a + CHUNK]
        base = slot.take(r) * bins
        g, h = (v.take(r) for v in seen.sums)
        for i, x in enumerate(seen.x):
            cell = base + x.take(r)
            out[0, i] += np.bincount(cell, g, slots * bins)
            out[1, i] += np.bincount(cell, h, slots * bins)
    return out.reshape(2, columns, slots, bins).transpose(2, 1, 3, 0).astype(np.int64)


def narrow(sums: np.ndarray) -> np.ndarray:
    """The same numbers in half the bytes, where they fit."""
    return sums.astype(np.int32) if sums.size and -2 ** 31 < sums.min() and sums.max() < 2 ** 31 else sums


def completed(ask: Level, sums: np.ndarray, parents: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
    """The sums of every node that may split: the lighter of two siblings is
    summed, the other is the rest of their parent."""
    own = dict(zip(ask.asked, sums))
    return {n: own[n] if n in own else parents[(n - 1) // 2] - own[sibling(n)] for n in ask.nodes}


@dataclass
class Splits:
    """The best split of each node of a level, and the sums left of it and of the node."""

    gain: np.ndarray
    place: np.ndarray
    threshold: np.ndarray
    null_left: np.ndarray
    left: np.ndarray
    whole: np.ndarray


def best_splits(found: dict[int, np.ndarray], spec: Spec) -> Splits:
    """Ties go to the earlier column, the smaller threshold, nulls to the right."""
    sums = np.stack(list(found.values()))
    n, columns, bins, _ = sums.shape
    if not columns:
        none = np.zeros(n, np.int64)
        return Splits(np.full(n, -np.inf), none, none, none > 0, np.zeros((n, 2)), np.zeros((n, 2)))
    g, h = sums[..., 0] / SCALE, sums[..., 1] / SCALE
    total_g, total_h = (v[:, 0].sum(axis=-1)[:, None, None, None] for v in (g, h))
    left_g, left_h = (np.cumsum(v[..., 1:-1], axis=-1) for v in (g, h))
    left_g = np.stack([left_g, left_g + g[..., :1]], axis=-1)
    left_h = np.stack([left_h, left_h + h[..., :1]], axis=-1)
    right_g, right_h = total_g - left_g, total_h - left_h
    lam = spec.reg_lambda
    gain = left_g ** 2 / (left_h + lam) + right_g ** 2 / (right_h + lam) - total_g ** 2 / (total_h + lam)
    least = max(spec.min_child_weight, 1e-9)
    gain[(left_h < least) | (right_h < least)] = -np.inf
    at = gain.reshape(n, -1).argmax(axis=1)
    place, cut, null_left = np.unravel_index(at, gain.shape[1:])
    own = (np.arange(n), place, cut, null_left)
    return Splits(gain[own], place, cut + 1, null_left.astype(bool), np.stack([left_g[own], left_h[own]], axis=1),
                  np.stack([total_g.ravel(), total_h.ravel()], axis=1))


def sibling(n: int) -> int:
    return n + 1 if n % 2 else n - 1


def growing(spec: Spec, features: list[str], number: int, lighter: bool) -> Generator[Level, Splits, Tree]:
    """Grow one tree level by level: yields what is to be summed (with ``lighter``
    only the lighter of two siblings, for who keeps the sums of their parents),
    takes the best splits of the level's nodes, and returns the tree."""
    tree, columns = Tree.empty(spec.max_depth), columns_of(spec, features, number)
    rate, lam = spec.learning_rate, spec.reg_lambda
    nodes = [0]                             # those of the level that may split
    for level in range(spec.max_depth):
        first = (1 << level) - 1
        ask = nodes if not level or not lighter else sorted({min((tree.cover[m], m) for m in (n, sibling(n)))[1] for n in nodes})
        slot = np.full(1 << level, -1, np.int64)
        slot[np.array(ask) - first] = np.arange(len(ask))
        best = yield Level(tree, level, columns, slot, ask, nodes)
        after = []
        for i, n in enumerate(nodes):
            if n == 0:
                g, h = best.whole[0]
                tree.value[0], tree.cover[0] = -rate * g / (h + lam), h
            if best.gain[i] <= LEAST_GAIN:
                continue
            tree.feature[n], tree.threshold[n], tree.null_left[n] = columns[best.place[i]], best.threshold[i], best.null_left[i]
            tree.gain[n] = best.gain[i]
            for child, (g, h) in ((2 * n + 1, best.left[i]), (2 * n + 2, best.whole[i] - best.left[i])):
                tree.value[child], tree.cover[child] = -rate * g / (h + lam), h
                if h >= 2 * spec.min_child_weight:
                    after.append(child)
        nodes = after
        if not nodes:
            break
    return tree


def grow_here(block: Block, model: int, spec: Spec, features: list[str], bins: int,
              first: int, most: int) -> tuple[list[Tree], list[float], Block]:
    """Up to ``most`` more trees from a block that is the whole table, the AUC on the
    fold held out (if any) after each, and the block with their margins."""
    made: list[Tree] = []
    aucs: list[float] = []
    margin = block.margins[0]
    held = np.flatnonzero(block.fold == spec.held_out) if spec.held_out is not None else None
    for number in range(first, min(first + most, spec.n_estimators)):
        grower = growing(spec, features, number, True)
        ask, sums = next(grower), {}
        seen = started(block, spec, number, ask, margin)
        try:
            while True:
                sums = completed(ask, level_sums(seen.down(block, ask), ask, bins), sums)
                ask = grower.send(best_splits(sums, spec))
        except StopIteration as end:
            made.append(end.value)
        margin = margin + made[-1].values(block.x)
        if held is not None:
            s = margin[held]
            ends = (s.min(), s.max()) if len(s) else (np.inf, -np.inf)
            aucs.append(float(auc_of(steps(s, block.y[held], *ends)[None])[0]))
    return made, aucs, replace(block, margins=margin[None], trees=block.trees + len(made))


def scratch() -> str:
    """The folder of an executor's own files, as seen from its Python workers; it goes with the application."""
    return os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0] or tempfile.gettempdir()


def by_model(model: int) -> int:
    return model


class Boosting:
    """Ensembles that grow together over one table.

    ``grow`` may be called again and again and goes on where it stopped.
    Ensembles with ``stopped`` set grow no further."""

    def __init__(self, df: DataFrame, features: list[str], label: str, keys: list[str], specs: list[Spec],
                 fold: str | None = None, max_bins: int = MAX_BINS, cuts: list[np.ndarray] | None = None):
        self.spark: SparkSession = df.sparkSession
        ensure_checkpoint_dir(self.spark)
        on_python_workers(self.spark)
        self.features, self.specs, self.bins = list(features), list(specs), max_bins
        self.run = uuid.uuid4().hex
        self.cuts = cut_points(df, self.features, max_bins) if cuts is None else cuts
        self.models: list[list[Tree]] = [[] for _ in specs]
        self.stopped = [False] * len(specs)
        self.base = 0               # trees that a single block's checkpoint holds
        self.alone = df.limit(BLOCK_ROWS + 1).count() <= BLOCK_ROWS
        blocks = blocks_of(df, self.features, label, keys, self.cuts, fold)
        if self.alone:      # a copy for each ensemble, put together in the task that grows it
            n = len(specs)

            def whole(parts):
                got: dict = {}
                for m, b in parts:
                    got.setdefault(m, []).append(b)
                return (whole_of(m, p) for m, p in got.items())
            blocks = blocks.flatMap(lambda b: [(m, b) for m in range(n)]).partitionBy(n, by_model).mapPartitions(whole)
        else:               # a task per core: each sends its sums once
            cores = self.spark.sparkContext.defaultParallelism
            blocks = blocks.map(lambda b: (int(b.name[1:]), b)).partitionBy(cores, by_model).values()
        self.blocks = self.kept = blocks.persist(StorageLevel.MEMORY_AND_DISK)
        self.laid: RDD | None = None
        if not self.alone:
            self.blocks.checkpoint()
            self._lay()
            self.laid.count()
            self.blocks.unpersist()         # from here on the checkpoint has them
        self.looks = 0
        self.aucs: list[list[float]] = [[] for _ in specs]      # of a single block's ensembles, after each tree
        self.reducers = max(1, min(len(specs), self.spark.sparkContext.defaultParallelism))

    def close(self) -> None:
        self.kept.unpersist()
        if self.laid is not None:
            self.laid.foreachPartition(lambda blocks: [shutil.rmtree(b.folder, ignore_errors=True) for b in blocks])
            self.laid.unpersist()

    def _lay(self) -> None:
        """Files of the blocks with the executors that are there now."""
        run = self.run
        if self.laid is not None:
            self.laid.unpersist()
        self.laid = self.blocks.mapPartitions(lambda blocks: lay(run, blocks)).persist(StorageLevel.MEMORY_AND_DISK)

    def _summed(self, make: Callable, of: Callable, since: list[int], until: list[int],
                join: Callable = np.add) -> dict:
        """Per model ``of``(model, sum over the parts of the table) of what ``make``(part, its
        blocks, first, trees) gives, {model: array, or None if its files are gone}.  ``trees``
        are each model's from ``first`` = ``since`` to ``until``; all, where files are gone."""
        for whole in (False, True):
            first = [0 if whole else n for n in since]
            trees = [m[a:b] for m, a, b in zip(self.models, first, until)]

            def part(number: int, blocks: Iterator[Laid]) -> Iterator[tuple]:
                own = list(blocks)
                return iter(make(number, own, first, trees).items() if own else ())

            def added(rows: Iterator[tuple]) -> Iterator[tuple]:
                out: dict = {}
                for k, v in rows:
                    if v is None or out.get(k, 0) is None:
                        out[k] = None
                    else:
                        v = v.astype(np.int64) if v.dtype == np.int32 else v
                        out[k] = join(out[k], v) if k in out else v
                return ((k, None if v is None else of(k, v)) for k, v in out.items())
            found = dict(self.laid.mapPartitionsWithIndex(part).partitionBy(self.reducers, by_model).mapPartitions(added).collect())
            if all(v is not None for v in found.values()):
                return found
            self._lay()
        raise RuntimeError("the files of the table's blocks went away again")

    def _tree(self, number: int, live: list[int]) -> None:
        """Grow tree ``number`` of the ensembles ``live``, a job per level."""
        growers = {m: growing(self.specs[m], self.features, number, True) for m in live}
        asked = {m: next(g) for m, g in growers.items()}
        bins, specs = self.bins, self.specs
        until = [min(number, len(m)) for m in self.models]
        while asked:
            now = asked

            def make(part: int, blocks: list[Laid], first: list[int], trees: list[list[Tree]]) -> dict:
                return {m: level_here(part, blocks, m, specs[m], number, a, first[m], trees[m], bins) for m, a in now.items()}

            def best(m: int, sums: np.ndarray) -> Splits:
                return best_splits(dict(zip(now[m].nodes, sums)), specs[m])
            first = [max(0, number - 1) if m in now and now[m].level == 0 else n for m, n in enumerate(until)]
            found, asked = self._summed(make, best, first, until), {}
            for m, splits in found.items():
                try:
                    asked[m] = growers[m].send(splits)
                except StopIteration as end:
                    self.models[m].append(end.value)

    def _trees_here(self, number: int, live: list[int], most: int) -> None:
        """Grow ``most`` trees of each ensemble, an ensemble a task.  The blocks of
        those that grow no further go."""
        bins, specs, features, wanted = self.bins, self.specs, self.features, set(live)

        def made(b: Block) -> Iterator[tuple]:
            if b.owner in wanted:
                yield grow_here(b, b.owner, specs[b.owner], features, bins, number, most)
        old, grown = self.kept, self.blocks.flatMap(made).persist(StorageLevel.MEMORY_AND_DISK)
        if number + most - self.base >= LOCAL_STEP:
            grown.checkpoint()
            self.base = number + most
        for m, trees, aucs in grown.map(lambda got: (got[2].owner, got[0], got[1])).collect():
            self.models[m] += trees
            self.aucs[m] += aucs
        old.unpersist()
        self.kept, self.blocks = grown, grown.map(lambda got: got[2])

    def grow(self, trees: int) -> None:
        """Up to ``trees`` more trees for every ensemble that is not done."""
        while trees > 0:
            number = max(len(m) for m in self.models)
            live = [i for i, s in enumerate(self.specs) if not self.stopped[i] and len(self.models[i]) == number
                    and number < s.n_estimators]
            if not live:
                return
            most = min(trees, LOCAL_STEP) if self.alone else 1
            if self.alone:
                self._trees_here(number, live, most)
            else:
                self._tree(number, live)
            trees -= most

    def staged_auc(self, since: list[int]) -> list[np.ndarray]:
        """Each ensemble's AUC on its held-out fold after every tree beyond its first
        ``since`` (at least those the blocks' margins hold), from rank histograms:
        margins are counted in ``CURVE_BINS`` steps between the tree's least and
        largest, those of a step tie."""
        if self.alone:
            return [np.array(a[n:], float) for a, n in zip(self.aucs, since)]
        held = [s.held_out for s in self.specs]
        until = [len(m) for m in self.models]
        open_ = [m for m, (a, b) in enumerate(zip(since, until)) if a < b]
        self.looks += 1
        look = self.looks

        def stages(b: Laid, m: int, first: int, trees: list[Tree], keep: bool) -> list[np.ndarray] | None:
            """Margins after each new tree of the rows held out."""
            if not b.there():
                return None
            rows = np.flatnonzero(b.column("fold") == held[m])
            x = np.ascontiguousarray(b.column("x")[:, rows])
            margin = margin_at(b, f"h{m}.", look + 1, len(rows), since[m], first, trees, x)
            if margin is None:
                return None
            out = []
            for t in trees[since[m] - first:]:
                margin = margin + t.values(x)
                out.append(margin)
            if keep:
                put_file(b.path(f"h{m}.{look % 2}"), np.array([until[m]]), margin)
            return out

        def reach(_: int, blocks: list[Laid], first: list[int], trees: list[list[Tree]]) -> dict:
            out = {}
            for m in open_:
                out[m] = np.full((until[m] - since[m], 2), -np.inf)
                for b in blocks:
                    every = stages(b, m, first[m], trees[m], False)
                    if every is None:
                        out[m] = None
                        break
                    out[m] = np.maximum(out[m], [(-s.min(), s.max()) if len(s) else (-np.inf, -np.inf) for s in every])
            return out

        def counts(_: int, blocks: list[Laid], first: list[int], trees: list[list[Tree]]) -> dict:
            out: dict = {}
            for m in open_:
                table = np.zeros((until[m] - since[m], 2 * CURVE_BINS), np.int64)
                for b in blocks:
                    every = stages(b, m, first[m], trees[m], True)
                    if every is None:
                        table = None
                        break
                    y = b.column("y")[b.column("fold") == held[m]].astype(np.int64)
                    for i, s in enumerate(every):
                        table[i] += steps(s, y, *ends[m][i]).ravel()
                out[m] = None if table is None else narrow(table)
            return out

        def curve(m: int, table: np.ndarray) -> np.ndarray:
            return auc_of(table.reshape(-1, CURVE_BINS, 2))
        found: dict = {}
        if open_:
            ends = {m: v * [-1.0, 1.0] for m, v in self._summed(reach, lambda m, v: v, since, until, np.maximum).items()}
            found = self._summed(counts, curve, since, until)
        return [found.get(m, np.zeros(0)) for m in range(len(since))]

    def ensemble(self, model: int, trees: int | None = None) -> "Ensemble":
        return Ensemble(self.features, self.cuts, self.models[model][:trees])


def steps(margin: np.ndarray, y: np.ndarray, low: float, high: float) -> np.ndarray:
    """(steps, 2) rows by label in each of ``CURVE_BINS`` steps between the margins' ends."""
    step = ((margin - low) * ((CURVE_BINS - 1) / max(high - low, 1e-300))).astype(np.int64)
    return np.bincount(step * 2 + y, minlength=2 * CURVE_BINS).reshape(-1, 2)


def auc_of(counts: np.ndarray) -> np.ndarray:
    """AUC per stage of (stages, steps, 2) counts by label; 0.5 with one class."""
    bad, good = counts[..., 0].astype(float), counts[..., 1].astype(float)
    below = np.cumsum(bad, axis=1) - bad
    pairs = bad.sum(axis=1) * good.sum(axis=1)
    won = (good * (below + bad / 2)).sum(axis=1)
    return np.where(pairs > 0, won / np.maximum(pairs, 1), 0.5)


def best_round(scores: list[float], patience: int) -> tuple[int, bool]:
    """(the best round, whether rounds end there): the first of the largest scores
    when rounds end after ``patience`` of them without a better one."""
    best, best_i = float("-inf"), -1
    for i, v in enumerate(scores):
        if v > best:
            best, best_i = v, i
        elif i - best_i >= patience:
            return best_i + 1, True
    return best_i + 1, False


def grow_until_best(boosting: Boosting, patience: int) -> tuple[list[int], list[list[float]]]:
    """Grow every ensemble until the AUC on its held-out fold has not risen for
    ``patience`` trees, or to its n_estimators: (best numbers of trees, AUC after
    each tree).  Nothing is fitted anew; trees come ``STEP`` at a time."""
    scores: list[list[float]] = [[] for _ in boosting.specs]
    while True:
        boosting.grow(STEP)
        if all(len(m) == len(s) for m, s in zip(boosting.models, scores)):
            return [best_round(s, patience)[0] for s in scores], scores
        for m, auc in enumerate(boosting.staged_auc([len(s) for s in scores])):
            scores[m] += auc.tolist()
            boosting.stopped[m] = best_round(scores[m], patience)[1]


@dataclass
class Ensemble:
    """A fitted ensemble: plain arrays of a size set by its parameters."""

    features: list[str]
    cuts: list[np.ndarray]
    trees: list[Tree] = field(default_factory=list)

    def probabilities(self, df: DataFrame, counts: list[int] | None = None, name: str = "probability_1") -> DataFrame:
        """``df`` plus the probability of class 1; with ``counts``, an array of the
        probabilities after that many trees each, from one walk through the trees."""
        stops = sorted(set(counts or [len(self.trees)]))
        if stops[0] < 0 or stops[-1] > len(self.trees):
            raise ValueError(f"tree counts must be between 0 and {len(self.trees)}")
        on_python_workers(df.sparkSession)
        ctx = df.sparkSession.sparkContext.broadcast(self)      # bounded by trees x nodes
        kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
        many = counts is not None
        inputs = [f"_x{i}_{uuid.uuid4().hex[:8]}" for i in range(len(self.features))]
        wide = df.select("*", *[F.col(c).cast("double").alias(a) for c, a in zip(self.features, inputs)])
        cols = df.columns

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = ctx.value
            for b in batches:
                x = np.zeros((len(own.features), b.num_rows), np.uint8)
                for i, c in enumerate(own.cuts):
                    x[i] = binned(_floats(b.column(len(cols) + i)), c)
                margin, at = np.zeros(b.num_rows), {}
                if 0 in stops:
                    at[0] = margin
                for i, t in enumerate(own.trees[:stops[-1]], 1):
                    margin = margin + t.values(x)
                    if i in stops:
                        at[i] = margin
                p = {i: 1 / (1 + np.exp(-m)) for i, m in at.items()}
                if many:
                    flat = np.stack([p[i] for i in counts], axis=1).ravel()
                    out = pa.ListArray.from_arrays(np.arange(b.num_rows + 1, dtype=np.int32) * len(counts), pa.array(flat))
                else:
                    out = pa.array(p[stops[-1]])
                yield pa.RecordBatch.from_arrays([*b.columns[:len(cols)], out], [*cols, name])
        return wide.mapInArrow(run, f"{kinds}, {name} {'array<double>' if many else 'double'}")

    def nodes(self, spark: SparkSession) -> DataFrame:
        """The split table: a row per node, tree, node, feature (null: a leaf), cut
        (values up to it go left), null_left, value, gain, cover."""
        rows = []
        for i, t in enumerate(self.trees):
            for n in np.flatnonzero((t.cover > 0) | (np.arange(len(t.cover)) == 0)).tolist():
                f = int(t.feature[n])
                leaf = f < 0
                rows.append((i, n, None if leaf else self.features[f], None if leaf else float(self.cuts[f][t.threshold[n] - 1]),
                             None if leaf else bool(t.null_left[n]), float(t.value[n]), None if leaf else float(t.gain[n]), float(t.cover[n])))
        return spark.createDataFrame(rows, "tree int, node int, feature string, cut double, null_left boolean, value double, "
                                           "gain double, cover double")

    def save(self, spark: SparkSession, path: str) -> None:
        depth = max((t.depth() for t in self.trees), default=0)
        meta = [(i, f, [float(c) for c in self.cuts[i]], depth, len(self.trees)) for i, f in enumerate(self.features)]
        self.nodes(spark).write.mode("overwrite").parquet(f"{path}/nodes")
        spark.createDataFrame(meta, "place int, feature string, cuts array<double>, depth int, trees int").coalesce(1) \
            .write.mode("overwrite").parquet(f"{path}/features")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "Ensemble":
        meta = spark.read.parquet(f"{path}/features").orderBy("place").collect()
        names = [r["feature"] for r in meta]
        cuts = [np.array(r["cuts"], float) for r in meta]
        trees = [Tree.empty(meta[0]["depth"]) for _ in range(meta[0]["trees"])]
        for r in spark.read.parquet(f"{path}/nodes").collect():         # bounded by trees x nodes
            t, n = trees[r["tree"]], r["node"]
            t.value[n], t.cover[n] = r["value"], r["cover"]
            if r["feature"] is not None:
                f = names.index(r["feature"])
                t.feature[n], t.gain[n], t.null_left[n] = f, r["gain"], r["null_left"]
                t.threshold[n] = 1 + np.searchsorted(cuts[f], r["cut"])
        return cls(names, cuts, trees)


def own_fold_probabilities(df: DataFrame, models: list[Ensemble], k: int, label: str) -> DataFrame:
    """(model, fold, label, probability_1) of models that grew together: model i on the
    rows of fold i mod ``k`` only, all in one pass over the rows."""
    on_python_workers(df.sparkSession)
    ctx = df.sparkSession.sparkContext.broadcast(models)        # bounded by models x trees x nodes
    features = models[0].features
    rows = df.select(F.col("fold").cast("int").alias("fold"), F.col(label).cast("double").alias("label"),
                     *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(features)]).filter("fold is not null")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = ctx.value
        for b in batches:
            x = np.zeros((len(features), b.num_rows), np.uint8)
            for i, c in enumerate(own[0].cuts):
                x[i] = binned(_floats(b.column(2 + i)), c)
            fold = b.column("fold").to_numpy()
            for f in range(k):
                at = np.flatnonzero(fold == f)
                part, labels = np.ascontiguousarray(x[:, at]), b.column("label").take(pa.array(at))
                for m in range(f, len(own), k):
                    margin = np.zeros(len(at))
                    for t in own[m].trees:
                        margin = margin + t.values(part)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), m, np.int32)), pa.array(np.full(len(at), f, np.int32)),
                                                      labels, pa.array(1 / (1 + np.exp(-margin)))], ["model", "fold", "label", "probability_1"])
    return rows.mapInArrow(run, "model int, fold int, label double, probability_1 double")
