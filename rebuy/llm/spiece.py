"""SentencePiece encoding and decoding by a max-plus parallel scan.

A text is a path of pieces through its characters.  For a unigram model the
path's weight is the sum of piece scores.  For a BPE model a piece may follow
another only if merging their joined text by rank yields just these two; that
step weighs 0 and any other minus infinity, and the one path of weight 0 is the
library's result.

A giant text is cut into chunks of ``CHUNK_CHARS``.  A *boundary state* is a
piece that ends at the cut or reaches over it, with the characters it reaches.
Each chunk yields its transfer matrix from the states of its left cut to those
of its right cut, computed alone; the matrices of a text combine under the
max-plus product, which is associative; the best path's state at every cut
follows, and each chunk is then backtraced alone between its two states.
Between two characters that no piece holds together every state is the same,
so most matrices have rank one and only their ends need the lattice.

A text of one chunk goes from the start state to the end state directly.
"""

from __future__ import annotations

import math
import re
from array import array
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rebuy.llm.shared import slices, stored

SPACE = "▁"
CHUNK_CHARS = 1 << 15
CACHE_ENTRIES = 300_000     # segments remembered, and as many older ones (about 130 MB a worker)
UNKNOWN_PENALTY = 10.0      # fixed value: below the least piece score
START = (-1, 0)
NEG = -math.inf


@dataclass
class Vocabulary:
    """Pieces of a model, and what follows from them."""
    ids: dict[str, int]             # ordinary pieces
    scores: list[float]
    bytes_: list[int]               # id of each byte's piece; empty without byte fallback
    unknown: int
    bpe: bool
    dummy_prefix: bool = True
    cache_entries: int = CACHE_ENTRIES
    text: list[bytes] = field(default_factory=list)     # id -> bytes it decodes to
    parts: dict[int, tuple[int, int]] = field(default_factory=dict)

    def __post_init__(self):
        self.pieces = {i: p for p, i in self.ids.items()}
        self.size = len(self.scores)
        self.longest = max(map(len, self.ids), default=1)
        self.joined = {x + y for p in self.ids for x, y in zip(p, p[1:])}
        inner = {c for p in self.ids if len(p) > 1 for c in p}
        self.alone = [c for c in "\n\t\r" if c not in inner]
        if any(x != SPACE and y == SPACE for x, y in self.joined):
            raise ValueError("pieces that hold a space after a word are not supported")
        stop = "".join(map(re.escape, self.alone))
        self.segment = re.compile(f"{SPACE}*[^{SPACE}{stop}]+|{SPACE}+" + (f"|[{stop}]" if stop else ""))
        least = min((self.scores[i] for i in self.ids.values()), default=0.0)
        self.unknown_score = least - UNKNOWN_PENALTY
        self.follows: dict[int, bool] = {}
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        if self.bpe and not self.parts:
            self._split_all()
        # every start of a piece -> its id, or -1 where no piece ends; a BPE
        # piece that merging never yields counts as a start only
        self.reach: dict[str, int] = {}
        for p, i in self.ids.items():
            for e in range(1, len(p)):
                self.reach.setdefault(p[:e], -1)
            if not self.bpe or len(p) == 1 or i in self.parts:
                self.reach[p] = i

    # ---- pieces ---------------------------------------------------------

    def at(self, s: str) -> int | None:
        """Id of a piece, or a stand-in above all ids for an unknown character."""
        i = self.ids.get(s)
        if i is None and len(s) == 1:
            return self.size + ord(s)
        return i

    def emit(self, i: int) -> list[int]:
        if i < self.size:
            return [i]
        if not self.bytes_:
            return [self.unknown]
        return [self.bytes_[b] for b in chr(i - self.size).encode("utf-8", "surrogatepass")]

    # ---- BPE ------------------------------------------------------------

    def _merge(self, s: str) -> tuple[list[str], tuple[str, str] | None]:
        """Plain BPE of a short string: symbols, and the last merge."""
        symbols, last = list(s), None
        while True:
            best = None
            for k in range(len(symbols) - 1):
                i = self.ids.get(symbols[k] + symbols[k + 1])
                if i is not None and (best is None or self.scores[i] > best[0]):
                    best = (self.scores[i], k)
            if best is None:
                return symbols, last
            k = best[1]
            last = (symbols[k], symbols[k + 1])
            symbols[k:k + 2] = [symbols[k] + symbols[k + 1]]

    def _split_all(self) -> None:
        """The last merge of every piece that merging its characters yields."""
        for p, i in self.ids.items():
            if len(p) > 1:
                symbols, last = self._merge(p)
                if len(symbols) == 1:
                    self.parts[i] = (self.at(last[0]), self.at(last[1]))

    def may_follow(self, a: int, b: int) -> bool:
        """Does merging a's and b's joined text keep the cut between them?

        Merges beside the cut run in order of score: a's right edge and b's
        left edge grow from a character each.  The cut is lost if ever the two
        edge symbols form a piece that comes before their own next merges."""
        if a < 0 or a >= self.size or b >= self.size:
            return True
        key = a << 20 | b
        known = self.follows.get(key)
        if known is None:
            known = self.follows[key] = self._may_follow(a, b)
        return known

    def _edge(self, i: int, side: int) -> list[int]:
        out = [i]
        while out[-1] in self.parts:
            out.append(self.parts[out[-1]][side])
        return out[::-1]

    def _may_follow(self, a: int, b: int) -> bool:
        if self.pieces[a][-1] + self.pieces[b][0] not in self.joined:
            return True
        xs, ys = self._edge(a, 1), self._edge(b, 0)
        i = j = 0
        name = lambda t: self.pieces[t] if t < self.size else chr(t - self.size)
        while True:
            cross = self.ids.get(name(xs[i]) + name(ys[j]))
            c = self.scores[cross] if cross is not None else NEG
            left = self.scores[xs[i + 1]] if i + 1 < len(xs) else NEG
            right = self.scores[ys[j + 1]] if j + 1 < len(ys) else NEG
            if c > left and c >= right and c > NEG:
                return False
            if left == NEG and right == NEG:
                return True
            if left >= right:
                i += 1
            else:
                j += 1

    def weight(self, a: int, b: int) -> float:
        """Weight of the step from piece a to piece b."""
        if self.bpe:
            return 0.0 if (b >= self.size or len(self.pieces[b]) == 1 or b in self.parts) and self.may_follow(a, b) else NEG
        return self.scores[b] if b < self.size else self.unknown_score

    # ---- segments -------------------------------------------------------

    def path(self, s: str) -> list[int]:
        """Best pieces of a segment from its hard start to its hard end."""
        return self._only_path(s) if self.bpe else self._best_path(s)

    def _only_path(self, s: str) -> list[int]:
        """The one path of weight 0: longest allowed piece first, back to the
        next shorter where none goes on.  A prefix has one path at most, so a
        position that failed once fails always."""
        n, reach, follows, size = len(s), self.reach, self.follows, self.size
        dead = [False] * (n + 1)
        out: list[int] = []
        choices: list[list[tuple[int, int]]] = []
        at, prev = 0, -1
        while at < n:
            found = []
            for e in range(at + 1, n + 1):
                t = reach.get(s[at:e])
                if t is None:
                    if e == at + 1:
                        found.append((size + ord(s[at]), e))
                    break
                if t >= 0:
                    found.append((t, e))
                elif e == at + 1:
                    found.append((size + ord(s[at]), e))
            while True:
                while found:
                    t, e = found.pop()
                    if dead[e]:
                        continue
                    ok = prev < 0 or follows.get(prev << 20 | t)
                    if ok or (ok is None and self.may_follow(prev, t)):
                        break
                else:
                    dead[at] = True
                    found, e = choices.pop(), at
                    out.pop()
                    at -= self.width(prev)
                    prev = out[-1] if out else -1
                    continue
                break
            choices.append(found)
            out.append(t)
            at, prev = e, t
        return out

    def _best_path(self, s: str) -> list[int]:
        n = len(s)
        last: list[int | None] = [None] * (n + 1)
        best = [0.0] + [NEG] * n
        for e in range(1, n + 1):
            for b in range(max(0, e - self.longest), e):
                t = self.at(s[b:e])
                if t is not None and best[b] + self.weight(-1, t) > best[e]:
                    best[e], last[e] = best[b] + self.weight(-1, t), t
        out, e = [], n
        while e > 0:
            out.append(last[e])
            e -= self.width(last[e])
        return out[::-1]

    def width(self, i: int) -> int:
        return len(self.pieces[i]) if i < self.size else 1

    def packed(self, s: str) -> bytes:
        """Ids of a segment as int32 bytes, remembered."""
        got = self.cache.get(s) or self.older.get(s)
        if got is None:
            # a closing mark that no piece joins to a word is a segment of its own
            k = next((k for k in range(len(s) - 1, max(0, len(s) - 3), -1) if s[k - 1:k + 1] not in self.joined), 0)
            got = self.packed(s[:k]) + self.packed(s[k:]) if k else self.pack(self.path(s))
        if len(s) <= 64:
            if len(self.cache) >= self.cache_entries:      # what is still in use moves up again
                self.older, self.cache = self.cache, {}
            self.cache[s] = got
        return got

    def pack(self, path: list[int]) -> bytes:
        size = self.size
        if path and max(path) >= size:
            path = [i for t in path for i in self.emit(t)]
        return array("i", path).tobytes()

    def packed_run(self, s: str) -> bytes:
        """Ids between two hard cuts."""
        one = self.packed
        return b"".join([self.cache.get(x) or one(x) for x in self.segment.findall(s)])

    def normal(self, text: str) -> str:
        s = text.replace(" ", SPACE)
        return SPACE + s if self.dummy_prefix and s else s

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(self.packed_run(self.normal(text)), np.int32)

    def decode(self, ids: list[int]) -> str:
        text = self.text
        out = b"".join([text[i] for i in ids]).decode("utf-8", "replace")
        return out[1:] if self.dummy_prefix and out[:1] == " " else out

    # ---- chunks ---------------------------------------------------------

    def hard(self, x: str, y: str) -> bool:
        """No piece holds x before y, by the same rule as ``segment``."""
        return (y == SPACE != x) or x in self.alone or y in self.alone

    def states(self, s: str, cut: int) -> list[tuple[int, int]]:
        """Boundary states at ``cut``: (piece, characters beyond the cut)."""
        if cut == 0:
            return [START]
        out = []
        for b in range(max(0, cut - self.longest), cut):
            for e in range(cut, min(len(s), b + self.longest) + 1):
                t = self.at(s[b:e])
                if t is not None:
                    out.append((t, e - cut))
        return out

    def _spread(self, s: str, begin: dict[int, dict[int, np.ndarray]], stop: int, trace: bool = False):
        """Max-plus reach from weighted states (position -> piece -> vector)
        to all states at or beyond ``stop``; with ``trace`` also the best
        predecessor of each."""
        nodes = {p: dict(v) for p, v in begin.items()}
        back: dict[tuple[int, int], tuple[int, int]] = {}
        todo = sorted(nodes)
        for p in range(todo[0] if todo else stop, stop):
            here = nodes.get(p)
            if not here:
                continue
            for e in range(p + 1, min(len(s), p + self.longest) + 1):
                t = self.at(s[p:e])
                if t is None:
                    continue
                for prev, v in here.items():
                    w = self.weight(prev, t)
                    if w == NEG:
                        continue
                    there = nodes.setdefault(e, {})
                    old = there.get(t)
                    new = v + w if old is None else np.maximum(old, v + w)
                    if trace and (old is None or new[0] > old[0]):
                        back[(e, t)] = (p, prev)
                    there[t] = new
        ends = {p: v for p, v in nodes.items() if p >= stop}
        return (ends, back) if trace else ends

    def hard_cuts(self, s: str, a: int, b: int) -> tuple[int, int] | None:
        """First and last hard cut in [a, b] (cuts have a character on both sides)."""
        first = next((p for p in range(max(a, 1), min(b, len(s) - 1) + 1) if self.hard(s[p - 1], s[p])), None)
        if first is None:
            return None
        return first, next(p for p in range(min(b, len(s) - 1), a - 1, -1) if self.hard(s[p - 1], s[p]))

    def matrix(self, s: str, a: int, b: int, end: bool) -> np.ndarray:
        """Transfer matrix of the chunk [a, b) of s (s holds context beyond)."""
        left = self.states(s, a)
        right = [START] if end else self.states(s, b)
        out = np.full((len(left), len(right)), NEG)
        begin: dict[int, dict[int, np.ndarray]] = {}
        for k, (t, c) in enumerate(left):
            v = np.full(len(left), NEG)
            v[k] = 0.0
            at = begin.setdefault(a + c, {})
            at[t] = np.maximum(at[t], v) if t in at else v
        cuts = self.hard_cuts(s, a, b if end else b - 1)
        if cuts:
            ends = self._spread(s, {p: v for p, v in begin.items() if p <= cuts[0]}, cuts[0])
            reach = [v for v in ends.get(cuts[0], {}).values()]
            if not reach:
                return out
            into = np.max(reach, axis=0)
            ends = self._spread(s, {cuts[1]: {-1: np.zeros(1)}}, b)
            if end:
                onward = np.array([max((v[0] for v in ends.get(b, {}).values()), default=NEG)])
            else:
                onward = np.array([ends.get(b + c, {}).get(t, [NEG])[0] for t, c in right])
            return into[:, None] + onward[None, :]
        ends = self._spread(s, begin, b)
        if end:
            out[:, 0] = np.max([v for v in ends.get(b, {}).values()], axis=0) if ends.get(b) else NEG
        else:
            for k, (t, c) in enumerate(right):
                v = ends.get(b + c, {}).get(t)
                if v is not None:
                    out[:, k] = v
        return out

    def _trace(self, s: str, p: int, prev: int, stop: int, goal: tuple[int, int] | None) -> list[int]:
        """Pieces of the best path from ``prev`` ending at p to the state
        ``goal`` (position, piece), or to any piece that ends at ``stop``."""
        if p >= stop:
            return []
        ends, back = self._spread(s, {p: {prev: np.zeros(1)}}, stop, trace=True)
        if goal is None:
            goal = (stop, max(ends[stop], key=lambda t: ends[stop][t][0]))
        out, at = [], goal
        while at != (p, prev):
            out.append(at[1])
            at = back[at]
        return out[::-1]

    def backtrace(self, s: str, a: int, b: int, enter: tuple[int, int], leave: tuple[int, int], end: bool) -> bytes:
        """Ids of the pieces that begin in the chunk, between its two states."""
        p, prev = a + enter[1], enter[0]
        if p >= b and not (end and p < b):
            return b""
        goal = None if end else (b + leave[1], leave[0])
        cuts = self.hard_cuts(s, p, b - 1)
        if not cuts:
            return self.pack(self._trace(s, p, prev, b, goal))
        head = self.pack(self._trace(s, p, prev, cuts[0], None))
        return head + self.packed_run(s[cuts[0]:cuts[1]]) + self.pack(self._trace(s, cuts[1], -1, b, goal))


def load(model: bytes) -> Vocabulary:
    """Read a SentencePiece model file's bytes."""
    from sentencepiece import sentencepiece_model_pb2 as pb
    m = pb.ModelProto()
    m.ParseFromString(model)
    n = m.normalizer_spec
    if n.precompiled_charsmap or n.remove_extra_whitespaces or not n.escape_whitespaces \
            or m.trainer_spec.treat_whitespace_as_suffix or m.trainer_spec.model_type not in (1, 2):
        raise ValueError("only unigram and BPE models with identity normalisation are supported")
    kind = pb.ModelProto.SentencePiece
    ids, bytes_, text, unknown = {}, [0] * 256, [], 0
    for i, p in enumerate(m.pieces):
        out = b""
        if p.type in (kind.NORMAL, kind.USER_DEFINED):
            ids[p.piece] = i
            out = p.piece.replace(SPACE, " ").encode()
        elif p.type == kind.BYTE:
            b = int(p.piece[3:5], 16)
            bytes_[b], out = i, bytes([b])
        elif p.type == kind.UNKNOWN:
            unknown, out = i, " ⁇ ".encode()
        text.append(out)
    return Vocabulary(ids, [p.score for p in m.pieces], bytes_ if m.trainer_spec.byte_fallback else [], unknown,
                      m.trainer_spec.model_type == 2, n.add_dummy_prefix, text=text)


# ---- the scan ---------------------------------------------------------------

def combine(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Max-plus product of two transfer matrices."""
    return (x[:, :, None] + y[None, :, :]).max(axis=1)


def scan(matrices: list[np.ndarray]) -> list[np.ndarray]:
    """All prefix products, by an associative doubling scan."""
    out, step = list(matrices), 1
    while step < len(out):
        out = [combine(out[i - step], out[i]) if i >= step else out[i] for i in range(len(out))]
        step *= 2
    return out


def cut_states(matrices: list[np.ndarray]) -> list[int]:
    """Index of the best path's state at every cut after the first chunk."""
    prefix = scan(matrices)
    at, out = 0, []
    for m, before in zip(reversed(matrices[1:]), reversed(prefix[:-1])):
        at = int(np.argmax(before[0] + m[:, at]))
        out.append(at)
    return out[::-1]


_CHUNK = pa.schema([("doc_id", pa.int64()), ("key", pa.int64()), ("nth", pa.int32()), ("last", pa.bool_()),
                    ("a", pa.int32()), ("b", pa.int32()), ("s", pa.string())])
_CHUNK_DDL = "doc_id long, key long, nth int, last boolean, a int, b int, s string"


def _giant(rows: DataFrame, ctx, chunk_chars: int) -> DataFrame:
    """(doc_id, key, ids) of texts that take several chunks."""
    def cut(batches):
        v = ctx.value
        for b in slices(batches):
            for doc, key, text in zip(*(b.column(c).to_pylist() for c in ("doc_id", "key", "text"))):
                s = v.normal(text)
                n = -(-len(s) // chunk_chars)
                out = []
                for k in range(n):
                    x, y = k * chunk_chars, min(len(s), (k + 1) * chunk_chars)
                    lo, hi = max(0, x - v.longest), min(len(s), y + v.longest)
                    out.append((doc, key, k, k == n - 1, x - lo, y - lo, s[lo:hi]))
                    if len(out) == 64 or k == n - 1:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, t) for c, t in zip(zip(*out), _CHUNK.types)], schema=_CHUNK)
                        out = []

    def transfer(batches):
        v = ctx.value
        for b in slices(batches):
            cols = [b.column(c).to_pylist() for c in ("a", "b", "s", "last")]
            ms = [v.matrix(s, x, y, last) for x, y, s, last in zip(*cols)]
            yield pa.RecordBatch.from_arrays(
                [b.column("key"), b.column("nth"), pa.array([m.shape[1] for m in ms], pa.int32()),
                 pa.array([m.ravel().tolist() for m in ms], pa.list_(pa.float64()))], ["key", "nth", "width", "cells"])

    def settle(key, t):
        t = t.sort_by("nth")
        ms = [np.array(c).reshape(-1, w) for c, w in zip(t.column("cells").to_pylist(), t.column("width").to_pylist())]
        at = cut_states(ms)
        return pa.table({"key": t.column("key"), "nth": t.column("nth"), "enter": pa.array([0, *at], pa.int32()),
                         "leave": pa.array([*at, 0], pa.int32())})

    def walk(batches):
        v = ctx.value
        for b in slices(batches):
            out = []
            for x, y, s, last, i, o in zip(*(b.column(c).to_pylist() for c in ("a", "b", "s", "last", "enter", "leave"))):
                enter = v.states(s, x)[i]
                leave = START if last else v.states(s, y)[o]
                out.append(np.frombuffer(v.backtrace(s, x, y, enter, leave, last), np.int32))
            yield pa.RecordBatch.from_arrays([b.column("key"), b.column("nth"), pa.array(out, pa.list_(pa.int32()))],
                                             ["key", "nth", "ids"])

    # chunks of one text are dealt to many tasks
    chunks = stored(rows.mapInArrow(cut, _CHUNK_DDL).repartition("key", "nth"), "chunks")
    moves = (chunks.drop("doc_id").mapInArrow(transfer, "key long, nth int, width int, cells array<double>")
             .groupBy("key").applyInArrow(settle, "key long, nth int, enter int, leave int"))
    walked = chunks.drop("doc_id").join(moves, ["key", "nth"]).mapInArrow(walk, "key long, nth int, ids array<int>")
    ids = (walked.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("nth", "ids"))).alias("parts"))
           .select("key", F.flatten(F.transform("parts", lambda p: p["ids"])).alias("ids")))
    return chunks.filter("nth = 0").select("doc_id", "key").join(ids, "key")


def _keyed(rows: DataFrame) -> DataFrame:
    """A number for every row: equal rows differ, reruns agree."""
    stable = stored(rows, "giants")
    return stable.withColumn("key", F.monotonically_increasing_id())


def read_model(path: str | None = None) -> bytes:
    """The bytes of a model file, by default the public 32k piece model."""
    if path is None:
        import public_tokenizers
        path = public_tokenizers.path("piece_bpe_32k.model")
    with open(path, "rb") as f:
        return f.read()


def encode(docs: DataFrame, model: bytes | None = None, chunk_chars: int = CHUNK_CHARS,
           cache_entries: int = CACHE_ENTRIES) -> DataFrame:
    """doc_id, ids for every row of ``docs`` (doc_id, text; other columns are
    ignored).  Null and empty texts have no ids.  Equal rows each return a row;
    an empty table returns none."""
    vocabulary = load(model or read_model())
    vocabulary.cache_entries = cache_entries
    ctx = docs.sparkSession.sparkContext.broadcast(vocabulary)      # one vocabulary file

    def direct(batches):
        v = ctx.value
        for b in slices(batches):
            ids = [v.encode(t) if t else np.empty(0, np.int32) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    rows = docs.select(F.col("doc_id").cast("long"), "text")
    is_giant = F.coalesce(F.length("text") > chunk_chars, F.lit(False))
    short = rows.filter(~is_giant).mapInArrow(direct, "doc_id long, ids array<int>")
    giant = _giant(_keyed(rows.filter(is_giant)), ctx, chunk_chars)
    return short.unionByName(giant.select("doc_id", "ids"))


def decode(encoded: DataFrame, model: bytes | None = None) -> DataFrame:
    """``encoded`` (with ids) plus ``decoded``, the text its ids stand for."""
    ctx = encoded.sparkSession.sparkContext.broadcast(load(model or read_model()))

    def run(batches):
        v = ctx.value
        for b in slices(batches):
            ids = b.column("ids")
            text = [v.decode(x.values.to_numpy(zero_copy_only=False).tolist()) if x.is_valid else None for x in ids]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(text, pa.string())], [*b.schema.names, "decoded"])
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema) + ", decoded string"
    return encoded.mapInArrow(run, schema)
