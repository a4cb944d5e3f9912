import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from rebuy.llm import ann, embed_dedup as ed
from rebuy.llm.pstable import collision

VEC = "vec_id long, embedding array<float>, label int, t string, key string, rep string, n_links string"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], lab, *["x"] * 4)
                                  for i, v, lab in rows], VEC)


def usable(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)


def brute_links(rows, t=0.93):
    n = len(rows)
    x = [np.array(r[1], np.float32).astype(float) if usable(r[1]) and r[2] is not None else None for r in rows]
    adj = [[j for j in range(n) if j != i and x[i] is not None and x[j] is not None and rows[i][2] == rows[j][2]
            and len(x[i]) == len(x[j]) and x[i] @ x[j] / math.sqrt((x[i] @ x[i]) * (x[j] @ x[j])) >= t] for i in range(n)]
    out, comp = [], {}
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for j in adj[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        c = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        out.append((rows[i][0], len(adj[i]), c, rows[i][0] == c))
    return out


def clustered(seed, n=160, dim=16):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((12, dim))
    rows = []
    for i in range(n):
        v = centres[rng.integers(12)] + rng.standard_normal(dim) * rng.choice([0.0, 0.05, 0.25, 2.0])
        rows.append((i, v.astype(np.float32) * np.float32(rng.choice([1, 3])), int(rng.integers(3))))
    return rows


@pytest.mark.parametrize("tile", [2048, 7])
def test_links_against_brute_force(spark, tile):
    rows = clustered(1)
    rows += [(1000 + i, rows[0][1], rows[0][2]) for i in range(60)]       # one very common vector
    got = ed.near_duplicates(frame(spark, rows), recall=0.99999, tile_rows=tile).collect()
    assert sorted(map(tuple, got)) == sorted(brute_links(rows))


ODD = [(1, [1, 0, 0], 1), (1, [1, 0, 0], 1), (2, [1, 0.01, 0], 1), (3, None, 1), (4, [0, 0, 0], 1), (5, [1, None, 0], 1),
       (6, [float("nan"), 1, 0], 1), (7, [float("inf"), 1, 0], 1), (8, [1, 0, 0], None), (9, [1, 0, 0], 2), (10, [1, 0], 1),
       (None, [1, 0, 0], 1), (11, [-0.0, 1, 0], 3), (12, [0.0, 1, 0], 3), (None, None, None), (13, [], 1)]


def test_odd_vectors(spark):
    order = lambda rows: sorted(rows, key=str)
    assert order(map(tuple, ed.near_duplicates(frame(spark, ODD)).collect())) == order(brute_links(ODD))
    assert ed.near_duplicates(frame(spark, [])).count() == 0
    assert ed.near_duplicates(frame(spark, [(1, None, None)])).collect()[0].n_links == 0


def test_plan_reaches_its_recall():
    for rows in (10, 10**4, 10**9):
        k, tables = ed.plan(rows, 0.93, 0.999)
        p = collision(math.sqrt(2 - 2 * 0.93), ed.WIDTH) ** k
        assert 1 - (1 - p) ** tables >= 0.999


def brute_nearest(rows, top, is_query):
    ok = [(i, np.array(v, np.float32).astype(float)) for i, v, _ in rows if i is not None and usable(v)]
    out = {}
    for q, x in ok:
        if is_query(q):
            near = {}
            for i, y in ok:
                if i != q and len(x) == len(y):
                    near[i] = max(near.get(i, -math.inf), float(x @ y))
            for i, s in near.items():
                out.setdefault(q, {})[i] = max(s, out.get(q, {}).get(i, -math.inf))
    return {q: sorted(n.items(), key=lambda r: (-r[1], r[0]))[:top] for q, n in out.items()}


def test_small_tables_are_exact(spark):
    rows = [(i, v, lab) for i, v, lab in clustered(2)] + ODD
    got = ann.nearest(frame(spark, rows), F.col("vec_id") % 20 == 0).collect()
    want = brute_nearest(rows, 20, lambda q: q % 20 == 0)
    assert {r.query_id for r in got} == set(want)
    for q, near in want.items():
        mine = sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == q)
        assert [r[0] for r in mine] == list(range(1, len(near) + 1))
        assert np.allclose([r[2] for r in mine], [s for _, s in near])
    assert ann.nearest(frame(spark, []), F.col("vec_id") % 20 == 0).count() == 0


def test_recall_beyond_the_sample(spark):
    """A small sample and small tiles: most results come from the buckets."""
    rng = np.random.default_rng(3)
    x = rng.standard_normal((2000, 32)).astype(np.float32) * rng.uniform(0.5, 2, (2000, 1)).astype(np.float32)
    rows = [(i, v, 0) for i, v in enumerate(x)]
    got = ann.nearest(frame(spark, rows), F.col("vec_id") % 20 == 0, sample_rows=100, tile_rows=64).collect()
    want = brute_nearest(rows, 20, lambda q: q % 20 == 0)
    hit = sum(len({i for i, _ in want[q]} & {r.vec_id for r in got if r.query_id == q}) for q in want)
    assert hit / (20 * len(want)) >= 0.9


def test_equal_vectors_tie_by_id(spark):
    rows = [(i, [1.0, 2.0, 0.5], 0) for i in range(60)]
    got = ann.nearest(frame(spark, rows), F.col("vec_id") == 20, sample_rows=30, tile_rows=5).orderBy("rank").collect()
    assert [r.vec_id for r in got] == [i for i in range(21) if i != 20]


def test_probes_come_in_order_of_success():
    p = ann.probes(np.array([0.2, -1.0]), np.array([0.1, 0.4]), 0.5, 1.5, 0.9)
    assert len({tuple(r) for r in p}) == len(p) > 1
    assert tuple(p[0]) == (0, -1)
