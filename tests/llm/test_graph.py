"""Graph search next to all inner products."""

import math

import numpy as np
import pandas as pd
import pytest

from reviewloom.llm import graph
from reviewloom.llm.graph import DEGREE, Graph, neighbours

DDL = "vec_id long, embedding array<float>, rank string, score string, part int"


def exact(vectors, k=20, every=20):
    usable = [(i, v, np.array(e, np.float32).astype(float)) for i, (v, e) in enumerate(vectors)
              if v is not None and e is not None and any(e) and all(x is not None and math.isfinite(x) for x in e)]
    width = max((len(e) for _, _, e in usable), default=0)
    x = np.array([np.pad(e, (0, width - len(e))) for _, _, e in usable]).reshape(len(usable), width)
    out = {}
    for n, (i, q, _) in enumerate(usable):
        if q % every == 0:
            scores = np.einsum("ij,j->i", x, x[n])
            out[i] = q, sorted((-s, v) for (j, v, _), s in zip(usable, scores) if j != i)[:k]
    return out


def run(rows, vectors, **options):
    return sorted(tuple(r) for r in neighbours(rows(DDL, *[(v, e, "x", "y", 1) for v, e in vectors]), **options).collect())


def recall(found, want):
    kept = sum(len({v for _, v in w} & {r[2] for r in found if r[0] == q}) for q, w in want.values())
    return kept / sum(len(w) for _, w in want.values())


def drawn(n, width, seed, centers=0, stretch=False):
    draw = np.random.default_rng(seed)
    x = draw.normal(size=(n, width))
    if centers:
        x = draw.normal(size=(centers, width))[draw.integers(0, centers, n)] + 0.1 * x
    x /= np.linalg.norm(x, axis=1)[:, None]
    return x * draw.lognormal(0, 0.7, (n, 1)) if stretch else x


@pytest.mark.parametrize("shape", [{}, {"centers": 12}, {"stretch": True}])
def test_recall(rows, shape):
    x = drawn(3000, 32, 1, **shape)
    vectors = [(i, [float(v) for v in x[i]]) for i in range(3000)]
    found, want = run(rows, vectors, shard_rows=1200), exact(vectors)
    assert recall(found, want) >= 0.95
    for q in list(want.values())[:20]:
        mine = sorted((r for r in found if r[0] == q[0]), key=lambda r: r[1])
        assert [r[1] for r in mine] == list(range(1, 21))
        assert [(-r[3], r[2]) for r in mine] == sorted((-r[3], r[2]) for r in mine)
        for r in mine:
            a, b = (np.array(vectors[i][1], np.float32).astype(float) for i in (q[0], r[2]))
            assert abs(r[3] - a @ b) < 1e-12


def test_small_tables_are_answered_whole(rows):
    x = drawn(60, 8, 2)
    vectors = [(i * 5, [float(v) for v in x[i]]) for i in range(60)]
    vectors += [(20, vectors[3][1])] * 3 + [(7, vectors[4][1])] * 30
    vectors += [(40, None), (60, [0.0] * 8), (80, [None] * 8), (100, [float("nan")] * 8), (None, vectors[1][1]), (3, [1.0, 2.0]), (40, [3.0]), (60, [])]
    found = run(rows, vectors)
    want = sorted((q, r + 1, v, -s) for q, w in exact(vectors).values() for r, (s, v) in enumerate(w))
    assert [f[:3] for f in found] == [w[:3] for w in want]
    assert np.allclose([f[3] for f in found], [w[3] for w in want], rtol=1e-14)


def test_large_group_of_equal_vectors(rows):
    x = drawn(900, 16, 3)
    vectors = [(i, [float(v) for v in x[i if i % 3 else 0]]) for i in range(900)]
    found, want = run(rows, vectors, shard_rows=256), exact(vectors)
    assert recall(found, want) >= 0.95
    assert [r[2] for r in found if r[0] == 60] == [v for _, v in want[60][1]]


def test_few_rows_and_none(rows):
    assert run(rows, []) == []
    assert run(rows, [(20, [1.0])]) == []
    assert run(rows, [(1, [1.0]), (2, [1.0])]) == []
    assert run(rows, [(20, [1.0]), (2, [2.0]), (1, [2.0])]) == [(20, 1, 1, 2.0), (20, 2, 2, 2.0)]


def test_huge_and_tiny_components(rows):
    vectors = [(0, [3e38, 1.0]), (1, [3e38, 1.0]), (2, [-3e38, 1.0]), (3, [1e-40, 0.0])]
    assert [r[2] for r in run(rows, vectors)] == [1, 3, 2]


def test_pruning_keeps_diverse_edges():
    x = drawn(600, 8, 4)
    g = Graph(x)
    node = np.arange(50)
    edges = g.pruned(node, np.tile(np.arange(600), (50, 1)), 1.2)
    p = g.points.astype(float)
    for n, kept in zip(node, edges):
        kept = [k for k in kept if k >= 0]
        away = {k: float(((p[k] - p[n]) ** 2).sum()) for k in range(600) if k != n}
        want = []
        for k in sorted(away, key=away.get)[: graph.PROPOSED]:
            if len(want) < DEGREE and all(1.2**2 * ((p[k] - p[w]) ** 2).sum() > away[k] for w in want):
                want.append(k)
        assert kept == want


def test_recall_on_given_vectors(spark):
    path = "/root/testdata/sf0.1/embeddings.parquet"
    t = pd.read_parquet(path)
    vectors = list(zip(t.vec_id.tolist(), [list(map(float, e)) for e in t.embedding]))
    found = [tuple(r) for r in neighbours(spark.read.parquet(path), shard_rows=700).collect()]
    assert recall(found, exact(vectors)) >= 0.95
