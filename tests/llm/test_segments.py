"""Pruned search next to all inner products."""

import math

import numpy as np
import pytest

from reviewloom.llm import segments
from reviewloom.llm.segments import best_of_block, statistics, top_k

DDL = "vec_id long, embedding array<float>, rank string, score string, part int"


def brute(vectors, k=5, every=50):
    usable = [(i, v, [math.floor(256 * float(np.float32(x))) for x in e]) for i, (v, e) in enumerate(vectors)
              if v is not None and e is not None and all(x is not None and math.isfinite(x) for x in e)]
    out = []
    for i, q, a in usable:
        if q % every == 0:
            others = sorted((-sum(x * y for x, y in zip(a, b)), v) for j, v, b in usable if j != i)
            out += [(q, r + 1, v, max(-(2**63), min(2**63 - 1, -s))) for r, (s, v) in enumerate(others[:k])]
    return sorted(out)


def run(rows, vectors):
    df = rows(DDL, *[(v, e, "x", "y", 1) for v, e in vectors])
    return sorted(tuple(r) for r in top_k(df).collect())


def test_bounds_hold():
    rng = np.random.default_rng(1)
    q, v = rng.normal(size=(30, 50)), rng.normal(size=(40, 50)) + 0.3
    exact = q @ v.T
    for n in (1, 4, 16, 50, 80):
        assert (statistics(q, n) @ statistics(v, n).T >= exact - 1e-9).all()
    assert np.allclose(statistics(q, 50) @ statistics(v, 50).T, exact)


@pytest.mark.parametrize("sparse", [0.0, 1.0])
def test_block_equals_brute_force(monkeypatch, sparse):
    monkeypatch.setattr(segments, "SPARSE", sparse)
    rng = np.random.default_rng(2)
    centers = rng.integers(-200, 200, (6, 32))
    v = centers[rng.integers(0, 6, 500)] + rng.integers(-3, 4, (500, 32))
    rids, ids = np.arange(500), rng.integers(0, 400, 500)
    q = np.arange(0, 500, 7)
    rows, cols, scores = best_of_block(v[q], rids[q], v, rids, ids, 5)
    for i, r in enumerate(q):
        want = sorted((-int(v[r] @ v[j]), ids[j]) for j in range(500) if j != r)[:5]
        assert [(-int(s), ids[c]) for c, s in zip(cols[rows == i], scores[rows == i])] == want


def test_given_shapes(rows):
    rng = np.random.default_rng(3)
    vectors = [(int(i), [float(x) for x in rng.normal(size=12)]) for i in range(120)]
    vectors += [(0, vectors[0][1]), (50, [1.0, 2.0]), (50, []), (7, None), (8, [1.0, None]), (9, [float("nan")] * 12), (10, [float("inf")] * 12),
                (None, [1.0] * 12), (100, [3e38] * 12), (101, [-3e38] * 12), (102, [0.0] * 12), (103, [0.0] * 12)]
    vectors = [(v, e) for v, e in vectors if e is None or not any(x is not None and abs(x) > 1e30 and math.isfinite(x) for x in e)]
    assert run(rows, vectors) == brute(vectors)


def test_huge_components_stop_at_64_bits(rows):
    got = run(rows, [(0, [3e38, 1.0]), (1, [3e38, 1.0]), (2, [-3e38, 1.0])])
    assert got == [(0, 1, 1, 2**63 - 1), (0, 2, 2, -(2**63))]


def test_few_rows_and_none(rows):
    assert run(rows, []) == []
    assert run(rows, [(50, [1.0])]) == []
    assert run(rows, [(1, [1.0]), (2, [1.0])]) == []
    assert run(rows, [(50, [1.0]), (2, [1.0]), (1, [1.0])]) == [(50, 1, 1, 65536), (50, 2, 2, 65536)]


def test_blocks_of_queries_are_not_broadcast(rows):
    """Copied for every block of vectors they grow with both tables, and a broadcast goes through the driver."""
    df = rows(DDL, *[(i, [float(i % 7), 1.0], "x", "y", 1) for i in range(200)])
    found = top_k(df)
    assert len(found.collect()) == 20
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()


def test_only_candidates_are_sorted(monkeypatch):
    sorted_rows = []
    plain = np.lexsort
    monkeypatch.setattr(segments.np, "lexsort", lambda keys: sorted_rows.append(len(keys[0])) or plain(keys))
    v = np.random.default_rng(4).integers(-99, 99, (400, 64))
    best_of_block(v[:10], np.arange(10), v, np.arange(400), np.arange(400), 5)
    assert sorted_rows[0] < 10 * 20
