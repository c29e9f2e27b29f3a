"""Hard negatives next to all inner products."""

import math

import numpy as np
import pytest

from reviewloom.llm.bond import Columns, hard_negatives, in_windows, nearest

DDL = "vec_id long, embedding array<float>, label long, part string, positive_score int, rid int"


def brute(vectors, every=100, positives=5, negatives=5, floor=80):
    usable = [(i, v, l, [max(-(2**63), min(2**63 - 1, math.floor(256 * float(np.float32(x))))) for x in e]) for i, (v, e, l) in enumerate(vectors)
              if None not in (v, e, l) and all(x is not None and math.isfinite(x) for x in e)]
    out = []
    for i, a, la, xa in usable:
        if a % every:
            continue
        scored = sorted((-max(-(2**63), min(2**63 - 1, sum(x * y for x, y in zip(xa, xb)))), v, j, l) for j, v, l, xb in usable if j != i)
        for p, pid, _, _ in [s for s in scored if s[3] == la][:positives]:
            fits = [s for s in scored if s[3] != la and floor * -p <= 100 * -s[0] <= 100 * -p][:negatives]
            out += [(a, pid, r + 1, s[1], -p, -s[0]) for r, s in enumerate(fits)]
    return sorted(out)


def run(rows, vectors, **options):
    df = rows(DDL, *[(v, e, l, "x", 1, 2) for v, e, l in vectors])
    return sorted(tuple(r) for r in hard_negatives(df, **options).collect())


def crowd(n, width, seed, centers=0):
    draw = np.random.default_rng(seed)
    x = draw.normal(size=(n, width))
    if centers:
        x = draw.normal(size=(centers, width))[draw.integers(0, centers, n)] + 0.2 * x
    return x / np.linalg.norm(x, axis=1)[:, None]


@pytest.mark.parametrize("rows_in_block", [40, 8192])
def test_equals_brute_force(rows, rows_in_block):
    x = crowd(400, 24, 1, 6)
    vectors = [(i % 310, [float(v) for v in x[i]], i % 3) for i in range(400)]
    vectors += [(0, vectors[0][1], 0)] * 4 + [(200, vectors[0][1], 1)] * 3
    vectors += [(None, vectors[1][1], 0), (300, None, 1), (301, vectors[2][1], None), (302, [1.0, None], 1), (303, [float("nan")] * 24, 1), (304, [float("inf")] * 24, 1),
                (305, [0.5, 0.5], 2), (300, [], 1), (100, [0.0] * 24, 2)]
    assert run(rows, vectors, rows_in_block=rows_in_block) == brute(vectors)


def test_huge_components_stop_at_64_bits(rows):
    vectors = [(0, [3e38, 1.0], 1), (1, [3e38, 2.0], 1), (2, [-3e38, 1.0], 2), (3, [3e38, -1.0], 2), (4, [1e12, 1.0], 1), (5, [1e9, 1.0], 2)]
    assert run(rows, vectors) == brute(vectors)


def test_few_rows_and_none(rows):
    assert run(rows, []) == []
    assert run(rows, [(100, [1.0], 1)]) == []
    assert run(rows, [(100, [1.0], 1), (2, [1.0], 1)]) == []
    assert run(rows, [(1, [1.0], 1), (2, [1.0], 1), (3, [1.0], 2)]) == []
    assert run(rows, [(100, [1.0], 1), (2, [1.0], 1), (3, [0.9], 2), (4, [0.7], 2), (5, [1.1], 2)]) == [(100, 2, 1, 3, 65536, 58880)]


@pytest.mark.parametrize("centers, most", [(0, 0.85), (40, 0.5)])
def test_the_bitmap_shrinks_before_all_columns_are_read(centers, most):
    x = np.floor(256 * crowd(4000, 64, 3, centers)).astype(np.int64)
    ids, block = np.arange(4000), Columns(x)
    for q in range(0, 4000, 200):
        others = ids != q
        at, scores = nearest(block, x[q], others.copy(), ids, ids, 5)
        want = sorted((-int(x[q] @ x[j]), j) for j in ids if j != q)[:5]
        assert [(-int(s), int(j)) for j, s in zip(at, scores)] == want
        tops = scores[[0, 2, 4]]
        for top, (inside, found) in zip(tops, in_windows(block, x[q], others & (ids % 3 > 0), ids, ids, tops, 5, 80)):
            fits = sorted((-int(x[q] @ x[j]), j) for j in ids if j != q and j % 3 and 80 * top <= 100 * int(x[q] @ x[j]) <= 100 * top)[:5]
            assert [(-int(s), int(j)) for j, s in zip(inside, found)] == fits
    assert block.read < most * block.whole


def test_unread_part_lies_between_the_bounds():
    x = np.floor(256 * crowd(500, 20, 4)).astype(np.int64)
    block, seen = Columns(x), []

    def wanted(lower, upper):
        seen.append((lower, upper))
        return np.ones(len(lower), bool)

    block.scan(x[7], np.ones(500, bool), wanted)
    exact = x @ x[7]
    assert len(seen) == 3
    assert all((lower <= exact + 1e-6).all() and (upper >= exact - 1e-6).all() for lower, upper in seen)
    assert all((np.diff([s[1] for s in seen], axis=0) <= 1e-3).ravel())
