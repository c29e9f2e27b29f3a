"""Search for a table of queries next to the search for one, and to all pairs."""

import math

import numpy as np
import pytest

from reviewloom.operators import retrieval
from reviewloom.operators.query_tables import search_table, top_k_table

DDL = "id long, values array<double>, category string, year int, month int, subcategory string"


def rows_of(n, seed, width=12):
    draw = np.random.default_rng(seed)
    return [(i, [float(v) for v in draw.normal(size=width)], f"Cat {i % 3}", 2018 + i % 2, 1 + i % 4, f"sub{i}") for i in range(n)]


@pytest.mark.parametrize("sizes", [(7, 3), (8192, 1024)])
def test_equals_all_pairs(rows, sizes):
    data = rows_of(60, 1)
    data += [(100 + i, data[3][1], "Cat 0", 2018, 1, "copy") for i in range(40)]
    data += [(200, None, "a", 1, 1, "x"), (201, [0.0] * 12, "a", 1, 1, "x"), (202, [1.0, None], "a", 1, 1, "x"), (203, [float("nan")] * 12, "a", 1, 1, "x"), (204, [1.0, 2.0], "a", 1, 1, "x")]
    usable = [(i, v) for i, v, *_ in data if v and any(v) and all(x is not None and math.isfinite(x) for x in v)]
    df = rows(DDL, *data)
    asked = df.filter("id % 5 = 0 or id = 204").selectExpr("id AS query_id", "values")
    got = sorted((r.query_id, r.rank, r.id) for r in top_k_table(asked, df, 6, rows_in_block=sizes[0], queries_in_block=sizes[1]).collect())
    want = []
    for q, a in usable:
        if q % 5 == 0 or q == 204:
            scored = sorted((-float(np.cumsum(np.array(a) * b)[-1] / (math.sqrt(np.cumsum(np.square(a))[-1]) * math.sqrt(np.cumsum(np.square(b))[-1]))), i) for i, b in usable if len(b) == len(a))
            want += [(q, r + 1, i) for r, (_, i) in enumerate(scored[:6])]
    assert got == sorted(want)


@pytest.mark.parametrize("prefilter", [False, True])
@pytest.mark.parametrize("k", [1, 5])
def test_equals_one_search_at_a_time(rows, prefilter, k):
    data = rows_of(48, 2)
    vectors = rows(DDL, *data)
    docs = vectors.select("category", "year", "month", "subcategory")
    wants = [(0, None, None, "ALL"), (5, "cat 1", None, None), (6, "Cat 2", "2019", None), (7, None, "2018", "3"), (8, "cat", "2018", "ALL"), (9, "Cat 9", None, None), (10, "", "2019", "2")]
    queries = rows("query_id long, values array<double>, category string, year string, month string", *[(i, data[i][1], *w) for i, *w in wants])
    got = sorted((r.query_id, r.rank, r.subcategory) for r in search_table(queries, vectors, docs, k, prefilter).collect())
    want = []
    for i, category, year, month in wants:
        for r in retrieval.search(vectors, data[i][1], docs, k, category, year, month, prefilter).collect():
            want.append((i, r["rank"], r.subcategory))
    assert got == sorted(want)


def test_text_ids_and_empty_tables(rows):
    df = rows("id string, values array<float>, other int", ("b", [1.0, 0.0], 1), ("a", [2.0, 0.0], 2), ("c", [0.0, 1.0], 3))
    asked = rows("query_id string, values array<float>", ("q", [3.0, 0.0]))
    assert [(r.id, r.score, r["rank"]) for r in top_k_table(asked, df, 2).orderBy("rank").collect()] == [("a", 1.0, 1), ("b", 1.0, 2)]
    assert top_k_table(asked.limit(0), df, 2).count() == 0
    assert top_k_table(asked, df.limit(0), 2).count() == 0


def test_scores_of_a_pair_of_full_blocks_stay_small():
    """Python's own count of a pair's memory; the whole matrix of scores alone would take 64 MB."""
    import tracemalloc

    import numpy as np

    from reviewloom.operators import query_tables as q

    rng = np.random.default_rng(0)

    def block(n):
        x = rng.normal(size=(n, 16))
        return {"id": list(range(n)), "width": 16, "data": x.tobytes(), "sizes": np.full(n, 16, np.int32).tobytes()}, x

    (asked, a), (held, b) = block(q.QUERIES_IN_BLOCK), block(q.VECTORS_IN_BLOCK)
    tracemalloc.start()
    at, row, _ = q._best(asked, held, 3, ())
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 48 * 2**20
    cosine = (a / np.linalg.norm(a, axis=1)[:, None]) @ (b / np.linalg.norm(b, axis=1)[:, None]).T
    assert (at == np.repeat(np.arange(len(a)), 3)).all() and (row.reshape(-1, 3) == np.argsort(-cosine, axis=1)[:, :3]).all()
