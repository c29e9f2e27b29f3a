"""Packing keeps every id, fills rows as a plain best-fit search does, and its files read back."""

import random

import numpy as np

from reviewloom.llm.packing import END, FIRST_BYTE, best_fit, given_ids, pack, position_ids, write_matrices


def plain_best_fit(sizes, width):
    free = []
    for size in sorted(sizes, reverse=True):
        fits = [f for f in free if f >= size]
        if fits:
            free[free.index(min(fits))] -= size
        else:
            free.append(width - size)
    return sorted(free)


def test_best_fit_against_a_plain_search():
    draw = random.Random(1)
    for width in (1, 7, 8, 64, 100):
        for _ in range(40):
            sizes = [draw.randint(1, width) for _ in range(draw.randint(0, 80))]
            places, n = best_fit(sizes, width)
            used = [0] * n
            taken = set()
            for size, (row, start) in zip(sizes, places):
                cells = {(row, c) for c in range(start, start + size)}
                assert not cells & taken and start + size <= width
                taken |= cells
                used[row] += size
            assert sorted(width - u for u in used) == plain_best_fit(sizes, width)


def unpacked(out, kind, width):
    docs = {}
    for r in out:
        row = np.frombuffer(r.ids, kind)
        assert len(row) == width and r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_ids and not row[r.n_ids :].any()
        assert [s for s in r.resets if s < r.n_ids] == r.cu_seqlens[:-1]
        for doc, first, a, b in zip(r.doc_ids, r.doc_starts, r.cu_seqlens, r.cu_seqlens[1:]):
            docs.setdefault(doc, []).append((first, row[a:b].tolist()))
    return {d: sorted(p) for d, p in docs.items()}


def texts(out, width):
    found = {}
    for doc, parts in unpacked(out, np.uint16, width).items():
        ids = [i for _, p in parts for i in p]
        assert [f for f, _ in parts] == list(np.cumsum([0] + [len(p) for _, p in parts])[:-1])
        assert ids[-1] == END and END not in ids[:-1]
        found[doc] = bytes(i - FIRST_BYTE for i in ids[:-1]).decode()
    return found


def test_round_trip(rows):
    long = "é word " * 30_000
    want = {1: "", None: "no id", 3: "short", 4: long, 6: "\x00\x01"}
    df = rows("doc_id long, text string, ids string", *[(k, v, "x") for k, v in want.items()], (2, None, "x"))
    for size in (10, 10_000_000):
        out = pack(df, width=64, group_ids=size).collect()
        assert texts(out, 64) == want
    assert pack(df.limit(0)).count() == 0
    twice = pack(rows("doc_id long, text string", (1, "a"), (1, "a")), width=4).collect()
    assert sum(len(r.doc_ids) for r in twice) == 2


def test_given_ids_and_matrices(rows, spark, tmp_path):
    df = rows("doc_id int, tokens array<int>", (1, [5, 6, 7]), (2, []), (3, None), (4, list(range(70_000, 70_023))), (5, [None, 9]))
    packed = pack(df, "tokens", given_ids, width=10)
    got = unpacked(packed.collect(), np.uint32, 10)
    assert {d: [i for _, p in x for i in p] for d, x in got.items()} == {1: [5, 6, 7], 4: list(range(70_000, 70_023)), 5: [0, 9]}
    write_matrices(packed, str(tmp_path / "m"), width=10)
    blocks = spark.read.parquet(str(tmp_path / "m")).collect()
    assert sum(b.n_rows for b in blocks) == packed.count()
    for b in blocks:
        ids = np.frombuffer(b.ids, np.uint32).reshape(b.n_rows, b.width)
        at = np.frombuffer(b.positions, np.int32).reshape(b.n_rows, b.width)
        splits, ends = np.frombuffer(b.row_splits, np.int32), np.frombuffer(b.cu_seqlens, np.int32)
        for i in range(b.n_rows):
            e = ends[splits[i] : splits[i + 1]]
            want = np.concatenate([np.arange(n) for n in np.diff(np.append(e, b.width))])
            assert (at[i] == want).all() and not ids[i, e[-1] :].any()


def test_positions():
    assert position_ids([0, 3, 5], 8).tolist() == [0, 1, 2, 0, 1, 0, 1, 2]


def test_given_documents(spark):
    from reviewloom.llm.registry import QUERIES

    folder = "/root/testdata/sf0.001"
    want = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    out = QUERIES["op3_packed_ids"](spark, folder).collect()
    assert texts(out, 8192) == want
    assert sum(r.n_ids for r in out) / (8192 * len(out)) > 0.9
