"""Signatures are unbiased; classes equal those of all pairs."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from reviewloom.llm import bagminhash
from reviewloom.llm.bagminhash import classes, deduplicated, overlap, signatures, weighted
from reviewloom.llm.textbytes import mix

W = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return W.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text))


def bag(text):
    w = words(text)
    return Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else None


def brute(docs):
    """doc index -> class index (least index), by comparing all pairs."""
    bags = [None if t is None else bag(t) for _, t in docs]
    up = list(range(len(docs)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            if docs[i][1] is None or docs[j][1] is None:
                continue
            if docs[i][1] == docs[j][1]:
                alike = True
            elif bags[i] is None or bags[j] is None:
                alike = False
            else:
                common = sum((bags[i] & bags[j]).values())
                alike = common / sum((bags[i] | bags[j]).values()) >= 0.8
            if alike:
                a, b = sorted((root(i), root(j)))
                up[b] = a
    return [root(i) for i in range(len(docs))]


def expected(docs):
    group, out = brute(docs), []
    for i, (doc, _) in enumerate(docs):
        ids = [d for (d, _), g in zip(docs, group) if g == group[i]]
        named = [d for d in ids if d is not None]
        out.append((doc, min(named) if named else None, len(ids)))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.doc_id, r["_class"], r["_size"]) for r in classes(df).collect()), key=str)


def test_components_agree_as_often_as_the_weighted_index_says():
    draw = random.Random(1)
    for _ in range(3):
        a, b = Counter(), Counter()
        for x in range(60):
            a[x], b[x] = draw.choice([0, 1, 2, 3, 7, 20]), draw.choice([0, 1, 2, 5, 9])
        want = sum((a & b).values()) / sum((a | b).values())
        items = [(0, x, n) for x, n in a.items() if n] + [(1, x, n) for x, n in b.items() if n]
        rows, hashes, weights = (np.array(c) for c in zip(*items))
        h = mix(hashes.astype(np.uint64) + np.uint64(12345))
        s = signatures(rows, h, weights, 2, size=20_000)
        assert np.isfinite(s).all()
        assert abs((s[0] == s[1]).mean() - want) < 4 * np.sqrt(want * (1 - want) / 20_000)


def test_weighted_and_overlap():
    rows, hashes, counts = weighted(np.array([1, 0, 1, 1]), np.array([5, 5, 5, 2], np.uint64))
    assert rows.tolist() == [0, 1, 1] and hashes.tolist() == [5, 2, 5] and counts.tolist() == [1, 1, 2]
    a = (np.array([1, 2], np.uint64), np.array([3, 1]))
    b = (np.array([2, 3], np.uint64), np.array([2, 1]))
    assert overlap(a, b) == 1 / 6


def corpus(seed, n=40):
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(500)]
    docs = []
    for i in range(n):
        base = draw.choices(vocabulary, k=draw.randint(1, 120))
        docs.append(" ".join(base))
        for _ in range(draw.choice([0, 0, 1, 4])):
            copy = list(base)
            for _ in range(draw.randint(0, 4)):
                copy[draw.randrange(len(copy))] = draw.choice(vocabulary)
            docs.append(draw.choice([" ", ", "]).join(copy))
    draw.shuffle(docs)
    return list(enumerate(docs, 100))


@pytest.mark.parametrize("seed", [1, 2])
def test_classes_equal_all_pairs(rows, seed):
    docs = corpus(seed)
    assert got(rows("doc_id long, text string", *docs)) == expected(docs)


def test_chains_of_drifting_copies(rows):
    # neighbours are alike, ends are not; all must be one class
    draw = random.Random(5)
    base = [f"x{draw.randrange(10**6)}" for _ in range(100)]
    docs = []
    for i in range(30):
        docs.append((i, " ".join(base)))
        base = base[2:] + [f"y{i}a", f"y{i}b"]
    draw.shuffle(docs)
    assert got(rows("doc_id long, text string", *docs)) == expected(docs)


def test_odd_rows(rows):
    long = "word " * 60_000
    docs = [(1, None), (2, None), (None, None), (3, ""), (4, ""), (5, "..."), (6, "!"), (7, "One two"), (8, "one, TWO!"), (9, "one two three"),
            (10, "a b c d e f"), (10, "a b c d e f"), (None, "a b c d e f"), (None, "only null id"), (None, "only null id"), (11, long), (12, long + "end"), (13, "é ü")]
    df = rows("doc_id long, text string, _class string, _rid int, node int", *[(*d, "x", 1, 1) for d in docs])
    assert got(df) == expected(docs)
    kept = deduplicated(df).collect()
    assert len(kept) == len(set(brute(docs)))
    assert sorted(str(r.doc_id) for r in kept if r.text is None) == ["1", "2", "None"]
    assert [r.doc_id for r in kept if r.text == "a b c d e f"] == [10]
    assert classes(df.limit(0)).count() == 0


def test_given_documents(spark):
    from reviewloom.llm.registry import QUERIES

    folder = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    out = QUERIES["op8_bagminhash_classes"](spark, folder).collect()
    assert sorted((r.doc_id, r.class_id, r.class_size) for r in out) == sorted(expected(docs))
    assert sum(r.representative for r in out) == len({r.class_id for r in out})


def crowded(seed, n=260):
    """Texts that share one long passage, so that hundreds of unlike texts meet in a band, with a few pairs of near copies."""
    draw = random.Random(seed)
    passage = [f"p{i}" for i in range(120)]
    docs = []
    for i in range(n):
        own = [f"d{i}x{draw.randrange(10**6)}" for _ in range(draw.randint(30, 60))]
        docs.append(" ".join(passage + own))
        if i % 13 == 0:
            docs.append(" ".join(passage + own[:-1] + ["other"]))
        if i % 20 == 0:
            docs.append(" ".join(["before"] + passage + own))
    draw.shuffle(docs)
    return list(enumerate(docs))


@pytest.mark.parametrize("cell", [1024, 16])
def test_bands_that_many_unlike_texts_share(rows, monkeypatch, cell):
    monkeypatch.setattr(bagminhash, "CELL_ROWS", cell)
    docs = crowded(3)
    assert got(rows("doc_id long, text string", *docs)) == expected(docs)


def test_no_rows_are_paired_up_across_groups(spark, rows, monkeypatch):
    docs = crowded(4, 120)
    df = rows("doc_id long, text string", *docs)
    sizes = []
    kept = bagminhash.stored
    monkeypatch.setattr(bagminhash, "stored", lambda d: (t := kept(d), sizes.append(t.count()))[0])
    got(df)
    assert max(sizes) <= len(docs) * bagminhash.BANDS


def test_keys_are_dealt_by_band_once(spark):
    keys = spark.createDataFrame([(i, i % 2, i // 3 if i < 9 else i) for i in range(20)], "node long, at int, band long")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        members = bagminhash._members(keys).select("band", "node", "at", "hub")
        found = sorted(map(tuple, members.collect()))
        plan = members._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert found == [(i // 3, i, i % 2, i // 3 * 3) for i in range(9)]
    made = [x for x in plan.splitlines() if "hashpartitioning(band" in x and "ReusedExchange" not in x]
    assert len(made) == 1 and "ReusedExchange" in plan
