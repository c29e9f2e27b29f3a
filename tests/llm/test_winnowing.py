"""Winnowing next to a plain search of every window."""

import hashlib
import random
import re

import numpy as np
import pytest

from reviewloom.llm import winnowing
from reviewloom.llm.winnowing import contamination, decontaminated, find_contamination, minima

W = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return W.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items):
    windows = {}
    for item, text in items:
        w = words(text)
        n = min(10, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add("" if item is None else str(item))
    out = []
    for doc, text in docs:
        w, hit, names = words(text), set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    hit |= set(range(i, i + n))
                    names |= windows[tuple(w[i : i + n])]
        out.append((doc, len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def run(rows, docs, items):
    d = rows("doc_id long, text string, _found int, spans int", *[(a, b, 1, 1) for a, b in docs])
    b = rows("item_id long, text string, _text int", *[(a, t, 1) for a, t in items])
    return sorted((tuple(r) for r in contamination(d, b).collect()), key=str)


def test_odd_rows(rows):
    ten = "One two THREE four five six seven eight nine ten"
    docs = [(1, None), (2, ""), (3, "..."), (4, f"x {ten.lower()}, y"), (4, f"x {ten.lower()}, y"), (None, ten + " eleven"),
            (6, "one two three four five six seven eight nine"), (7, "ein süßer Été"), (8, "ö" + ten), (9, "pre " * 30_000 + ten + " post" * 30_000),
            (10, "ten"), (11, "a\nb-c")]
    items = [(1, ten), (1, ten), (None, ten + " eleven twelve"), (3, "süßer été"), (4, ""), (5, None), (6, "!"), (7, "A b C")]
    assert run(rows, docs, items) == brute(docs, items)


def test_random_texts_of_few_words(rows):
    draw = random.Random(5)
    docs = [(i, " ".join(draw.choices("abc", k=draw.randint(0, 80)))) for i in range(200)]
    items = [(i, " ".join(draw.choices("abc", k=draw.choice([1, 4, 5, 6, 9, 10, 11, 12, 20]) if i else 3))) for i in range(3, 12)]
    assert run(rows, docs, items) == brute(docs, items)
    long_items = [(i, t) for i, t in items if len(t.split()) > 8]
    assert run(rows, docs, long_items) == brute(docs, long_items)


def test_blocks_of_the_benchmark_give_the_same(rows, monkeypatch):
    draw = random.Random(6)
    docs = [(i, " ".join(draw.choices("abcd", k=40))) for i in range(60)]
    items = [(i, " ".join(draw.choices("abcd", k=draw.choice([4, 5, 11])))) for i in range(30)]
    want = brute(docs, items)
    monkeypatch.setattr(winnowing, "BLOCK_BYTES", 150)
    assert run(rows, docs, items) == want


def test_empty_tables(rows):
    docs = [(1, "a b c")]
    assert run(rows, docs, [])[0][2:4] == (0, 0)
    assert run(rows, [], [(1, "a")]) == []
    one = rows("doc_id long, text string, lang string", (1, "a b c", "en"), (2, "x", None), (3, None, None))
    assert [r.doc_id for r in decontaminated(one, rows("item_id long, text string", (1, "b c"))).orderBy("doc_id").collect()] == [2, 3]
    spans = find_contamination(one, rows("item_id long, text string", (1, "b c"))).filter("doc_id = 1").first()["_found"]["spans"]
    assert spans == [[1, 3]]


@pytest.mark.parametrize("wide", [1, 2, 6])
def test_minima_cover_every_run(wide):
    grams = np.random.default_rng(2).integers(0, 20, 300).astype(np.uint64)
    keep = minima(grams, wide)
    assert all(keep[i : i + wide].any() for i in range(len(grams) - wide + 1))
