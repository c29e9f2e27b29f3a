"""Aligned tokens next to the libraries and a plain search over byte positions."""

import hashlib
import json
import random
from collections import Counter

import pandas as pd
import pytest
import sentencepiece
from tokenizers import Tokenizer

from reviewloom.llm import alignment
from reviewloom.llm.alignment import FIRST, SECOND, Aligner, ByteLevel, alignments, merges_by_rank, token_overlaps

DEFINITION, MODEL = open(FIRST, "rb").read(), open(SECOND, "rb").read()
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
ODD = [
    None, "", " ", "  two  blanks ", "\n\n\t x", "a<|endoftext|>b<s></s><unk><0x41>", "don't we'll I'M", "naïve ÉTÉ größer", "中文字符テスト 한국어", "👩‍👩‍👧 🏳️‍🌈",
    "=" * 333, "▁ under ▁", "1234567890123 ½", "é \u0000 x\x7f", "the the the", "the the the", "word " * 3000, "!?!?" * 40,
]


@pytest.fixture(scope="module")
def sides():
    first = Tokenizer.from_str(DEFINITION.decode())
    first.encode_special_tokens = True
    return first, sentencepiece.SentencePieceProcessor(model_file=SECOND)


def spelled(text, sides):
    """(id, first byte, end byte) lists of both sides, or None."""
    letters = {}
    for b in range(256):
        letters[chr(b) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174 else chr(256 + len([c for c in letters if ord(c) > 255]))] = b
    first, second = sides
    a = first.encode(" " + text, add_special_tokens=False).ids
    b = second.encode(text)
    words = [bytes(letters[c] for c in first.id_to_token(i)) for i in a], []
    for i in b:
        piece = second.id_to_piece(i)
        words[1].append(bytes([int(piece[3:5], 16)]) if second.is_byte(i) else piece.replace("▁", " ").encode())
    out = []
    for ids, parts in zip((a, b), words):
        if b"".join(parts) != (" " + text).encode():
            return None
        at, side = 0, []
        for i, w in zip(ids, parts):
            side.append((i, at, at + len(w)))
            at += len(w)
        out.append(side)
    return out


def groups(found):
    a, b = found
    cuts = sorted({t[2] for t in a} & {t[2] for t in b})
    lo, out = 0, []
    for cut in cuts:
        out.append(([t[0] for t in a if lo <= t[1] < cut], [t[0] for t in b if lo <= t[1] < cut]))
        lo = cut
    return out


def brute(docs, sides):
    all_groups = [groups(s) if t and (s := spelled(t, sides)) else [] for _, t in docs]
    counts = Counter(pair for g in all_groups for pair in {(i, j) for a, b in g for i in a for j in b})
    best = {}
    for (i, _), n in counts.items():
        best[i] = max(best.get(i, 0), n)
    out = []
    for (doc_id, _), g in zip(docs, all_groups):
        links = [(i, j) for a, b in g for i in a for j in b]
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
        out.append((doc_id, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), len(links), sum(counts[p] == best[p[0]] for p in links),
                    sum(counts[p] for p in links), hashlib.sha256(text.encode()).hexdigest() if g else ""))
    return sorted(out, key=str)


def drawn(n, seed=5):
    draw = random.Random(seed)
    alphabet = ["a", "b", " ", " ", "the", "ing", "é", "中", "=", "==", "'s", "\n", "1", "👍", "▁", "Ab", "\t", "-", "ß"]
    return ["".join(draw.choices(alphabet, k=draw.randint(0, 40))) for _ in range(n)]


def got(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in alignments(df).collect()), key=str)


@pytest.mark.parametrize("small", [False, True])
def test_equals_brute_force(rows, sides, monkeypatch, small):
    if small:
        for name in ("CHUNK_BYTES", "PAIRS_AT_ONCE", "PAIRS_IN_ROW"):
            monkeypatch.setattr(alignment, name, 7)
        monkeypatch.setattr(alignment, "BROADCAST_PAIRS", 0)
    docs = [(i % 50 if i % 9 else None, t) for i, t in enumerate(ODD + drawn(150))]
    df = rows("doc_id long, text string, row int, pair string, n_a string, times int", *[(*d, 1, "x", "y", 2) for d in docs])
    assert got(df) == brute(docs, sides)


def test_texts_that_tokens_do_not_spell(rows, spark):
    marked = spark.createDataFrame([(1, bytearray(b"ab\xff")), (2, bytearray("▁a".encode()))], "doc_id long, text binary")
    df = marked.selectExpr("doc_id", "cast(text AS string) AS text")
    assert got(df) == [(i, 0, 0, 0, 0, 0, 0, "") for i in (1, 2)]


def test_empty_table_and_other_id_types(rows):
    assert got(rows("doc_id long, text string")) == []
    out = alignments(rows("doc_id string, text string", ("x", "hello"))).first()
    assert (out.doc_id, out.n_groups) == ("x", 1)


def test_long_runs_cost_their_distinct_ids():
    x = Aligner(DEFINITION, True, MODEL).aligned([b"=" * 200_001 + b"a"])
    _, pair, times = x.linked_ids()
    assert len(pair) < 200 and times.sum() == x.totals(1)[1][0] == (x.size_a * x.size_b).sum()


def test_overlaps_are_complete(rows, sides):
    texts = [t for t in ODD + drawn(60, 6) if t]
    df = rows("doc_id long, text string", *enumerate(texts))
    found = {}
    for r in token_overlaps(df).collect():
        found.setdefault(r.doc_id, []).append((r.a_pos, r.b_pos, r.a_id, r.b_id, r.a_end, r.b_end))
    for i, text in enumerate(texts):
        if len(text) > 2000:
            continue
        both = spelled(text, sides)
        want = [(p, q, a[0], b[0], a[2], b[2]) for p, a in enumerate(both[0]) for q, b in enumerate(both[1]) if a[1] < b[2] and b[1] < a[2]] if both else []
        assert sorted(found.get(i, [])) == want


def test_the_faster_rule_is_the_same(sides):
    assert merges_by_rank(DEFINITION)
    parsed = json.loads(DEFINITION)
    parsed["model"]["merges"] = parsed["model"]["merges"][::-1]
    assert not merges_by_rank(json.dumps(parsed).encode())
    texts = [" " + t for t in ODD if t] + drawn(2000, 7)
    want = [e.ids for e in sides[0].encode_batch(texts, add_special_tokens=False)]
    assert [list(x) for x in ByteLevel(DEFINITION, True).encode(texts)] == want
    assert [list(x) for x in ByteLevel(DEFINITION, False).encode(texts)] == want


def test_given_documents(spark, sides):
    folder = "/root/testdata/sf0.001/documents.parquet"
    docs = [(r.doc_id, r.text) for r in pd.read_parquet(folder).itertuples()]
    short = [d for d in docs if d[1] and len(d[1]) < 3000][:40]
    df = spark.createDataFrame(short, "doc_id long, text string")
    assert got(df) == brute(short, sides)
    assert alignments(spark.read.parquet(folder)).count() == len(docs)
