"""Token counts next to the tokenizer's own library."""

import random

import public_tokenizers
from tokenizers import Tokenizer

from reviewloom.llm import whole_tokens
from reviewloom.llm.whole_tokens import TOKENIZER, TokenCounter, token_counts

ODD = [
    "", " ", "   ", "\n\n \t x", "a<|endoftext|>b", "<|endoftext|><|endoftext|>", " <|endoftext|> ", "don't we'll I'M",
    "\x1c\x1d\x85 x y z", "naïve ÉTÉ größer ñandú", "中文字符テスト 한국어", "👩‍👩‍👧 🏳️‍🌈", "1234567890123 ½ Ⅷ",
    "!!!???###%%%", "a" * 5000, " " * 3000 + "x", "́́é", "\x00\x01\x7f", "﻿bom​",
]


def reference(texts):
    t = Tokenizer.from_file(TOKENIZER)
    return [len(e.ids) for e in t.encode_batch(texts, add_special_tokens=False)]


def counter():
    definition = open(TOKENIZER, encoding="utf-8").read()
    return TokenCounter(definition, whole_tokens.whole_tokens(definition))


def test_odd_texts_and_random_strings():
    draw = random.Random(3)
    alphabet = "ab 's\n\t.,é中1\x1c\x85 ́<|>" + "endoftext" + "👍"
    texts = ODD + ["".join(draw.choices(alphabet, k=draw.randint(0, 60))) for _ in range(3000)]
    assert counter().counts(texts) == reference(texts)


def test_whole_tokens_are_single():
    c = counter()
    sample = random.Random(1).sample(sorted(c.whole), 2000)
    assert reference(sample) == [1] * 2000
    assert len(c.whole) > 40_000


def test_memory_is_bounded(monkeypatch):
    monkeypatch.setattr(whole_tokens, "REMEMBERED", 5)
    c = counter()
    for i in range(10):
        texts = [f"zzq{i}{j}qq xxk{j}" for j in range(20)]
        assert c.counts(texts) == reference(texts)
        assert len(c.table) <= len(c.whole) + 5 + 200


def test_rows(rows):
    df = rows("doc_id long, text string, n_tokens int, n_bytes int", (1, None, 7, 7), (1, None, 7, 7), (None, "", 1, 1), (2, "héllo world", 1, 1), (3, "word " * 100_000, 1, 1))
    got = sorted(((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts(df).collect()), key=str)
    long = reference(["word " * 100_000])[0]
    want = [(1, 0, 0, False), (1, 0, 0, False), (None, 0, 0, False), (2, 12, reference(["héllo world"])[0], False), (3, 500_000, long, True)]
    assert got == sorted(want, key=str)
    assert token_counts(df.limit(0)).count() == 0


def test_given_documents(spark):
    from reviewloom.llm.registry import QUERIES

    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    got = {r.doc_id: r for r in QUERIES["op10_whole_token_counts"](spark, folder).collect()}
    want = dict(zip(texts, reference(list(texts.values()))))
    assert {k: r.n_tokens for k, r in got.items()} == want
    assert all(r.n_bytes == len(texts[k].encode()) for k, r in got.items())
    assert public_tokenizers.path("byte_bpe_50k.json") == TOKENIZER
