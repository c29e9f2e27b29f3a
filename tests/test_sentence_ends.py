"""Sentence ends: made-up cases, both forms of the table, and aspects over learnt sentences."""

import pytest
from pyspark.sql import functions as F

from reviewloom.functions.text import sentences
from reviewloom.operators import aspects, sentence_ends

CORPUS = [
    "I saw Dr. Smith. He left. The shop, e.g. this one, is near.",
    "Ask Dr. Brown about it. It is 3.5 in. wide. We went in. It rained.",
    "Bring milk, eggs, etc. The list is long. See Dr. Smith e.g. now!",
    "A board of 12 in. long wood. The tools, etc. are in the shop. They put it in. So it was done.",
    "Only the price, e.g. in the shop, is high? Dr. Jones knows the one in here. in the end it works.",
    "Some say (approx. 5 in. or so) it fits. The approx. size is right. It came approx. late. The end",
] * 3 + ["They need approx. two of it"] * 60


@pytest.fixture
def corpus(rows):
    return rows("row_id long, text string", *enumerate(CORPUS), (100, None), (101, ""), (102, "  "), (103, "no period"))


def cut(df, **kw):
    return {r.row_id: r.sentences for r in sentence_ends.with_sentences(df, **kw).collect()}


def test_abbreviations_are_learnt(corpus):
    got = {r.word: r for r in sentence_ends.abbreviation_scores(sentence_ends.word_counts(corpus)).collect()}
    assert {w for w, r in got.items() if r.is_abbreviation} == {"dr", "e.g", "etc", "# in", "approx"}
    assert not got["in"].is_abbreviation and not got["smith"].is_abbreviation


def test_sentences(corpus):
    got = cut(corpus)
    assert got[0] == ["I saw Dr. Smith.", "He left.", "The shop, e.g. this one, is near."]
    assert got[1] == ["Ask Dr. Brown about it.", "It is 3.5 in. wide.", "We went in.", "It rained."]
    assert got[2] == ["Bring milk, eggs, etc.", "The list is long.", "See Dr. Smith e.g. now!"]
    assert got[3] == ["A board of 12 in. long wood.", "The tools, etc. are in the shop.", "They put it in.", "So it was done."]
    assert got[4][0] == "Only the price, e.g. in the shop, is high?"
    assert got[5] == ["Some say (approx. 5 in. or so) it fits.", "The approx. size is right.", "It came approx. late.", "The end"]
    assert (got[100], got[101], got[102], got[103]) == (None, [], ["  "], ["no period"])


def test_a_large_table_is_joined_with_equal_result(corpus, monkeypatch):
    small = cut(corpus)
    monkeypatch.setattr(sentence_ends, "may_broadcast", lambda table: False)
    assert cut(corpus) == small


def test_plain_split_where_nothing_was_learnt(rows):
    texts = ["One. Two!  Three? ", "no end", "a.b c. d.\n\ne", "... x", "."]
    df = rows("row_id long, text string", *enumerate(texts))
    none = sentence_ends.word_counts(df).limit(0)
    want = {r.row_id: r.s for r in df.select("row_id", sentences("text").alias("s")).collect()}
    assert cut(df, counts=none) == want


def test_aspects_over_learnt_sentences(corpus):
    held = sentence_ends.with_sentences(corpus).filter("row_id = 4")
    price = {"price": ["price"]}
    got = aspects.tag_aspects(held, price, text="sentences").first().relevant_sentences
    assert got == "Only the price, e.g. in the shop, is high?"
    assert aspects.tag_aspects(held, price).first().relevant_sentences == "Only the price, e.g."


def test_a_long_text(rows, corpus):
    df = rows("row_id long, text string", (1, "Ask Dr. Smith now. " * 20_000))
    got = sentence_ends.with_sentences(df, sentence_ends.word_counts(corpus)).select(F.size("sentences").alias("n"), F.array_distinct("sentences").alias("d")).first()
    assert (got.n, got.d) == (20_000, ["Ask Dr. Smith now."])
