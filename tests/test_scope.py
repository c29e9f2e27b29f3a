"""Scoped sentiment, several-word keywords, and tables too large for one value."""

import pytest
from pyspark.sql import functions as F

from reviewloom.functions import sentiment as SC
from reviewloom.functions.sentiment import scoped_valence
from reviewloom.operators import aspects, labeling
from reviewloom.operators.aspects import tag_aspects
from reviewloom.operators.labeling import lexicon_label, weak_labels


def totals(rows, *texts):
    df = rows("no int, text string", *enumerate(texts))
    return [r.s for r in df.select("no", scoped_valence("text").alias("s")).orderBy("no").collect()]


def test_each_rule(rows):
    good, bad = 2.0, -2.0
    texts = {
        "good": good, "bad": bad, "": 0.0, "nothing here": 0.0,
        "not good at all": good * SC.NEGATED, "it was not at all good": good * SC.NEGATED, "not one of the good": good,
        "isn't good": good * SC.NEGATED, "Isn’t good": good * SC.NEGATED, "not never good": good * SC.NEGATED**2,
        "very good": good + SC.BOOST, "very bad": bad - SC.BOOST, "slightly good": good - SC.BOOST, "very x good": good + 0.95 * SC.BOOST, "very x y good": good + 0.9 * SC.BOOST,
        "very not good": (good + 0.95 * SC.BOOST) * SC.NEGATED, "GOOD thing": good + SC.CAPITALS, "GOOD": good, "VERY good": good + SC.BOOST + SC.CAPITALS,
        "good but bad": good / 2 + bad * 1.5, "good but bad but good": good / 2 + bad * 1.5 + good * 1.5,
        "good!": good + SC.EXCLAMATION, "bad!!!!!!": bad - 4 * SC.EXCLAMATION, "good?": good, "good??": good + 0.36, "good?????": good + SC.MANY_QUESTIONS,
    }
    assert totals(rows, *texts) == pytest.approx(list(texts.values()))
    assert totals(rows, None) == [0.0]


def test_negation_turns_the_label(rows):
    df = rows("row_id int, text string", (1, "not good at all"), (2, "very good"), (3, "the part"), (4, None))
    assert [r.sentiment_label for r in lexicon_label(df, scoped=True).orderBy("row_id").collect()] == ["NEGATIVE", "POSITIVE", "NEUTRAL", "NEUTRAL"]


@pytest.mark.parametrize("scoped", [False, True])
def test_rule_rows_and_tables_agree(rows, monkeypatch, scoped):
    lexicon = {"good": 1.9, "awful": -2.1, "fine": 0.8, "not": -0.4}
    texts = ["Not good, awful!", "fine but not fine", None, "", "nothing known", "GOOD good very good day", "awful " * 40]
    df = rows("row_id int, text string, rating double, relevant_sentences string, word string", *[(i, t, 3.0, t, "x") for i, t in enumerate(texts)])
    table = rows("word string, valence double, other int", *[(w, v / 2, 1) for w, v in lexicon.items() for _ in range(2)], (None, 5.0, 1))
    small = [tuple(r) for r in lexicon_label(df, lexicon, scoped=scoped).orderBy("row_id").collect()]
    assert [tuple(r) for r in lexicon_label(df, table, scoped=scoped).orderBy("row_id").collect()] == small
    rule = "scoped_lexicon" if scoped else "lexicon"
    votes = [r[rule] for r in labeling.label_matrix(df, [rule], table).orderBy("row_id").collect()]
    marks = [r.sentiment_label for r in labeling.aspect_labels(df, table, scoped).orderBy("row_id").collect()]
    assert marks == [s[-1] for s in small] == [{0: "NEUTRAL", 1: "POSITIVE", 2: "NEGATIVE"}[v] for v in votes]
    monkeypatch.setattr(labeling, "may_broadcast", lambda *a: False)
    assert [tuple(r) for r in lexicon_label(df, table, scoped=scoped).orderBy("row_id").collect()] == small
    assert weak_labels(df, [rule, "high_rating"], lexicon=lexicon).count() == len(texts)


TAGGED = "row_id long, text string, aspect_note string"
SAID = [(1, "Free shipping cost was low. The customer service desk helped."), (2, "Service desk. customer service"), (3, "shipping-cost and service"), (4, None), (5, "customer. service desk")]
WORDS = {"delivery": ["free shipping", "Shipping cost"], "help": ["customer service", "service desk", "desk"], "two": ["customer service desk"]}
WANT = [(1, "delivery", "Free shipping cost was low."), (1, "help", "The customer service desk helped."), (1, "two", "The customer service desk helped."),
        (2, "help", "Service desk. customer service"), (5, "help", "service desk")]


@pytest.mark.parametrize("form", ["mapping", "table", "long table"])
def test_keywords_of_several_words(rows, monkeypatch, form):
    df = rows(TAGGED, *[(i, t, "x") for i, t in SAID])
    keys = {a: [k.lower() for k in v] for a, v in WORDS.items()}
    if form != "mapping":
        keys = rows("aspect string, keyword string", *[(a, k) for a, v in keys.items() for k in v], ("none", None), (None, "desk"), ("none", "?!"))
    if form == "long table":
        monkeypatch.setattr(aspects, "may_broadcast", lambda *a: False)
    got = sorted((r.row_id, r.aspect, r.relevant_sentences) for r in tag_aspects(df, keys, lower=True, several_words=True).collect())
    assert got == WANT
    single = sorted((r.row_id, r.aspect) for r in tag_aspects(df, keys, lower=True).collect())
    assert single == [(1, "help"), (2, "help"), (5, "help")]
    per = {r.row_id: (r.matched_aspects, r.relevant_sentences) for r in tag_aspects(df, keys, lower=True, per="review", several_words=True).collect()}
    assert per[1] == ("delivery, help, two", " ".join(w[2] for w in WANT[:3])) and set(per) == {1, 2, 5}


def test_order_of_aspects_and_case(rows, monkeypatch):
    df = rows(TAGGED, (1, "Aa bb", "x"))
    table = rows("aspect string, keyword string, aspect_no int", ("late", "Aa", 2), ("early", "bb", 7), ("late", "bb", 1), ("never", "aa", 0))
    for large in (False, True):
        if large:
            monkeypatch.setattr(aspects, "may_broadcast", lambda *a: False)
        assert tag_aspects(df, table, per="review").first().matched_aspects == "late, early"


def test_a_table_of_many_words(spark, rows):
    """Beyond what goes along with each row, words are joined; nothing is gathered in one cell."""
    table = spark.range(700_000).select(F.concat(F.lit("w"), F.col("id")).alias("word"), (F.col("id") % 5 - 2.0).alias("valence"))
    df = rows("row_id long, text string", *[(i, f"w{i} w{i + 1} unknown w{699_999 - i}") for i in range(50)])
    got = {r.row_id: r.compound for r in lexicon_label(df, table).collect()}
    for i in range(50):
        s = sum(n % 5 - 2.0 for n in (i, i + 1, 699_999 - i))
        assert got[i] == pytest.approx(s / (s * s + 15) ** 0.5)
    keys = spark.range(250_000).select(F.concat(F.lit("a"), F.col("id") % 7).alias("aspect"), F.concat(F.lit("w"), F.col("id")).alias("keyword"))
    tagged = {(r.row_id, r.aspect) for r in tag_aspects(df, keys).collect()}
    assert tagged == {(i, f"a{n % 7}") for i in range(50) for n in (i, i + 1)}
