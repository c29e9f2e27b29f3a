"""Labelling rules, label model, aspects."""

import pytest
from pyspark.sql import functions as F

from reviewloom.functions import labels as L
from reviewloom.functions.text import sentences, tokens
from reviewloom.operators import aspects, labeling


@pytest.mark.parametrize(
    "text,want",
    [
        ("great and excellent but bad", 1), ("great but bad", 0), ("good, bad, awful", 2), ("GOOD", 1), ("refund", 2),
        ("nothing", 0), ("", 0), (None, 0), ("goodgood bad", 1),
    ],
)
def test_keyword_ratio(rows, text, want):
    assert rows("text string", (text,)).select(L.keyword_ratio()).first()[0] == want


def test_weak_labels_of_the_fixture(rows):
    df = rows(
        "row_id int, rating int, text string", (1, 1, "Horrible product, bad and broken. A waste."), (2, 4, "Excellent quality, love it"), (3, 3, "It is okay"),
        *[(10 + i, 1 + i % 5, "bad" if i % 5 < 2 else "great" if i % 5 > 2 else "okay") for i in range(50)],
    )
    got = {r.row_id: r.sentiment_label for r in labeling.weak_labels(df).collect()}
    assert got[1] == "NEGATIVE" and got[2] == "POSITIVE" and None not in got.values()


def test_label_model_depends_on_counts_only(rows):
    votes = [(1, 0, 1), (0, 2, 2), (0, 0, 0), (1, 0, 0)]
    once = rows("a int, b int, c int", *[v for v, n in zip(votes, (5, 3, 2, 1)) for _ in range(n)])
    tenfold = rows("a int, b int, c int", *[v for v, n in zip(votes, (50, 30, 20, 10)) for _ in range(n)]).repartition(7)
    first, second = (labeling.fit_label_model(d, ["a", "b", "c"]) for d in (once, tenfold))
    assert set(first) == set(votes) and first[(1, 0, 1)] == second[(1, 0, 1)] == 1 and second[(0, 2, 2)] == 2


@pytest.mark.parametrize("votes,want", [((0, 1, 2), 0), ((1, 1, 2), 1), ((2, 2, 0), 2), ((1, 2, 2), 2)])
def test_majority(rows, votes, want):
    df = rows("a int, b int, c int", votes)
    assert labeling.majority_label(df, ["a", "b", "c"]).first().majority == want


def test_lexicon_table_equals_literal(rows, spark):
    df = rows("row_id int, text string", (1, "good good bad"), (2, "worst"), (3, "plain"), (4, None))
    literal = labeling.lexicon_label(df).select("row_id", "compound", "sentiment_label")
    table = spark.createDataFrame(list(L.DEFAULT_LEXICON.items()), "word string, valence double")
    joined = labeling.lexicon_label(df, table).select("row_id", "compound", "sentiment_label")
    assert sorted(literal.collect()) == sorted(joined.collect())
    assert {r.row_id: r.sentiment_label for r in literal.collect()} == {1: "POSITIVE", 2: "NEGATIVE", 3: "NEUTRAL", 4: "NEUTRAL"}
    large = {**L.DEFAULT_LEXICON, **{f"word{i}": 1.0 for i in range(3000)}}
    assert sorted(labeling.lexicon_label(df, large).select("row_id", "compound", "sentiment_label").collect()) == sorted(literal.collect())
    # no id is needed, rows that share one keep their own scores, columns keep their places
    same = rows("text string, row_id int", ("good", 1), ("bad", 1), ("good word7", 1))
    for lexicon in (None, L.DEFAULT_LEXICON, large):
        out = labeling.lexicon_label(same, lexicon)
        assert out.columns == ["text", "row_id", "compound", "sentiment_label"]
        assert [r.sentiment_label for r in out.collect()] == ["POSITIVE", "NEGATIVE", "POSITIVE"]
    assert len({r.compound for r in labeling.lexicon_label(same, large).collect()}) == 3
    votes = labeling.label_matrix(rows("text string, rating double", ("zork", 3.0)), lexicon={"zork": 4.0}).first()
    assert votes["lexicon"] == labeling.label_matrix(rows("text string, rating double", ("good", 3.0))).first()["lexicon"]
    tagged = rows("relevant_sentences string", ("zork",), ("none",))
    assert [r.sentiment_label for r in labeling.aspect_labels(tagged, {"zork": -3.0}).collect()] == ["NEGATIVE", "NEUTRAL"]


KEYWORDS = {
    "delivery": ["delivery", "fast", "shipping"], "quality": ["quality", "great", "good"], "customer_service": ["service", "helpful", "customer"],
    "product_design": ["design", "stylish"], "cost": ["price", "expensive", "cheap"],
}


@pytest.fixture
def reviews(rows):
    return rows(
        "row_id int, text string, user_id string, asin string",
        (1, "The delivery was fast and the product quality is great.", "u1", "a1"),
        (2, "I had a terrible experience with customer service.", "u2", "a2"),
        (3, "The design is stylish but the price is too high.", "u3", "a3"),
    )


def test_aspects_in_order(reviews):
    got = [(r.row_id, r.aspect) for r in aspects.tag_aspects(reviews, KEYWORDS).collect()]
    by_row = {i: [a for j, a in got if j == i] for i in (1, 2, 3)}
    assert by_row == {1: ["delivery", "quality"], 2: ["customer_service"], 3: ["product_design", "cost"]}


def test_aspect_labels_have_no_null(reviews):
    labelled = labeling.aspect_labels(aspects.tag_aspects(reviews, KEYWORDS))
    assert labelled.filter("sentiment_label is null").count() == 0 and labelled.count() == 5


def test_aspect_case_and_per_review(rows):
    df = rows("row_id int, text string", (1, "Delivery was slow. The delivery came! Price $5?"), (2, "nothing here"), (3, None))
    assert [r.relevant_sentences for r in aspects.tag_aspects(df, {"d": ["delivery"]}).collect()] == ["The delivery came!"]
    lower = aspects.tag_aspects(df, {"d": ["delivery"]}, lower=True).collect()
    assert [r.relevant_sentences for r in lower] == ["Delivery was slow. The delivery came!"]
    per = aspects.tag_aspects(df, {"d": ["delivery"], "c": ["$"]}, per="review").collect()
    assert [(r.matched_aspects, r.relevant_sentences) for r in per] == [("d, c", "The delivery came! Price $5?")]


def test_phrases_match_inside_words(rows):
    df = rows("row_id int, text string", (1, "Very easy to use. It helped. Overpriced!"))
    got = sorted((r.aspect, r.sentence) for r in aspects.phrase_sentences(df).collect())
    assert got == [("Customer Service", "It helped."), ("Pricing", "Overpriced!"), ("Usability", "Very easy to use.")]


def test_aspect_table_joins_synonyms():
    assert aspects.aspect_table({"a": ["x"]}, {"x": ["y z"]}) == {"a": ["x", "y z"]}


def test_sentences_and_tokens(spark):
    row = spark.range(1).select(
        sentences(F.lit("Hi... there!  Is it? yes")).alias("s"), tokens(F.lit("don't pay $5, user-friendly über")).alias("t")
    ).first()
    assert row.s == ["Hi...", "there!", "Is it?", "yes"]
    assert row.t == ["don", "t", "pay", "$", "5", "user-friendly", "über"]


@pytest.mark.parametrize("per", ["aspect", "review"])
@pytest.mark.parametrize("more", [0, 3000])
def test_keyword_tables_of_any_length_equal_the_mapping(reviews, spark, per, more):
    listed = [(a, k, i) for i, (a, ks) in enumerate(KEYWORDS.items()) for k in ks] + [("cost", f"x{i}", 4) for i in range(more)]
    table = spark.createDataFrame(listed, "aspect string, keyword string, aspect_no int")
    # equal ids, as after a join, stay rows of their own
    twice = reviews.union(reviews).drop("row_id")
    folded, looked_up = (aspects.tag_aspects(twice, t, per=per) for t in (KEYWORDS, table))
    assert folded.columns == looked_up.columns
    assert sorted(map(tuple, folded.collect())) == sorted(map(tuple, looked_up.collect()))
    assert folded.count() == 2 * (5 if per == "aspect" else 3)
    by_name = [r.aspect for r in aspects.tag_aspects(reviews, table.drop("aspect_no")).filter("row_id = 3").collect()]
    assert by_name == ["cost", "product_design"]
