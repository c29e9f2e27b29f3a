"""Documents, summaries, JSON repair, retrieval."""

import json

import pytest
from pyspark.sql import functions as F

from reviewloom.functions import columns as K
from reviewloom.functions import constants as C
from reviewloom.functions.json_text import flatten_predictions, flatten_summaries, repair_json
from reviewloom.operators import filters, retrieval, rollup, summaries
from reviewloom.plans import skew


@pytest.fixture
def labelled(rows):
    data = [(i, " ".join(f"w{i}_{j}" for j in range(i % 9)), float(i % 5 + 1), i, 2020, 1 + i % 2, "x,y,toys" if i % 4 else None, "Main", "POSITIVE" if i % 2 else "NEGATIVE") for i in range(120)]
    data.append((500, None, 1.0, 0, 2020, 1, None, None, "POSITIVE"))
    return rows(
        "row_id bigint, text string, rating double, helpful_vote int, year int, review_month int, categories string, main_category string, sentiment_label string", *data
    )


def _joined_texts(labelled):
    texts = {}
    for r in labelled.orderBy("row_id").collect():
        if r.main_category is not None:
            texts.setdefault((r.year, r.review_month, "toys" if r.categories else "Main"), []).append(r.text)
    return {k: " ".join(v) for k, v in texts.items()}


@pytest.mark.parametrize("part_chars", [50, 8_000_000])
def test_document_parts_make_the_whole_text(labelled, part_chars):
    parts = {}
    for r in rollup.monthly_documents(labelled, part_chars).orderBy("part").collect():
        parts.setdefault((r.year, r.month, r.category), []).append(r.text)
    assert {k: " ".join(v) for k, v in parts.items()} == _joined_texts(labelled)
    assert (max(map(len, parts.values())) > 1) == (part_chars == 50)
    # statistics stand once for each document, however many parts it has
    assert rollup.monthly_documents(labelled, part_chars).filter("n_reviews is not null").count() == len(parts)


@pytest.mark.parametrize("twice", [False, True])
@pytest.mark.parametrize("at_once", [10, 16_000_000])
@pytest.mark.parametrize("part_chars", [50, 8_000_000])
def test_parts_of_named_texts_equal_those_of_rows(labelled, rows, monkeypatch, part_chars, at_once, twice):
    """Texts shared by reviews, null, empty, missing, not plain, and ids that repeat."""
    monkeypatch.setattr(rollup, "BYTES_AT_ONCE", at_once)
    data = [(i, None if i == 3 else "" if i == 4 else f"größe {i} " * (i % 7)) for i in range(20)] + [(None, "never said")]
    texts = rows("text_id bigint, text string", *data, *([(5, data[5][1])] if twice else []))
    named = labelled.withColumn("text_id", F.when(F.col("row_id") % 5 > 0, F.col("row_id") % 23)).drop("text")
    told = named.join(texts, "text_id", "left")
    for make in (rollup.document_parts, rollup.monthly_documents):
        want = sorted(map(str, make(told, part_chars).collect()))
        assert sorted(map(str, make(named, part_chars, texts=texts).collect())) == want and want


@pytest.mark.parametrize("hot_rows", [10, 1_000_000])
@pytest.mark.parametrize("n_words", [1, 7, 100_000])
def test_document_chunks_equal_chunks_of_the_joined_text(labelled, monkeypatch, n_words, hot_rows):
    plain = skew.running_total
    monkeypatch.setattr(rollup, "running_total", lambda *a: plain(*a, buckets=8, hot_rows=hot_rows))
    got = {(r.year, r.month, r.category, r.chunk_no): r.text for r in rollup.document_chunks(labelled, n_words).collect()}
    want = {}
    for key, text in _joined_texts(labelled).items():
        words = text.split()
        for i in range(0, len(words), n_words):
            want[(*key, i // n_words)] = " ".join(words[i : i + n_words])
    assert got == want


@pytest.mark.parametrize("home_pieces", [0, 40, 1_000_000])
@pytest.mark.parametrize("hot_rows", [10, 1_000_000])
@pytest.mark.parametrize("n_words", [1, 7, 100_000])
def test_chunks_of_shared_texts_equal_chunks_of_the_joined_text(labelled, rows, monkeypatch, n_words, hot_rows, home_pieces):
    plain = skew.running_total
    monkeypatch.setattr(rollup, "running_total", lambda *a: plain(*a, buckets=8, hot_rows=hot_rows))
    # text 1 is shared by half of the rows, 3 is blank, 4 null, 5 missing
    made = {i: f"  w{i}\u2003é{i}\n\tß{i} " + " ".join(f"x{i}_{j}" for j in range(i)) for i in range(12)} | {3: " \t ", 4: None}
    del made[5]
    text_id = F.when(F.col("row_id") % 2 == 1, 1).when(F.col("row_id") % 20 == 0, None).otherwise(F.col("row_id") % 12)
    named = labelled.drop("text").withColumn("text_id", text_id.cast("bigint"))
    texts = rows("text_id bigint, text string", *made.items())
    joined = _joined_texts(named.join(texts, "text_id", "left").withColumn("text", F.coalesce("text", F.lit(""))))
    want = {}
    for key, text in joined.items():
        words = text.split()
        for i in range(0, len(words), n_words):
            want[(*key, i // n_words)] = " ".join(words[i : i + n_words])
    got = rollup.document_chunks_of(named, texts, n_words, home_pieces).collect()
    assert {(r.year, r.month, r.category, r.chunk_no): r.text for r in got} == want and len(got) == len(want)


def test_statistics_mode_tie_goes_to_the_smallest(labelled):
    got = {(r.month, r.category): r for r in rollup.document_statistics(labelled).collect()}
    assert {r.dominant_sentiment for r in got.values()} <= {"NEGATIVE", "POSITIVE"}
    tied = labelled.filter("row_id in (1, 2)").withColumns({"review_month": F.lit(1), "categories": F.lit("a")})
    assert rollup.document_statistics(tied).first().dominant_sentiment == "NEGATIVE"


@pytest.mark.parametrize("path,want", [("a,b,c,d", "c"), ("a", "a"), ("a,b", "b"), (" ", "main"), (None, "main"), ("a, b, c", " c")])
def test_category_level(rows, path, want):
    assert rows("p string, m string", (path, "main")).select(K.category_level("p", "m")).first()[0] == want


@pytest.mark.parametrize("text", ["", "one", " a  b\tc ", "a b c d", "a b c d e f g"])
def test_chunk_text(rows, text):
    got = [r.chunk for r in summaries.chunk_text(rows("id int, text string", (1, text)), n_words=3).orderBy("chunk_no").collect()]
    words = text.split()
    assert got == [" ".join(words[i : i + 3]) for i in range(0, len(words), 3)]


@pytest.mark.parametrize(
    "text,want",
    [
        ('{"a": {"b": 1} "c": 2}', {"a": {"b": 1}, "c": 2}), ("{a: 1}", {"a": 1}), ('{"a": [1, 2, ], }', {"a": [1, 2]}),
        ('{"a": {"b": 1}', {"a": {"b": 1}}), ('{"a": 1}}}', {"a": 1}), ('[{"a": 1} {"b": 2}]', [{"a": 1}, {"b": 2}]),
        ('{"p": {"Performance": {"s": "x"} }, "q": 1}', {"p": {"Performance": {"s": "x"}}, "q": 1}),
        ('{"a": 1\\n\\t}', {"a": 1}), ('{"a": 1}', {"a": 1}), ("hopeless", None), ("", None), (None, None),
    ],
)
def test_json_repair(rows, text, want):
    got = repair_json(rows("id int, analysis string", (1, text))).collect()
    assert (json.loads(got[0].analysis) if got else None) == want


def test_flatten(rows):
    made = '{"product_summaries": {"Mug": {"Price": {"sentiment": "Mixed", "summary": "s"}, "Quality": {}}}, "overall": 1}'
    got = [tuple(r) for r in flatten_summaries(rows("id int, analysis string", (7, made))).collect()]
    assert got == [(7, "Mug", "Price", "Mixed", "s"), (7, "Mug", "Quality", None, None)]


@pytest.mark.parametrize(
    "text,want",
    [('["POSITIVE",{"POS":0.9,"NEU":0.05,"NEG":0.05}]', ("POSITIVE", 0.9, 0.05, 0.05)), ('["NEUTRAL",{"NEU":1}]', ("NEUTRAL", None, 1.0, None)), ("no", (None,) * 4)],
)
def test_flatten_predictions(rows, text, want):
    assert tuple(flatten_predictions(rows("prediction string", (text,))).first()) == want


def test_path_metadata(rows):
    got = rows("p string", ("RAG/Toys/2020/5/Mug.json",), ("RAG/Toys/2020/5",)).select(K.path_metadata("p").alias("m")).collect()
    assert tuple(got[0].m) == ("Toys", "Mug.json", "2020", "5") and got[1].m is None


def test_vector_key_collides_without_the_category(rows):
    df = rows("path string, values array<double>", ("R/A/2020/1/s.json", [1.0]), ("R/B/2020/1/s.json", [1.0]))
    assert retrieval.vector_rows(df).select("id").distinct().count() == 1
    assert retrieval.vector_rows(df, include_category=True).select("id").distinct().count() == 2


@pytest.fixture
def vectors(rows):
    data = [(i, [1.0, i / 10], "Toys" if i % 2 else "Home & Toys", 2019 + i % 2, i % 3 + 1, f"s{i}") for i in range(20)] + [(99, [0.0, 0.0], "Toys", 2019, 1, "zero")]
    return rows("id int, values array<double>, category string, year int, month int, subcategory string", *data)


@pytest.fixture
def docs(vectors):
    finding = F.concat(F.lit('{"Quality": {"sentiment": "Positive", "summary": "q'), "id", F.lit('"}, "Price": {"summary": "p"}}'))
    return vectors.select("category", "year", "month", "subcategory", finding.alias("analysis"))


def test_top_k(vectors):
    got = retrieval.top_k(retrieval.with_norm(vectors), [1.0, 0.0], 3, norms="norm").collect()
    assert [r.id for r in got] == [0, 1, 2] and got[0].score == pytest.approx(1.0)
    assert retrieval.top_k(vectors, [1.0, 0.0], 100).count() == 20
    assert filters.valid_vectors(vectors, 3).count() == 0


def test_search_filters_after_ranking(vectors, docs):
    after = retrieval.search(vectors, [1.0, 0.0], docs, k=4, category="toys", year=2020, month="ALL")
    assert sorted(r.subcategory for r in after.collect()) == ["s1", "s3"]
    before = retrieval.search(vectors, [1.0, 0.0], docs, k=4, category="toys", year=2020, prefilter=True)
    assert sorted(r.subcategory for r in before.collect()) == ["s1", "s3", "s5", "s7"]
    # nothing of 2020 among the two best: every matching document comes back
    fallback = retrieval.search(vectors, [1.0, 0.0], docs, k=1, category="Toys", year=2020)
    assert fallback.count() == 10


def test_merge_and_report(vectors, docs):
    found = retrieval.search(vectors, [1.0, 0.0], docs, k=3)
    merged = {r.aspect: (r.sentiment, r.summary) for r in retrieval.merge_aspects(found).collect()}
    assert merged == {"Quality": ("Positive", "q2"), "Price": ("Unknown", "p")}
    text = retrieval.findings_report(retrieval.merge_aspects(found)).first().report
    assert text.index("**Quality**:\n  Sentiment: Positive") < text.index("**Price**: Sentiment data is currently unavailable")
    assert retrieval.findings_report(retrieval.merge_aspects(found.filter("rank < 0"))).first().report == C.REPORT_EMPTY


def test_embedding(rows):
    df = rows("id int, text string", (1, "good mug"), (2, "mug good"), (3, ""), (4, None))
    got = {r.id: r["values"] for r in retrieval.embed(df, dim=16).collect()}
    assert got[1] == got[2] and sum(v * v for v in got[1]) == pytest.approx(1.0) and got[3] == got[4] == [0.0] * 16
    own = retrieval.embed_with(df.filter("id < 3"), lambda texts: [[len(t), 1] for t in texts])
    assert {r.id: r["values"] for r in own.collect()} == {1: [8.0, 1.0], 2: [8.0, 1.0]}


def test_summaries(rows):
    text = "The mug is good. The lid broke. The mug is a good mug. Nothing else?"
    df = rows("id int, text string", (1, text), (2, ""))
    # mean counts: (3+3+2+2)/4 beats (3+3+2+1+2+3)/6
    assert summaries.key_sentences(df, ["id"], "text", 1).first().summary == "The mug is good."
    assert summaries.key_sentences(df, ["id"], "text", 2).first().summary == "The mug is good. The mug is a good mug."
    running = {r.id: r.analysis for r in summaries.running_summary(df, ["id"], n_words=4, n=1).collect()}
    assert len(running[1].split("\n")) == 4 and running[2] == "No summary generated."
    assert summaries.hierarchical_summary(df, ["id"], n_words=4, n=1, final=2).count() == 1


def test_user_summariser_sees_the_summary_before(rows):
    df = rows("id int, text string", (1, "a b c d e"), (2, ""))

    def shorten(chunk, previous):
        if chunk == "c d":
            raise RuntimeError("no answer")
        return f"{previous}>{chunk[0]}"

    got = {r.id: r.analysis for r in summaries.running_summary_with(df, shorten, n_words=2).collect()}
    assert got == {1: "None>a\nNone>a>e", 2: "No summary generated."}


def test_prompt(rows):
    df = rows("t string, p string", ("text", None), ("text", "old"))
    got = [r[0] for r in df.select(K.filled_prompt("{PREVIOUS_SUMMARY}|{TEXT}", "t", "p")).collect()]
    assert got == ["None|text", "old|text"]


def test_facets(rows):
    df = rows("category string, year int, month int", ("a", 2020, 2), ("a", 2020, 1), ("a", 2021, 1), ("b", 2020, 3), ("b", None, 3))
    tree = {r.category: r.years for r in rollup.facet_tree(df).collect()}
    assert tree == {"a": {2020: [1, 2], 2021: [1]}, "b": {2020: [3]}}
    assert sorted(r.option for r in rollup.facet_options(df, "a", 2020).collect()) == ["1", "2", "ALL"]
    assert sorted(r.option for r in rollup.facet_options(df).collect()) == ["a", "b"]
