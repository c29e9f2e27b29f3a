"""What must not depend on the size or the form of the input."""

import json

import pytest
from pyspark.sql import functions as F

from reviewloom.functions.columns import price_text
from reviewloom.functions.json_text import flatten_summaries, is_json, repair_json
from reviewloom.operators import aggregates, quality, retrieval, summaries
from reviewloom.schemas import from_ddl
from reviewloom.sources import readers
from reviewloom.streaming import increments


def test_a_field_that_first_appears_late_is_read(spark, tmp_path):
    lines = [json.dumps({"a": i} if i < 1500 else {"a": "x", "b": i}) for i in range(1800)]
    (tmp_path / "rows.jsonl").write_text("\n".join(lines))
    df = readers.read_jsonl(spark, str(tmp_path / "rows.jsonl"))
    assert df.dtypes == [("a", "string"), ("b", "bigint")]
    assert df.filter("a is not null").count() == 1800 and df.filter("b is not null").count() == 300


def test_ids_of_different_keys_differ(rows):
    df = rows("x string, y string", ("a|b", "c"), ("a", "b|c"), ("a", None), ("a", "\0"), ("", "a"))
    ids = [r.row_id for r in readers.with_row_id(df, ["x", "y"]).collect()]
    assert len(set(ids)) >= 4


@pytest.mark.parametrize("text,good", [
    ('{"a": 1}', True), (' [1, 2] ', True), ('{"a": 1, "a": 2}', True), ('{"a": 1} tail', False), ('{"a": 1}, {"b": 2}', False),
    ('{"a": 1}]', False), ("null", True), ("", False), (None, False), ("x", False), ('{"a": 1} null', False),
])
def test_one_json_value_exactly(rows, text, good):
    assert rows("j string", (text,)).select(is_json("j").alias("g")).first().g == good


def test_repaired_rows_keep_repeated_keys(rows):
    df = rows("analysis string", ('{"a": 1, "a": 2}',), ('{"a": 1} tail',))
    assert [r.analysis for r in repair_json(df).collect()] == ['{"a": 1, "a": 2}']


def test_odd_entries_are_skipped_by_themselves(rows):
    text = '{"product_summaries": {"p": {"Q": {"sentiment": "Good", "summary": "s"}, "R": "plain", "S": [1]}, "odd": "text", "q": {"T": {"summary": "t"}}}}'
    got = sorted((r.product_type, r.aspect, r.sentiment, r.summary) for r in flatten_summaries(rows("analysis string", (text,), ("no json",))).collect())
    assert got == [("p", "Q", "Good", "s"), ("q", "T", None, "t")]
    found = rows("rank int, subcategory string, analysis string", (1, "a", '{"Q": {"sentiment": "Good", "summary": "s"}, "R": "plain"}'), (2, "b", '{"R": {"sentiment": "Bad"}}'))
    assert sorted((r.aspect, r.sentiment) for r in retrieval.merge_aspects(found).collect()) == [("Q", "Good"), ("R", "Bad")]


def test_texts_without_tokens_keep_their_row(rows):
    df = rows("k int, text string", (1, "... !!! ???"), (2, "Good things. Other words here."), (3, ""), (4, None))
    got = {r.k: r.summary for r in summaries.key_sentences(df, ["k"], "text", 1).collect()}
    assert got == {1: "...", 2: "Good things.", 3: "", 4: None}


def test_missing_and_unreadable_columns_stop_the_gate(rows):
    df = rows("row_id int, user_id string, text string", (1, "x", "t"), (2, "7", "u"))
    found = quality.violations(df, rules=["range"], schema=from_ddl("row_id int, user_id bigint, asin string, text string"))
    report = quality.report(found)
    assert {r.check: r.n_flagged for r in report.collect()}["schema_validation"] == 2
    with pytest.raises(quality.ValidationError):
        quality.stop_on_failure(report)
    fine = quality.violations(df, rules=["range"], schema=from_ddl("row_id int, text string"))
    assert quality.stop_on_failure(quality.report(fine)).count() == len(quality.REPORT_CHECKS)


def test_checks_that_are_not_listed_are_reported(rows):
    df = rows("row_id int, text string, title string, helpful_vote int", (1, "short", "t", -1), (2, "long enough text", "title is long", 0))
    report = {r.check: r.n_flagged for r in quality.report(quality.row_violations(df, rules=["rough"])).collect()}
    assert report["short_text"] == 1 and report["negative_votes"] == 1 and report["schema_validation"] == 0


def test_whole_numbers_are_read_exactly(rows):
    df = rows("n string", ("9007199254740993",), ("3.7",), ("x",), (None,))
    schema = from_ddl("n bigint")
    assert [r.n for r in quality.conform(df, schema).collect()] == [9007199254740993, 3, 0, 0]
    assert quality.lossy_casts(df, schema).first().n_lost == 1


@pytest.mark.parametrize("price,want", [(12345678.0, "12345678.0"), (0.0001, "0.0001"), (3.5, "3.5"), (None, "unknown"), (1e9, "1000000000.0"), (-2.5e7, "-25000000.0"), (10.0, "10.0")])
def test_prices_are_plain_decimals(rows, price, want):
    assert rows("p double", (price,)).select(price_text("p").alias("p")).first().p == want


def test_every_column_is_on_the_card(rows):
    df = rows("a int, b array<int>, c map<string,int>, d struct<x:int>", (1, [1], {"k": 1}, (1,)), (None, None, None, None))
    card = {r["column"]: r for r in aggregates.data_card(df).collect()}
    assert set(card) == set(df.columns) and all(r.nulls == 1 and r.n_rows == 2 for r in card.values())
    assert card["a"].largest == "1" and card["b"].largest is None


def test_a_month_that_became_empty_loses_its_rows(rows, spark, tmp_path):
    ddl = "row_id int, year int, review_month int"
    path = str(tmp_path / "stage")
    both = rows(ddl, (1, 2020, 1), (2, 2020, 2)).withColumn("review_time", F.make_timestamp("year", "review_month", F.lit(3), F.lit(0), F.lit(0), F.lit(0)))
    for month in (1, 2):
        increments.append_month(both, path, 2020, month)
    increments.append_month(both.filter("row_id = 1"), path, 2020, 2)
    assert [r.row_id for r in spark.read.parquet(path).collect()] == [1]
