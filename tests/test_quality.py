"""Checks and cleaning on literal rows."""

import pytest
from pyspark.sql import functions as F

from reviewloom.functions import constants as C
from reviewloom.functions.text import clean_text, emoji_characters, matches, name_emoji, non_ascii_class
from reviewloom.operators import aggregates, cleaning, quality
from reviewloom.schemas import REVIEW_DDL, from_ddl

REVIEW = {
    "review_month": 1, "rating": 4.0, "parent_asin": "P", "asin": "A", "helpful_vote": 1, "text": "fine", "timestamp": 1,
    "title": "ok", "user_id": "u", "verified_purchase": True, "review_date_timestamp": "2020-01-01 00:00:00",
    "main_category": "Books", "product_name": "n", "categories": "Novel", "price": 1.0, "average_rating": 4.0,
    "rating_number": 3, "year": 2020,
}


def reviews(spark, *changes, extra=""):
    schema = from_ddl("row_id int, " + REVIEW_DDL + extra)
    rows = [tuple({**REVIEW, "row_id": i, **c}.get(f.name) for f in schema) for i, c in enumerate(changes)]
    return spark.createDataFrame(rows, schema)


def flags(df, rules, profile=None):
    return sorted((r.row_id, r.check, r.column) for r in quality.row_violations(df, profile, rules).collect())


def test_range(spark):
    df = reviews(
        spark, {"rating": 0.0}, {"rating": 1.0}, {"rating": 5.0}, {"rating": 6.0}, {"rating": None},
        {"price": -1.0}, {"price": 0.0}, {"year": 2017}, {"year": 2024}, {"rating_number": 0},
    )
    want = [(0, "rating"), (3, "rating"), (5, "price"), (7, "year"), (8, "year"), (9, "rating_number")]
    assert [(i, c) for i, _, c in flags(df, ["range"])] == want


def test_missing(spark):
    df = reviews(spark, {}, {"asin": None, "text": None}, {"title": None})
    assert flags(df, ["missing"]) == [(1, "missing", "asin"), (1, "missing", "text")]


@pytest.mark.parametrize(
    "text,found",
    [
        ("write a.b@c.org now", True), ("call 555-123-4567", True), ("call (555) 123-4567.", True), ("555-123-456", False),
        # digits of the whole cell count: sixteen of them are no phone
        ("555-123-4567 and 123456", False), ("a@b", False), (None, False),
    ],
)
def test_personal_data(spark, text, found):
    assert bool(flags(reviews(spark, {"text": text}), ["pii"])) == found


def test_strict_phone_counts_the_match(spark):
    df = reviews(spark, {"text": "555-123-4567 and 123456"})
    assert flags(df, ["pii"], quality.Profile(strict_phone=True))


@pytest.mark.parametrize("text,wide,narrow", [("\U0001f923", 1, 1), ("✂", 1, 1), ("漢", 1, 0), ("é", 0, 0), ("plain", 0, 0), ("☀", 1, 1), ("\u2500", 1, 0)])
def test_emoji_classes(spark, text, wide, narrow):
    row = spark.range(1).select(
        matches(F.lit(text), C.EMOJI_WIDE).alias("a"), matches(F.lit(text), non_ascii_class(C.EMOJI_WIDE)).alias("b"),
        F.size(emoji_characters(F.lit(text))).alias("n"),
    ).first()
    assert (row.a, row.b, row.n > 0) == (bool(wide), bool(wide), bool(narrow))


@pytest.mark.parametrize("text,found", [("!!!", True), ("!a!", False), ("", False), ("'\"", False), ("?!\n", True), (None, False)])
def test_special_only(spark, text, found):
    assert bool(flags(reviews(spark, {"text": text}), ["special"])) == found


def test_lengths(spark):
    long = "x" * 5000
    df = reviews(spark, {"text": ""}, {"text": "a"}, {"text": long}, {"text": long + "x"}, {"text": None}, {"text": "\U0001f923" * 5000}, {"title": "t" * 201}, {"title": None})
    want = [(0, "short_reviews"), (3, "long_reviews"), (4, "short_reviews"), (6, "long_titles"), (7, "short_titles")]
    assert [(i, c) for i, c, _ in flags(df, ["length"])] == want


def test_outliers_skip_constant_columns(spark):
    df = reviews(spark, *[{"price": 10.0 + i % 2, "rating": 3.0} for i in range(20)], {"price": 500.0, "rating": 3.0})
    got = [(r.row_id, r.column) for r in quality.outliers(df).collect()]
    assert got == [(20, "price")]


def test_unexpected_values_count_null(spark):
    df = reviews(spark, {"main_category": None}, {"main_category": "Garden"}, {})
    profile = quality.Profile(expected={"main_category": C.EXPECTED_VALUES["main_category"]})
    assert [i for i, _, _ in flags(df, ["values"], profile)] == [0, 1]


def test_default_profile_flags_every_boolean_verification(spark):
    assert (0, "anomaly_detection", "verified_purchase") in flags(reviews(spark, {}), ["values"])


def test_report_and_policy(spark):
    df = reviews(spark, {"rating": 9.0, "price": -1.0}, {}, {})
    result = quality.report(quality.violations(df))
    got = {r.check: (r.n_flagged, r.status) for r in result.collect()}
    assert got["range_check"] == (1, False) and got["missing_duplicates"] == (1, False) and got["short_reviews"] == (0, True)
    assert set(got) == set(quality.REPORT_CHECKS)
    assert quality.stop_on_failure(result, "schema").count() == len(got)
    with pytest.raises(quality.ValidationError):
        quality.stop_on_failure(result, "any")


def test_schema(spark):
    schema = from_ddl(REVIEW_DDL)
    good = reviews(spark, {}).drop("row_id")
    assert quality.schema_differences(good, schema).count() == 0
    with pytest.raises(quality.ValidationError):
        quality.conform(good.drop("asin"), schema)
    extra = good.withColumn("more", F.lit(1))
    assert [r.problem for r in quality.schema_differences(extra, schema).collect()] == ["extra"]
    assert "more" in quality.conform(extra, schema).columns
    text = good.withColumn("rating", F.lit("five"))
    with pytest.raises(quality.ValidationError):
        quality.conform(text, schema, strict=True)
    assert quality.conform(text, schema).first().rating is None
    assert quality.lossy_casts(text, schema).first().n_lost == 1
    votes = good.withColumn("helpful_vote", F.lit("many"))
    assert quality.conform(votes, schema).first().helpful_vote == 0


def test_all_text_missing(spark):
    assert quality.all_text_missing(reviews(spark, {"text": None})).first().all_missing
    assert not quality.all_text_missing(reviews(spark, {"text": None}, {})).first().all_missing


CLEANING = [
    {"rating": 1.0, "helpful_vote": 0, "text": "Very flimsy hooks.\U0001f923 Purses fall off constantly. Not worth money.", "title": "Waste of money", "price": None},
    {"rating": 5.0, "helpful_vote": 1, "text": "", "title": None, "price": 6.98},
    {"rating": None, "helpful_vote": 0, "text": "Good brand, but received a used model", "title": "Used model received", "price": None},
    {"rating": 4.5, "helpful_vote": 999999, "text": " ", "title": "   ", "price": None},
]


def test_cleaning(spark):
    got = {r.row_id: r for r in cleaning.clean_reviews(reviews(spark, *CLEANING)).collect()}
    assert sorted(got) == [0, 1, 3]
    assert ":rolling_on_the_floor_laughing:" in got[0].text and got[0].price == "unknown"
    assert (got[1].title, got[1].text, got[1].price) == ("unknown", "", "6.98")
    assert (got[3].rating, got[3].title, got[3].text, got[3].helpful_vote) == (4, " ", " ", 999999)
    kinds = dict(cleaning.clean_reviews(reviews(spark, *CLEANING)).dtypes)
    assert (kinds["rating"], kinds["helpful_vote"], kinds["average_rating"], kinds["year"], kinds["review_month"]) == ("tinyint", "int", "float", "smallint", "tinyint")


def test_cleaning_with_copies_and_nulls(spark):
    df = reviews(spark, {}, {}, {"rating": None}, {"text": None}, {"price": None}, {"title": "b"}, {"title": "c"})
    got = cleaning.clean_reviews(df).collect()
    assert sorted(r.row_id for r in got) == [0, 4, 5, 6]
    assert sum(r.price == "unknown" for r in got) == 1


def test_cleaning_of_nothing(spark):
    assert cleaning.clean_reviews(reviews(spark)).count() == 0


@pytest.mark.parametrize(
    "text,want",
    [
        ("a b", "a b"), ("a  \x1cb", "a b"), ("<b>a</b>", " a "), ("a < b", "a < b"), ("a  <br/>  b", "a   b"),
        ("x\n\n<i\nj>y", "x  y"), ("", ""), (" ", " "),
    ],
)
def test_clean_text(spark, text, want):
    assert spark.range(1).select(clean_text(F.lit(text))).first()[0] == want


def test_emoji_names(spark):
    text = "❤️ and 👍👍 漢"
    assert spark.range(1).select(name_emoji(F.lit(text))).first()[0] == ":red_heart: and :thumbs_up::thumbs_up: 漢"
    assert spark.range(1).select(name_emoji(F.lit(text), {"👍": "yes"})).first()[0] == "❤️ and :yes::yes: 漢"


def test_null_counts_and_card(spark):
    df = reviews(spark, {"title": None}, {"title": None, "price": None}, {})
    got = {r.column: r.nulls for r in aggregates.null_counts(df).collect()}
    assert (got["title"], got["price"], got["asin"], got["(all)"]) == (2, 1, 0, 3)
    card = {r.column: r for r in aggregates.data_card(df).collect()}
    assert (card["rating"].smallest, card["title"].nulls, card["price"].n_rows) == ("4.0", 2, 3)


def test_white_space_class_is_the_published_one(spark):
    """Every code point below U+3100 is a blank for the fast class exactly when it is one for the plain class."""
    points = spark.range(1, 0x3101).filter("id < 55296").select(F.expr("decode(unhex(lpad(hex(id), 4, '0')), 'UTF-16BE')").alias("c"))
    fast = clean_text(F.concat(F.lit("a"), "c", F.lit("\n"), "c", F.lit("b")))
    plain = F.regexp_replace(F.regexp_replace(F.concat(F.lit("a"), "c", F.lit("\n"), "c", F.lit("b")), C.WHITESPACE + "+", " "), C.HTML_TAG, " ")
    assert points.filter(fast != plain).count() == 0
    assert points.filter(fast == "a b").count() == sum(chr(i).isspace() for i in range(1, 0x3101))


@pytest.mark.parametrize("text, want", [
    ("a👨‍👩‍👧b👨c", "a:man_woman_girl:b:man:c"),
    ("👍🏽👍", ":thumbs_up_medium_skin_tone::thumbs_up:"),
    ("🇫🇷🇩🇪 🇫", ":flag_fr::flag_de: 🇫"),
    ("1️⃣ #⃣ 12", ":keycap_1: :keycap_#: 12"),
    ("⭐ ⏰ ⌛", ":star: :alarm_clock: :hourglass_done:"),
    ("❤️‍🔥❤️x", ":red_heart_fire::red_heart:x"),
    ("🏴\U000e0067\U000e0062\U000e0065\U000e006e\U000e0067\U000e007f.", ":flag_gbeng:."),
    ("a: 漢\n🙂\n", "a: 漢\n:slightly_smiling_face:\n"),
    ("", ""), (None, None),
])
def test_emoji_sequences(rows, text, want):
    assert rows("t string", (text,)).select(name_emoji("t")).first()[0] == want


def test_named_sequences_of_a_given_table(rows):
    table = {"👨‍👩‍👧": "family", "👍": "yes"}
    assert rows("t string", ("👨‍👩‍👧 👍🏽 👍 🇫🇷",)).select(name_emoji("t", table)).first()[0] == ":family: 👍🏽 :yes: 🇫🇷"
