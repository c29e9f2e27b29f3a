"""Acquisition: time columns, join, sample, split, periods."""

import hashlib
from datetime import date

import pytest
from pyspark.sql import functions as F

from reviewloom.functions.columns import add_review_time, category_path
from reviewloom.operators import filters, joins, periods, sampling


@pytest.fixture
def reviews(rows):
    return rows(
        "row_id bigint, timestamp bigint, images string, parent_asin string, rating int",
        (1, 1514764800000, "img1", "A1", 4), (2, 1546300800000, "img2", "A2", 5), (3, 1577836800000, "img3", "A3", 3),
    )


@pytest.fixture
def products(rows):
    return rows(
        "parent_asin string, main_category string, title string, categories array<string>, price double, average_rating double, rating_number bigint",
        *[(f"A{i}", f"Product{i}", f"Name{i}", [f"Cat{i}", "x"], 10.0 * i, 5 - i / 2, 100 * i) for i in (1, 2, 3)],
    )


def test_review_time(reviews):
    got = add_review_time(reviews).orderBy("row_id").collect()
    assert [r.review_date_timestamp for r in got] == [f"{y}-01-01 00:00:00" for y in (2018, 2019, 2020)]
    assert "images" not in got[0].asDict() and got[2].year == 2020


def test_left_join_keeps_rows(reviews, products):
    joined = joins.join_metadata(add_review_time(reviews), products)
    assert joined.count() == 3 and "product_name" in joined.columns
    assert joins.join_bloat(reviews, products).first().no_bloat
    assert category_path(joined).filter("row_id = 2").first().categories == "Cat2,x"


def test_join_bloat_counts_repeated_keys(reviews, products):
    got = joins.join_bloat(reviews, products.unionByName(products.filter("parent_asin = 'A1'"))).first()
    assert (got.rows_before, got.rows_after, got.repeated_keys, got.no_bloat) == (3, 4, 1, False)


def test_null_keys_meet_only_when_asked(rows, products):
    left = rows("row_id int, parent_asin string", (1, None), (2, "A1"))
    right = products.withColumn("parent_asin", F.when(F.col("parent_asin") != "A2", F.col("parent_asin")))
    assert joins.join_metadata(left, right).filter("row_id = 1").first().product_name is None
    assert joins.join_metadata(left, right, null_safe=True).filter("row_id = 1").first().product_name == "Name2"


def test_window_end_day(rows):
    df = rows("t string", ("2019-12-31 00:00:00",), ("2019-12-31 10:00:00",), ("2020-01-01 00:00:00",))
    df = df.select(F.to_timestamp("t").alias("review_time"))
    assert filters.in_window(df, "2018-01-01", "2019-12-31").count() == 2
    assert filters.in_window(df, "2018-01-01", "2019-12-31", end_inclusive_day=False).count() == 1


@pytest.mark.parametrize("size,want", [(49, 0), (50, 0), (149, 1), (150, 2), (250, 2)])
def test_sample_rounds_half_even(spark, size, want):
    df = spark.range(size).select(F.col("id").alias("row_id"), F.lit(1).alias("review_month"), F.lit(5.0).alias("rating"))
    assert sampling.stratified_sample(df).count() == want


@pytest.mark.parametrize("digits", [1, 2, 4])
def test_sample_equals_full_ranking(spark, digits):
    """The cut by leading digits picks the rows a ranking of every stratum would."""
    df = spark.range(3000).select(
        F.col("id").alias("row_id"), (F.col("id") % 3).alias("review_month"), F.when(F.col("id") % 10 < 7, 1.0).otherwise(2.0).alias("rating")
    )
    got = {r.row_id for r in sampling.stratified_sample(df, frac=0.37, digits=digits).collect()}
    want = set()
    groups = {}
    for r in df.collect():
        groups.setdefault((r.review_month, r.rating), []).append(r.row_id)
    for ids in groups.values():
        ranked = sorted(ids, key=lambda i: (hashlib.md5(f"{i}:42".encode()).hexdigest(), i))
        want |= set(ranked[: round(0.37 * len(ids))])
    assert got == want


def test_null_strata_are_never_drawn(rows):
    df = rows("row_id int, review_month int, rating double", *[(i, 1, None) for i in range(200)])
    assert sampling.stratified_sample(df).count() == 0


@pytest.mark.parametrize("n", [0, 1, 9, 10, 11, 57])
def test_time_split_sizes(spark, n):
    df = spark.range(n).select(F.col("id").alias("row_id"), F.timestamp_seconds(F.floor(F.col("id") / 7) * 86400).alias("review_time"))
    got = {r["split"]: r["count"] for r in sampling.time_split(df).groupBy("split").count().collect()}
    train, val = int(n * 0.8), int(n * (0.8 + 0.1))
    want = {"train": train, "val": val - train, "test": n - val}
    assert got == {k: v for k, v in want.items() if v}


def test_time_split_with_one_shared_timestamp(spark):
    """Ties on the cut go by id, even when every row has the same time."""
    df = spark.range(100).select(F.col("id").alias("row_id"), F.timestamp_seconds(F.lit(0)).alias("review_time"))
    got = sampling.time_split(df).filter("split = 'train'").agg(F.max("row_id")).first()[0]
    assert got == 79


def test_oversample(rows):
    df = rows("row_id int, main_category string", *[(i, "small" if i < 3 else "large") for i in range(100)], (100, None))
    got = {r.main_category: r["count"] for r in sampling.oversample(df, min_samples=50).groupBy("main_category").count().collect()}
    assert got == {"small": 50, "large": 97}
    drawn = sampling.oversample(df, min_samples=50).filter("main_category = 'small'")
    assert {r.row_id for r in drawn.collect()} <= {0, 1, 2}
    assert sorted(drawn.collect()) == sorted(sampling.oversample(df, min_samples=50).filter("main_category = 'small'").collect())


def test_fraction_limits(spark):
    df = spark.range(1000).withColumnRenamed("id", "row_id")
    assert sampling.fraction_sample(df, 1.0).count() == 1000
    assert sampling.fraction_sample(df, 0.0).count() == 0
    assert 50 < sampling.fraction_sample(df, 0.1).count() < 150


def test_bernoulli_only_draws_named_strata(spark):
    df = spark.range(1000).withColumn("review_month", F.lit(1))
    assert sampling.bernoulli_sample(df, "review_month", {1: 1.0}).count() == 1000
    assert sampling.bernoulli_sample(df, "review_month", {2: 1.0}).count() == 0


def test_periods(rows):
    none = rows("start_date string, year int, month int")
    assert periods.next_training_window(none).first() == (date(2018, 1, 1), date(2019, 12, 31))
    assert tuple(periods.next_serving_month(none).first()) == (2020, 1)
    runs = rows("category string, start_date string, year int, month int", ("a", "2018-01-01", 2020, 12), ("a", "2018-04-01", 2020, 3), ("b", "2018-01-01", 2020, 5))
    windows = {r.category: (str(r.start_date), str(r.end_date)) for r in periods.next_training_window(runs, ["category"]).collect()}
    assert windows == {"a": ("2018-07-01", "2020-06-30"), "b": ("2018-04-01", "2020-03-31")}
    months = {r.category: (r.year, r.month) for r in periods.next_serving_month(runs, ["category"]).collect()}
    assert months == {"a": (2021, 1), "b": (2020, 6)}


def test_split_by_year_adds_up(reviews):
    timed = add_review_time(reviews)
    early, late = filters.split_by_year(timed)
    assert early.count() + late.count() == timed.count()
    assert {r.year for r in late.collect()} == {2020}


def test_time_split_puts_missing_times_last(spark):
    when = F.when(F.col("id") >= 3, F.timestamp_seconds(F.col("id")))
    df = spark.range(10).select(F.col("id").alias("row_id"), when.alias("review_time"))
    got = {r.row_id: r["split"] for r in sampling.time_split(df).collect()}
    assert [got[i] for i in (3, 9, 0, 1, 2)] == ["train", "train", "train", "val", "test"]
