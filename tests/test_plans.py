"""What the physical plans must and must not hold."""

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from reviewloom import catalog
from reviewloom.functions.columns import add_review_time
from reviewloom.operators import aspects, filters, labeling, quality, retrieval, rollup, sampling, summaries
from reviewloom.sources.adapters import Tables


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "reviews")
    rows = spark.range(2000).select(
        F.col("id").alias("row_id"),
        (F.lit(1514764800000) + F.col("id") * 86400000).alias("timestamp"),
        (F.col("id") % 5 + 1).cast("double").alias("rating"),
        F.lit("The delivery was fast.").alias("text"),
        F.lit("t").alias("title"),
        F.lit("img").alias("images"),
        F.array(F.col("id").cast("double"), F.lit(1.0)).alias("values"),
    )
    rows.write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("cut", ["window", "midnight", "month"])
def test_time_bounds_reach_the_scan(stored, cut):
    timed = add_review_time(stored)
    made = {
        "window": lambda: filters.in_window(timed, "2018-02-01", "2018-03-31"),
        "midnight": lambda: filters.in_window(timed, "2018-02-01", "2018-03-31", end_inclusive_day=False),
        "month": lambda: filters.in_month(timed, 2018, 2),
    }[cut]()
    assert made.count() == {"window": 59, "midnight": 59, "month": 28}[cut]
    text = plan(made.select("row_id"))
    assert "GreaterThanOrEqual(timestamp,1517443200000)" in text
    # two columns are read, not seven
    assert "ReadSchema: struct<row_id:bigint,timestamp:bigint>" in text


def test_time_split_moves_no_rows(stored):
    assert "Exchange" not in plan(sampling.time_split(add_review_time(stored)))


def test_sample_never_shuffles_full_rows(stored):
    drawn = sampling.stratified_sample(add_review_time(stored), frac=0.1)
    text = plan(drawn)
    assert "Exchange hashpartitioning" not in text and "Window" not in text and "BroadcastHashJoin" in text


def test_row_level_work_needs_no_exchange(stored):
    for df in (
        aspects.tag_aspects(stored),
        labeling.label_matrix(stored),
        quality.row_violations(stored, rules=["range", "missing", "pii", "emoji", "special", "length"]),
    ):
        text = plan(df)
        assert "Exchange" not in text and text.count("FileScan") == 1


def test_top_k_keeps_k_per_task(stored):
    best = retrieval.top_k(stored, [1.0, 0.0], 5, row_id="row_id")
    assert "TakeOrderedAndProject" in plan(best)


def test_duplicates_read_the_ids_only_on_the_second_pass(stored):
    assert "ReadSchema: struct<row_id:bigint>" in plan(quality.duplicates(stored))


@pytest.fixture
def no_broadcast(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


@pytest.mark.skipif(not Path("/root/testdata/sf0.001").exists(), reason="test tables are not there")
def test_no_join_moves_the_texts_of_reviews(spark, no_broadcast):
    """Texts are joined above all other joins, so only keys and numbers are exchanged for those."""
    joins = [line for line in plan(Tables(spark, "/root/testdata/sf0.001").joined()).splitlines() if "Join [" in line]
    assert "_doc" in joins[0] and any("parent_asin" in line for line in joins[1:])


@pytest.mark.parametrize("make", [rollup.document_parts, rollup.monthly_documents])
@pytest.mark.parametrize("part_chars", [5, 8_000_000])
def test_texts_of_documents_move_once(spark, make, part_chars):
    columns = ["id as row_id", "string(id) as text", "double(id) as rating", "int(id) as helpful_vote", "int(id % 2) as year", "int(id % 3) as review_month"]
    columns += ["concat('a,b,c', id % 2) as categories", "string(id) as main_category", "string(id % 3) as sentiment_label"]
    text = plan(make(spark.range(60).selectExpr(*columns), part_chars))
    assert text.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" not in text


@pytest.mark.skipif(not Path("/root/testdata/sf0.001").exists(), reason="test tables are not there")
@pytest.mark.parametrize("name", ["E02_document_chunks", "CH5_document_chain"])
def test_chunks_are_laid_out_without_texts(spark, no_broadcast, name):
    """By document only numbers are exchanged; of a chunk's texts the largest piece stays where it is."""
    catalog.load_all()
    text = plan(catalog.QUERIES[name](spark, "/root/testdata/sf0.001"))
    laid = re.findall(r"Exchange hashpartitioning\(year[^\n]*\n(?:[^\n]* Filter [^\n]*\n)?[^\n]*Scan ExistingRDD\[([^\]]*)\]", text)
    assert laid and all("text#" not in columns for columns in laid)
    assert len(laid) == text.count("Exchange hashpartitioning(year")


@pytest.mark.skipif(not Path("/root/testdata/sf0.001").exists(), reason="test tables are not there")
@pytest.mark.parametrize("name", ["E02_document_parts", "E02_monthly_documents"])
def test_texts_of_parts_move_pressed(spark, no_broadcast, name):
    catalog.load_all()
    text = plan(catalog.QUERIES[name](spark, "/root/testdata/sf0.001"))
    moved = re.findall(r"Exchange hashpartitioning[^\n]*\n[^\n]*", text)
    assert not any(re.search(r"\btext#", m) for m in moved)
    assert sum("_pressed#" in m for m in moved if "hashpartitioning(year" in m) == 1


def test_key_sentences_move_no_rows(stored):
    text = plan(summaries.key_sentences(stored, ["row_id"], "text", 1))
    assert not any(word in text for word in ("Exchange", "Sort", "Window", "Generate"))
