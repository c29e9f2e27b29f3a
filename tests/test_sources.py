"""Readers, writers, streams on small files."""

import gzip
import json

import pytest
from pyspark.sql import functions as F

from reviewloom.operators import aggregates
from reviewloom.schemas import RAW_REVIEW_DDL, from_ddl
from reviewloom.session import shared_folder
from reviewloom.sources import readers, writers
from reviewloom.streaming import increments


def _lines(path, records):
    with gzip.open(path, "wt") as f:
        f.writelines((r if isinstance(r, str) else json.dumps(r)) + "\n" for r in records)
    return str(path)


def test_jsonl_gz(spark, tmp_path):
    path = _lines(tmp_path / "r.jsonl.gz", [{"rating": 5, "text": "a", "timestamp": i, "images": []} for i in range(25)] + ["{broken"])
    schema = from_ddl(RAW_REVIEW_DDL + ", _corrupt_record string")
    df = readers.read_jsonl(spark, path, schema).cache()
    assert df.filter("_corrupt_record is not null").count() == 1 and df.filter("rating = 5").count() == 25
    assert readers.read_jsonl(spark, path, schema, limit=7).count() == 7
    assert readers.read_jsonl(spark, path, schema, partitions=4).rdd.getNumPartitions() == 4


def test_inference_sees_keys_missing_in_the_first_line(spark, tmp_path):
    path = _lines(tmp_path / "m.jsonl.gz", [{"a": 1}, {"a": 2, "b": {"c": ["x"]}}])
    df = readers.read_jsonl(spark, path)
    assert df.columns == ["a", "b"] and df.filter("b.c[0] = 'x'").count() == 1


def test_csv_keeps_quotes_breaks_and_blanks(spark, tmp_path):
    data = [(1, 'say "hi", ok\nnext', " lead"), (2, "", None), (3, None, "é")]
    df = spark.createDataFrame(data, "id int, text string, title string")
    back = readers.read_csv(spark, writers.write_stage(df, str(tmp_path / "c"), fmt="csv"), df.schema)
    got = {r.id: (r.text, r.title) for r in back.collect()}
    assert got[1] == ('say "hi", ok\nnext', " lead") and got[3] == (None, "é")
    assert readers.read_csv(spark, str(tmp_path / "c")).dtypes[0] == ("id", "int")


def test_json_tree_skips_bad_files_and_entries(spark, tmp_path):
    for name, text in {"a/2020/1/x.json": '{"k": 1}', "a/2020/2/y.json": '[{"k": 2}, 5, {"k": 3}]', "a/z.json": "{broken", "a/n.txt": "{}"}.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(text)
    got = sorted((r.path.split("/")[-1], json.loads(r.record)["k"]) for r in readers.read_json_tree(spark, str(tmp_path)).collect())
    assert got == [("x.json", 1), ("y.json", 2), ("y.json", 3)]


def test_document_array(spark, tmp_path):
    (tmp_path / "d.json").write_text('[{"text": "a",\n "year": 1}, {"text": "b", "year": 2}]')
    assert readers.read_documents(spark, str(tmp_path / "d.json"), array=True).count() == 2


def test_latest_file(spark, tmp_path):
    import os

    for i, name in enumerate(["data_1.csv", "data_2.csv", "other_3.csv"]):
        (tmp_path / name).write_text("x")
        os.utime(tmp_path / name, (1000 + i, 1000 + i))
    assert readers.latest_file(spark, str(tmp_path), "data_").first().path.endswith("data_2.csv")


def test_row_ids_are_unique_and_stable(spark, tmp_path):
    spark.createDataFrame([("same", None)] * 500 + [("x", "y")], "a string, b string").repartition(3).write.json(str(tmp_path / "r"))
    read = lambda: readers.with_row_id(spark.read.schema("a string, b string").json(str(tmp_path / "r")))
    first = {r.row_id for r in read().collect()}
    assert len(first) == 501 and first == {r.row_id for r in read().collect()}
    keyed = readers.with_row_id(spark.range(3).withColumn("k", F.lit("v")), ["id", "k"])
    assert keyed.select("row_id").distinct().count() == 3


def test_stage_replaces_only_its_partitions(spark, tmp_path):
    path = str(tmp_path / "s")
    writers.write_stage(spark.range(10).withColumn("p", F.col("id") % 2), path, by=["p"])
    writers.write_stage(spark.range(3).withColumn("p", F.lit(1)), path, by=["p"])
    assert {r.p: r["count"] for r in spark.read.parquet(path).groupBy("p").count().collect()} == {0: 5, 1: 3}


def test_create_or_append_by_name(spark, tmp_path):
    df = spark.range(2).withColumn("v", F.lit("x"))
    writers.drop_table(spark, "t_append")
    writers.create_or_append(df, "t_append", str(tmp_path / "t"))
    writers.create_or_append(df.select("v", "id"), "t_append")
    assert readers.read_table(spark, "t_append").filter("v = 'x'").count() == 4
    writers.drop_table(spark, "t_append")


def test_external_upsert_sends_groups(spark, tmp_path):
    folder = str(tmp_path)

    def send(group):
        import uuid

        with open(f"{folder}/{uuid.uuid4().hex}.json", "w") as f:
            json.dump(group, f)

    writers.upsert_external(spark.range(0, 25, 1, 2), send, 10)
    sizes = sorted(len(json.loads(p.read_text())) for p in tmp_path.iterdir())
    assert sum(sizes) == 25 and max(sizes) == 10


def test_metrics_files(spark, tmp_path):
    path = writers.write_metrics(spark.createDataFrame([("All", 0.5)], "slice string, f1 double"), str(tmp_path / "m"))
    assert spark.read.json(f"{path}/json").first().f1 == 0.5
    assert spark.read.option("header", True).csv(f"{path}/csv").first().slice == "All"


def test_stream_adds_each_row_once(spark, tmp_path):
    source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    ddl = "row_id bigint, timestamp bigint"
    for month in (1, 2):
        rows = spark.range(10).select((F.col("id") + 10 * month).alias("row_id"), (F.lit(1577836800000) + (month - 1) * 31 * 86400000).alias("timestamp"))
        rows.write.mode("append").json(source)
        for _ in range(2):
            increments.run_available(increments.review_stream(spark, source, ddl), target, state)
    filed = spark.read.parquet(target)
    assert filed.count() == 20 and {(r.year, r.review_month) for r in filed.collect()} == {(2020, 1), (2020, 2)}


def test_upsert_of_nothing(spark):
    empty = spark.createDataFrame([], "id string, at int, v string")
    assert aggregates.upsert_latest(empty, empty, ["id"], ["at"]).count() == 0


def test_shared_folder_follows_the_session(spark):
    assert shared_folder(spark) == shared_folder(spark)
    assert spark.sparkContext._jsc.sc().getCheckpointDir().isDefined()


@pytest.mark.parametrize("parts", [1, 20])
def test_spread_leaves_enough_splits_alone(spark, parts):
    df = spark.range(0, 100, 1, parts)
    assert readers.spread(df).rdd.getNumPartitions() == max(parts, spark.sparkContext.defaultParallelism)
