"""Sharding law: stable, weighted, few moves; slots without gaps."""

from collections import Counter
import zlib

from pyspark.sql import functions as F
import pytest

from reviewloom.llm.rendezvous import number_slots, place, shard_records


def test_odd_rows(rows):
    df = rows("doc_id long, text string, shard string, slot string", (1, None, "a", "b"), (1, "", "a", "b"), (2, "é", "", ""), (2, "é", "", ""), (None, "x", "", ""), (None, "y" * 100_000, "", ""))
    out = place(df).collect()
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in out) == sorted(
        (str(i), 16 + len(t.encode()), zlib.crc32(t.encode())) for i, t in [(1, ""), (1, ""), (2, "é"), (2, "é"), (None, "x"), (None, "y" * 100_000)])
    by_id = {}
    for r in out:
        by_id.setdefault(r.doc_id, set()).add((r.shard, r.grown_shard))
    assert all(len(x) == 1 for x in by_id.values())
    check_slots(out)
    assert place(df.limit(0)).count() == 0


def check_slots(out):
    slots = {}
    for r in out:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())


def test_one_hot_key_and_growth(spark):
    df = spark.range(20_000).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("doc_id"), F.lit("t").alias("text"))
    out = place(df).collect()
    check_slots(out)
    ids = {r.doc_id: r for r in out}
    moved = [r for r in ids.values() if r.shard != r.grown_shard]
    assert all(r.grown_shard == 40 for r in moved)
    assert 0.4 < len(moved) / (len(ids) / 41) < 1.6
    # a shard more gives what the grown column says
    again = shard_records(df.distinct(), "doc_id", [1.0] * 41).collect()
    assert {r.doc_id: r.shard for r in again} == {i: r.grown_shard for i, r in ids.items()}


def test_weights(spark):
    df = spark.range(12_000).select(F.col("id").alias("key"), F.lit("old").alias("shard"))
    shares = Counter(r.shard for r in shard_records(df, "key", [1.0, 2.0, 3.0]).collect())
    assert all(abs(shares[i] - 2000 * (i + 1)) < 300 for i in range(3))
    heavier = {r.key: r.shard for r in shard_records(df, "key", [1.0, 2.0, 4.0]).collect()}
    before = {r.key: r.shard for r in shard_records(df, "key", [1.0, 2.0, 3.0]).collect()}
    assert all(heavier[k] == 2 for k in before if before[k] != heavier[k])
    with pytest.raises(ValueError):
        shard_records(df, "key", [1.0, 0.0])


def test_slots_of_repeated_rows(rows):
    df = rows("shard int, x int", *[(0, 5)] * 50, (0, None), (1, 1))
    out = number_slots(df, "shard", ["x"]).collect()
    check_slots(out)
    assert len(out) == 52


def test_no_python_in_the_plan(rows):
    plan = place(rows("doc_id long, text string", (1, "a")))._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "MapIn"))


def test_one_row_repeated_unfolds_in_many_tasks(spark):
    df = spark.range(1_000_000).select(F.lit(0).alias("shard"), F.lit(None).cast("long").alias("x"))
    out = number_slots(df, "shard", ["x"]).withColumn("task", F.spark_partition_id())
    by_task = out.groupBy("task").count().collect()
    assert len(by_task) > 1 and sum(r["count"] for r in by_task) == 1_000_000
    assert out.agg(F.min("slot"), F.max("slot"), F.countDistinct("slot")).first()[:] == (0, 999_999, 1_000_000)
