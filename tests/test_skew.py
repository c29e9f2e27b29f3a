"""The exact building blocks against brute force, with a hot key."""

import random

import pytest
from pyspark.sql import functions as F

from reviewloom.operators import aggregates, joins, quality
from reviewloom.plans import skew


@pytest.mark.parametrize("sort_rows", [10, 200_000])
def test_order_statistics(spark, sort_rows):
    keys = [(i % 7, i) for i in range(500)]
    random.Random(1).shuffle(keys)
    df = spark.createDataFrame(keys, "a int, b int").repartition(4)
    want = sorted(keys)
    spots = [0, 1, 250, 399, 499]
    got = skew.order_statistics(df, ["a", "b"], spots, buckets=8, sort_rows=sort_rows)
    assert got == {p: want[p] for p in spots}
    with pytest.raises(ValueError):
        skew.order_statistics(df, ["a", "b"], [500], buckets=8, sort_rows=sort_rows)


@pytest.mark.parametrize("sort_rows", [5, 200_000])
def test_weighted_order_statistics(spark, sort_rows):
    counts = [(float(v), (v * 7) % 5 + 1) for v in range(60)] + [(1000.0, 400)]
    flat = sorted(v for v, n in counts for _ in range(n))
    df = spark.createDataFrame(counts, "v double, n bigint")
    spots = [0, len(flat) // 3, len(flat) - 1]
    got = skew.order_statistics(df, ["v"], spots, weight="n", buckets=6, sort_rows=sort_rows)
    assert {p: g[0] for p, g in got.items()} == {p: flat[p] for p in spots}


@pytest.mark.parametrize("hot_rows,buckets", [(10_000, 512), (50, 16), (40, 4), (100, 3)])
def test_running_total_with_hot_key(spark, hot_rows, buckets):
    data = [("hot" if i % 3 else f"k{i % 10}", i, (i * 37) % 11) for i in range(900)]
    df = spark.createDataFrame(data, "k string, row_id bigint, v bigint").repartition(5)
    got = {(r.k, r.row_id): r.before for r in skew.running_total(df, ["k"], "row_id", "v", buckets=buckets, hot_rows=hot_rows).collect()}
    want, sums = {}, {}
    for k, i, v in sorted(data, key=lambda x: x[1]):
        want[(k, i)] = sums.get(k, 0)
        sums[k] = want[(k, i)] + v
    assert got == want


@pytest.mark.parametrize("limit,operator", [(100, "BroadcastHashJoin"), (1, None)])
def test_join_small_broadcasts_only_when_counted_small(spark, limit, operator):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        big = spark.range(100).withColumn("k", F.col("id") % 5)
        small = big.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
        joined = skew.join_small(big, small, "k", max_rows=limit)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert ("BroadcastHashJoin" in plan) == (operator is not None)
        assert joined.filter("n = 20").count() == 100
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_exact_quantiles(spark):
    values = [float((i * 7919) % 1000) for i in range(777)] + [5.0] * 300
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    want = df.agg(F.percentile("v", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))).first()[0]
    assert aggregates.exact_quantiles(df, "v", [0.25, 0.5, 0.75]) == pytest.approx(want)
    assert aggregates.exact_quantiles(df.filter("v < 0"), "v", [0.5]) == [None]


def test_duplicates_of_a_hot_group(rows):
    copies = [(i, "same", None, ["a"]) for i in range(300)]
    near = [(300, "same", "", ["a"]), (301, None, "same", ["a"]), (302, "same", None, ["a", None]), (303, "same", None, None)]
    df = rows("row_id int, a string, b string, c array<string>", *copies, *near)
    assert sorted(r.row_id for r in quality.duplicates(df).collect()) == list(range(1, 300))
    assert sorted(r.row_id for r in aggregates.distinct_rows(df).collect()) == [0, 300, 301, 302, 303]


def test_upsert_keeps_last_write(rows):
    ddl = "id string, at int, v string"
    old, new = rows(ddl, ("a", 1, "x"), ("b", 5, "y")), rows(ddl, ("a", 2, "z"), ("b", 4, "late"), ("c", 1, "n"))
    got = {r.id: r.v for r in aggregates.upsert_latest(old, new, ["id"], ["at"]).collect()}
    assert got == {"a": "z", "b": "y", "c": "n"}


def _final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_product_is_split_over_tasks(spark):
    """A product (or a missing one) with most reviews: the join partition is split at run time."""
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)
    try:
        hot = F.when(F.col("id") % 2 == 0, "hot").when(F.col("id") % 3 == 0, None).otherwise(F.col("id").cast("string"))
        reviews = spark.range(0, 60_000, 1, 8).select(F.col("id").alias("row_id"), hot.alias("parent_asin"))
        products = spark.range(0, 60_000, 1, 8).select(F.col("id").cast("string").alias("parent_asin")).union(spark.createDataFrame([("hot",)], "parent_asin string"))
        meta = products.select("parent_asin", *[F.lit("x").alias(c) for c in ("main_category", "title")], F.array(F.lit("c")).alias("categories"), F.lit(1.0).alias("price"), F.lit(1.0).alias("average_rating"), F.lit(1).alias("rating_number"))
        joined = joins.join_metadata(reviews, meta)
        plan = _final_plan(joined)
        assert "skew=true" in plan
        assert joined.count() == 60_000 and joined.filter("product_name is null").count() == 10_000
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_buckets_follow_the_order_and_are_even(spark):
    # ids crowd at the low end: even widths would put nearly all rows into one bucket
    df = spark.range(1000).select((F.col("id") % 2).alias("k"), F.pow(F.lit(1.02), F.col("id")).alias("at"))
    got = skew.with_bucket(df, ["k"], "at", 8, "b").groupBy("k", "b").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("lo"), F.max("at").alias("hi")).orderBy("k", "b").collect()
    for k in (0, 1):
        mine = [r for r in got if r.k == k]
        assert [r.b for r in mine] == list(range(8)) and max(r.n for r in mine) < 80
        assert all(a.hi < b.lo for a, b in zip(mine, mine[1:]))


def test_few_wide_rows_are_not_broadcast(spark):
    wide = spark.range(10).select("id", F.repeat(F.lit("x"), 2_000_000).alias("text"))
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    big = spark.range(1000)
    assert "broadcast" not in plan(skew.join_small(big, wide, "id"))
    assert "broadcast" in plan(skew.join_small(big, wide.select("id"), "id"))
    listed = spark.range(10).select("id", F.array_repeat(F.lit(1.5), 500_000).alias("values"))
    assert not skew.may_broadcast(listed) and skew.may_broadcast(listed.limit(0))
