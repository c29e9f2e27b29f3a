"""Radix selection: every position of awkward columns, all columns in the same passes."""

import math
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from reviewloom.operators import aggregates, sampling
from reviewloom.plans import order


def ordered(values):
    """Non-null values in Spark's order: NaN last, zeros equal."""
    return sorted((v for v in values if v is not None), key=lambda v: (isinstance(v, float) and math.isnan(v), v))


def same(a, b):
    return a == b or (math.isnan(a) and math.isnan(b))


def test_every_position(spark, monkeypatch):
    rng = random.Random(3)
    doubles = [0.0, -0.0, math.inf, -math.inf, math.nan, 5e-324, -5e-324, 1.7e308, -1.7e308, None] + [rng.choice([1, -1]) * 10 ** rng.uniform(-300, 300) for _ in range(80)]
    longs = [2**63 - 1, -(2**63), 0, None] + [rng.randrange(-(2**62), 2**62) for _ in range(40)] + [7] * 46
    near = [1.0 + i * 2**-52 for i in range(90)]
    df = spark.createDataFrame(list(zip(doubles, longs, near)), "a double, b long, c double")
    passes = []
    count = order._count
    monkeypatch.setattr(order, "_count", lambda *args: (passes.append(1), count(*args)))
    got = order.order_values(df, ["a", "b", "c"], lambda n: range(n))
    assert len(passes) <= 6
    for name, values in (("a", doubles), ("b", longs), ("c", near)):
        want = ordered(values)
        assert sorted(got[name]) == list(range(len(want)))
        for i, v in enumerate(want):
            place = got[name][i]
            assert same(place.value, v) and place.below <= i < place.below + place.copies
    sevens = [p for p in got["b"].values() if p.value == 7]
    assert {p.copies for p in sevens} == {46} and len({p.below for p in sevens}) == 1


def test_positions_outside(spark):
    with pytest.raises(ValueError, match="outside"):
        order.order_values(spark.range(5), ["id"], lambda n: [5])


@settings(max_examples=12, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), st.floats(allow_nan=False, allow_infinity=False, width=32)), st.one_of(st.none(), st.integers(-1000, 1000))), max_size=40))
def test_quantiles_equal_the_sorting_aggregate(spark, values):
    df = spark.createDataFrame(values, "x double, y int")
    shares = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = aggregates.exact_quantiles(df, ["x", "y"], shares)
    want = df.agg(*[F.percentile(c, F.array(*[F.lit(s) for s in shares])).alias(c) for c in ("x", "y")]).first()
    for c in ("x", "y"):
        assert got[c] == pytest.approx(want[c]) if want[c] else got[c] == [None] * len(shares)


def test_all_columns_share_the_passes_and_nothing_is_kept(spark):
    rows = spark.range(0, 20_000, 1, 4)
    df = rows.select(*[(F.col("id") * (i + 3) % 9973).cast("double").alias(f"c{i}") for i in range(12)])
    fences = {r["column"]: r for r in aggregates.quartile_fences(df, df.columns).collect()}
    assert len(fences) == 12
    want = df.agg(F.percentile("c7", F.lit(0.25))).first()[0]
    assert fences["c7"]["q1"] == pytest.approx(want)
    assert spark.sparkContext._jsc.sc().getPersistentRDDs().isEmpty()


def test_time_split_without_times_or_rows(spark):
    rows = [(i, None if i % 2 else "2020-01-01 00:00:00") for i in range(10)]
    df = spark.createDataFrame(rows, "row_id long, t string").withColumn("review_time", F.to_timestamp("t"))
    got = {r.row_id: r.split for r in sampling.time_split(df).collect()}
    assert [got[i] for i in (0, 2, 4, 6, 8, 1, 3, 5)] == ["train"] * 8 and (got[7], got[9]) == ("val", "test")
    assert sampling.time_split(df.limit(0)).count() == 0
