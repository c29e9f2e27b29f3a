"""Distance between training and serving features, and between periods."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reviewloom.functions.constants import DRIFT_LIMITS, SKEW_LIMITS

NUMERIC = ("price", "helpful_vote")
# bins of stored histograms: 0, then 1, 2, 5 times the powers of ten. They never depend on the data, so periods add up
EDGES = (0.0, *(float(f"{step}e{power}") for power in range(-2, 7) for step in (1, 2, 5)))
MISSING = "missing"
HISTOGRAM = "feature string, bucket string, n bigint, period string"


def feature_skew(
    train: DataFrame, serve: DataFrame, limits: Mapping[str, float] = SKEW_LIMITS, numeric=NUMERIC, bins: int = 20
) -> DataFrame:
    """Per feature: distance, threshold, alert.

    Categories use the largest difference of shares, numbers the Jensen-Shannon
    divergence (base 2) over shared equal-width bins. One pass counts the
    (feature, bucket) pairs of both sides.
    """
    features = [f for f in limits if f in train.columns and f in serve.columns]
    numbers = [f for f in features if f in numeric]
    both = train.select(*features, F.lit(1).alias("_side")).unionByName(serve.select(*features, F.lit(0).alias("_side")))
    buckets = {}
    if numbers:
        span = [g(F.col(f).cast("double")).alias(f"{k}_{f}") for f in numbers for k, g in (("lo", F.min), ("hi", F.max))]
        bounds = both.agg(F.struct(*span).alias("b")).scalar()
        for f in numbers:
            low, high = bounds.getField(f"lo_{f}"), bounds.getField(f"hi_{f}")
            place = F.floor((F.col(f).cast("double") - low) / (high - low) * bins)
            buckets[f] = F.when(high > low, F.least(place, F.lit(bins - 1))).otherwise(F.lit(0)).cast("string")
    for f in features:
        # long texts are compared by digest
        buckets.setdefault(f, F.md5(F.col(f)) if f == "text" else F.col(f).cast("string"))
    pairs = F.array(*[F.struct(F.lit(f).alias("feature"), buckets[f].alias("bucket")) for f in features])
    counts = (
        both.select("_side", F.inline(pairs))
        .groupBy("feature", "bucket")
        .agg(F.sum("_side").alias("n_train"), F.sum(1 - F.col("_side")).alias("n_serve"))
    )
    totals = both.agg(F.struct(F.sum("_side").alias("t"), F.sum(1 - F.col("_side")).alias("s")).alias("n")).scalar()
    p, q = F.col("n_train") / totals.getField("t"), F.col("n_serve") / totals.getField("s")
    shares = counts.select("feature", p.alias("p"), q.alias("q"))
    return _against(shares.groupBy("feature").agg(_distance(numbers).alias("distance")), {f: limits[f] for f in features})


def _distance(numbers: Sequence[str]) -> Column:
    """Aggregate over the buckets of a feature with shares ``p`` and ``q``."""
    p, q, m = F.col("p"), F.col("q"), (F.col("p") + F.col("q")) / 2
    term = F.when(p > 0, p * F.log2(p / m)).otherwise(0.0) / 2 + F.when(q > 0, q * F.log2(q / m)).otherwise(0.0) / 2
    is_number = F.col("feature").isin(*numbers) if numbers else F.lit(False)
    return F.when(is_number, F.sum(term)).otherwise(F.max(F.abs(p - q)))


def _against(distances: DataFrame, limits: Mapping[str, float]) -> DataFrame:
    limit = F.lit(None).cast("double")
    for f, value in limits.items():
        limit = F.when(F.col("feature") == f, F.lit(float(value))).otherwise(limit)
    return distances.withColumn("threshold", limit).withColumn("alert", F.col("distance") > F.col("threshold"))


def period_histograms(
    rows: DataFrame, period: str, features: Sequence[str] = tuple(DRIFT_LIMITS), numeric: Sequence[str] = NUMERIC,
    edges: Sequence[float] = EDGES,
) -> DataFrame:
    """Per period and feature: how many rows fall into each bucket.

    Numbers fall between fixed ``edges`` (a bucket is named by the count of edges at or below the value), long texts into
    256 buckets by digest, other values are their own bucket, nulls share one. Rows without a period belong to none. One
    pass with map-side sums; histograms of parts of a period add up to that of the whole.
    """
    held = [f for f in features if f in rows.columns]
    if not held:
        raise ValueError("none of the features is a column")

    def bucket(f: str) -> Column:
        if f in numeric:
            value = F.col(f).cast("double")
            below = F.filter(F.array(*map(F.lit, edges)), lambda e: e <= value)
            return F.when(value.isNotNull(), F.size(below).cast("string"))
        return F.substring(F.md5(F.col(f)), 1, 2) if f == "text" else F.col(f).cast("string")

    pairs = F.array(*[F.struct(F.lit(f).alias("feature"), F.coalesce(bucket(f), F.lit(MISSING)).alias("bucket")) for f in held])
    placed = rows.filter(F.col(period).isNotNull()).select(F.col(period).cast("string").alias("period"), F.inline(pairs))
    return placed.groupBy("period", "feature", "bucket").agg(F.count(F.lit(1)).alias("n"))


def store_periods(histograms: DataFrame, path: str) -> str:
    """File the histograms by period. A period that is filed again is replaced, the others are not touched, so a monthly
    run may be repeated; the replaced periods change together when the write commits."""
    # a period holds a bounded number of buckets: one file
    rows = histograms.select("feature", "bucket", "n", "period").repartition("period")
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("period").parquet(path)
    return path


def stored_periods(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(HISTOGRAM).parquet(path)


def feature_drift(histograms: DataFrame, limits: Mapping[str, float] = DRIFT_LIMITS, numeric: Sequence[str] = NUMERIC) -> DataFrame:
    """Each period against the last one before it that holds the feature: period, previous, feature, distance, threshold, alert.

    Distances are those of ``feature_skew``. The first period has nothing before it and no row. Works on histograms only:
    every bucket goes to its own period and to the next one, and the two shares meet in one aggregate, without a self-join.
    """
    counts = histograms.filter(F.col("feature").isin(*limits)).groupBy("period", "feature", "bucket").agg(F.sum("n").alias("n"))
    along = Window.partitionBy("feature").orderBy("period")
    totals = counts.groupBy("period", "feature").agg(F.sum("n").alias("_total")).select(
        "*", F.lag("period").over(along).alias("previous"), F.lead("period").over(along).alias("_next"),
    )
    shared = counts.join(totals, ["period", "feature"]).withColumn("_share", F.col("n") / F.col("_total"))
    sides = F.array(
        F.struct("period", "previous", F.col("_share").alias("p"), F.lit(0.0).alias("q")),
        F.struct(F.col("_next").alias("period"), F.col("period").alias("previous"), F.lit(0.0).alias("p"), F.col("_share").alias("q")),
    )
    met = shared.select("feature", "bucket", F.inline(sides)).filter(F.col("period").isNotNull() & F.col("previous").isNotNull())
    shares = met.groupBy("period", "previous", "feature", "bucket").agg(F.sum("p").alias("p"), F.sum("q").alias("q"))
    distances = shares.groupBy("period", "previous", "feature").agg(_distance([f for f in limits if f in numeric]).alias("distance"))
    return _against(distances, limits)
