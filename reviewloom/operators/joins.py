"""Joins between reviews, metadata, flags and stored documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewloom.functions.columns import product_columns
from reviewloom.plans.skew import join_small


def join_metadata(reviews: DataFrame, meta: DataFrame, null_safe: bool = False) -> DataFrame:
    """Left join on the product key.

    Spark picks the strategy from run-time sizes and splits hot products
    (adaptive skew join). ``null_safe`` also pairs null keys with null keys.
    """
    right = product_columns(meta)
    if not null_safe:
        return reviews.join(right, "parent_asin", "left")
    left, right = reviews.alias("l"), right.alias("r")
    joined = left.join(right, F.col("l.parent_asin").eqNullSafe(F.col("r.parent_asin")), "left")
    return joined.select("l.*", *[f"r.{c}" for c in right.columns if c != "parent_asin"])


def join_bloat(reviews: DataFrame, meta: DataFrame, key: str = "parent_asin") -> DataFrame:
    """Rows before and after a left join, and how many metadata keys repeat.

    Both sides shrink to one count per key first, so the join itself is not run.
    """
    left = reviews.groupBy(key).agg(F.count(F.lit(1)).alias("n_left"))
    right = meta.groupBy(key).agg(F.count(F.lit(1)).alias("n_right"))
    sizes = left.join(right, key, "full")
    n_left, n_right = F.coalesce("n_left", F.lit(0)), F.coalesce("n_right", F.lit(0))
    return sizes.agg(
        F.sum(n_left).alias("rows_before"),
        F.sum(n_left * F.greatest(n_right, F.lit(1))).alias("rows_after"),
        F.coalesce(F.sum(F.when(F.col(key).isNotNull() & (n_right > 1), 1)), F.lit(0)).alias("repeated_keys"),
    ).withColumn("no_bloat", F.col("rows_before") == F.col("rows_after"))


def with_stratum_count(df: DataFrame, strata: Sequence[str], name: str = "count") -> DataFrame:
    """Each row with the size of its stratum; rows with a null stratum go.

    A window would move every row of a stratum to one task; the counts are
    combined map-side and come back as a checked small table.
    """
    strata = list(strata)
    counts = df.dropna(subset=strata).groupBy(*strata).agg(F.count(F.lit(1)).alias(name))
    return join_small(df, counts, strata)


def attach(df: DataFrame, extra: DataFrame, key: str = "row_id") -> DataFrame:
    """Bring columns computed elsewhere back by row key."""
    return df.join(extra, key, "inner")


def flagged_survivors(df: DataFrame, flags: DataFrame, key: str = "row_id") -> DataFrame:
    """Rows of ``df`` whose key was flagged."""
    return df.join(flags.select(key), key, "left_semi")


def outside(df: DataFrame, col: str, allowed: DataFrame | Sequence[str]) -> DataFrame:
    """Rows whose value is not in a reference set; null is outside."""
    if isinstance(allowed, DataFrame):
        return df.join(allowed.select(F.col(allowed.columns[0]).alias(col)), col, "left_anti")
    return df.filter(~F.coalesce(F.col(col).cast("string").isin(list(allowed)), F.lit(False)))


def inside(df: DataFrame, col: str, allowed: DataFrame) -> DataFrame:
    return df.join(allowed.select(F.col(allowed.columns[0]).alias(col)), col, "left_semi")


def documents_of(hits: DataFrame, docs: DataFrame) -> DataFrame:
    """Stored documents of retrieved hits, by their path metadata."""
    return join_small(docs, hits, ["category", "year", "month", "subcategory"])
