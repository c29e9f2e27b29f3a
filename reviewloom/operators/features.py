"""Model features and label encoding."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewloom.functions.columns import number_or_null
from reviewloom.plans.skew import join_small
from reviewloom.session import settle

FIRST_COLUMNS = ("text", "price", "price_missing", "helpful_vote", "verified_purchase")


def prepare_features(df: DataFrame, null_verified: bool = False) -> DataFrame:
    """Empty texts, numeric price with a missing mark, whole votes, 0/1 verification."""
    price = number_or_null("price")
    return df.withColumns(
        {
            "text": F.coalesce("text", F.lit("")),
            "title": F.coalesce("title", F.lit("")),
            "price": F.coalesce(price, F.lit(0.0)),
            "price_missing": price.isNull().cast("int"),
            "helpful_vote": F.coalesce(F.col("helpful_vote").cast("int"), F.lit(0)),
            "verified_purchase": F.coalesce("verified_purchase", F.lit(null_verified)).cast("int"),
        }
    )


def features_first(df: DataFrame, first: Sequence[str] = FIRST_COLUMNS) -> DataFrame:
    return df.select(*first, *[c for c in df.columns if c not in first])


def model_input(df: DataFrame, name: str = "combined_text") -> DataFrame:
    return df.withColumn(name, F.concat_ws(" ", "title", "text"))


def encode_labels(df: DataFrame, col: str = "sentiment_label", name: str = "label") -> DataFrame:
    """Sorted distinct strings to 0..k-1, null stays null.

    The classes are sorted once over all tasks; a class's number is its place in its sorted part plus the sizes of the
    parts before it, one row for each part.
    """
    classes = df.select(F.col(col).alias("_class")).filter(F.col("_class").isNotNull()).distinct()
    # a part number in the upper and a place in the lower 33 bits
    placed = settle(classes.orderBy("_class").withColumn("_at", F.monotonically_increasing_id()))
    place, part = F.col("_at").bitwiseAND((1 << 33) - 1), F.shiftright("_at", 33)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = settle(sizes.select("_part", before.alias("_before")))
    coded = placed.join(F.broadcast(starts), part == F.col("_part")).select("_class", (place + F.col("_before")).cast("int").alias("_code"))
    kept = [c for c in df.columns if c != name]
    joined = join_small(df.withColumn("_class", F.col(col)), coded, "_class", "left")
    return joined.select(*kept, F.col("_code").alias(name))
