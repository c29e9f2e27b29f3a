"""The cleaning step: distinct rows, required fields, types, fills, text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewloom.functions.columns import narrow_types, price_text
from reviewloom.functions.constants import EMOJI_WIDE
from reviewloom.functions.text import clean_text, matches, name_emoji, non_ascii_class
from reviewloom.operators.aggregates import distinct_rows
from reviewloom.operators.filters import with_text_and_rating


def fill_missing(df: DataFrame) -> DataFrame:
    return df.fillna({"title": "unknown", "helpful_vote": 0})


def clean_reviews(df: DataFrame, emoji_names: dict[str, str] | None = None, flag: Column | None = None) -> DataFrame:
    """Drop copies and rows without text or rating, narrow types, fill, clean text.

    Emoji are named on flagged rows; by default the flag is the wide emoji test
    on the raw text, as the validation step computes it.
    """
    flagged = flag if flag is not None else matches("text", non_ascii_class(EMOJI_WIDE))
    kept = with_text_and_rating(distinct_rows(df)).withColumn("_flag", flagged)
    typed = fill_missing(narrow_types(kept)).withColumn("price", price_text("price"))
    cleaned = typed.withColumns({"title": clean_text("title"), "text": clean_text("text")})
    named = F.when(F.col("_flag"), name_emoji("text", emoji_names)).otherwise(F.col("text"))
    return cleaned.withColumn("text", named).drop("_flag")
