"""Row filters: periods, required values, browsing, hit metadata."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewloom.functions.text import word_count


def _between(df: DataFrame, col: str, low: Column, high: Column, closed: bool) -> DataFrame:
    """``low <= col < high`` (``<= high`` when closed).

    The derived review time cannot be pushed into a scan, its source column of
    epoch milliseconds can: the same bounds are put on it.
    """
    def limits(c: Column, lo: Column, hi: Column) -> Column:
        return (c >= lo) & ((c <= hi) if closed else (c < hi))

    if col == "review_time" and dict(df.dtypes).get("timestamp") == "bigint":
        df = df.filter(limits(F.col("timestamp"), F.unix_millis(low), F.unix_millis(high)))
    return df.filter(limits(F.col(col), low, high))


def in_window(df: DataFrame, start: str, end: str, end_inclusive_day: bool = True, col: str = "review_time") -> DataFrame:
    """Rows from ``start`` to ``end``.

    ``end_inclusive_day=False`` stops at the last day's midnight, the published rule.
    """
    low, last = F.to_timestamp(F.lit(start)), F.to_date(F.lit(end))
    high = F.to_timestamp(F.date_add(last, 1)) if end_inclusive_day else F.to_timestamp(F.lit(end))
    return _between(df, col, low, high, closed=not end_inclusive_day)


def in_month(df: DataFrame, year: int, month: int, col: str = "review_time") -> DataFrame:
    """Rows of one calendar month, as a half-open range."""
    first = F.make_date(F.lit(year), F.lit(month), F.lit(1))
    return _between(df, col, F.to_timestamp(first), F.to_timestamp(F.add_months(first, 1)), closed=False)


def with_text_and_rating(df: DataFrame) -> DataFrame:
    return df.dropna(subset=["text", "rating"])


def split_by_year(df: DataFrame, early: Sequence[int] = (2018, 2019), late: int = 2020) -> tuple[DataFrame, DataFrame]:
    return df.filter(F.col("year").isin(list(early))), df.filter(F.col("year") == late)


def min_words(df: DataFrame, n: int, col: str = "text") -> DataFrame:
    return df.filter(word_count(col) >= n)


def browse(df: DataFrame, where: dict, columns: Sequence[str]) -> DataFrame:
    """Distinct combinations of some columns among rows equal to ``where``."""
    for name, value in where.items():
        df = df.filter(F.col(name) == value)
    return df.select(*columns).distinct()


def hit_filter(df: DataFrame, category: str | None = None, year=None, month=None) -> DataFrame:
    """Metadata filter of hits: category contains, year and month equal; "ALL" months pass."""
    if category:
        df = df.filter(F.contains(F.lower("category"), F.lit(category.lower())))
    if year:
        df = df.filter(F.col("year").cast("string") == str(year))
    if month and month != "ALL":
        df = df.filter(F.col("month").cast("string") == str(month))
    return df


def combination_counts(df: DataFrame, where: Column, columns: Sequence[str]) -> DataFrame:
    return df.filter(where).groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))


def valid_vectors(df: DataFrame, dim: int, values: str = "values", meta: str | None = None) -> DataFrame:
    """Vector rows of the expected length, with metadata when that column is named."""
    kept = df.filter(F.col(values).isNotNull() & (F.size(values) == dim))
    return kept.filter(F.col(meta).isNotNull()) if meta else kept
