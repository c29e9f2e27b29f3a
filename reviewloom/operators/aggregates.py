"""Counts, moments, quantiles and summaries."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewloom.plans.order import order_values
from reviewloom.plans.skew import join_small


def strata_counts(df: DataFrame, strata: Sequence[str] = ("review_month", "rating")) -> DataFrame:
    return df.dropna(subset=list(strata)).groupBy(*strata).agg(F.count(F.lit(1)).alias("count"))


def value_counts(df: DataFrame, col: str) -> DataFrame:
    counted = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    return counted.orderBy(F.desc("n"), col)


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct()


def null_counts(df: DataFrame) -> DataFrame:
    """Nulls per column and over all columns, from one pass."""
    columns = df.columns
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    total = sum((F.col(c) for c in columns), F.lit(0).cast("long"))
    rows = [F.struct(F.lit(c).alias("column"), F.col(c).alias("nulls")) for c in columns]
    rows.append(F.struct(F.lit("(all)").alias("column"), total.alias("nulls")))
    return counts.select(F.inline(F.array(*rows)))


def mean_std(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean and sample deviation per column, from one pass."""
    aggs = [f(c).alias(f"{p}_{c}") for c in columns for p, f in (("m", F.avg), ("s", F.stddev_samp))]
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"m_{c}").alias("mean"), F.col(f"s_{c}").alias("std")) for c in columns]
    return df.agg(*aggs).select(F.inline(F.array(*rows)))


def exact_quantiles(df: DataFrame, columns: str | Sequence[str], probabilities: Sequence[float]):
    """Linear-interpolated quantiles of a column, or a mapping of them for several; None where a column has no values.

    All columns are searched in the same passes over ``df``.
    """
    names = [columns] if isinstance(columns, str) else list(columns)

    def spots_of(total: int) -> list[int]:
        return [f((total - 1) * p) for p in probabilities for f in (math.floor, math.ceil)] if total else []

    totals: dict[str, int] = {}
    at = order_values(df, names, spots_of, totals)
    out = {}
    for c in names:
        spots = [(totals[c] - 1) * p for p in probabilities]
        between = [(at[c][math.floor(s)].value, at[c][math.ceil(s)].value, s - math.floor(s)) for s in spots] if totals[c] else []
        out[c] = [float(a) if a == b else a + (b - a) * share for a, b, share in between] or [None] * len(probabilities)
    return out[columns] if isinstance(columns, str) else out


def quartile_fences(df: DataFrame, columns: Sequence[str], approximate: bool = False) -> DataFrame:
    """Quartiles and the 1.5 IQR fences of each column."""
    names, shares = list(columns), [0.25, 0.75]
    got = dict(zip(names, df.approxQuantile(names, shares, 0.001))) if approximate else exact_quantiles(df, names, shares)
    rows = []
    for c in names:
        q1, q3 = got[c] or (None, None)
        if q1 is not None:
            rows.append((c, q1, q3, q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)))
    return df.sparkSession.createDataFrame(rows, "column string, q1 double, q3 double, low double, high double")


def class_shares(df: DataFrame, col: str, minority: float = 0.1) -> DataFrame:
    """Share of each class; classes below ``minority`` are marked."""
    counts = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    total = df.select(F.count(F.lit(1))).scalar()
    share = F.col("n") / total
    return counts.select(col, "n", share.alias("share"), (share < minority).alias("is_minority"))


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    counted = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return counted.filter("n > 1")


def data_card(df: DataFrame) -> DataFrame:
    """Per column: type, rows, nulls, smallest and largest value as text; nested columns have no such values."""
    kinds = dict(df.dtypes)
    none = F.lit(None).cast("string")
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for c, kind in df.dtypes:
        low, high = (none, none) if kind.startswith(("array", "map", "struct")) else (F.min(c).cast("string"), F.max(c).cast("string"))
        aggs += [F.count(c).alias(f"n_{c}"), low.alias(f"lo_{c}"), high.alias(f"hi_{c}")]
    rows = [
        F.struct(
            F.lit(c).alias("column"),
            F.lit(kinds[c]).alias("type"),
            F.col("_rows").alias("n_rows"),
            (F.col("_rows") - F.col(f"n_{c}")).alias("nulls"),
            F.col(f"lo_{c}").alias("smallest"),
            F.col(f"hi_{c}").alias("largest"),
        )
        for c in df.columns
    ]
    return df.agg(*aggs).select(F.inline(F.array(*rows)))


def latest_period(df: DataFrame, year: str = "year", month: str = "review_month", by: Sequence[str] = ()) -> DataFrame:
    grouped = df.groupBy(*by).agg(F.max(F.struct(F.col(year).alias("year"), F.col(month).alias("month"))).alias("p"))
    return grouped.select(*by, "p.year", "p.month")


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each key. Partial maxima are combined before the shuffle."""
    rest = [c for c in df.columns if c not in (*keys, *order)]
    best = df.groupBy(*keys).agg(F.max(F.struct(*order, *rest)).alias("_row"))
    return best.select(*keys, "_row.*").select(*df.columns)


def upsert_latest(old: DataFrame, new: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keyed upsert: the last write of each key over both tables."""
    return latest_per_key(old.unionByName(new), keys, order)


def union_by_name(first: DataFrame, *others: DataFrame) -> DataFrame:
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first


def distinct_rows(df: DataFrame, row_id: str = "row_id") -> DataFrame:
    """One row per set of equal rows, under its smallest id.

    Later copies are found on digests and ids alone. When they are few, the full
    rows are filtered in place and never shuffled.
    """
    from reviewloom.operators.quality import duplicates

    if row_id not in df.columns:
        return df.dropDuplicates()
    return join_small(df, duplicates(df, row_id).select(row_id), row_id, "left_anti").select(*df.columns)


def extra_columns(df: DataFrame, expected: Sequence[str]) -> DataFrame:
    """Columns beyond the expected set, one row each; schema work only."""
    names = [(c,) for c in df.columns if c not in set(expected)]
    return df.sparkSession.createDataFrame(names, "column string")
