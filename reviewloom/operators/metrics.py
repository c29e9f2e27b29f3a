"""Classification metrics overall and per slice, bias and quality gates.

Rows are reduced to (slice values, label, prediction) counts in one pass; every
metric is arithmetic on those counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FULL = "Full Dataset"


def _ratio(num, den):
    return F.coalesce(F.when(den > 0, num / den), F.lit(0.0))


def _per_class(counts: DataFrame, by: Sequence[str], label: str, pred: str) -> DataFrame:
    """Support, predictions and hits of each class, from confusion counts."""
    none = F.lit(0).cast("long")
    sides = F.array(
        F.struct(F.col(label).alias("class"), F.col("n").alias("support"), none.alias("predicted"),
                 F.when(F.col(label) == F.col(pred), F.col("n")).otherwise(none).alias("hits")),
        F.struct(F.col(pred).alias("class"), none.alias("support"), F.col("n").alias("predicted"), none.alias("hits")),
    )
    rows = counts.select(*by, F.inline(sides))
    grouped = rows.groupBy(*by, "class").agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "hits")])
    return grouped.withColumns(
        {"precision": _ratio(F.col("hits"), F.col("predicted")), "recall": _ratio(F.col("hits"), F.col("support"))}
    ).withColumn("f1", _ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))


def _weighted(classes: DataFrame, by: Sequence[str]) -> DataFrame:
    samples = F.sum("support")
    return classes.groupBy(*by).agg(
        (F.sum("hits") / samples).alias("accuracy"),
        *[(F.sum(F.col(m) * F.col("support")) / samples).alias(m) for m in ("precision", "recall", "f1")],
        samples.alias("samples"),
    )


def class_report(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """Precision, recall, F1 and support per class."""
    counts = df.groupBy(label, pred).agg(F.count(F.lit(1)).alias("n"))
    return _per_class(counts, [], label, pred).select("class", "precision", "recall", "f1", "support")


def overall_metrics(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    counts = df.groupBy(label, pred).agg(F.count(F.lit(1)).alias("n"))
    return _weighted(_per_class(counts, [], label, pred), [])


def slice_metrics(
    df: DataFrame, label: str = "label", pred: str = "prediction", slices: Sequence[str] = ("year", "main_category")
) -> DataFrame:
    """The same metrics for every value of each slice column and for everything.

    Null slice values form no slice; the counts of one pass serve all groupings.
    """
    fine = df.groupBy(*slices, label, pred).agg(F.count(F.lit(1)).alias("n"))
    places = [
        F.when(F.col(c).isNotNull(), F.struct(F.lit(c).alias("slice_column"), F.col(c).cast("string").alias("slice_value")))
        for c in slices
    ]
    places.append(F.struct(F.lit(FULL).alias("slice_column"), F.lit("All").alias("slice_value")))
    spread = fine.select(label, pred, "n", F.explode(F.array_compact(F.array(*places))).alias("p"))
    by = ["slice_column", "slice_value"]
    counts = spread.groupBy("p.slice_column", "p.slice_value", label, pred).agg(F.sum("n").alias("n"))
    return _weighted(_per_class(counts, by, label, pred), by)


def biased_slices(metrics: DataFrame, min_share: float = 0.1, ratio: float = 0.9) -> DataFrame:
    """Slices with enough samples whose F1 falls below ``ratio`` of the full F1."""
    full = metrics.filter(F.col("slice_column") == FULL).select(F.struct("f1", "samples")).scalar()
    limit = full.getField("f1") * ratio
    return metrics.filter((F.col("samples") >= full.getField("samples") * min_share) & (F.col("f1") < limit)).withColumn(
        "f1_threshold", limit
    )


def quality_gate(metrics: DataFrame, f1: float = 0.6) -> DataFrame:
    return metrics.withColumn("passed", F.col("f1") >= f1)


def challenger_gate(new: DataFrame, old: DataFrame, biased: DataFrame) -> DataFrame:
    """Deploy when the new F1 is at least the archived one and no slice is biased."""
    archived = old.select(F.max("f1")).scalar()
    n_biased = biased.select(F.count(F.lit(1))).scalar()
    better = F.col("f1") >= F.coalesce(archived, F.lit(0.0))
    return new.select("f1", better.alias("not_worse"), (n_biased > 0).alias("bias"), (better & (n_biased == 0)).alias("deploy"))


def best_runs(runs: DataFrame, metric: str, n: int, ties: Sequence[str] = ()) -> DataFrame:
    """The ``n`` best experiment runs."""
    return runs.orderBy(F.desc(metric), *ties).limit(n)
