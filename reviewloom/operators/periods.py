"""Next training window and serving month from a table of earlier runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewloom.functions.constants import TRAINING_MONTHS, TRAINING_SHIFT


def next_training_window(
    runs: DataFrame,
    by: Sequence[str] = (),
    start: str = "start_date",
    months: int = TRAINING_MONTHS,
    shift: int = TRAINING_SHIFT,
    default: str = "2018-01-01",
) -> DataFrame:
    """Latest start moved by ``shift`` months, or the default; ends a day short of ``months`` later."""
    latest = runs.groupBy(*by).agg(F.max(F.to_date(start)).alias("_latest"))
    first = F.coalesce(F.add_months("_latest", shift), F.lit(default).cast("date"))
    return latest.select(*by, first.alias("start_date"), F.date_sub(F.add_months(first, months), 1).alias("end_date"))


def next_serving_month(
    runs: DataFrame, by: Sequence[str] = (), year: str = "year", month: str = "month", default: tuple[int, int] = (2020, 1)
) -> DataFrame:
    """The month after the latest one served, or the default."""
    latest = runs.groupBy(*by).agg(F.max(F.struct(F.col(year).alias("y"), F.col(month).alias("m"))).alias("_p"))
    after = F.add_months(F.make_date(F.col("_p.y"), F.col("_p.m"), F.lit(1)), 1)
    first = F.coalesce(after, F.make_date(F.lit(default[0]), F.lit(default[1]), F.lit(1)))
    return latest.select(*by, F.year(first).alias("year"), F.month(first).alias("month"))


def latest_run(runs: DataFrame, by: Sequence[str] = (), order: Sequence[str] = ("updated_at", "path")) -> DataFrame:
    """The newest dataset or artifact, of each group when ``by`` is given."""
    rest = [c for c in runs.columns if c not in (*by, *order)]
    best = runs.groupBy(*by).agg(F.max(F.struct(*order, *rest)).alias("_run"))
    return best.select(*by, "_run.*")
