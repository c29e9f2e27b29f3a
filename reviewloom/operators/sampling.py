"""Stratified and random draws, oversampling and the split by time.

Draws use md5 of the row id and the seed, so they repeat on any cluster and in
any SQL engine.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewloom.functions.constants import SAMPLING_FRACTION, SEED
from reviewloom.plans.order import order_values
from reviewloom.plans.skew import join_small, order_statistics


def draw_key(row_id: str, seed: int = SEED) -> Column:
    return F.md5(F.concat(F.col(row_id).cast("string"), F.lit(f":{seed}")))


def stratified_sample(
    df: DataFrame,
    strata: Sequence[str] = ("review_month", "rating"),
    frac: float = SAMPLING_FRACTION,
    seed: int = SEED,
    row_id: str = "row_id",
    digits: int = 4,
) -> DataFrame:
    """Exactly round-half-even(frac * size) rows of every stratum.

    The last key to keep is found per stratum from narrow passes: counts per
    leading key digits, then a ranking of only the rows that share the digits of
    the cut. The full rows are filtered against that key and never shuffled, and
    no task ever ranks a whole stratum. ``row_id`` must be unique.
    """
    strata = list(strata)
    narrow = df.select(*strata, row_id).dropna(subset=strata).withColumn("_key", draw_key(row_id, seed))
    narrow = narrow.withColumn("_slot", F.substring("_key", 1, digits))
    slots = narrow.groupBy(*strata, "_slot").agg(F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy(*strata)
    along = whole.orderBy("_slot").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    marked = slots.select(
        "*",
        F.bround(F.lit(frac) * F.sum("_n").over(whole)).cast("long").alias("_take"),
        F.sum("_n").over(along).alias("_upto"),
    )
    cut = marked.filter("_take > _upto - _n and _take <= _upto").select(
        *strata, "_slot", (F.col("_take") - F.col("_upto") + F.col("_n")).alias("_left")
    )
    edge = join_small(narrow, cut, [*strata, "_slot"])
    rank = F.row_number().over(Window.partitionBy(*strata, "_slot").orderBy("_key", row_id))
    last = edge.withColumn("_rank", rank).filter("_rank = _left")
    last = last.select(*strata, F.col("_key").alias("_last_key"), F.col(row_id).alias("_last_id"))
    drawn = join_small(df.withColumn("_key", draw_key(row_id, seed)), last, strata)
    keep = (F.col("_key") < F.col("_last_key")) | (
        (F.col("_key") == F.col("_last_key")) & (F.col(row_id) <= F.col("_last_id"))
    )
    return drawn.filter(keep).select(*df.columns)


def bernoulli_sample(df: DataFrame, by: str, fractions: dict, seed: int = SEED) -> DataFrame:
    """Independent draws per row at the fraction of its stratum."""
    return df.sampleBy(by, fractions, seed)


def fraction_sample(df: DataFrame, frac: float, seed: int = SEED, row_id: str = "row_id") -> DataFrame:
    """Repeatable random fraction: the leading eight key digits against a limit."""
    limit = min(int(frac * 2**32), 2**32)
    if limit == 2**32:
        return df
    return df.filter(F.substring(draw_key(row_id, seed), 1, 8) < F.lit(f"{limit:08x}"))


def oversample(
    df: DataFrame, column: str = "main_category", min_samples: int = 50, seed: int = SEED, row_id: str = "row_id"
) -> DataFrame:
    """Slices below ``min_samples`` are drawn up to it with replacement; others pass.

    ``copy`` numbers the drawn rows. Only rows of small slices are ranked.
    """
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    marked = join_small(df, counts.filter(F.col("_n") < min_samples), column, "left").filter(F.col(column).isNotNull())
    large = marked.filter(F.col("_n").isNull()).drop("_n").withColumn("copy", F.lit(0))
    small = marked.filter(F.col("_n").isNotNull()).withColumn(
        "_rank", F.row_number().over(Window.partitionBy(column).orderBy(row_id)) - 1
    )
    picks = counts.filter(F.col("_n") < min_samples).select(
        column, "_n", F.explode(F.sequence(F.lit(1), F.lit(min_samples))).alias("copy")
    )
    digest = F.md5(F.concat_ws(":", F.col(column).cast("string"), F.col("copy").cast("string"), F.lit(str(seed))))
    picks = picks.withColumn("_rank", (F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % F.col("_n")).cast("int"))
    drawn = small.drop("_n").join(picks.drop("_n"), [column, "_rank"])
    return large.select(*df.columns, "copy").unionByName(drawn.select(*df.columns, "copy"))


def time_split(
    df: DataFrame, ts: str = "review_time", train: float = 0.8, val: float = 0.1, row_id: str = "row_id"
) -> DataFrame:
    """Mark the oldest rows ``train``, the next ``val``, the rest ``test``.

    Cut positions are floor(n * share) in (time, id) order. Radix passes find the times of the cuts, then only rows of
    such a time are ordered by id. The returned plan compares each row with two literals and moves no data.
    """
    # missing times sort last
    micros = F.coalesce(F.unix_micros(F.col(ts)), F.lit(2**63 - 1))
    keys = df.select(micros.alias("_t"), F.col(row_id).alias("_id"))
    cuts: list[int] = []

    def spots_of(total: int) -> list[int]:
        cuts.extend([int(total * train), int(total * (train + val))])
        return [c for c in cuts if c < total]

    at = order_values(keys, ["_t"], spots_of)["_t"]
    bounds = []
    for cut in cuts:
        bound = None
        if cut in at:
            place = at[cut]
            ids = keys.filter(F.col("_t") == F.lit(place.value))
            bound = (place.value, order_statistics(ids, ["_id"], [cut - place.below])[cut - place.below][0])
        bounds.append(bound)

    def earlier(bound) -> Column:
        if bound is None:
            return F.lit(True)
        return (micros < F.lit(bound[0])) | ((micros == F.lit(bound[0])) & (F.col(row_id) < F.lit(bound[1])))

    split = F.when(earlier(bounds[0]), "train").when(earlier(bounds[1]), "val").otherwise("test")
    return df.withColumn("split", split)
