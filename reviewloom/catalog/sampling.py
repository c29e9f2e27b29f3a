"""L: sampling, splitting, periods, increments."""

from __future__ import annotations

from pyspark.sql import functions as F

from reviewloom.catalog import query
from reviewloom.catalog import sql as S
from reviewloom.operators import periods, sampling
from reviewloom.session import scratch_path
from reviewloom.streaming import increments


@query(
    "L01_stratified_sample",
    f"""WITH {S.REVIEWS}, r AS (SELECT row_id, review_month, rating, row_number() OVER (PARTITION BY review_month, rating ORDER BY md5(row_id || ':42'), row_id) AS rn,
    count(*) OVER (PARTITION BY review_month, rating) AS n FROM reviews) SELECT row_id, review_month, rating FROM r WHERE rn <= round_even(0.01 * n, 0)""",
)
def stratified_sample(t):
    return sampling.stratified_sample(t.reviews()).select("row_id", "review_month", "rating")


@query("L02_bernoulli_by_month")
def bernoulli_by_month(t):
    fractions = {m: 0.1 for m in range(1, 13)}
    return sampling.bernoulli_sample(t.reviews().select("row_id", "review_month"), "review_month", fractions)


@query("L03_random_fraction", f"WITH {S.RAW} SELECT row_id FROM raw_reviews WHERE substr(md5(row_id || ':42'), 1, 8) < '{int(0.1 * 2**32):08x}'")
def random_fraction(t):
    return sampling.fraction_sample(t.raw_reviews().select("row_id"), 0.1)


@query(
    "L04_oversample_small_slices",
    """WITH slices AS (SELECT o_orderkey AS row_id, CASE WHEN o_orderkey % 1000 < 3 THEN 'rare ' || (o_orderkey % 1000) ELSE o_orderpriority END AS slice FROM orders),
    sized AS (SELECT *, count(*) OVER (PARTITION BY slice) AS n, row_number() OVER (PARTITION BY slice ORDER BY row_id) - 1 AS rk FROM slices),
    picks AS (SELECT slice, n, CAST(copy AS INTEGER) AS copy, CAST('0x' || substr(md5(slice || ':' || copy || ':42'), 1, 8) AS BIGINT) % n AS rk
      FROM (SELECT DISTINCT slice, n FROM sized WHERE n < 400), range(1, 401) r(copy))
    SELECT row_id, slice, CAST(0 AS INTEGER) AS copy FROM sized WHERE n >= 400
    UNION ALL SELECT sized.row_id, sized.slice, copy FROM picks JOIN sized ON sized.slice = picks.slice AND sized.rk = picks.rk""",
)
def oversample_small_slices(t):
    part = F.col("o_orderkey") % 1000
    slice_name = F.when(part < 3, F.concat(F.lit("rare "), part.cast("string"))).otherwise(F.col("o_orderpriority"))
    rows = t.orders.select(F.col("o_orderkey").alias("row_id"), slice_name.alias("slice"))
    return sampling.oversample(rows, "slice", 400)


@query(
    "L05_time_split",
    f"""WITH {S.RAW}, r AS (SELECT row_id, row_number() OVER (ORDER BY review_time, row_id) - 1 AS pos, count(*) OVER () AS n FROM raw_reviews)
    SELECT row_id, CASE WHEN pos < floor(n * 0.8::DOUBLE) THEN 'train' WHEN pos < floor(n * (0.8::DOUBLE + 0.1::DOUBLE)) THEN 'val' ELSE 'test' END AS split FROM r""",
)
def time_split(t):
    return sampling.time_split(t.reviews().select("row_id", "review_time")).select("row_id", "split")


@query(
    "L06_next_training_window",
    """SELECT o_orderpriority AS category, strftime(max(o_orderdate) + INTERVAL 3 MONTH, '%Y-%m-%d') AS start_date,
    strftime(max(o_orderdate) + INTERVAL 3 MONTH + INTERVAL 24 MONTH - INTERVAL 1 DAY, '%Y-%m-%d') AS end_date FROM orders GROUP BY 1""",
)
def next_training_window(t):
    runs = t.orders.select(F.col("o_orderpriority").alias("category"), F.col("o_orderdate").alias("start_date"))
    found = periods.next_training_window(runs, ["category"])
    return found.select("category", *[F.date_format(c, "yyyy-MM-dd").alias(c) for c in ("start_date", "end_date")])


@query(
    "L07_next_serving_month",
    """WITH latest AS (SELECT o_custkey % 50 AS category, max(date_trunc('month', o_orderdate)) + INTERVAL 1 MONTH AS m FROM orders GROUP BY 1)
    SELECT category, CAST(year(m) AS INTEGER) AS year, CAST(month(m) AS INTEGER) AS month FROM latest""",
)
def next_serving_month(t):
    runs = t.orders.select(
        (F.col("o_custkey") % 50).alias("category"), F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month")
    )
    return periods.next_serving_month(runs, ["category"])


@query(
    "L08_monthly_increment",
    f"WITH {S.REVIEWS} SELECT row_id, rating, year, review_month FROM reviews WHERE year = 1996 AND review_month IN (2, 3)",
)
def monthly_increment(t):
    """February, March, then March again: each month is there once."""
    path = scratch_path(t.spark, "months")
    rows = t.reviews().select("row_id", "rating", "review_time", "year", "review_month")
    for month in (2, 3, 3):
        increments.append_month(rows, path, 1996, month)
    return t.spark.read.parquet(path).select("row_id", "rating", "year", "review_month")


@query(
    "L08_increment_stream",
    "SELECT event_id, epoch_us(ts) // 1000 AS timestamp, CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS review_month FROM events",
)
def increment_stream(t):
    """Files arrive in two runs of the stream; the second reads only the new ones."""
    spark = t.spark
    source, target, state = (scratch_path(spark, n) for n in ("arrivals", "filed", "state"))
    rows = t.events.select("event_id", F.unix_millis(F.col("ts").cast("timestamp")).alias("timestamp"))
    for half in (0, 1):
        rows.filter(F.col("event_id") % 2 == half).write.mode("append").parquet(source)
        stream = increments.review_stream(spark, source, "event_id bigint, timestamp bigint", "parquet")
        increments.run_available(stream, target, state)
    filed = spark.read.schema("event_id bigint, timestamp bigint, year int, review_month int").parquet(target)
    return filed


@query("L08_monthly_counts", "SELECT CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month, count(*) AS n FROM events GROUP BY ALL")
def monthly_counts(t):
    return increments.monthly_counts(t.events)
