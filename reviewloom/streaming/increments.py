"""Monthly increments: only new review files are read, then added to the stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewloom.functions.columns import add_review_time
from reviewloom.operators.filters import in_month
from reviewloom.sources.writers import write_stage


def append_month(reviews: DataFrame, path: str, year: int, month: int) -> str:
    """Batch form: write one month; running it again replaces that month only, also by nothing.

    Overwriting touches only partitions that get rows, so the folder of a month that became empty is removed.
    """
    rows = in_month(reviews, year, month)
    written = write_stage(rows, path, by=["year", "review_month"])
    if rows.isEmpty():
        spark = reviews.sparkSession
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/year={year}/review_month={month}")
        folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)
    return written


def review_stream(spark: SparkSession, folder: str, schema: T.StructType | str, fmt: str = "json") -> DataFrame:
    """New files of a folder as an unbounded table of reviews with their time columns."""
    return add_review_time(spark.readStream.schema(schema).format(fmt).load(folder))


def run_available(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Process all files that arrived since the last run, file them by month, stop.

    The checkpoint remembers the files, so a repeated or restarted run adds each
    row once.
    """
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .option("path", path)
        .partitionBy("year", "review_month")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def monthly_counts(events: DataFrame, ts: str = "ts") -> DataFrame:
    """Rows per month of arrival."""
    return events.groupBy(F.year(ts).alias("year"), F.month(ts).alias("month")).agg(F.count(F.lit(1)).alias("n"))
