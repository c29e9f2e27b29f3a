"""Writers: stage tables, documents, metrics, warehouse tables, keyed upserts."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_stage(df: DataFrame, path: str, by: Sequence[str] = (), fmt: str = "parquet", mode: str = "overwrite") -> str:
    """A stage hand-off; with ``by`` only the partitions present in ``df`` are replaced.

    Rows are rebalanced by partition before writing: small partitions give one
    file instead of one per task, large ones are split over several tasks.
    """
    if by:
        df = df.hint("rebalance", *by)
    writer = df.write.mode(mode)
    if by:
        writer = writer.partitionBy(*by).option("partitionOverwriteMode", "dynamic")
    if fmt == "csv":
        writer = writer.option("header", True).option("quote", '"').option("escape", '"')
        # the writer trims by default, which would change texts
        writer = writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    writer.format(fmt).save(path)
    return path


def write_jsonl(df: DataFrame, path: str, compression: str | None = "gzip") -> str:
    df.write.mode("overwrite").option("compression", compression or "none").option("ignoreNullFields", False).json(path)
    return path


def write_documents(df: DataFrame, path: str, by: Sequence[str] = ("category", "year", "month")) -> str:
    """Documents as JSON below category/year/month; file-safe folder names come from Spark."""
    writer = (df.hint("rebalance", *by) if by else df).write.mode("overwrite")
    (writer.partitionBy(*by) if by else writer).json(path)
    return path


def write_metrics(metrics: DataFrame, path: str) -> str:
    """Metrics as CSV and as JSON. A metrics table has one row per slice."""
    metrics.write.mode("overwrite").option("header", True).csv(f"{path}/csv")
    metrics.write.mode("overwrite").json(f"{path}/json")
    return path


def save_table(df: DataFrame, name: str, path: str | None = None) -> None:
    """Replace a warehouse table."""
    writer = df.write.mode("overwrite")
    (writer.option("path", path) if path else writer).saveAsTable(name)


def create_or_append(df: DataFrame, name: str, path: str | None = None) -> None:
    """Create the table on the first run, add rows by column name afterwards."""
    spark = df.sparkSession
    if spark.catalog.tableExists(name):
        df.select(*spark.table(name).columns).write.insertInto(name)
    else:
        save_table(df, name, path)


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def upsert_external(df: DataFrame, send: Callable[[list[dict]], None], batch: int = 100) -> None:
    """Send rows to an outside store in groups of ``batch``, task by task.

    ``send`` must be an upsert by key: a lost task repeats its groups.
    """

    def run(rows) -> None:
        group: list[dict] = []
        for row in rows:
            group.append(row.asDict(recursive=True))
            if len(group) == batch:
                send(group)
                group = []
        if group:
            send(group)

    df.foreachPartition(run)


def period_partition(df: DataFrame, dataset: str, start: str, end: str) -> DataFrame:
    """Stage columns a run is filed under."""
    return df.withColumns(
        {"dataset": F.lit(dataset), "period_start": F.lit(start).cast("date"), "period_end": F.lit(end).cast("date")}
    )
