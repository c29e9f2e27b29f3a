"""Readers for reviews, metadata, documents and warehouse tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewloom.functions.json_text import is_json


def spread(df: DataFrame) -> DataFrame:
    """Use every core when the files give fewer splits than there are cores.

    A gzip file or a single Parquet row group is read by one task; its rows are
    dealt out once. Inputs with enough splits pass unchanged.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def read_jsonl(
    spark: SparkSession, paths: str | Sequence[str], schema: T.StructType | str | None = None,
    limit: int | None = None, partitions: int | None = None,
) -> DataFrame:
    """JSON lines, gzipped or not.

    With a schema nothing is inferred and bad lines land in ``_corrupt_record``
    when the schema names it. Gzip files do not split: pass ``partitions`` to
    spread the rows of a few large ones.
    """
    if schema is None:
        df = read_jsonl_inferred(spark, paths)
    else:
        df = spark.read.schema(schema).option("mode", "PERMISSIVE").json(paths)
    if partitions:
        df = df.repartition(partitions)
    return df.limit(limit) if limit is not None else df


def read_jsonl_inferred(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Infer the record type from all lines, one pass of its own, then parse every line with it.

    A field counts wherever it first appears, and values of several types meet in the wider one. A line that doesn't
    parse gives nulls.
    """
    found = spark.read.option("samplingRatio", 1.0).json(paths).schema
    schema = T.StructType([f for f in found if f.name != "_corrupt_record"])
    return spark.read.text(paths).select(F.from_json("value", schema).alias("p")).select("p.*")


def read_csv(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType | str | None = None) -> DataFrame:
    """CSV with header, doubled quotes and line breaks inside quotes."""
    reader = spark.read.option("header", True).option("quote", '"').option("escape", '"').option("multiLine", True)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(paths)


def read_documents(spark: SparkSession, path: str, schema: T.StructType | str | None = None, array: bool = False) -> DataFrame:
    """A document store: JSON lines, or one JSON array per file with ``array``."""
    reader = spark.read.option("multiLine", array)
    return (reader.schema(schema) if schema is not None else reader).json(path)


def read_json_tree(spark: SparkSession, root: str, pattern: str = "*.json") -> DataFrame:
    """Every JSON object below a folder with the path of its file.

    A file holds an object or a list; other list entries and files that do not
    parse are skipped.
    """
    files = (
        spark.read.option("wholetext", True).option("recursiveFileLookup", True).option("pathGlobFilter", pattern).text(root)
        .select(F.col("_metadata.file_path").alias("path"), F.trim("value").alias("value"))
    )
    parsed = files.filter(is_json("value"))
    items = F.when(F.col("value").startswith("["), F.from_json("value", "array<string>")).otherwise(F.array("value"))
    return parsed.select("path", F.explode(items).alias("record")).filter(F.col("record").startswith("{"))


def latest_file(spark: SparkSession, path: str, prefix: str = "") -> DataFrame:
    """The newest file whose name starts with ``prefix``; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "modificationTime")
    named = files.filter(F.substring_index("path", "/", -1).startswith(prefix))
    return named.agg(F.max_by("path", F.struct("modificationTime", "path")).alias("path"))


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def _hash_id(*parts: Column) -> Column:
    """Digest of the parts; each goes with its length, so that no two lists of parts read alike."""
    texts = [p.cast("string") for p in parts]
    return F.md5(F.concat(*[F.concat(F.length(x).cast("string"), F.lit(":"), x) for x in texts]))


def with_row_id(df: DataFrame, keys: Sequence[str] | None = None, name: str = "row_id") -> DataFrame:
    """A stable id per row, kept from ingest on.

    Natural keys are hashed. Without them the id is the content digest, the file
    split and the number among equal rows of that split; equal rows are numbered
    inside a split only, so a huge group of copies spreads over its splits.
    Needs a frame read straight from files.
    """
    from reviewloom.operators.quality import row_digest

    if keys:
        return df.withColumn(name, _hash_id(*[F.coalesce(F.col(k).cast("string"), F.lit("\0")) for k in keys]))
    columns = df.columns
    placed = df.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"))
    marked = placed.withColumn("_digest", row_digest(df, columns))
    same = Window.partitionBy("_digest", "_file", "_block").orderBy(F.lit(1))
    numbered = marked.withColumn("_no", F.row_number().over(same))
    digest = F.concat_ws(".", F.col("_digest.a").cast("string"), F.col("_digest.b").cast("string"))
    return numbered.select(*columns, _hash_id(digest, F.col("_file"), F.col("_block"), F.col("_no")).alias(name))
