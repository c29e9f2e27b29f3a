"""A stored table with one row for each key; an upsert touches only the buckets its keys fall into."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewloom.operators.aggregates import upsert_latest
from reviewloom.sources.writers import write_stage

BUCKET = "_bucket"
BUCKETS = 256


def _bucket(keys: Sequence[str], buckets: int):
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _existing(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    try:
        return spark.read.schema(T.StructType(schema.fields + [T.StructField(BUCKET, T.IntegerType())])).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _replace(spark: SparkSession, schema: T.StructType, pending: str, path: str) -> None:
    """Put the buckets that are pending in place of those stored, then forget them. Repeating it changes nothing."""
    waiting = _existing(spark, pending, schema)
    if waiting is None or waiting.isEmpty():
        return
    write_stage(waiting, path, by=[BUCKET])
    waiting.limit(0).drop(BUCKET).write.mode("overwrite").parquet(pending)


def upsert_stored(new: DataFrame, path: str, keys: Sequence[str], order: Sequence[str], buckets: int = BUCKETS) -> list[int]:
    """Upsert ``new`` into the table at ``path``: the last write of each key, by ``order``, stays. Returns the buckets rewritten.

    Keys are dealt to ``buckets`` folders by a hash; the number is chosen once for a table. Only folders that new keys fall
    into are read and replaced, so the work follows the new rows. The merged folders are written beside the table first
    (``<path>.pending``) and then moved in; a run that dies between the two is finished by the next one, and repeating a run
    changes nothing. One writer at a time. A null is a key value like any other; of rows equal in ``order`` the greatest stays.
    """
    spark, pending, schema = new.sparkSession, f"{path.rstrip('/')}.pending", new.schema
    _replace(spark, schema, pending, path)
    new = new.withColumn(BUCKET, _bucket(keys, buckets))
    touched = sorted(r[0] for r in new.select(BUCKET).distinct().collect())
    old = _existing(spark, path, schema)
    if old is None:
        old = new.limit(0)
        if not touched:
            old.drop(BUCKET).write.mode("overwrite").parquet(path)
    if touched:
        # the bucket follows from the keys, so grouping by it too changes nothing and keeps it
        merged = upsert_latest(old.filter(F.col(BUCKET).isin(touched)), new, [BUCKET, *keys], order)
        write_stage(merged, pending, by=[BUCKET])
        _replace(spark, schema, pending, path)
    return touched


def read_stored(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table as of the last finished upsert."""
    return _existing(spark, path, schema).drop(BUCKET)
