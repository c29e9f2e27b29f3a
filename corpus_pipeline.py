"""The corpus pipeline: quality, near-duplicates, benchmark passages, piece ids.

Each stage takes (spark, docs, sf_dir) and returns what it keeps of ``docs``, with the columns of ``docs``; the last adds
the ids. Every stage works on all rows its predecessor kept. Rows with null ids or texts pass the stages as the
operators' docstrings say; an empty input gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from reviewloom.llm import bagminhash, pieces, resampling, winnowing
from reviewloom.llm.registry import table
from reviewloom.session import scratch_path, tune


# rows that go to a Python worker at once; texts may be long, and stages follow one another in the same workers
ROWS_IN_BATCH = 1000


def prepared(spark: SparkSession) -> SparkSession:
    """The session with the settings of the operators and short batches."""
    tune(spark).conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_IN_BATCH))
    return spark


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling towards good and clean text keeps."""
    return resampling.accepted(docs, table(prepared(spark), sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the least id, of each class of near-duplicates."""
    prepared(spark)
    return bagminhash.deduplicated(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    return winnowing.decontaminated(docs, table(prepared(spark), sf_dir, "benchmark"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with the piece ids of their texts."""
    prepared(spark)
    return pieces.encode(docs, out="ids")


STAGES = [
    ("quality classifier", quality),
    ("MinHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("SentencePiece encoding and decoding", encoding),
]

# the classifier's counts and the piece search are beyond SQL; tests hold the stages against brute-force versions
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written and read again by the next."""
    docs = table(prepared(spark), sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            path = scratch_path(spark, f"stage{i}")
            docs.write.parquet(path)
            docs = spark.read.schema(docs.schema).parquet(path)
    return docs
