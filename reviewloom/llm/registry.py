"""Named queries of this subpackage and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

from reviewloom.session import tune

MODULES = ["alignment", "bagminhash", "bond", "context_tree", "graph", "packing", "pieces", "rendezvous", "resampling", "segments", "warc", "winnowing", "whole_tokens"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``."""

    def register(fn):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")

        def run(spark, sf_dir):
            return fn(tune(spark), sf_dir)

        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def load_all() -> None:
    for module in MODULES:
        import_module(f"reviewloom.llm.{module}")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def sheltered(documents: DataFrame, keep: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Apply a filter that adds helper columns of its own, whatever the other columns of ``documents`` are called."""
    names = documents.columns
    plain = documents.toDF(*[c if c in ("doc_id", "text") else f"c{i}" for i, c in enumerate(names)])
    return keep(plain).select(*plain.columns).toDF(*names)
