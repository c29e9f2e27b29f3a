"""Retrieval views over the given tables, with their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# one stored analysis per vector; every fifth lacks a sentiment, every seventh a summary
ANALYSES = """analyses AS (
  SELECT vec_id, embedding, 'cat ' || label AS category, CAST(2018 + vec_id % 3 AS INTEGER) AS year,
         CAST(1 + vec_id % 12 AS INTEGER) AS month, 'sub_' || vec_id AS subcategory,
         CASE WHEN vec_id % 5 = 0 THEN NULL WHEN label % 2 = 0 THEN 'Positive' ELSE 'Negative' END AS quality_sentiment,
         'quality of ' || vec_id AS quality_summary, 'Mixed' AS price_sentiment,
         CASE WHEN vec_id % 7 = 0 THEN NULL ELSE 'price of ' || vec_id END AS price_summary
  FROM embeddings)"""


def analyses(t) -> DataFrame:
    sentiment = F.when(F.col("vec_id") % 5 == 0, None).when(F.col("label") % 2 == 0, "Positive").otherwise("Negative")
    quality = F.struct(sentiment.alias("sentiment"), F.concat(F.lit("quality of "), "vec_id").alias("summary"))
    price = F.struct(
        F.lit("Mixed").alias("sentiment"),
        F.when(F.col("vec_id") % 7 != 0, F.concat(F.lit("price of "), "vec_id")).alias("summary"),
    )
    return t.embeddings.select(
        "vec_id",
        "embedding",
        F.concat(F.lit("cat "), "label").alias("category"),
        (F.lit(2018) + F.col("vec_id") % 3).cast("int").alias("year"),
        (F.lit(1) + F.col("vec_id") % 12).cast("int").alias("month"),
        F.concat(F.lit("sub_"), "vec_id").alias("subcategory"),
        F.to_json(F.struct(quality.alias("Quality"), price.alias("Price"))).alias("analysis"),
    )


# near-JSON in the six damaged forms the repair knows, repeated keys and text after the value, one per event
BROKEN = """broken AS (
  SELECT event_id, CASE event_id % 10
    WHEN 0 THEN '{"a": {"v": ' || event_id || '} {"w": 1}}'
    WHEN 1 THEN '{"a": {"v": ' || event_id || '} "b": 2}'
    WHEN 2 THEN '{a: ' || event_id || ', b : "x"}'
    WHEN 3 THEN '{"a": [1, 2, ], "b": ' || event_id || ', }'
    WHEN 4 THEN '{"a": {"v": ' || event_id || '}'
    WHEN 5 THEN '{"a": ' || event_id || '}}}'
    WHEN 6 THEN '{"p": {"Performance":  {"s": "' || event_type || '"} }, "b": ' || event_id || '}\\n'
    WHEN 7 THEN '{"a": 0, "a": ' || event_id || '}'
    WHEN 8 THEN '{"a": ' || event_id || '} and more'
    ELSE 'no json ' || event_type END AS analysis FROM events)"""


def broken(t) -> DataFrame:
    n = F.col("event_id").cast("string")
    forms = [
        F.concat(F.lit('{"a": {"v": '), n, F.lit('} {"w": 1}}')),
        F.concat(F.lit('{"a": {"v": '), n, F.lit('} "b": 2}')),
        F.concat(F.lit("{a: "), n, F.lit(', b : "x"}')),
        F.concat(F.lit('{"a": [1, 2, ], "b": '), n, F.lit(", }")),
        F.concat(F.lit('{"a": {"v": '), n, F.lit("}")),
        F.concat(F.lit('{"a": '), n, F.lit("}}}")),
        F.concat(F.lit('{"p": {"Performance":  {"s": "'), "event_type", F.lit('"} }, "b": '), n, F.lit("}\\n")),
        F.concat(F.lit('{"a": 0, "a": '), n, F.lit("}")),
        F.concat(F.lit('{"a": '), n, F.lit("} and more")),
        F.concat(F.lit("no json "), "event_type"),
    ]
    picked = F.element_at(F.array(*forms), (F.col("event_id") % 10 + 1).cast("int"))
    return t.events.select("event_id", picked.alias("analysis"))
