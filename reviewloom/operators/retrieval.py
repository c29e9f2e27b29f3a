"""Nearest documents by cosine, metadata filters, findings and their report."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewloom.functions.json_text import entries, finding
from reviewloom.functions import constants as C
from reviewloom.functions.columns import path_metadata, vector_key, without_extension
from reviewloom.functions.text import tokens
from reviewloom.functions.vectors import as_vector, cosine, norm, unit
from reviewloom.operators.filters import hit_filter
from reviewloom.session import settle



def top_k(
    vectors: DataFrame, query: Sequence[float] | Column, k: int = 10, values: str = "values",
    row_id: str = "id", norms: str | None = None,
) -> DataFrame:
    """The ``k`` most similar rows; ties by id. Each task keeps only its best ``k``."""
    if isinstance(query, Column):
        score = cosine(values, query, norm_a=norms)
    else:
        size = F.lit(math.sqrt(sum(float(v) ** 2 for v in query)))
        score = cosine(values, as_vector(query), norm_a=norms, norm_b=size)
    scored = vectors.withColumn("score", score)
    return scored.filter(F.col("score").isNotNull()).orderBy(F.desc("score"), row_id).limit(k)


def with_norm(vectors: DataFrame, values: str = "values", name: str = "norm") -> DataFrame:
    """Store the length once, so queries need only one product per row."""
    return vectors.withColumn(name, norm(values))


def ranked(hits: DataFrame, row_id: str = "id") -> DataFrame:
    """Number the hits of one query, best first. Hits are at most ``k`` rows."""
    return hits.withColumn("rank", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.desc("score"), row_id)))


def search(
    vectors: DataFrame, query: Sequence[float] | Column, docs: DataFrame, k: int = 25, category: str | None = None,
    year=None, month=None, prefilter: bool = False, values: str = "values", row_id: str = "id",
) -> DataFrame:
    """Top-k, then the metadata filter; all documents of the category when nothing is left.

    Filtering after the ranking can leave fewer than ``k`` hits, as published;
    ``prefilter`` ranks only matching rows.
    """
    pool = hit_filter(vectors, category, year, month) if prefilter else vectors
    best = ranked(top_k(pool, query, k, values, row_id), row_id)
    hits = settle(hit_filter(best, category, year, month).select("category", "year", "month", "subcategory", "rank"))
    if hits.limit(1).count():
        # at most k rows, so the documents are read in place
        return docs.join(F.broadcast(hits), ["category", "year", "month", "subcategory"])
    rest = docs
    for name, value in (("category", category), ("year", year), ("month", None if month == "ALL" else month)):
        if value:
            rest = rest.filter(F.col(name).cast("string") == str(value))
    return rest.withColumn("rank", F.lit(1))


def merge_aspects(
    found: DataFrame, col: str = "analysis", order: Sequence[str] = ("rank", "subcategory"), by: Sequence[str] = ()
) -> DataFrame:
    """Aspects over ranked documents: the last document wins, first seen comes first.

    ``by`` merges the documents of each query (or other key) by themselves. An entry that isn't an object is skipped by itself.
    """
    if dict(found.dtypes)[col] == "string":
        rows = found.select(*by, *order, F.posexplode(entries(col)).alias("_pos", "aspect", "_v")).withColumn("_f", finding("_v"))
    else:
        rows = found.select(*by, *order, F.posexplode(col).alias("_pos", "aspect", "_f"))
    rows = rows.filter(F.col("_f").isNotNull())
    place = F.struct(*order, "_pos")
    merged = rows.groupBy(*by, "aspect").agg(
        F.min(place).alias("_first"), F.max(F.struct(*order, "_pos", "_f")).alias("_last")
    )
    return merged.select(
        *by,
        "aspect",
        F.coalesce("_last._f.sentiment", F.lit("Unknown")).alias("sentiment"),
        F.coalesce("_last._f.summary", F.lit(C.NO_SUMMARY)).alias("summary"),
        F.col("_first").alias("first_seen"),
    )


def findings_report(merged: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One text: a bullet per aspect, or the fixed sentence when there is none. With ``by``, one for each key that has aspects."""
    missing = F.concat(F.lit("- **"), F.col("aspect"), F.lit("**" + C.REPORT_MISSING))
    known = F.format_string("- **%s**:\n  Sentiment: %s\n  Summary: %s\n\n", "aspect", "sentiment", "summary")
    lines = merged.withColumn("_line", F.when(F.col("sentiment") == "Unknown", missing).otherwise(known))
    body = lines.groupBy(*by).agg(F.expr("listagg(_line, '') within group (order by first_seen)").alias("_body"))
    full = F.concat(F.lit(C.REPORT_HEAD), F.col("_body"), F.lit(C.REPORT_TAIL))
    return body.select(*by, F.coalesce(full, F.lit(C.REPORT_EMPTY)).alias("report"))


def vector_rows(df: DataFrame, path: str = "path", values: str = "values", include_category: bool = False) -> DataFrame:
    """Keyed vector records with metadata taken from the file path."""
    meta = df.withColumn("metadata", path_metadata(path)).filter(F.col("metadata").isNotNull())
    m = F.col("metadata")
    key = vector_key(m["subcategory"], m["year"], m["month"], m["category"] if include_category else None)
    return meta.withColumn("id", key).select("id", values, "metadata")


def document_path(category, year, month, subcategory, root: str = "RAG") -> Column:
    parts = [F.col(c) if isinstance(c, str) else c for c in (category, year, month)]
    name = F.concat(without_extension(subcategory), F.lit(".json"))
    return F.concat_ws("/", F.lit(root), *[p.cast("string") for p in parts], name)


def embed(df: DataFrame, text: str = "text", dim: int = 64, name: str = "values") -> DataFrame:
    """Hashed term counts scaled to unit length."""
    step = df.withColumn("_tokens", tokens(F.lower(F.coalesce(F.col(text), F.lit("")))))
    hashed = HashingTF(inputCol="_tokens", outputCol="_tf", numFeatures=dim).transform(step)
    hashed = hashed.withColumn("_raw", vector_to_array("_tf"))
    return hashed.withColumn(name, unit("_raw")).drop("_tokens", "_tf", "_raw")


def embed_with(df: DataFrame, fn: Callable[[list[str]], list[list[float]]], text: str = "text", name: str = "values") -> DataFrame:
    """Vectors from a user function, called once per Arrow batch of texts."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema) + f", `{name}` array<double>"

    def run(batches):
        for batch in batches:
            yield batch.assign(**{name: [list(map(float, v)) for v in fn(batch[text].tolist())]})

    return df.mapInPandas(run, schema)
