"""Repair, parse and flatten JSON held in text columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FINDING = "struct<sentiment:string,summary:string>"

# The rewrites, in their order. Each entry is (pattern, replacement).
REWRITES = [
    (r"\\n|\\t", ""),
    (r"(?U)\}\s*\{", "},{"),
    (r'(?U)(?<=\})(\s*)(?=")', ",$1"),
    (r'(?U)"Performance":\s*\{([^{}]*)\}\s*(?=[\]}])', '"Performance": {$1},'),
    (r"(?U)(?<=\{|,)(\s*)(\w+)(\s*):", '$1"$2":'),
    (r"(?U),\s*([\]}])", "$1"),
]


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _count(c: Column, char: str) -> Column:
    return F.length(c) - F.length(F.replace(c, F.lit(char), F.lit("")))


def repaired(c) -> Column:
    """Near-JSON after the rewrites, with braces added or trailing characters cut."""
    text = _col(c)
    for pattern, replacement in REWRITES:
        text = F.regexp_replace(text, pattern, replacement)
    return text


def balanced(c) -> Column:
    text = _col(c)
    missing = _count(text, "{") - _count(text, "}")
    return (
        F.when(missing > 0, F.concat(text, F.repeat(F.lit("}"), missing)))
        .when(missing < 0, F.substring(text, F.lit(1), F.greatest(F.length(text) + missing, F.lit(0))))
        .otherwise(text)
    )


def is_json(c) -> Column:
    """Exactly one JSON value: repeated keys are fine, text after the value is not.

    The parser stops after a value, so the text is tried as the only entry of a list, and, for a text that closes the
    list itself, inside an object.
    """
    listed = F.when(
        F.try_parse_json(F.concat(F.lit('{"v":'), _col(c), F.lit("\n}"))).isNotNull(), F.try_parse_json(F.concat(F.lit("["), _col(c), F.lit("\n]")))
    )
    alone = F.try_variant_get(listed, "$[0]", "variant").isNotNull() & F.try_variant_get(listed, "$[1]", "variant").isNull()
    return F.coalesce(alone, F.lit(False))


def repair_json(df: DataFrame, col: str = "analysis") -> DataFrame:
    """Repair a column and drop the rows that still do not parse.

    The one-element array holds the rewritten text once; as plain nested columns
    the optimiser would repeat the rewrites for each use.
    """
    fixed = F.filter(F.transform(F.array(repaired(col)), balanced), is_json)
    return df.select(*[F.explode(fixed).alias(c) if c == col else F.col(c) for c in df.columns])


def flatten_summaries(df: DataFrame, col: str = "analysis") -> DataFrame:
    """One row per (product type, aspect) of the nested summaries.

    JSON text is taken apart level by level, so an entry of another form is skipped by itself.
    """
    kept = [c for c in df.columns if c != col]
    if dict(df.dtypes)[col] == "string":
        per_type = df.select(*kept, F.explode(entries(F.get_json_object(col, "$.product_summaries"))).alias("product_type", "aspects"))
        found = per_type.select(*kept, "product_type", F.explode(entries("aspects")).alias("aspect", "finding"))
        found = found.withColumn("finding", finding("finding")).filter("finding is not null")
    else:
        per_type = df.select(*kept, F.explode(f"{col}.product_summaries").alias("product_type", "aspects"))
        found = per_type.select(*kept, "product_type", F.explode("aspects").alias("aspect", "finding"))
    return found.select(*kept, "product_type", "aspect", "finding.sentiment", "finding.summary")


def entries(c) -> Column:
    """The entries of a JSON object, each value as text; null for other values."""
    return F.when(F.ltrim(_col(c)).startswith("{"), F.from_json(_col(c), "map<string,string>"))


def finding(c) -> Column:
    """Sentiment and summary of one entry; null when it isn't an object."""
    return F.when(F.ltrim(_col(c)).startswith("{"), F.from_json(_col(c), FINDING))


def flatten_predictions(df: DataFrame, col: str = "prediction") -> DataFrame:
    """Label and class confidences out of ``["LABEL", {"POS":…,"NEU":…,"NEG":…}]``."""
    scores = {f"{k}_confidence": F.get_json_object(col, f"$[1].{k}").try_cast("double") for k in ("POS", "NEU", "NEG")}
    kept = [c for c in df.columns if c != col]
    return df.select(*kept, F.get_json_object(col, "$[0]").alias("sentiment_label"), *[e.alias(n) for n, e in scores.items()])
