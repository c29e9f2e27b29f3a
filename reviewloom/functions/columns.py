"""Column expressions for review and product fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def add_review_time(df: DataFrame, millis: str = "timestamp") -> DataFrame:
    """Event time, its text form, year and month from epoch milliseconds; images go."""
    when = F.timestamp_millis(F.col(millis))
    return df.drop("images").withColumns(
        {
            "review_time": when,
            "review_date_timestamp": F.date_format(when, TIME_FORMAT),
            "year": F.year(when),
            "review_month": F.month(when),
        }
    )


def comma_path(c) -> Column:
    """Array of category levels as one comma-joined string, null when missing."""
    return F.when(_col(c).isNotNull(), F.array_join(_col(c), ","))


def category_path(df: DataFrame, col: str = "categories") -> DataFrame:
    """Join list-typed categories; a column that is already text stays as it is."""
    if isinstance(df.schema[col].dataType, T.ArrayType):
        return df.withColumn(col, comma_path(col))
    return df


def product_columns(meta: DataFrame) -> DataFrame:
    """The seven metadata columns, the title under its product name."""
    return meta.withColumnRenamed("title", "product_name").select(
        "parent_asin", "main_category", "product_name", "categories", "price", "average_rating", "rating_number"
    )


def drop_columns(df: DataFrame, *names: str) -> DataFrame:
    return df.drop(*names)


def narrow_types(df: DataFrame) -> DataFrame:
    """Small storage types; fractions are cut off, missing votes become 0 first."""
    kinds = {"rating": "tinyint", "helpful_vote": "int", "average_rating": "float", "year": "smallint", "review_month": "tinyint"}
    filled = df.fillna({"helpful_vote": 0}) if "helpful_vote" in df.columns else df
    return filled.withColumns({c: F.col(c).cast(k) for c, k in kinds.items() if c in df.columns})


def price_text(c) -> Column:
    c = _col(c)
    plain = c.cast("string")
    # beyond seven digits and below a thousandth a double is written with an exponent
    digits = F.regexp_replace(F.regexp_replace(plain.try_cast("decimal(38,18)").cast("string"), r"(\.\d*?)0+$", "$1"), r"\.$", ".0")
    return F.when(c.isNull() | (plain == "NULL"), "unknown").when(plain.rlike(r"^-?\d\.\d+E-?\d+$"), F.coalesce(digits, plain)).otherwise(plain)


def number_or_null(c, kind: str = "double") -> Column:
    """Numeric coercion: unreadable values become null."""
    return _col(c).cast("string").try_cast(kind)


def time_or_null(c, fmt: str | None = None) -> Column:
    """Unreadable timestamps become null."""
    return F.try_to_timestamp(_col(c), F.lit(fmt)) if fmt else F.try_to_timestamp(_col(c))


def text_guard(c="text") -> Column:
    """Rows whose text is present."""
    return _col(c).isNotNull()


def anonymised(c) -> Column:
    return F.sha2(_col(c).cast("string"), 256)


def label_name(c) -> Column:
    from reviewloom.functions.constants import LABEL_NAMES

    expr = F.lit(None).cast("string")
    for code, name in LABEL_NAMES.items():
        expr = F.when(_col(c) == code, name).otherwise(expr)
    return expr


def label_code(c) -> Column:
    from reviewloom.functions.constants import LABEL_NAMES

    expr = F.lit(None).cast("int")
    for code, name in LABEL_NAMES.items():
        expr = F.when(_col(c) == name, F.lit(code)).otherwise(expr)
    return expr


def category_level(path, fallback, level: int = 3) -> Column:
    """The ``level``-th part of a comma path, else its last part; blank paths use the fallback."""
    from reviewloom.functions.constants import WHITESPACE

    path, fallback = _col(path), _col(fallback)
    blank = path.isNull() | F.regexp_replace(path, WHITESPACE, "").eqNullSafe("")
    levels = F.split(F.when(blank, fallback).otherwise(path), ",")
    return F.when(F.size(levels) >= level, F.try_element_at(levels, F.lit(level))).otherwise(F.try_element_at(levels, F.lit(-1)))


def file_safe(c) -> Column:
    return F.replace(_col(c), F.lit(" "), F.lit("_"))


def without_extension(c) -> Column:
    return F.split_part(_col(c), F.lit("."), F.lit(1))


def path_metadata(path) -> Column:
    """``root/category/year/month/subcategory`` as a struct; shorter paths give null."""
    parts = F.split(_col(path), "/")
    names = {"category": 2, "subcategory": 5, "year": 3, "month": 4}
    fields = [F.try_element_at(parts, F.lit(i)).alias(n) for n, i in names.items()]
    return F.when(F.size(parts) >= 5, F.struct(*fields))


def embedding_text(meta, record_json) -> Column:
    """Metadata as ``k: v`` pairs, then the record as JSON."""
    meta = _col(meta)
    pairs = [F.concat(F.lit(f"{n}: "), meta[n]) for n in ("category", "subcategory", "year", "month")]
    return F.concat_ws(" ", *pairs, _col(record_json))


def vector_key(subcategory, year, month, category=None) -> Column:
    """Stable key of a vector row; naming the category keeps equal subcategories apart."""
    parts = [_col(c).cast("string") for c in (subcategory, year, month)]
    if category is not None:
        parts.insert(0, _col(category))
    return F.sha2(F.concat_ws("_", *parts), 256)


def filled_prompt(template: str, text, previous) -> Column:
    """The template with the earlier summary, then the text, put in place."""
    step = F.replace(F.lit(template), F.lit("{PREVIOUS_SUMMARY}"), F.coalesce(_col(previous), F.lit("None")))
    return F.replace(step, F.lit("{TEXT}"), _col(text))
