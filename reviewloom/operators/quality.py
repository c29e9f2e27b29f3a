"""Data-quality checks: one long table of (check, column, row_id, detail).

All row-level checks are evaluated in a single scan; those that need statistics
read them as scalar subqueries. Duplicate detection groups by row content.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewloom.functions import constants as C
from reviewloom.functions.text import matches, non_ascii_class
from reviewloom.operators.aggregates import quartile_fences
from reviewloom.session import settle


@dataclass
class Profile:
    """What to check; the defaults are the published limits."""

    ranges: dict = field(default_factory=lambda: dict(C.RANGES))
    critical: Sequence[str] = tuple(C.CRITICAL_COLUMNS)
    pii: Sequence[str] = tuple(C.PII_COLUMNS)
    text_length: tuple[int, int] = C.TEXT_LENGTH
    title_length: tuple[int, int] = C.TITLE_LENGTH
    outliers: Sequence[str] = tuple(C.OUTLIER_COLUMNS)
    z: float = 3.0
    expected: dict = field(default_factory=lambda: dict(C.EXPECTED_VALUES))
    last_day: str = C.LAST_REVIEW_DAY
    time: str = "review_time"
    emoji: str = C.EMOJI_WIDE
    strict_phone: bool = False
    row_id: str = "row_id"


def _violation(check: str, column: str, broken: Column, detail: Column | str) -> Column:
    detail = F.lit(detail) if isinstance(detail, str) else detail.cast("string")
    row = F.struct(F.lit(check).alias("check"), F.lit(column).alias("column"), detail.alias("detail"))
    return F.when(F.coalesce(broken, F.lit(False)), row)


def _emit(df: DataFrame, found: list[Column], row_id: str) -> DataFrame:
    found = found or [_violation("none", "none", F.lit(False), "none")]
    return df.select(F.col(row_id).alias("row_id"), F.explode(F.array_compact(F.array(*found))).alias("v")).select(
        "v.check", "v.column", "row_id", "v.detail"
    )


def _have(df: DataFrame, names) -> list[str]:
    return [c for c in names if c in df.columns]


def range_rules(df: DataFrame, p: Profile) -> list[Column]:
    """Nulls compare to nothing, so they pass."""
    found = []
    for c in _have(df, p.ranges):
        low, high = p.ranges[c]
        broken = F.lit(False)
        if low is not None:
            broken = broken | F.coalesce(F.col(c) < low, F.lit(False))
        if high is not None:
            broken = broken | F.coalesce(F.col(c) > high, F.lit(False))
        found.append(_violation("range_check", c, broken, F.col(c)))
    return found


def missing_rules(df: DataFrame, p: Profile) -> list[Column]:
    return [_violation("missing", c, F.col(c).isNull(), "null") for c in _have(df, p.critical)]


def has_email(c: str) -> Column:
    # the plain character test spares the pattern on most texts
    return F.contains(F.col(c), F.lit("@")) & matches(c, C.EMAIL)


def has_phone(c: str, strict: bool = False) -> Column:
    """A phone-like run; the digit count is over the whole cell, or over the run when strict."""
    counted = F.regexp_substr(F.col(c), F.lit(C.PHONE)) if strict else F.col(c)
    digits = F.length(F.regexp_replace(counted, r"\D", ""))
    # digits are only counted where the pattern hit
    return F.when(matches(c, C.PHONE), digits.between(10, 15)).otherwise(False)


def pii_rules(df: DataFrame, p: Profile) -> list[Column]:
    found = []
    for c in _have(df, p.pii):
        found.append(_violation("privacy_compliance", c, has_email(c), "email"))
        found.append(_violation("privacy_compliance", c, has_phone(c, p.strict_phone), "phone"))
    return found


def pii_flag(c: str = "text") -> Column:
    """The simpler patterns, as a text flag."""
    hit = (F.contains(F.col(c), F.lit("@")) & matches(c, C.EMAIL_SIMPLE)) | matches(c, C.PHONE_SIMPLE)
    return F.when(F.coalesce(hit, F.lit(False)), "Potential PII detected").otherwise("No PII detected")


def emoji_rules(df: DataFrame, p: Profile) -> list[Column]:
    return [_violation("emoji_detection", c, matches(c, non_ascii_class(p.emoji)), "emoji") for c in _have(df, ["text"])]


def special_rules(df: DataFrame, p: Profile) -> list[Column]:
    return [_violation("special_characters_detection", c, matches(c, C.SPECIAL_ONLY), F.col(c)) for c in _have(df, ["text"])]


def length_rules(df: DataFrame, p: Profile) -> list[Column]:
    found = []
    for c, (low, high), name in (("text", p.text_length, "reviews"), ("title", p.title_length, "titles")):
        if c in df.columns:
            size = F.length(F.coalesce(F.col(c), F.lit("")))
            found.append(_violation(f"short_{name}", c, size < low, size))
            found.append(_violation(f"long_{name}", c, size > high, size))
    return found


def date_rules(df: DataFrame, p: Profile) -> list[Column]:
    limit = F.to_timestamp(F.lit(p.last_day))
    return [_violation("anomaly_detection", c, F.col(c) > limit, F.date_format(c, "yyyy-MM-dd HH:mm:ss")) for c in _have(df, [p.time])]


def value_rules(df: DataFrame, p: Profile) -> list[Column]:
    """Values outside the expected set; null is unexpected."""
    found = []
    for c in _have(df, p.expected):
        text = F.col(c).cast("string")
        known = F.coalesce(text.isin(list(p.expected[c])), F.lit(False))
        found.append(_violation("anomaly_detection", c, ~known, F.concat(F.lit("unexpected: "), F.coalesce(text, F.lit("null")))))
    return found


def rough_rules(df: DataFrame, p: Profile, min_length: int = 10) -> list[Column]:
    """Texts and titles under ten characters, negative votes."""
    found = [_violation("short_text", c, F.length(c) < min_length, F.length(c)) for c in _have(df, ["text", "title"])]
    return found + [_violation("negative_votes", c, F.col(c) < 0, F.col(c)) for c in _have(df, ["helpful_vote"])]


def non_english_rules(df: DataFrame, p: Profile) -> list[Column]:
    return [_violation("non_english", c, matches(c, C.NON_ASCII), "non-ascii") for c in _have(df, ["text"])]


def outlier_rules(df: DataFrame, p: Profile) -> list[Column]:
    """More than ``z`` sample deviations from the mean; constant columns are skipped.

    Mean and deviation of all columns are one scalar subquery.
    """
    columns = _have(df, p.outliers)
    if not columns:
        return []
    aggs = [f(F.col(c).cast("double")).alias(f"{k}_{c}") for c in columns for k, f in (("m", F.avg), ("s", F.stddev_samp))]
    stats = df.agg(F.struct(*aggs).alias("stats")).scalar()
    found = []
    for c in columns:
        mean, std = stats.getField(f"m_{c}"), stats.getField(f"s_{c}")
        score = F.when(std > 0, (F.col(c) - mean) / std)
        found.append(_violation("anomaly_detection", c, F.abs(score) > p.z, "outlier"))
    return found


ROW_RULES = {
    "range": range_rules,
    "missing": missing_rules,
    "pii": pii_rules,
    "emoji": emoji_rules,
    "special": special_rules,
    "length": length_rules,
    "date": date_rules,
    "values": value_rules,
    "rough": rough_rules,
    "non_english": non_english_rules,
    "outliers": outlier_rules,
}
DEFAULT_RULES = ["range", "missing", "pii", "emoji", "special", "length", "date", "values", "outliers"]


def row_violations(df: DataFrame, profile: Profile | None = None, rules: Sequence[str] = tuple(DEFAULT_RULES)) -> DataFrame:
    p = profile or Profile()
    found = [v for name in rules for v in ROW_RULES[name](df, p)]
    return _emit(df, found, p.row_id)


def outliers(df: DataFrame, profile: Profile | None = None) -> DataFrame:
    return row_violations(df, profile, ["outliers"])


def iqr_outliers(df: DataFrame, columns: Sequence[str] = ("price", "average_rating", "rating"), row_id: str = "row_id") -> DataFrame:
    """Rows outside the quartile fences, which become literals in one filter."""
    found = []
    for f in quartile_fences(df, columns).collect():
        found.append(_violation("iqr", f["column"], ~F.col(f["column"]).between(f["low"], f["high"]), F.col(f["column"])))
    return _emit(df.select(row_id, *columns), found, row_id)


def row_digest(df: DataFrame, columns: Sequence[str]) -> Column:
    """128 bits of the row content; nulls and empty strings differ."""
    kinds = dict(df.dtypes)
    flat = [F.to_json(c) if kinds[c].startswith(("array", "map", "struct")) else F.col(c) for c in columns]
    holes = F.concat(*[F.when(F.col(c).isNull(), "1").otherwise("0") for c in columns])
    return F.struct(F.xxhash64(holes, *flat).alias("a"), F.xxhash64(F.lit("second"), holes, *flat).alias("b"))


def duplicates(df: DataFrame, row_id: str = "row_id") -> DataFrame:
    """Later copies of equal rows, the smallest id kept.

    Content is reduced to a digest and combined map-side, then every id that is
    not the keeper of its group is found by an anti join on the unique id. A
    group that holds a third of all rows therefore never meets in one task.
    """
    digest = row_digest(df, [c for c in df.columns if c != row_id])
    keepers = df.groupBy(digest.alias("_digest")).agg(F.min(row_id).alias(row_id)).select(row_id)
    copies = df.select(row_id).join(keepers, row_id, "left_anti")
    return copies.select(
        F.lit("duplicates").alias("check"), F.lit("(row)").alias("column"), F.col(row_id).alias("row_id"), F.lit("copy").alias("detail")
    )


def schema_violations(df: DataFrame, schema: T.StructType, row_id: str = "row_id") -> DataFrame:
    """A row for each declared column that is missing or holds values its type can't take; ``row_id`` is null.

    A column of another type whose present values all convert passes, as ``conform`` would take it.
    """
    lost = lossy_casts(df, schema).filter("n_lost > 0")
    missing = schema_differences(df, schema).filter("problem = 'missing'").select("column", F.lit("missing column").alias("detail"))
    broken = missing.unionByName(lost.select("column", F.concat(F.col("n_lost").cast("string"), F.lit(" values don't convert")).alias("detail")))
    return broken.select(F.lit("schema_validation").alias("check"), "column", F.lit(None).cast(dict(df.dtypes)[row_id]).alias("row_id"), "detail")


def violations(
    df: DataFrame, profile: Profile | None = None, rules: Sequence[str] = tuple(DEFAULT_RULES), schema: T.StructType | None = None
) -> DataFrame:
    """Everything the checks flag, as one long table; a declared schema is checked as well."""
    p = profile or Profile()
    found = row_violations(df, p, rules).unionByName(duplicates(df, p.row_id))
    return found if schema is None else found.unionByName(schema_violations(df, schema, p.row_id))


# checks reported together under one published name
REPORT_NAMES = {"missing": "missing_duplicates", "duplicates": "missing_duplicates"}
REPORT_CHECKS = [
    "short_reviews", "long_reviews", "short_titles", "long_titles", "schema_validation", "range_check",
    "missing_duplicates", "privacy_compliance", "emoji_detection", "anomaly_detection", "special_characters_detection",
]


def report(found: DataFrame, checks: Sequence[str] = tuple(REPORT_CHECKS)) -> DataFrame:
    """One row per check: flagged rows and status.

    The flagged ids stay in the long table, whole and spread over tasks; a list
    cell per check would gather them in one place. Checks that aren't listed but
    flagged something follow the listed ones. A finding without a row, such as
    a missing column, counts once for its column.
    """
    spark = found.sparkSession
    name = F.col("check")
    for part, whole in REPORT_NAMES.items():
        name = F.when(F.col("check") == part, whole).otherwise(name)
    # a finding about a column has no row; its column stands in
    whole_column = F.when(F.col("row_id").isNull(), F.col("column"))
    rows = found.select(name.alias("check"), "row_id", whole_column.alias("_column")).distinct().groupBy("check").agg(F.count(F.lit(1)).alias("n"))
    listed = spark.createDataFrame([(c,) for c in checks], "check string")
    n = F.coalesce("n", F.lit(0))
    return listed.join(rows, "check", "full").select("check", n.alias("n_flagged"), (n == 0).alias("status"))


def all_text_missing(df: DataFrame, col: str = "text") -> DataFrame:
    """Warning flag when no row has text."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), (F.count(col) == 0).alias("all_missing"))


class ValidationError(ValueError):
    pass


def stop_on_failure(result: DataFrame, policy: str = "schema") -> DataFrame:
    """Raise when the schema check failed, or any check with ``policy="any"``."""
    result = settle(result)
    failed = [r["check"] for r in result.filter("not status").select("check").collect()]
    broken = failed if policy == "any" else [c for c in failed if c == "schema_validation"]
    if broken:
        raise ValidationError(f"failed checks: {sorted(broken)}")
    return result


def schema_differences(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Missing columns, wrong types and extra columns; no data is read."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema}
    rows = []
    for f in schema:
        want = f.dataType.simpleString()
        if f.name not in actual:
            rows.append((f.name, "missing", want, None))
        elif actual[f.name] != want:
            rows.append((f.name, "type", want, actual[f.name]))
    names = {f.name for f in schema}
    rows += [(c, "extra", None, t) for c, t in actual.items() if c not in names]
    return df.sparkSession.createDataFrame(rows, "column string, problem string, expected string, actual string")


def conform(df: DataFrame, schema: T.StructType, strict: bool = False) -> DataFrame:
    """The table in the declared types.

    A missing column fails. A wrong type fails when ``strict``; otherwise it is
    converted: whole numbers become 0 where unreadable, fractions null. Extra
    columns stay.
    """
    missing = [f.name for f in schema if f.name not in df.columns]
    if missing:
        raise ValidationError(f"missing columns: {missing}")
    actual = {f.name: f.dataType for f in df.schema}
    wrong = [f for f in schema if actual[f.name].simpleString() != f.dataType.simpleString()]
    if strict and wrong:
        raise ValidationError(f"wrong types: {[f.name for f in wrong]}")
    changed = {}
    for f in wrong:
        read = _read_as(f)
        whole = isinstance(f.dataType, (T.IntegerType, T.LongType))
        changed[f.name] = F.coalesce(read, F.lit(0).cast(f.dataType)) if whole else read
    return df.withColumns(changed) if changed else df


def _read_as(f: T.StructField) -> Column:
    """A column's text in the declared type, null where it can't be read; whole numbers exactly, fractions cut off."""
    text = F.col(f.name).cast("string")
    read = text.try_cast(f.dataType)
    if isinstance(f.dataType, (T.IntegerType, T.LongType)):
        read = F.coalesce(read, text.try_cast("double").try_cast(f.dataType))
    return read


def lossy_casts(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Per converted column, how many present values the conversion cannot read."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema}
    wrong = [f for f in schema if f.name in actual and actual[f.name] != f.dataType.simpleString()]
    if not wrong:
        return df.sparkSession.createDataFrame([], "column string, n_lost bigint")
    lost = [
        F.count_if(F.col(f.name).isNotNull() & _read_as(f).isNull()).alias(f.name)
        for f in wrong
    ]
    rows = [F.struct(F.lit(f.name).alias("column"), F.col(f.name).alias("n_lost")) for f in wrong]
    return df.agg(*lost).select(F.inline(F.array(*rows)))
