"""I: data-quality checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from reviewloom.catalog import query
from reviewloom.catalog import sql as S
from reviewloom.functions import constants as C
from reviewloom.functions.text import emoji_characters
from reviewloom.operators import aggregates, quality
from reviewloom.schemas import from_ddl

# the test orders lie in other years than the published window
PROFILE = quality.Profile(
    ranges={"rating": (2, 4), "price": (901, None), "year": (1996, 2000), "rating_number": (2, None)},
    expected={"main_category": ["Brand#1", "Brand#2"], "verified_purchase": ["true"]},
    last_day="2000-12-31 00:00:00",
)


def _only(found, check):
    return found.filter(F.col("check") == check).select("row_id", "column")


def _texts(t):
    """Documents under review column names; every seventh is punctuation only."""
    text = F.when(F.col("doc_id") % 7 == 0, F.concat(F.lit("?!"), F.repeat(F.lit("."), (F.col("doc_id") % 5).cast("int")))).otherwise(F.col("text"))
    return t.documents.select(F.col("doc_id").alias("row_id"), text.alias("text"))


TEXTS = "texts AS (SELECT doc_id AS row_id, CASE WHEN doc_id % 7 = 0 THEN '?!' || repeat('.', CAST(doc_id % 5 AS INTEGER)) ELSE text END AS text FROM documents)"


@query(
    "I01_conform_schema",
    """SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 0 ELSE user_id END AS user_id, CASE WHEN event_id % 3 = 1 THEN NULL ELSE value END AS value,
    event_id % 2 = 0 AS flag FROM events""",
)
def conform_schema(t):
    raw = t.events.select(
        "event_id",
        F.when(F.col("event_id") % 3 == 0, "x").otherwise(F.col("user_id").cast("string")).alias("user_id"),
        F.when(F.col("event_id") % 3 == 1, "NULL").otherwise(F.col("value").cast("string")).alias("value"),
        F.when(F.col("event_id") % 2 == 0, "true").otherwise("false").alias("flag"),
    )
    return quality.conform(raw, from_ddl("event_id bigint, user_id bigint, value double, flag boolean"))


@query(
    "I01_lossy_casts",
    """SELECT 'user_id' AS "column", count(*) FILTER (event_id % 3 = 0) AS n_lost FROM events
    UNION ALL SELECT 'value', count(*) FILTER (event_id % 3 = 1) FROM events""",
)
def lossy_casts(t):
    raw = t.events.select(
        F.when(F.col("event_id") % 3 == 0, "x").otherwise(F.col("user_id").cast("string")).alias("user_id"),
        F.when(F.col("event_id") % 3 == 1, "NULL").otherwise(F.col("value").cast("string")).alias("value"),
    )
    return quality.lossy_casts(raw, from_ddl("user_id bigint, value double"))


@query("I01b_strict_schema", "SELECT event_id, user_id, value FROM events")
def strict_schema(t):
    """Passes only because every type is the declared one."""
    rows = t.events.select("event_id", "user_id", "value")
    return quality.conform(rows, from_ddl("event_id bigint, user_id bigint, value double"), strict=True)


RANGE_SQL = """SELECT row_id, 'rating' AS "column" FROM joined WHERE rating < 2 OR rating > 4
    UNION ALL SELECT row_id, 'price' FROM joined WHERE price < 901
    UNION ALL SELECT row_id, 'year' FROM joined WHERE year < 1996 OR year > 2000
    UNION ALL SELECT row_id, 'rating_number' FROM joined WHERE rating_number < 2"""


@query("I02_range_check", f"WITH {S.JOINED} {RANGE_SQL}")
def range_check(t):
    return _only(quality.row_violations(t.joined(), PROFILE, ["range"]), "range_check")


@query("I03_missing_values", f"WITH {S.JOINED} SELECT row_id, 'asin' AS \"column\" FROM joined WHERE asin IS NULL")
def missing_values(t):
    return _only(quality.row_violations(t.joined(), PROFILE, ["missing"]), "missing")


@query("I04_duplicate_rows", "SELECT doc_id AS row_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS rn FROM documents) WHERE rn > 1")
def duplicate_rows(t):
    return quality.duplicates(t.documents.select(F.col("doc_id").alias("row_id"), "text")).select("row_id")


_DIGITS = r"length(regexp_replace(text, '\D', '', 'g')) BETWEEN 10 AND 15"


@query(
    "I05_personal_data",
    f"""SELECT doc_id AS row_id, 'email' AS detail FROM documents WHERE regexp_matches(text, '{C.EMAIL}')
    UNION ALL SELECT doc_id, 'phone' FROM documents WHERE {_DIGITS} AND regexp_matches(text, '{C.PHONE}')""",
)
def personal_data(t):
    rows = t.documents.select(F.col("doc_id").alias("row_id"), "text")
    return quality.row_violations(rows, PROFILE, ["pii"]).select("row_id", "detail")


@query(
    "I05b_personal_data_flag",
    f"""SELECT doc_id, CASE WHEN regexp_matches(text, '{C.EMAIL_SIMPLE}') OR regexp_matches(text, '{C.PHONE_SIMPLE}')
    THEN 'Potential PII detected' ELSE 'No PII detected' END AS pii_flag FROM documents""",
)
def personal_data_flag(t):
    return t.documents.select("doc_id", quality.pii_flag("text").alias("pii_flag"))


_WITH_EMOJI = "CASE doc_id % 6 WHEN 0 THEN text || ' 🤣' WHEN 1 THEN '✂' || text WHEN 2 THEN '🇩🇪' ELSE text END"


@query(
    "I06_emoji",
    f"""SELECT page_id AS row_id FROM pages WHERE regexp_matches(html, '{C.EMOJI_WIDE}')
    UNION ALL SELECT doc_id FROM documents WHERE regexp_matches({_WITH_EMOJI}, '{C.EMOJI_WIDE}')""",
)
def emoji(t):
    """Half of the documents carry an emoji: behind the text, before it, or alone."""
    kind = F.col("doc_id") % 6
    text = F.when(kind == 0, F.concat("text", F.lit(" 🤣"))).when(kind == 1, F.concat(F.lit("✂"), "text")).when(kind == 2, "🇩🇪").otherwise(F.col("text"))
    rows = t.pages.select(F.col("page_id").alias("row_id"), F.col("html").alias("text")).unionByName(
        t.documents.select(F.col("doc_id").alias("row_id"), text.alias("text"))
    )
    return quality.row_violations(rows, PROFILE, ["emoji"]).select("row_id")


@query(
    "I06b_emoji_characters",
    f"""SELECT event_id, array_to_string(regexp_extract_all(event_type || CASE event_id % 3 WHEN 0 THEN '🤣 ok ❤' WHEN 1 THEN '漢字✂' ELSE '' END, '{C.EMOJI_NARROW}'), ' ') AS found FROM events""",
)
def emoji_chars(t):
    kind = F.col("event_id") % 3
    text = F.concat("event_type", F.when(kind == 0, "\U0001f923 ok ❤").when(kind == 1, "漢字✂").otherwise(""))
    return t.events.select("event_id", F.array_join(emoji_characters(text), " ").alias("found"))


@query("I07_special_characters", f"WITH {TEXTS} SELECT row_id, text AS detail FROM texts WHERE regexp_matches(text, '{C.SPECIAL_ONLY}')")
def special_characters(t):
    return quality.row_violations(_texts(t), PROFILE, ["special"]).select("row_id", "detail")


@query(
    "I08_lengths",
    f"""WITH {S.RAW} SELECT row_id, 'long_reviews' AS "check" FROM raw_reviews WHERE length(text) > 5000
    UNION ALL SELECT row_id, 'short_titles' FROM raw_reviews WHERE length(coalesce(title, '')) < 1
    UNION ALL SELECT row_id, 'short_reviews' FROM raw_reviews WHERE length(coalesce(text, '')) < 1
    UNION ALL SELECT row_id, 'long_titles' FROM raw_reviews WHERE length(title) > 200""",
)
def lengths(t):
    return quality.row_violations(t.raw_reviews(), PROFILE, ["length"]).select("row_id", "check")


def _z_sql(table: str, row_id: str, columns) -> str:
    stats = ", ".join(f"avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}" for c in columns)
    return " UNION ALL ".join(
        f"SELECT {row_id} AS row_id, '{c}' AS \"column\" FROM {table}, (SELECT {stats} FROM {table}) WHERE s_{c} > 0 AND abs(({c} - m_{c}) / s_{c}) > 3"
        for c in columns
    )


@query("I09_z_outliers", f"WITH {S.JOINED} {_z_sql('joined', 'row_id', C.OUTLIER_COLUMNS)}")
def z_outliers(t):
    return quality.outliers(t.joined(), PROFILE).select("row_id", "column")


@query("I10_late_dates", f"WITH {S.JOINED} SELECT row_id FROM joined WHERE review_time > TIMESTAMP '2000-12-31'")
def late_dates(t):
    return quality.row_violations(t.joined(), PROFILE, ["date"]).select("row_id")


VALUES_SQL = """SELECT row_id, 'main_category' AS "column" FROM joined WHERE NOT coalesce(main_category IN ('Brand#1', 'Brand#2'), false)
    UNION ALL SELECT row_id, 'verified_purchase' FROM joined WHERE NOT verified_purchase"""


@query("I11_unexpected_values", f"WITH {S.JOINED} {VALUES_SQL}")
def unexpected_values(t):
    return quality.row_violations(t.joined(), PROFILE, ["values"]).select("row_id", "column")


@query(
    "I12_iqr_outliers",
    """WITH q AS (SELECT quantile_cont(value, 0.25) AS a, quantile_cont(value, 0.75) AS b FROM events)
    SELECT event_id AS row_id FROM events, q WHERE value < a - 1.5 * (b - a) OR value > b + 1.5 * (b - a)""",
)
def iqr_outliers(t):
    return quality.iqr_outliers(t.events.withColumnRenamed("event_id", "row_id"), ["value"]).select("row_id")


@query(
    "I13_rough_lengths",
    f"""WITH {S.RAW} SELECT row_id, 'short_text' AS "check", 'title' AS "column" FROM raw_reviews WHERE length(title) < 30
    UNION ALL SELECT row_id, 'short_text', 'text' FROM raw_reviews WHERE length(text) < 30
    UNION ALL SELECT row_id, 'negative_votes', 'helpful_vote' FROM raw_reviews WHERE helpful_vote - 10 < 0""",
)
def rough_lengths(t):
    rows = t.raw_reviews().withColumn("helpful_vote", F.col("helpful_vote") - 10)
    found = [v for v in quality.rough_rules(rows, PROFILE, min_length=30)]
    return quality._emit(rows, found, "row_id").select("row_id", "check", "column")


@query("I14_repeated_key", "SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1")
def repeated_key(t):
    return aggregates.repeated_keys(t.lineitem, "l_orderkey")


@query(
    "I15_class_imbalance",
    "SELECT quality, n FROM (SELECT quality, count(*) AS n, sum(count(*)) OVER () AS total FROM labels GROUP BY quality) WHERE n < 0.4 * total",
)
def class_imbalance(t):
    return aggregates.class_shares(t.labels, "quality", 0.4).filter("is_minority").select("quality", "n")


@query("I16_negative_price", "SELECT c_custkey AS row_id FROM customer WHERE c_acctbal - 1000 < 0")
def negative_price(t):
    rows = t.customer.select(F.col("c_custkey").alias("row_id"), (F.col("c_acctbal") - 1000).alias("price"))
    return quality.row_violations(rows, rules=["range"]).select("row_id")


@query("I17_non_english", "SELECT doc_id AS row_id FROM documents WHERE regexp_matches(text, '[^\\x00-\\x7F]')")
def non_english(t):
    rows = t.documents.select(F.col("doc_id").alias("row_id"), "text")
    return quality.row_violations(rows, rules=["non_english"]).select("row_id")


_FOUND = f"""found AS (
    SELECT 'range_check' AS "check", row_id FROM ({RANGE_SQL})
    UNION SELECT 'missing_duplicates', row_id FROM joined WHERE asin IS NULL
    UNION SELECT 'anomaly_detection', row_id FROM ({VALUES_SQL})
    UNION SELECT 'anomaly_detection', row_id FROM joined WHERE review_time > TIMESTAMP '2000-12-31'
    UNION SELECT 'anomaly_detection', row_id FROM ({_z_sql('joined', 'row_id', C.OUTLIER_COLUMNS)})
    UNION SELECT 'short_titles', row_id FROM joined WHERE title IS NULL OR title = ''
    UNION SELECT 'short_reviews', row_id FROM joined WHERE text = ''
    UNION SELECT 'long_titles', row_id FROM joined WHERE length(title) > 200
    UNION SELECT 'long_reviews', row_id FROM joined WHERE length(text) > 5000
    UNION SELECT 'emoji_detection', row_id FROM joined WHERE regexp_matches(text, '{C.EMOJI_WIDE}')
    UNION SELECT 'special_characters_detection', row_id FROM joined WHERE regexp_matches(text, '{C.SPECIAL_ONLY}')
    UNION SELECT 'privacy_compliance', row_id FROM joined WHERE regexp_matches(text, '{C.EMAIL}') OR regexp_matches(title, '{C.EMAIL}')
      OR ({_DIGITS} AND regexp_matches(text, '{C.PHONE}'))
      OR ({_DIGITS.replace('text', 'title')} AND regexp_matches(title, '{C.PHONE}')))"""
REPORT_SQL = f"""{_FOUND}, checks AS (SELECT unnest([{S.quoted(quality.REPORT_CHECKS)}]) AS "check")
    SELECT checks."check", count(row_id) AS n_flagged, count(row_id) = 0 AS status FROM checks LEFT JOIN found ON checks."check" = found."check" GROUP BY ALL"""


@query("I18_quality_report", f"WITH {S.JOINED}, {REPORT_SQL}")
def quality_report(t):
    return quality.report(quality.violations(t.joined(), PROFILE))


@query("I18_all_violations", f"WITH {S.JOINED}, {_FOUND} SELECT * FROM found")
def all_violations(t):
    found = quality.violations(t.joined(), PROFILE)
    name = F.when(F.col("check") == "missing", "missing_duplicates").otherwise(F.col("check"))
    return found.select(name.alias("check"), "row_id").distinct()


def _badly_typed(t):
    """Events without a declared column and with values that don't convert."""
    user = F.when(F.col("event_id") % 3 == 0, "x").otherwise(F.col("user_id").cast("string"))
    return t.events.select(F.col("event_id").alias("row_id"), user.alias("user_id"), F.lit("long enough").alias("text"))


_DECLARED = "row_id bigint, user_id bigint, text string, value double"
_SCHEMA_REPORT = f"""SELECT "check", CASE "check" WHEN 'schema_validation' THEN 1 + CAST((SELECT count(*) > 0 FROM events WHERE event_id % 3 = 0) AS BIGINT)
    WHEN 'rough' THEN (SELECT count(*) FROM events)
    WHEN 'missing_duplicates' THEN (SELECT count(*) - count(DISTINCT CASE WHEN event_id % 3 = 0 THEN 'x' ELSE CAST(user_id AS VARCHAR) END) FROM events) ELSE 0 END AS n_flagged FROM (SELECT unnest([{S.quoted([*quality.REPORT_CHECKS, 'rough'])}]) AS "check")"""


def _schema_report(t):
    """The declared schema is checked, and a check that isn't listed keeps its place in the report."""
    rows = _badly_typed(t)
    found = quality.violations(rows, PROFILE, ["range"], from_ddl(_DECLARED))
    other = rows.select(F.lit("rough").alias("check"), F.lit("text").alias("column"), "row_id", F.lit("any").alias("detail"))
    return quality.report(found.unionByName(other))


@query("I18_schema_report", f"""SELECT "check", n_flagged, n_flagged = 0 AS status FROM ({_SCHEMA_REPORT})""")
def schema_report(t):
    return _schema_report(t)


@query("I19_failing_gate", f"""SELECT string_agg("check", ',' ORDER BY "check") AS stopped_by FROM ({_SCHEMA_REPORT}) WHERE n_flagged > 0 AND "check" = 'schema_validation'""")
def failing_gate(t):
    """The gate raises on the broken schema; what it names is the result."""
    result = _schema_report(t)
    try:
        quality.stop_on_failure(result, "schema")
    except quality.ValidationError:
        return result.filter("not status and check = 'schema_validation'").agg(F.array_join(F.array_sort(F.collect_list("check")), ",").alias("stopped_by"))
    return result.select(F.lit(None).cast("string").alias("stopped_by")).limit(1)


@query("I19_stop_on_failure", f"WITH {S.JOINED}, {REPORT_SQL}")
def stop_on_failure(t):
    """The schema check passed, so the report goes through."""
    return quality.stop_on_failure(quality.report(quality.violations(t.joined(), PROFILE)), "schema")


@query("I20_all_text_missing", "SELECT count(*) AS n_rows, count(text) = 0 AS all_missing FROM documents")
def all_text_missing(t):
    return quality.all_text_missing(t.documents)
