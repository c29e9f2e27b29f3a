"""B: projections and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from reviewloom.catalog import query
from reviewloom.catalog import sql as S
from reviewloom.catalog.views import ANALYSES, BROKEN, analyses, broken
from reviewloom.functions import columns as K
from reviewloom.functions import constants as C
from reviewloom.functions import json_text, text, vectors
from reviewloom.operators import cleaning, features, joins, retrieval, summaries


@query(
    "B01_epoch_to_time",
    f"WITH {S.REVIEWS} SELECT row_id, timestamp, review_date_timestamp FROM reviews",
)
def epoch_to_time(t):
    return t.reviews().select("row_id", "timestamp", "review_date_timestamp")


@query("B02_year_month", f"WITH {S.REVIEWS} SELECT row_id, year, review_month FROM reviews")
def year_month(t):
    return t.reviews().select("row_id", "year", "review_month")


@query("B03_drop_columns", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def drop_columns(t):
    return K.drop_columns(t.customer, "c_nationkey", "c_mktsegment", "not_there")


@query("B04_product_columns", f"WITH {S.RAW}, {S.PRODUCTS} SELECT * FROM products")
def product_columns(t):
    return K.product_columns(t.products()).withColumn("categories", K.comma_path("categories"))


@query("B05_category_path", "SELECT p_partkey, p_brand || ',' || p_type || ',' || p_name AS categories FROM part")
def category_path(t):
    listed = t.part.select("p_partkey", F.array("p_brand", "p_type", "p_name").alias("categories"))
    return K.category_path(K.category_path(listed))


@query(
    "B06_narrow_types",
    f"""WITH {S.JOINED} SELECT row_id, CAST(trunc(rating) AS TINYINT) AS rating, CAST(helpful_vote AS INTEGER) AS helpful_vote,
    CAST(average_rating AS FLOAT) AS average_rating, CAST(year AS SMALLINT) AS year, CAST(review_month AS TINYINT) AS review_month FROM joined""",
)
def narrow_types(t):
    rows = t.joined().select("row_id", "rating", "helpful_vote", "average_rating", "year", "review_month")
    return K.narrow_types(rows)


@query("B07_fill_missing", f"WITH {S.RAW} SELECT row_id, coalesce(title, 'unknown') AS title, coalesce(helpful_vote, 0) AS helpful_vote FROM raw_reviews")
def fill_missing(t):
    return cleaning.fill_missing(t.raw_reviews().select("row_id", "title", "helpful_vote"))


@query(
    "B08_price_text",
    f"WITH {S.JOINED} SELECT row_id, CASE WHEN price IS NULL THEN 'unknown' ELSE CAST(price AS VARCHAR) END AS price FROM joined",
)
def price_text(t):
    return t.joined().select("row_id", K.price_text("price").alias("price"))


@query("B09_collapse_space", f"SELECT doc_id, regexp_replace(text, '{S.WS}+', ' ', 'g') AS text FROM documents")
def collapse_space(t):
    return t.documents.select("doc_id", text.collapse_space("text").alias("text"))


@query("B10_strip_tags", f"SELECT page_id, {S.clean('html')} AS html FROM pages")
def strip_tags(t):
    return t.pages.select("page_id", text.clean_text("html").alias("html"))


@query(
    "B11_name_emoji",
    """SELECT event_id, CASE event_id % 4 WHEN 0 THEN event_type || ' :rolling_on_the_floor_laughing: ok'
       WHEN 1 THEN event_type || ':red_heart::red_heart:' WHEN 2 THEN ':thumbs_up:' || event_type ELSE event_type END AS text FROM events""",
)
def name_emoji(t):
    kind = F.col("event_id") % 4
    raw = (
        F.when(kind == 0, F.concat("event_type", F.lit(" \U0001f923 ok")))
        .when(kind == 1, F.concat("event_type", F.lit("❤️❤")))
        .when(kind == 2, F.concat(F.lit("\U0001f44d"), "event_type"))
        .otherwise(F.col("event_type"))
    )
    return t.events.select("event_id", text.name_emoji(raw).alias("text"))


# emoji of more than one character, and what they are named; the last ones are no emoji
SEQUENCES = [
    ("\U0001f468\u200d\U0001f469\u200d\U0001f467", ":man_woman_girl:"), ("\U0001f44d\U0001f3fd", ":thumbs_up_medium_skin_tone:"), ("\U0001f1eb\U0001f1f7", ":flag_fr:"),
    ("1\ufe0f\u20e3", ":keycap_1:"), ("\u2b50\ufe0f", ":star:"), ("\u23f0", ":alarm_clock:"),
    ("\U0001f3f4\U000e0067\U000e0062\U000e0065\U000e006e\U000e0067\U000e007f", ":flag_gbeng:"), ("\u2764\ufe0f\u200d\U0001f525", ":red_heart_fire:"),
    ("\U0001f1eb\U0001f1f7\U0001f1e9\U0001f1ea", ":flag_fr::flag_de:"), ("1 \u6f22 \u200d", "1 \u6f22 \u200d"),
]


@query(
    "B11_emoji_sequences",
    "SELECT event_id, event_type || ' ' || CASE event_id % 10 " + " ".join(f"WHEN {i} THEN '{name}{name}'" for i, (_, name) in enumerate(SEQUENCES)) + " END || ' ' || event_type AS text FROM events",
)
def emoji_sequences(t):
    """Families, skin tones, flags, keycaps, the star and a clock, each twice between words."""
    one = F.element_at(F.array(*[F.lit(s + s) for s, _ in SEQUENCES]), (F.col("event_id") % 10 + 1).cast("int"))
    return t.events.select("event_id", text.name_emoji(F.concat_ws(" ", "event_type", one, "event_type")).alias("text"))


FEATURE_SQL = f"""{S.JOINED}, feature_rows AS (
  SELECT row_id, coalesce(text, '') AS text, coalesce(title, '') AS title, coalesce(price, 0.0) AS price,
         CAST(price IS NULL AS INTEGER) AS price_missing, CAST(coalesce(helpful_vote, 0) AS INTEGER) AS helpful_vote,
         CAST(coalesce(verified_purchase, false) AS INTEGER) AS verified_purchase FROM joined)"""


def _features(t):
    rows = t.joined().select(
        "row_id", "text", "title", K.price_text("price").alias("price"), "helpful_vote", "verified_purchase"
    )
    return features.prepare_features(rows)


@query("B12_prepare_features", f"WITH {FEATURE_SQL} SELECT * EXCLUDE (text), md5(text) AS text_md5 FROM feature_rows")
def prepare_features(t):
    return _features(t).withColumn("text_md5", F.md5("text")).drop("text")


@query(
    "B13_features_first",
    f"WITH {FEATURE_SQL} SELECT md5(text) AS text, price, price_missing, helpful_vote, verified_purchase, row_id, title FROM feature_rows",
)
def features_first(t):
    return features.features_first(_features(t)).withColumn("text", F.md5("text"))


@query("B14_model_input", f"WITH {FEATURE_SQL} SELECT row_id, md5(title || ' ' || text) AS combined FROM feature_rows")
def model_input(t):
    return features.model_input(_features(t)).select("row_id", F.md5("combined_text").alias("combined"))


@query(
    "B15_category_level",
    f"""WITH {S.RAW}, {S.PRODUCTS}, paths AS (SELECT parent_asin, main_category, CASE CAST(parent_asin AS BIGINT) % 4 WHEN 0 THEN '  '
      WHEN 1 THEN NULL WHEN 2 THEN 'one,two' ELSE categories END AS path FROM products)
    SELECT parent_asin, CASE WHEN path IS NULL OR trim(path) = '' THEN main_category WHEN path = 'one,two' THEN 'two'
      ELSE split_part(path, ',', 3) END AS level FROM paths""",
)
def category_level(t):
    n = F.col("parent_asin").cast("bigint") % 4
    path = F.when(n == 0, "  ").when(n == 1, None).when(n == 2, "one,two").otherwise(K.comma_path("categories"))
    return t.products().select("parent_asin", K.category_level(path, "main_category").alias("level"))


@query(
    "B16_chunk_text",
    f"""WITH w AS (SELECT doc_id, {S.words('text')} AS ws FROM documents),
    s AS (SELECT doc_id, ws, unnest(range(0, len(ws), 200)) AS start FROM w)
    SELECT doc_id, CAST(start // 200 AS INTEGER) AS chunk_no, array_to_string(list_slice(ws, start + 1, start + 200), ' ') AS chunk FROM s""",
)
def chunk_text(t):
    return summaries.chunk_text(t.documents.select("doc_id", "text"), n_words=200)


# RE2 has no look-around, so the twin captures the neighbours and puts them back
_JSON_SQL = r"""rewritten AS (SELECT event_id,
  regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(analysis,
    '\\n|\\t', '', 'g'), '\}\s*\{', '},{', 'g'), '\}(\s*)"', '},\1"', 'g'),
    '"Performance":\s*\{([^{}]*)\}\s*([\]}])', '"Performance": {\1},\2', 'g'),
    '([{,])(\s*)(\w+)(\s*):', '\1\2"\3":', 'g'), ',\s*([\]}])', '\1', 'g') AS a FROM broken),
counted AS (SELECT event_id, a, len(a) - len(replace(a, '{', '')) - len(a) + len(replace(a, '}', '')) AS missing FROM rewritten),
closed AS (SELECT event_id, CASE WHEN missing > 0 THEN a || repeat('}', CAST(missing AS INTEGER))
  WHEN missing < 0 THEN left(a, greatest(len(a) + missing, 0)) ELSE a END AS analysis FROM counted)"""


@query("B17_repair_json", f"WITH {BROKEN}, {_JSON_SQL} SELECT event_id, analysis FROM closed WHERE json_valid(analysis)")
def repair_json(t):
    return json_text.repair_json(broken(t))


@query(
    "B18_flatten_predictions",
    """SELECT event_id, CASE WHEN event_id % 3 = 2 THEN NULL ELSE upper(event_type) END AS sentiment_label,
       CASE WHEN event_id % 3 = 2 THEN NULL ELSE value END AS POS_confidence,
       CASE WHEN event_id % 3 = 2 THEN NULL ELSE CAST(0.05 AS DOUBLE) END AS NEU_confidence,
       CASE WHEN event_id % 3 = 0 THEN CAST(0.25 AS DOUBLE) END AS NEG_confidence FROM events""",
)
def flatten_predictions(t):
    head = F.concat(F.lit('["'), F.upper("event_type"), F.lit('", {"POS": '), F.col("value").cast("string"), F.lit(', "NEU": 0.05'))
    kind = F.col("event_id") % 3
    made = F.when(kind == 0, F.concat(head, F.lit(', "NEG": 0.25}]'))).when(kind == 1, F.concat(head, F.lit("}]"))).otherwise("none")
    return json_text.flatten_predictions(t.events.select("event_id", made.alias("prediction")))


PATH_SQL = f"""{ANALYSES}, paths AS (SELECT vec_id, embedding, category, year, month, subcategory,
  CASE WHEN vec_id % 9 = 0 THEN 'RAG/' || category ELSE 'RAG/' || category || '/' || year || '/' || month || '/' || subcategory || '.json' END AS path
  FROM analyses)"""


def _paths(t):
    full = F.concat_ws("/", F.lit("RAG"), "category", F.col("year").cast("string"), F.col("month").cast("string"), F.concat("subcategory", F.lit(".json")))
    short = F.concat(F.lit("RAG/"), "category")
    return analyses(t).withColumn("path", F.when(F.col("vec_id") % 9 == 0, short).otherwise(full))


@query(
    "B19_path_metadata",
    f"""WITH {PATH_SQL} SELECT vec_id, CASE WHEN vec_id % 9 <> 0 THEN category END AS category, CASE WHEN vec_id % 9 <> 0 THEN CAST(year AS VARCHAR) END AS year,
    CASE WHEN vec_id % 9 <> 0 THEN CAST(month AS VARCHAR) END AS month, CASE WHEN vec_id % 9 <> 0 THEN subcategory || '.json' END AS subcategory FROM paths""",
)
def path_metadata(t):
    m = _paths(t).select("vec_id", K.path_metadata("path").alias("m"))
    return m.select("vec_id", "m.category", "m.year", "m.month", "m.subcategory")


@query(
    "B20_embedding_text",
    f"""WITH {PATH_SQL} SELECT vec_id, 'category: ' || category || ' subcategory: ' || subcategory || '.json year: ' || year || ' month: ' || month
    || ' {{"id":' || vec_id || '}}' AS embedding_text FROM paths WHERE vec_id % 9 <> 0""",
)
def embedding_text(t):
    rows = _paths(t).select("vec_id", K.path_metadata("path").alias("m"), F.to_json(F.struct(F.col("vec_id").alias("id"))).alias("j"))
    return rows.filter("m is not null").select("vec_id", K.embedding_text("m", "j").alias("embedding_text"))


@query(
    "B21_vector_key",
    f"WITH {PATH_SQL} SELECT vec_id, sha256(subcategory || '.json_' || year || '_' || month) AS id FROM paths WHERE vec_id % 9 <> 0",
)
def vector_key(t):
    rows = _paths(t).select("path", F.col("vec_id").alias("values"))
    return retrieval.vector_rows(rows).select(F.col("values").alias("vec_id"), "id")


@query("B22_anonymise_user", "SELECT event_id, sha256(CAST(user_id AS VARCHAR)) AS user_id FROM events")
def anonymise_user(t):
    return t.events.select("event_id", K.anonymised("user_id").alias("user_id"))


@query(
    "B23_flatten_summaries",
    f"""WITH {ANALYSES} SELECT vec_id, subcategory AS product_type, 'Quality' AS aspect, quality_sentiment AS sentiment, quality_summary AS summary FROM analyses
    UNION ALL SELECT vec_id, subcategory, 'Price', price_sentiment, price_summary FROM analyses""",
)
def flatten_summaries(t):
    wrapped = F.concat(F.lit('{"product_summaries": {"'), "subcategory", F.lit('": '), "analysis", F.lit("}}"))
    return json_text.flatten_summaries(analyses(t).select("vec_id", wrapped.alias("analysis")))


@query(
    "B24_file_names",
    "SELECT c_custkey, replace(c_mktsegment || ' ' || c_name, ' ', '_') AS file_name, split_part(c_name || '.v1.json', '.', 1) AS lookup FROM customer",
)
def file_names(t):
    name = F.concat("c_mktsegment", F.lit(" "), "c_name")
    return t.customer.select(
        "c_custkey", K.file_safe(name).alias("file_name"), K.without_extension(F.concat("c_name", F.lit(".v1.json"))).alias("lookup")
    )


@query(
    "B25_label_codes",
    """SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'NEUTRAL' WHEN 1 THEN 'POSITIVE' WHEN 2 THEN 'NEGATIVE' END AS name,
       CASE WHEN event_id % 4 < 3 THEN CAST(event_id % 4 AS INTEGER) END AS code FROM events""",
)
def label_codes(t):
    named = t.events.select("event_id", K.label_name(F.col("event_id") % 4).alias("name"))
    return named.withColumn("code", K.label_code("name"))


@query(
    "B26_encode_labels",
    "SELECT p_partkey, p_type, CAST(dense_rank() OVER (ORDER BY p_type) - 1 AS INTEGER) AS label FROM part",
)
def encode_labels(t):
    return features.encode_labels(t.part.select("p_partkey", "p_type"), "p_type")


@query(
    "B26_encode_many_labels",
    "SELECT c_name, c_custkey, CAST(dense_rank() OVER (ORDER BY c_name) - 1 AS INTEGER) AS label FROM customer",
)
def encode_many_labels(t):
    """As many classes as customers."""
    return features.encode_labels(t.customer.select("c_name", "c_custkey"), "c_name")


@query(
    "B27_logits_to_prediction",
    """WITH l AS (SELECT vec_id, CAST(embedding[1] AS DOUBLE) * 5 AS a, CAST(embedding[2] AS DOUBLE) * 5 AS b, CAST(embedding[3] AS DOUBLE) * 5 AS c FROM embeddings),
    m AS (SELECT *, greatest(a, b, c) AS top FROM l),
    e AS (SELECT *, exp(a - top) AS ea, exp(b - top) AS eb, exp(c - top) AS ec FROM m)
    SELECT vec_id, CASE WHEN a = top THEN 'NEGATIVE' WHEN b = top THEN 'NEUTRAL' ELSE 'POSITIVE' END AS label,
    round(ea / (ea + eb + ec), 2) AS NEG, round(eb / (ea + eb + ec), 2) AS NEU, round(ec / (ea + eb + ec), 2) AS POS FROM e""",
)
def logits_to_prediction(t):
    rows = t.embeddings.select("vec_id", F.transform(F.slice("embedding", 1, 3), lambda x: x.cast("double") * 5).alias("logits"))
    scored = rows.select("vec_id", vectors.predicted_class("logits").alias("label"), vectors.class_confidences("logits").alias("c"))
    return scored.select("vec_id", "label", *[F.col("c")[k].alias(k) for k in ("NEG", "NEU", "POS")])


@query("B28_fill_prompt", "SELECT item_id, 'Before: ' || CASE WHEN item_id % 2 = 0 THEN 'None' ELSE 'seen ' || item_id END || ' Text: ' || text AS prompt FROM benchmark")
def fill_prompt(t):
    previous = F.when(F.col("item_id") % 2 == 1, F.concat(F.lit("seen "), "item_id"))
    return t.benchmark.select("item_id", K.filled_prompt("Before: {PREVIOUS_SUMMARY} Text: {TEXT}", "text", previous).alias("prompt"))


@query(
    "B30_number_or_null",
    "SELECT event_id, CASE WHEN event_id % 5 = 0 THEN NULL ELSE value END AS value FROM events",
)
def number_or_null(t):
    raw = F.when(F.col("event_id") % 5 == 0, "n/a").otherwise(F.col("value").cast("string"))
    return t.events.select("event_id", K.number_or_null(raw).alias("value"))


@query(
    "B31_time_or_null",
    "SELECT event_id, CASE WHEN event_id % 5 = 0 THEN NULL ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS ts FROM events",
)
def time_or_null(t):
    raw = F.when(F.col("event_id") % 5 == 0, "someday").otherwise(F.date_format("ts", K.TIME_FORMAT))
    return t.events.select("event_id", F.date_format(K.time_or_null(raw), K.TIME_FORMAT).alias("ts"))


@query("B32_text_guard", f"WITH {S.RAW} SELECT row_id, title FROM raw_reviews WHERE title IS NOT NULL")
def text_guard(t):
    return t.raw_reviews().select("row_id", "title").filter(K.text_guard("title"))
