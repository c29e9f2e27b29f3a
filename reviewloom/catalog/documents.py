"""Documents, summaries, facets, retrieval, and the chains."""

from __future__ import annotations

from pyspark.sql import functions as F

from reviewloom.catalog import query
from reviewloom.catalog import sql as S
from reviewloom.catalog.quality import PROFILE, REPORT_SQL
from reviewloom.catalog.views import ANALYSES, analyses
from reviewloom.functions import constants as C
from reviewloom.functions.labels import rating_class
from reviewloom.operators import cleaning, quality, query_tables, retrieval, rollup, summaries
from reviewloom.plans import chains

DOCS = f"""{S.JOINED}, doc_rows AS (
  SELECT row_id, text, rating, helpful_vote, year, review_month AS month, coalesce(split_part(categories, ',', 3), main_category) AS category,
    CASE WHEN rating >= 4 THEN 'POSITIVE' WHEN rating <= 2 THEN 'NEGATIVE' ELSE 'NEUTRAL' END AS s FROM joined WHERE categories IS NOT NULL)"""


def _labelled_by_text(t):
    rows, texts = t.joined_by_text()
    return rows.withColumn("sentiment_label", rating_class("rating")), texts


@query(
    "E02_monthly_documents",
    f"""WITH {DOCS}, sizes AS (SELECT year, month, category, s, count(*) AS n FROM doc_rows GROUP BY ALL),
    modes AS (SELECT year, month, category, s, row_number() OVER (PARTITION BY year, month, category ORDER BY n DESC, s) AS rn FROM sizes),
    base AS (SELECT year, month, category, md5(string_agg(text, ' ' ORDER BY row_id)) AS text_md5, round(avg(rating), 6) AS average_rating,
      round(avg(helpful_vote), 6) AS avg_helpful_votes FROM doc_rows GROUP BY ALL)
    SELECT base.*, s AS dominant_sentiment FROM base JOIN modes USING (year, month, category) WHERE rn = 1""",
)
def monthly_documents(t):
    rows, texts = _labelled_by_text(t)
    docs = rollup.monthly_documents(rows, texts=texts)
    return docs.select(
        "year", "month", "category", F.md5("text").alias("text_md5"), F.round("average_rating", 6).alias("average_rating"),
        F.round("avg_helpful_votes", 6).alias("avg_helpful_votes"), "dominant_sentiment",
    )


@query(
    "E02_document_parts",
    f"""WITH {DOCS}, sized AS (SELECT *, sum(length(text) + 1) OVER (PARTITION BY year, month, category) AS total,
      coalesce(sum(length(text) + 1) OVER (PARTITION BY year, month, category ORDER BY row_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM doc_rows),
    parts AS (SELECT *, CAST(CASE WHEN total > 20000 THEN before // 20000 ELSE 0 END AS BIGINT) AS part FROM sized)
    SELECT year, month, category, part, md5(string_agg(text, ' ' ORDER BY row_id)) AS text_md5 FROM parts GROUP BY ALL""",
)
def document_parts(t):
    """The same documents cut at 20,000 characters, so the long ones are in parts."""
    rows, texts = _labelled_by_text(t)
    parts = rollup.document_parts(rows, 20_000, texts)
    return parts.select("year", "month", "category", "part", F.md5("text").alias("text_md5"))


@query(
    "E02_document_chunks",
    f"""WITH {DOCS}, d AS (SELECT year, month, category, {S.words("string_agg(text, ' ' ORDER BY row_id)")} AS ws FROM doc_rows GROUP BY ALL),
    c AS (SELECT *, unnest(range(0, len(ws), 1000)) AS start FROM d)
    SELECT year, month, category, CAST(start // 1000 AS BIGINT) AS chunk_no, md5(array_to_string(list_slice(ws, start + 1, start + 1000), ' ')) AS text_md5 FROM c""",
)
def document_chunks(t):
    chunks = rollup.document_chunks_of(*t.joined_by_text(), 1000)
    return chunks.select("year", "month", "category", "chunk_no", F.md5("text").alias("text_md5"))


FACETS = f"{ANALYSES}, facets AS (SELECT DISTINCT category, year, month FROM analyses)"


@query("E11_facet_tree", f"WITH {FACETS} SELECT category, year, string_agg(CAST(month AS VARCHAR), ',' ORDER BY month) AS months FROM facets GROUP BY ALL")
def facet_tree(t):
    tree = rollup.facet_tree(analyses(t)).select("category", F.explode("years").alias("year", "m"))
    return tree.select("category", "year", F.array_join(F.transform("m", lambda x: x.cast("string")), ",").alias("months"))


@query(
    "E12_facet_options",
    f"""WITH {FACETS} SELECT 'category' AS level, category AS option FROM facets GROUP BY ALL
    UNION ALL SELECT DISTINCT 'year', CAST(year AS VARCHAR) FROM facets WHERE category = 'cat 1'
    UNION ALL SELECT 'month', 'ALL' UNION ALL SELECT DISTINCT 'month', CAST(month AS VARCHAR) FROM facets WHERE category = 'cat 1' AND year = 2019""",
)
def facet_options(t):
    rows = analyses(t)
    levels = {"category": (), "year": ("cat 1",), "month": ("cat 1", 2019)}
    parts = [rollup.facet_options(rows, *args).select(F.lit(k).alias("level"), "option") for k, args in levels.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# --- retrieval ----------------------------------------------------------------

RANKED = f"""{ANALYSES}, q AS (SELECT CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE vec_id = 0),
scored AS (SELECT a.*, list_cosine_similarity(CAST(embedding AS DOUBLE[]), v) AS score FROM analyses a, q),
best AS (SELECT *, row_number() OVER (ORDER BY score DESC, vec_id) AS rank FROM scored ORDER BY score DESC, vec_id LIMIT 25)"""


def _target(t):
    return t.embeddings.filter("vec_id = 0").first()["embedding"]


def _search(t, **kw):
    rows = analyses(t)
    docs = rows.select("category", "year", "month", "subcategory", "analysis")
    return retrieval.search(rows.drop("analysis"), _target(t), docs, values="embedding", row_id="vec_id", **kw)


@query("M01_search_then_filter", f"WITH {RANKED} SELECT category, year, month, subcategory, CAST(rank AS INTEGER) AS rank FROM best WHERE year = 2018")
def search_then_filter(t):
    return _search(t, year=2018, month="ALL").drop("analysis")


@query(
    "M01_filter_then_search",
    f"WITH {RANKED} SELECT category, year, month, subcategory, CAST(row_number() OVER (ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored WHERE year = 2019 AND month = 5 ORDER BY score DESC, vec_id LIMIT 25",
)
def filter_then_search(t):
    return _search(t, year=2019, month=5, prefilter=True).drop("analysis")


@query(
    "M02_search_fallback",
    f"""WITH {RANKED} SELECT category, year, month, subcategory, CAST(1 AS INTEGER) AS rank FROM scored
    WHERE category = (SELECT max(category) FROM scored) AND year = 2019""",
)
def search_fallback(t):
    """One hit only, which the filter removes: all documents of the category come instead."""
    category = analyses(t).agg(F.max("category")).first()[0]
    return _search(t, k=1, category=category, year=2019, month="ALL").drop("analysis")


# every fiftieth vector asks, with a category, a year and a month of its own or without
ASKED = f"""{ANALYSES}, asked AS (
  SELECT vec_id AS query_id, CAST(embedding AS DOUBLE[]) AS v,
         CASE WHEN vec_id % 3 = 1 THEN 'cat ' || label END AS want_category, CASE WHEN vec_id % 4 <> 1 THEN CAST(2018 + vec_id % 5 AS VARCHAR) END AS want_year,
         CASE vec_id % 7 WHEN 0 THEN 'ALL' WHEN 1 THEN NULL ELSE CAST(1 + vec_id % 6 AS VARCHAR) END AS want_month
  FROM embeddings WHERE vec_id % 50 = 0),
scored AS (SELECT q.query_id, q.want_category, q.want_year, q.want_month, a.*, list_cosine_similarity(CAST(embedding AS DOUBLE[]), v) AS score FROM analyses AS a, asked AS q),
kept AS (SELECT *, coalesce(contains(lower(category), lower(want_category)), TRUE) AND coalesce(want_year = CAST(year AS VARCHAR), TRUE)
                   AND (coalesce(want_month, 'ALL') = 'ALL' OR want_month = CAST(month AS VARCHAR)) AS meets FROM scored)"""
COLUMNS = "query_id, CAST(rank AS INTEGER) AS rank, category, year, month, subcategory"


def _answers(k: int, prefilter: bool) -> str:
    first = "WHERE meets" if prefilter else ""
    return f"""{ASKED}, best AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM kept {first} QUALIFY rank <= {k}),
    hits AS (SELECT * FROM best WHERE meets),
    answers AS (SELECT * FROM hits UNION ALL SELECT *, 1 AS rank FROM kept WHERE meets AND query_id NOT IN (SELECT query_id FROM hits))"""


def _asked(t):
    row, cell = t.embeddings.filter("vec_id % 50 = 0"), F.col("vec_id")
    month = F.when(cell % 7 == 0, "ALL").when(cell % 7 > 1, (F.lit(1) + cell % 6).cast("string"))
    return row.select(
        cell.alias("query_id"), F.col("embedding").alias("values"), F.when(cell % 3 == 1, F.concat(F.lit("cat "), "label")).alias("category"),
        F.when(cell % 4 != 1, (F.lit(2018) + cell % 5).cast("string")).alias("year"), month.alias("month"),
    )


def _table_search(t, **kw):
    rows = analyses(t)
    docs = rows.select("category", "year", "month", "subcategory", "analysis")
    return query_tables.search_table(_asked(t), rows.drop("analysis"), docs, row_id="vec_id", values="embedding", **kw)


@query("M01_search_query_table", f"WITH {_answers(25, False)} SELECT {COLUMNS} FROM answers")
def search_query_table(t):
    """All queries at once, each with its own filters; the best 25 are filtered, the rest falls back to its documents."""
    return _table_search(t).drop("analysis")


@query("M01_filtered_query_table", f"WITH {_answers(10, True)} SELECT {COLUMNS} FROM answers")
def filtered_query_table(t):
    return _table_search(t, k=10, prefilter=True).drop("analysis")


@query(
    "M03_query_table_report",
    f"""WITH {_answers(25, False)}, rows_ AS (
      SELECT query_id, rank, subcategory, 0 AS pos, 'Quality' AS aspect, quality_sentiment AS s, quality_summary AS m FROM answers
      UNION ALL SELECT query_id, rank, subcategory, 1, 'Price', price_sentiment, price_summary FROM answers)
    SELECT query_id, aspect, coalesce(arg_max_null(s, (rank, subcategory)), 'Unknown') AS sentiment,
      coalesce(arg_max_null(m, (rank, subcategory)), 'No summary available.') AS summary FROM rows_ GROUP BY query_id, aspect""",
)
def query_table_findings(t):
    """The merged findings of every query."""
    return retrieval.merge_aspects(_table_search(t), by=["query_id"]).select("query_id", "aspect", "sentiment", "summary")


MERGED = f"""{RANKED}, rows_ AS (
  SELECT rank, subcategory, 0 AS pos, 'Quality' AS aspect, quality_sentiment AS s, quality_summary AS m FROM best
  UNION ALL SELECT rank, subcategory, 1, 'Price', price_sentiment, price_summary FROM best),
merged AS (SELECT aspect, coalesce(arg_max_null(s, rank), 'Unknown') AS sentiment, coalesce(arg_max_null(m, rank), 'No summary available.') AS summary,
  min(rank * 10 + pos) AS first_seen FROM rows_ GROUP BY aspect)"""


def _merged(t):
    return retrieval.merge_aspects(_search(t))


@query("E15_last_wins_merge", f"WITH {MERGED} SELECT aspect, sentiment, summary FROM merged")
def last_wins_merge(t):
    return _merged(t).select("aspect", "sentiment", "summary")


@query(
    "M03_merged_findings",
    f"""WITH {ANALYSES}, rows_ AS (SELECT category, vec_id, subcategory, 'Quality' AS aspect, quality_sentiment AS s, quality_summary AS m FROM analyses WHERE year = 2018)
    SELECT aspect, coalesce(arg_max_null(s, subcategory), 'Unknown') AS sentiment, coalesce(arg_max_null(m, subcategory), 'No summary available.') AS summary FROM rows_ GROUP BY aspect
    UNION ALL SELECT 'Price', 'Mixed', coalesce(arg_max_null(price_summary, subcategory), 'No summary available.') FROM analyses WHERE year = 2018""",
)
def merged_findings(t):
    """All documents of a year, as the fallback finds them."""
    rows = analyses(t).filter("year = 2018").withColumn("rank", F.lit(1))
    return retrieval.merge_aspects(rows).select("aspect", "sentiment", "summary")


def _literal(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


@query(
    "B29_findings_report",
    f"""WITH {MERGED} SELECT {_literal(C.REPORT_HEAD)} || string_agg(CASE WHEN sentiment = 'Unknown' THEN '- **' || aspect || '**' || {_literal(C.REPORT_MISSING)}
    ELSE '- **' || aspect || '**:' || chr(10) || '  Sentiment: ' || sentiment || chr(10) || '  Summary: ' || summary || chr(10) || chr(10) END, '' ORDER BY first_seen)
    || {_literal(C.REPORT_TAIL)} AS report FROM merged""",
)
def findings_report(t):
    return retrieval.findings_report(_merged(t))


@query("M04_document_embedding")
def document_embedding(t):
    """Hashed term vectors; the hash is Spark's own, so rows only."""
    embedded = retrieval.embed(t.documents.select("doc_id", "text"))
    return embedded.select("doc_id", F.size("values").alias("dim"), F.round(retrieval.norm("values"), 6).alias("length"))


# --- summaries ----------------------------------------------------------------


def _key_sentences(name: str, source: str, key: str, text: str, n: int) -> str:
    """CTEs choosing the n best sentences of each key, like the operator."""
    return f"""{name}_cut AS (SELECT {key}, {S.sentences(text)} AS ss FROM {source}),
{name}_sent AS (SELECT {key}, unnest(ss) AS s, unnest(range(0, len(ss))) AS pos FROM {name}_cut),
{name}_tok AS (SELECT {key}, pos, unnest({S.tokens('lower(s)')}) AS tok FROM {name}_sent),
{name}_freq AS (SELECT {key}, tok, count(*) AS n FROM {name}_tok GROUP BY ALL),
{name}_score AS (SELECT {key}, pos, sum(n) / count(*) AS score FROM {name}_tok JOIN {name}_freq USING ({key}, tok) GROUP BY ALL),
{name}_rank AS (SELECT {key}, pos, row_number() OVER (PARTITION BY {key} ORDER BY score DESC, pos) AS rn FROM {name}_score),
{name} AS (SELECT {key}, string_agg(s, ' ' ORDER BY pos) AS summary FROM {name}_sent JOIN {name}_rank USING ({key}, pos) WHERE rn <= {n} GROUP BY ALL)"""


def _chunk_sql(n_words: int) -> str:
    return f"""word_lists AS (SELECT doc_id, {S.words('text')} AS ws FROM documents),
starts AS (SELECT *, unnest(range(0, len(ws), {n_words})) AS start FROM word_lists),
chunk_rows AS (SELECT doc_id, start // {n_words} AS chunk_no, array_to_string(list_slice(ws, start + 1, start + {n_words}), ' ') AS chunk FROM starts)"""


@query(
    "M05_running_summary",
    f"""WITH {_chunk_sql(1000)}, {_key_sentences('lv', 'chunk_rows', 'doc_id, chunk_no', 'chunk', 2)},
    joined_up AS (SELECT doc_id, string_agg(summary, chr(10) ORDER BY chunk_no) AS analysis FROM lv GROUP BY doc_id)
    SELECT doc_id, coalesce(analysis, 'No summary generated.') AS analysis FROM documents LEFT JOIN joined_up USING (doc_id)""",
)
def running_summary(t):
    return summaries.running_summary(t.documents, ["doc_id"], n_words=1000)


@query(
    "M06_hierarchical_summary",
    f"""WITH {_chunk_sql(400)}, {_key_sentences('lv', 'chunk_rows', 'doc_id, chunk_no', 'chunk', 2)},
    joined_up AS (SELECT doc_id, string_agg(summary, ' ' ORDER BY chunk_no) AS alltext FROM lv GROUP BY doc_id),
    {_key_sentences('top', 'joined_up', 'doc_id', 'alltext', 3)}
    SELECT doc_id, summary FROM top""",
)
def hierarchical_summary(t):
    return summaries.hierarchical_summary(t.documents, ["doc_id"])


# --- chains -------------------------------------------------------------------


# the report of the drawn rows: the sample takes the place of the joined view
SAMPLED = S.JOINED.replace("joined AS (", "every_row AS (") + """,
joined AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY review_month, rating ORDER BY md5(row_id || ':42'), row_id) AS rn,
  count(*) OVER (PARTITION BY review_month, rating) AS n FROM every_row
  WHERE review_time >= TIMESTAMP '1996-01-01' AND review_time < TIMESTAMP '2001-01-01') WHERE rn <= round_even(0.2 * n, 0))"""


@query("CH1_sample_quality_report", f"WITH {SAMPLED}, {REPORT_SQL}")
def sample_quality_report(t):
    """Window, draw 20 %, join metadata, validate, report."""
    sample = chains.settle(chains.sample_chain(t.reviews(), t.products(), "1996-01-01", "2000-12-31", 0.2))
    return chains.validate(sample, PROFILE)[1]


@query(
    "CH2_clean_reviews",
    f"""WITH {S.JOINED} SELECT row_id, CAST(rating AS TINYINT) AS rating, {S.clean("coalesce(title, 'unknown')")} AS title, md5({S.clean('text')}) AS text_md5,
    CASE WHEN price IS NULL THEN 'unknown' ELSE CAST(price AS VARCHAR) END AS price FROM joined
    QUALIFY row_number() OVER (PARTITION BY joined.* EXCLUDE (row_id) ORDER BY row_id) = 1""".replace("joined.* EXCLUDE (row_id)", "user_id, asin, rating, timestamp, helpful_vote, verified_purchase, title, text"),
)
def clean_reviews(t):
    cleaned = cleaning.clean_reviews(t.joined())
    return cleaned.select("row_id", "rating", "title", F.md5("text").alias("text_md5"), "price")


@query("CH3_training_chain")
def training_chain(t):
    """Sample, clean, tag and label: counts per aspect and label. The label model is iterative, so rows only."""
    stages = chains.training_chain(t.reviews(), t.products(), "1996-01-01", "2000-12-31", 0.2)
    return stages["labelled"].groupBy("sentiment_label", "rating").agg(F.count(F.lit(1)).alias("n"))


@query(
    "CH4_serving_chain",
    f"""WITH {S.JOINED}, r AS (SELECT *, row_number() OVER (PARTITION BY review_month, rating ORDER BY md5(row_id || ':42'), row_id) AS rn,
    count(*) OVER (PARTITION BY review_month, rating) AS n FROM joined WHERE year = 1996 AND review_month = 2)
    SELECT row_id, coalesce(price, 0) AS price, CAST(price IS NULL AS INTEGER) AS price_missing, CAST(helpful_vote AS INTEGER) AS helpful_vote,
    CAST(verified_purchase AS INTEGER) AS verified_purchase FROM r WHERE rn <= round_even(0.5 * n, 0)""",
)
def serving_chain(t):
    rows = chains.serving_chain(t.reviews(), t.products(), 1996, 2, 0.5)
    return rows.select("row_id", "price", "price_missing", "helpful_vote", "verified_purchase")


@query(
    "CH5_document_chain",
    f"""WITH {DOCS}, d AS (SELECT year, month, category, {S.words("string_agg(text, ' ' ORDER BY row_id)")} AS ws FROM doc_rows GROUP BY ALL),
    c AS (SELECT *, unnest(range(0, len(ws), 1000)) AS start FROM d),
    parts AS (SELECT year, month, category, CAST(start // 1000 AS BIGINT) AS chunk_no, array_to_string(list_slice(ws, start + 1, start + 1000), ' ') AS chunk FROM c),
    {_key_sentences('lv', 'parts', 'year, month, category, chunk_no', 'chunk', 2)} SELECT * FROM lv""",
)
def document_chain(t):
    rows, texts = t.joined_by_text()
    return chains.document_chain(rows, 1000, texts=texts)
