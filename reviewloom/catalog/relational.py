"""C to H: filters, joins, aggregations, windows, sorts and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from reviewloom.catalog import query
from reviewloom.catalog import sql as S
from reviewloom.catalog.views import ANALYSES, analyses
from reviewloom.functions.text import word_count
from reviewloom.operators import aggregates, filters, joins, metrics, periods, quality, query_tables, retrieval, sampling
from reviewloom.schemas import REVIEW_DDL, from_ddl


# --- C: filters ---------------------------------------------------------------


@query(
    "C01_training_window",
    f"WITH {S.REVIEWS} SELECT row_id, rating FROM reviews WHERE review_time BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1997-12-31'",
)
def training_window(t):
    return filters.in_window(t.reviews(), "1996-01-01", "1997-12-31", end_inclusive_day=False).select("row_id", "rating")


@query(
    "C01_training_window_whole_days",
    "SELECT event_id FROM events WHERE ts >= TIMESTAMP '2024-01-02' AND ts < TIMESTAMP '2024-01-06'",
)
def training_window_whole_days(t):
    rows = t.events.select("event_id", F.col("ts").cast("timestamp").alias("review_time"))
    return filters.in_window(rows, "2024-01-02", "2024-01-05").select("event_id")


@query(
    "C02_serving_month",
    f"WITH {S.REVIEWS} SELECT row_id, review_date_timestamp FROM reviews WHERE review_date_timestamp BETWEEN '1996-02-01 00:00:00' AND '1996-02-29 23:59:59'",
)
def serving_month(t):
    return filters.in_month(t.reviews(), 1996, 2).select("row_id", "review_date_timestamp")


@query("C03_fixed_window", f"WITH {S.REVIEWS} SELECT row_id, year FROM reviews WHERE review_time BETWEEN TIMESTAMP '1998-01-01' AND TIMESTAMP '2000-12-31'")
def fixed_window(t):
    return filters.in_window(t.reviews(), "1998-01-01", "2000-12-31", end_inclusive_day=False).select("row_id", "year")


@query("C04_text_and_rating", f"WITH {S.RAW} SELECT row_id, title AS text, rating FROM raw_reviews WHERE title IS NOT NULL AND rating IS NOT NULL")
def text_and_rating(t):
    return filters.with_text_and_rating(t.raw_reviews().select("row_id", F.col("title").alias("text"), "rating"))


@query(
    "C05_split_by_year",
    f"WITH {S.REVIEWS} SELECT row_id, CASE WHEN year = 2000 THEN 'late' ELSE 'early' END AS part FROM reviews WHERE year IN (1998, 1999, 2000)",
)
def split_by_year(t):
    early, late = filters.split_by_year(t.reviews().select("row_id", "year"), (1998, 1999), 2000)
    return early.select("row_id", F.lit("early").alias("part")).unionByName(late.select("row_id", F.lit("late").alias("part")))


@query("C06_min_words", f"WITH w AS (SELECT doc_id, CAST(len({S.words('text')}) AS INTEGER) AS n FROM documents) SELECT * FROM w WHERE n >= 8")
def min_words(t):
    return filters.min_words(t.documents, 8).select("doc_id", word_count("text").alias("n"))


@query("C07_browse_products", "SELECT DISTINCT p_type, p_name FROM part WHERE p_brand = 'Brand#2'")
def browse_products(t):
    return filters.browse(t.part, {"p_brand": "Brand#2"}, ["p_type", "p_name"])


@query("C08_hit_filter", f"WITH {ANALYSES} SELECT vec_id FROM analyses WHERE lower(category) LIKE '%at 1%' AND year = 2019")
def hit_filter(t):
    return filters.hit_filter(analyses(t), "AT 1", 2019, "ALL").select("vec_id")


@query(
    "C09_combination_counts",
    f"WITH {S.PREDICTIONS} SELECT label, prediction, year, count(*) AS n FROM predictions WHERE label <> prediction GROUP BY ALL",
)
def combination_counts(t):
    return filters.combination_counts(t.predictions(), F.col("label") != F.col("prediction"), ["label", "prediction", "year"])


@query("C10_valid_vectors", "SELECT vec_id FROM embeddings WHERE vec_id % 3 <> 0 AND vec_id % 5 <> 0")
def valid_vectors(t):
    cut = F.when(F.col("vec_id") % 3 == 0, F.slice("embedding", 1, 10)).otherwise(F.col("embedding"))
    rows = t.embeddings.select("vec_id", cut.alias("values"), F.when(F.col("vec_id") % 5 != 0, F.lit("m")).alias("meta"))
    return filters.valid_vectors(rows, 64, meta="meta").select("vec_id")


# --- D: joins -----------------------------------------------------------------


@query("D01_join_metadata", f"WITH {S.JOINED} SELECT row_id, parent_asin, product_name, main_category, price, rating_number FROM joined")
def join_metadata(t):
    return t.joined().select("row_id", "parent_asin", "product_name", "main_category", "price", "rating_number")


@query(
    "D01_join_metadata_null_safe",
    f"""WITH {S.REVIEWS}, {S.PRODUCTS}, meta AS (SELECT CASE WHEN parent_asin = '7' THEN NULL ELSE parent_asin END AS k, product_name FROM products)
    SELECT row_id, parent_asin, meta.product_name FROM reviews LEFT JOIN meta ON parent_asin IS NOT DISTINCT FROM k""",
)
def join_metadata_null_safe(t):
    meta = t.products().withColumn("parent_asin", F.when(F.col("parent_asin") != "7", F.col("parent_asin")))
    return joins.join_metadata(t.reviews(), meta, null_safe=True).select("row_id", "parent_asin", "product_name")


@query(
    "D02_stratum_count",
    f"WITH {S.REVIEWS} SELECT row_id, review_month, rating, count(*) OVER (PARTITION BY review_month, rating) AS count FROM reviews",
)
def stratum_count(t):
    return joins.with_stratum_count(t.reviews().select("row_id", "review_month", "rating"), ["review_month", "rating"])


@query("D03_attach_predictions", f"WITH {S.PREDICTIONS} SELECT row_id, raw_reviews.rating, prediction FROM raw_reviews JOIN predictions USING (row_id)")
def attach_predictions(t):
    return joins.attach(t.raw_reviews().select("row_id", "rating"), t.predictions().select("row_id", "prediction"))


@query(
    "D04_flagged_survivors",
    f"WITH {S.RAW} SELECT row_id FROM raw_reviews WHERE title IS NOT NULL AND length(text) > 5000",
)
def flagged_survivors(t):
    rows = t.raw_reviews()
    flags = quality.row_violations(rows.select("row_id", "text"), rules=["length"]).filter("check = 'long_reviews'")
    return joins.flagged_survivors(rows.filter("title is not null"), flags).select("row_id")


@query(
    "D05_membership",
    """SELECT o_orderkey, 'with customer' AS kind FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
    UNION ALL SELECT o_orderkey, 'without' FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
    UNION ALL SELECT o_orderkey, 'status' FROM orders WHERE o_orderstatus NOT IN ('F', 'O')""",
)
def membership(t):
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus")
    known = t.customer.filter("c_mktsegment = 'BUILDING'").select("c_custkey")
    parts = {
        "with customer": joins.inside(rows, "o_custkey", known),
        "without": joins.outside(rows, "o_custkey", known),
        "status": joins.outside(rows, "o_orderstatus", ["F", "O"]),
    }
    return aggregates.union_by_name(*[p.select("o_orderkey", F.lit(k).alias("kind")) for k, p in parts.items()])


@query("D06_documents_of_hits", f"WITH {ANALYSES} SELECT vec_id, category, subcategory, quality_summary FROM analyses WHERE vec_id % 4 = 0")
def documents_of_hits(t):
    docs = analyses(t)
    hits = docs.filter("vec_id % 4 = 0").select("vec_id", "category", "year", "month", "subcategory")
    found = joins.documents_of(hits, docs.drop("vec_id", "embedding"))
    return found.select("vec_id", "category", "subcategory", F.get_json_object("analysis", "$.Quality.summary").alias("quality_summary"))


@query(
    "D07_join_bloat",
    f"""WITH {S.REVIEWS}, meta AS (SELECT CAST(p_partkey // 2 AS VARCHAR) AS parent_asin FROM part)
    SELECT (SELECT count(*) FROM reviews) AS rows_before, (SELECT count(*) FROM reviews LEFT JOIN meta USING (parent_asin)) AS rows_after,
    (SELECT count(*) FROM (SELECT parent_asin FROM meta GROUP BY 1 HAVING count(*) > 1)) AS repeated_keys,
    (SELECT count(*) FROM reviews) = (SELECT count(*) FROM reviews LEFT JOIN meta USING (parent_asin)) AS no_bloat""",
)
def join_bloat(t):
    meta = t.part.select(F.floor(F.col("p_partkey") / 2).cast("string").alias("parent_asin"))
    return joins.join_bloat(t.reviews().select("row_id", "parent_asin"), meta)


# --- E: aggregations ----------------------------------------------------------


@query("E01_strata_counts", f"WITH {S.REVIEWS} SELECT review_month, rating, count(*) AS count FROM reviews GROUP BY ALL")
def strata_counts(t):
    return aggregates.strata_counts(t.reviews())


@query("E03_value_counts", f"WITH {S.JOINED} SELECT main_category, count(*) AS n FROM joined WHERE main_category IS NOT NULL GROUP BY ALL")
def value_counts(t):
    return aggregates.value_counts(t.joined(), "main_category")


@query("E04_distinct_values", "SELECT DISTINCT event_type FROM events")
def distinct_values(t):
    return aggregates.distinct_values(t.events, "event_type")


@query("E04_count_distinct", "SELECT count(DISTINCT user_id) AS users, count(DISTINCT event_type) AS kinds FROM events")
def count_distinct(t):
    return t.events.agg(F.countDistinct("user_id").alias("users"), F.countDistinct("event_type").alias("kinds"))


NULL_COLUMNS = ["row_id", "title", "parent_asin", "product_name", "price", "rating"]


@query(
    "E05_null_counts",
    f"WITH {S.JOINED}, c AS (SELECT "
    + ", ".join(f"count(*) - count({c}) AS {c}" for c in NULL_COLUMNS)
    + " FROM joined) "
    + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", {c} AS nulls FROM c" for c in NULL_COLUMNS)
    + f" UNION ALL SELECT '(all)', {' + '.join(NULL_COLUMNS)} FROM c",
)
def null_counts(t):
    return aggregates.null_counts(t.joined().select(*NULL_COLUMNS))


@query(
    "E06_mean_std",
    """SELECT 'l_quantity' AS "column", round(avg(l_quantity), 6) AS mean, round(stddev_samp(l_quantity), 6) AS std FROM lineitem
    UNION ALL SELECT 'l_discount', round(avg(l_discount), 6), round(stddev_samp(l_discount), 6) FROM lineitem""",
)
def mean_std(t):
    got = aggregates.mean_std(t.lineitem, ["l_quantity", "l_discount"])
    return got.select("column", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"))


def _quartile_sql(table: str, col: str) -> str:
    return (
        f"SELECT '{col}' AS \"column\", round(q1, 6) AS q1, round(q3, 6) AS q3, round(q1 - 1.5 * (q3 - q1), 6) AS low, "
        f"round(q3 + 1.5 * (q3 - q1), 6) AS high FROM (SELECT quantile_cont({col}, 0.25) AS q1, quantile_cont({col}, 0.75) AS q3 FROM {table})"
    )


@query("E07_quartile_fences", " UNION ALL ".join(_quartile_sql("lineitem", c) for c in ("l_extendedprice", "l_quantity")))
def quartile_fences(t):
    got = aggregates.quartile_fences(t.lineitem, ["l_extendedprice", "l_quantity"])
    return got.select("column", *[F.round(c, 6).alias(c) for c in ("q1", "q3", "low", "high")])


@query(
    "E08_class_shares",
    f"""WITH {S.PREDICTIONS} SELECT label, count(*) AS n, round(count(*) / (SELECT count(*) FROM predictions), 6) AS share,
    count(*) / (SELECT count(*) FROM predictions) < 0.25 AS is_minority FROM predictions GROUP BY label""",
)
def class_shares(t):
    return aggregates.class_shares(t.predictions(), "label", 0.25).withColumn("share", F.round("share", 6))


@query("E09_repeated_keys", f"WITH {S.RAW} SELECT asin, count(*) AS n FROM raw_reviews WHERE asin IS NOT NULL GROUP BY asin HAVING count(*) > 1")
def repeated_keys(t):
    return aggregates.repeated_keys(t.raw_reviews(), "asin")


@query(
    "E10_data_card",
    """SELECT 'c_custkey' AS "column", 'bigint' AS type, count(*) AS n_rows, count(*) - count(c_custkey) AS nulls, CAST(min(c_custkey) AS VARCHAR) AS smallest, CAST(max(c_custkey) AS VARCHAR) AS largest FROM customer
    UNION ALL SELECT 'c_mktsegment', 'string', count(*), count(*) - count(c_mktsegment), min(c_mktsegment), max(c_mktsegment) FROM customer
    UNION ALL SELECT 'c_acctbal', 'double', count(*), count(*) - count(c_acctbal), CAST(min(c_acctbal) AS VARCHAR), CAST(max(c_acctbal) AS VARCHAR) FROM customer""",
)
def data_card(t):
    return aggregates.data_card(t.customer.select("c_custkey", "c_mktsegment", "c_acctbal"))


@query("E16_latest_period", f"WITH {S.JOINED} SELECT main_category, max(year) AS year, CAST(max(year * 100 + review_month) % 100 AS INTEGER) AS month FROM joined WHERE main_category IS NOT NULL GROUP BY 1")
def latest_period(t):
    return aggregates.latest_period(t.joined().filter("main_category is not null"), by=["main_category"])


# --- F: windows ---------------------------------------------------------------


@query(
    "F01_fraction_per_stratum",
    """WITH r AS (SELECT event_id, event_type, row_number() OVER (PARTITION BY event_type ORDER BY md5(event_id || ':7'), event_id) AS rn,
      count(*) OVER (PARTITION BY event_type) AS n FROM events) SELECT event_id, event_type FROM r WHERE rn <= round_even(0.25 * n, 0)""",
)
def fraction_per_stratum(t):
    rows = t.events.select("event_id", "event_type")
    return sampling.stratified_sample(rows, ["event_type"], 0.25, seed=7, row_id="event_id")


@query(
    "F02_later_copies",
    "SELECT doc_id AS row_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY text, lang ORDER BY doc_id) AS rn FROM documents) WHERE rn > 1",
)
def later_copies(t):
    return quality.duplicates(t.documents.select(F.col("doc_id").alias("row_id"), "text", "lang")).select("row_id")


@query(
    "F03_split_by_position",
    """WITH r AS (SELECT event_id, row_number() OVER (ORDER BY ts, event_id) - 1 AS pos, count(*) OVER () AS n FROM events)
    SELECT event_id, CASE WHEN pos < floor(n * 0.7::DOUBLE) THEN 'train' WHEN pos < floor(n * (0.7::DOUBLE + 0.2::DOUBLE)) THEN 'val' ELSE 'test' END AS split FROM r""",
)
def split_by_position(t):
    rows = t.events.select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    return sampling.time_split(rows, "ts", 0.7, 0.2, row_id="event_id").select("event_id", "split")


@query(
    "F04_latest_per_key",
    "SELECT user_id, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1",
)
def latest_per_key(t):
    rows = t.events.select("user_id", "ts", "event_id", "value")
    return aggregates.latest_per_key(rows, ["user_id"], ["ts", "event_id"]).drop("ts")


@query(
    "F05_z_score_rows",
    "SELECT event_id AS row_id FROM events, (SELECT avg(value) AS m, stddev_samp(value) AS s FROM events) WHERE abs((value - m) / s) > 3",
)
def z_score_rows(t):
    profile = quality.Profile(outliers=["value"])
    return quality.outliers(t.events.withColumnRenamed("event_id", "row_id"), profile).select("row_id")


# --- G: sorts, limits ---------------------------------------------------------


@query("G01_sort_by_time", "SELECT event_id, user_id, value FROM events ORDER BY ts, event_id")
def sort_by_time(t):
    return t.events.orderBy("ts", "event_id").select("event_id", "user_id", "value")


@query("G02_first_rows", f"WITH {S.RAW} SELECT row_id, title FROM raw_reviews ORDER BY row_id LIMIT 25")
def first_rows(t):
    return t.raw_reviews().select("row_id", "title").orderBy("row_id").limit(25)


@query("G03_best_runs", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def best_runs(t):
    return metrics.best_runs(t.orders.select("o_orderkey", "o_totalprice"), "o_totalprice", 10, ["o_orderkey"])


@query(
    "G04_nearest_vectors",
    """WITH q AS (SELECT CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE vec_id = 0)
    SELECT vec_id, round(list_cosine_similarity(CAST(embedding AS DOUBLE[]), v), 5) AS score FROM embeddings, q
    ORDER BY list_cosine_similarity(CAST(embedding AS DOUBLE[]), v) DESC, vec_id LIMIT 10""",
)
def nearest_vectors(t):
    target = t.embeddings.filter("vec_id = 0").first()["embedding"]
    best = retrieval.top_k(t.embeddings, target, 10, "embedding", "vec_id")
    return best.select("vec_id", F.round("score", 5).alias("score"))


@query(
    "G04_nearest_for_query_table",
    """SELECT q.vec_id AS query_id, v.vec_id, round(list_cosine_similarity(CAST(v.embedding AS DOUBLE[]), CAST(q.embedding AS DOUBLE[])), 5) AS score,
      CAST(row_number() OVER (PARTITION BY q.vec_id ORDER BY list_cosine_similarity(CAST(v.embedding AS DOUBLE[]), CAST(q.embedding AS DOUBLE[])) DESC, v.vec_id) AS INTEGER) AS rank
    FROM embeddings AS q, embeddings AS v WHERE q.vec_id % 50 = 0 QUALIFY rank <= 10""",
)
def nearest_for_query_table(t):
    """The ten nearest rows of every fiftieth vector, among all rows."""
    asked = t.embeddings.filter("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("values"))
    best = query_tables.top_k_table(asked, t.embeddings, 10, row_id="vec_id", values="embedding")
    return best.select("query_id", "vec_id", F.round("score", 5).alias("score"), "rank")


@query(
    "G05_newest_artifact",
    """SELECT strftime(o_orderdate, '%Y-%m-%d') AS updated_at, 'model-' || o_orderkey AS path FROM orders
    ORDER BY updated_at DESC, path DESC LIMIT 1""",
)
def newest_artifact(t):
    runs = t.orders.select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("updated_at"), F.concat(F.lit("model-"), "o_orderkey").alias("path"))
    return periods.latest_run(runs)


# --- H: set operations --------------------------------------------------------


@query(
    "H01_union_by_name",
    "SELECT c_custkey AS key, c_name AS name, c_mktsegment AS segment FROM customer UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier",
)
def union_by_name(t):
    people = t.customer.select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    return aggregates.union_by_name(people, t.supplier.select(F.col("s_name").alias("name"), F.col("s_suppkey").alias("key")))


@query("H02_distinct_rows", "SELECT min(doc_id) AS row_id, md5(text) AS text_md5, lang FROM documents GROUP BY text, lang")
def distinct_rows(t):
    rows = t.documents.select(F.col("doc_id").alias("row_id"), "text", "lang")
    return aggregates.distinct_rows(rows).select("row_id", F.md5("text").alias("text_md5"), "lang")


@query("H03_intersect_ids", "SELECT doc_id FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)")
def intersect_ids(t):
    return joins.flagged_survivors(t.documents.select("doc_id"), t.labels, "doc_id")


@query(
    "H04_extra_columns",
    f"""WITH {S.JOINED} SELECT 'review_time' AS "column", count(*) - count(review_time) AS nulls FROM joined
    UNION ALL SELECT 'row_id', count(*) - count(row_id) FROM joined""",
)
def extra_columns(t):
    rows = t.joined()
    extra = [r["column"] for r in aggregates.extra_columns(rows, from_ddl(REVIEW_DDL).names).collect()]
    return aggregates.null_counts(rows.select(*extra)).filter("column <> '(all)'")
