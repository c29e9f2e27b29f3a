"""A: scans, sources and sinks. Each writes given rows and reads them back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from reviewloom.catalog import query
from reviewloom.catalog import sql as S
from reviewloom.catalog.views import ANALYSES, analyses
from reviewloom.functions.columns import path_metadata, vector_key, without_extension
from reviewloom.functions.json_text import flatten_summaries
from reviewloom.operators import aggregates, metrics, periods, sampling
from reviewloom.session import scratch_path
from reviewloom.sources import keyed_files, readers, stored, writers

ORDER_DDL = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderpriority string"
ORDER_SQL = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders"
ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]


def _table_name() -> str:
    return f"reviewloom_{uuid.uuid4().hex}"


@query("A01_read_jsonl_gz", ORDER_SQL)
def read_jsonl_gz(t):
    path = writers.write_jsonl(t.orders.select(*ORDER_COLUMNS), scratch_path(t.spark, "jsonl"))
    return readers.read_jsonl(t.spark, path, ORDER_DDL)


@query("A02_read_jsonl_inferred", ORDER_SQL)
def read_jsonl_inferred(t):
    path = writers.write_jsonl(t.orders.select(*ORDER_COLUMNS), scratch_path(t.spark, "jsonl"))
    return readers.read_jsonl_inferred(t.spark, path)


@query("A03_read_csv_quoted", "SELECT doc_id, md5(text) AS text_md5, lang, source, n_chars FROM documents")
def read_csv_quoted(t):
    path = writers.write_stage(t.documents, scratch_path(t.spark, "csv"), fmt="csv")
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    return readers.read_csv(t.spark, path, schema).select("doc_id", F.md5("text").alias("text_md5"), "lang", "source", "n_chars")


@query(
    "A04_write_stage_partitioned",
    "SELECT o_orderkey, o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders",
)
def write_stage_partitioned(t):
    rows = t.orders.select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("year"))
    path = writers.write_stage(rows, scratch_path(t.spark, "stage"), by=["year"])
    return t.spark.read.parquet(path)


@query("A05_document_store_json", "SELECT doc_id, md5(text) AS text_md5, lang FROM documents")
def document_store_json(t):
    path = writers.write_documents(t.documents.select("doc_id", "text", "lang"), scratch_path(t.spark, "docs"), by=())
    back = readers.read_documents(t.spark, path, "doc_id bigint, text string, lang string")
    return back.select("doc_id", F.md5("text").alias("text_md5"), "lang")


@query(
    "A06_latest_dataset",
    """SELECT category, updated_at, path FROM (
         SELECT o_orderpriority AS category, strftime(o_orderdate, '%Y-%m-%d') AS updated_at,
                'run-' || o_orderkey AS path,
                row_number() OVER (PARTITION BY o_orderpriority
                  ORDER BY strftime(o_orderdate, '%Y-%m-%d') DESC, 'run-' || o_orderkey DESC) AS rn FROM orders)
       WHERE rn = 1""",
)
def latest_dataset(t):
    runs = t.orders.select(
        F.col("o_orderpriority").alias("category"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("updated_at"),
        F.concat(F.lit("run-"), "o_orderkey").alias("path"),
    )
    return periods.latest_run(runs, ["category"])


@query(
    "A07_scan_json_tree",
    "SELECT s_suppkey, s_name, 'block=' || (s_suppkey // 200) AS folder FROM supplier",
)
def scan_json_tree(t):
    record = F.to_json(F.struct("s_suppkey", "s_name"))
    rows = t.supplier.select(F.floor(F.col("s_suppkey") / 200).alias("block"), record.alias("record"))
    lists = rows.groupBy("block").agg(F.concat(F.lit("["), F.array_join(F.collect_list("record"), ","), F.lit("]")).alias("value"))
    path = scratch_path(t.spark, "tree")
    lists.write.partitionBy("block").text(path)
    found = readers.read_json_tree(t.spark, path, pattern="*.txt")
    return found.select(
        F.get_json_object("record", "$.s_suppkey").cast("bigint").alias("s_suppkey"),
        F.get_json_object("record", "$.s_name").alias("s_name"),
        F.regexp_extract("path", r"(block=\d+)", 1).alias("folder"),
    )


@query(
    "A08_write_summary_tree",
    f"""WITH {ANALYSES}
    SELECT category, year, month, subcategory AS product_type, 'Quality' AS aspect, quality_sentiment AS sentiment, quality_summary AS summary FROM analyses
    UNION ALL SELECT category, year, month, subcategory, 'Price', price_sentiment, price_summary FROM analyses""",
)
def write_summary_tree(t):
    flat = flatten_summaries(
        analyses(t).select(
            "category", "year", "month",
            F.concat(F.lit('{"product_summaries": {"'), "subcategory", F.lit('": '), "analysis", F.lit("}}")).alias("analysis"),
        )
    )
    path = writers.write_documents(flat, scratch_path(t.spark, "summaries"))
    schema = "product_type string, aspect string, sentiment string, summary string, category string, year int, month int"
    return t.spark.read.schema(schema).json(path)


@query(
    "A08_file_per_key",
    f"""WITH {ANALYSES}, flat AS (
      SELECT category, year, month, subcategory, 'Quality' AS aspect, quality_sentiment AS sentiment, quality_summary AS summary FROM analyses
      UNION ALL SELECT category, year, month, subcategory, 'Price', price_sentiment, price_summary FROM analyses)
    SELECT category, CAST(year AS VARCHAR) AS year, CAST(month AS VARCHAR) AS month, subcategory,
      sha256(subcategory || '_' || year || '_' || month) AS id, aspect, sentiment, summary FROM flat""",
)
def file_per_key(t):
    """A file per category, year, month and subcategory: written, read as a tree, keyed by its path."""
    flat = flatten_summaries(
        analyses(t).select(
            "category", "year", "month",
            F.concat(F.lit('{"product_summaries": {"'), "subcategory", F.lit('": '), "analysis", F.lit("}}")).alias("analysis"),
        )
    )
    rows = flat.withColumnRenamed("product_type", "subcategory")
    root = keyed_files.write_file_per_key(rows, scratch_path(t.spark, "RAG"), order=["aspect"])
    found = readers.read_json_tree(t.spark, root)
    # the path below the root, as keys are taken from it
    inside = F.concat(F.lit("RAG/"), F.substring_index(keyed_files.decoded("path"), "/", -4))
    placed = found.withColumn("m", path_metadata(inside))
    keys = {c: keyed_files.original(F.col(f"m.{c}")) for c in ("category", "year", "month")}
    keys["subcategory"] = keyed_files.original(without_extension(F.col("m.subcategory")))
    named = placed.select(*[v.alias(c) for c, v in keys.items()], F.from_json("record", "aspect string, sentiment string, summary string").alias("r"))
    return named.select("category", "year", "month", "subcategory", vector_key("subcategory", "year", "month").alias("id"), "r.*")


@query("A09_load_warehouse_table", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def load_warehouse_table(t):
    path = writers.write_stage(t.customer.select("c_custkey", "c_name", "c_acctbal"), scratch_path(t.spark, "csv"), fmt="csv")
    name = _table_name()
    writers.save_table(
        readers.read_csv(t.spark, path, "c_custkey bigint, c_name string, c_acctbal double"), name, scratch_path(t.spark, name)
    )
    return readers.read_table(t.spark, name)


@query("A10_full_table_scan", "SELECT * FROM supplier")
def full_table_scan(t):
    name = _table_name()
    writers.save_table(t.supplier, name, scratch_path(t.spark, name))
    return readers.read_table(t.spark, name)


@query("A11_create_or_append", "SELECT s_suppkey, s_name FROM supplier UNION ALL SELECT s_suppkey, s_name FROM supplier")
def create_or_append(t):
    name, path = _table_name(), scratch_path(t.spark, "append")
    rows = t.supplier.select("s_suppkey", "s_name")
    writers.drop_table(t.spark, name)
    for _ in range(2):
        writers.create_or_append(rows, name, path)
    return t.spark.table(name)


@query(
    "A12_upsert_latest",
    """SELECT user_id, event_type, event_id, value FROM (
         SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events)
       WHERE rn = 1""",
)
def upsert_latest(t):
    rows = t.events.select("user_id", "event_type", "ts", "event_id", "value")
    old, new = rows.filter(F.col("event_id") % 2 == 0), rows.filter(F.col("event_id") % 2 == 1)
    return aggregates.upsert_latest(old, new, ["user_id", "event_type"], ["ts", "event_id"]).drop("ts")


@query(
    "A12_stored_upsert",
    """SELECT user_id, event_type, event_id, value FROM (
         SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events)
       WHERE rn = 1""",
)
def stored_upsert(t):
    """Three upserts one after the other into a stored table."""
    rows = t.events.select("user_id", "event_type", "ts", "event_id", "value")
    path = scratch_path(t.spark, "keyed")
    for i in range(3):
        stored.upsert_stored(rows.filter(F.col("event_id") % 3 == i), path, ["user_id", "event_type"], ["ts", "event_id"], buckets=16)
    return stored.read_stored(t.spark, path, rows.schema).drop("ts")


@query(
    "A13_write_metrics",
    f"""WITH {S.PREDICTIONS}
    SELECT CAST(year AS VARCHAR) AS slice_value, count(*) AS samples FROM predictions GROUP BY year
    UNION ALL SELECT 'All', count(*) FROM predictions""",
)
def write_metrics(t):
    table = metrics.slice_metrics(t.predictions(), slices=["year"]).select("slice_value", "samples")
    path = writers.write_metrics(table, scratch_path(t.spark, "metrics"))
    return t.spark.read.schema("slice_value string, samples bigint").json(f"{path}/json")


@query(
    "A14_all_categories_one_job",
    f"""WITH {S.JOINED}, ranked AS (
      SELECT row_id, main_category, review_month, rating,
             row_number() OVER (PARTITION BY main_category, review_month, rating ORDER BY md5(row_id || ':42'), row_id) AS rn,
             count(*) OVER (PARTITION BY main_category, review_month, rating) AS n
      FROM joined WHERE main_category IS NOT NULL)
    SELECT row_id, main_category, review_month, rating FROM ranked WHERE rn <= round_even(0.3 * n, 0)""",
)
def all_categories_one_job(t):
    drawn = sampling.stratified_sample(
        t.joined().drop("text"), ["main_category", "review_month", "rating"], frac=0.3
    )
    return drawn.select("row_id", "main_category", "review_month", "rating")
