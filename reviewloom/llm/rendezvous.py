"""Sharding by weighted rendezvous hashing, in DataFrame functions alone."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewloom.llm.registry import query, table

SHARDS = 40
NULL_KEY = "\\N"
# slots that one row unfolds at once
SPAN = 100_000


def _cost(key: Column, shard: Column, weight: Column) -> Column:
    """-ln(u) / weight with u drawn from (key, shard); the least cost wins with a chance in proportion to the weight."""
    digits = F.substring(F.md5(F.concat(key, F.lit("#"), shard.cast("string"))), 1, 13)
    u = (F.conv(digits, 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))
    return -F.log(u) / weight


def key_text(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(NULL_KEY))


def shard_of(key: Column, weights: Sequence[float], first: int = 0) -> Column:
    """struct(cost, shard) of the shard that wins a key among shards ``first``, ``first`` + 1, ..."""
    costs = F.transform(
        F.array(*[F.struct(F.lit(first + i).alias("shard"), F.lit(float(w)).alias("weight")) for i, w in enumerate(weights)]),
        lambda s: F.struct(_cost(key, s["shard"], s["weight"]).alias("cost"), s["shard"].alias("shard")),
    )
    return F.array_min(costs)


def shard_records(rows: DataFrame, key: str, weights: Sequence[float], out: str = "shard") -> DataFrame:
    """Add the shard of each record; the record key and the weights alone decide.

    A shard added at the end takes records only into itself, in proportion to its weight, and a changed weight
    moves records only to or from that shard. Null keys share one place of their own; equal keys share a shard.
    An input column named ``out`` is replaced. No shuffle.
    """
    if not weights or any(w <= 0 for w in weights):
        raise ValueError("shards need positive weights")
    return rows.withColumn(out, shard_of(key_text(key), weights)["shard"])


def number_slots(rows: DataFrame, shard: str, order: Sequence[str], pieces: int = 256) -> DataFrame:
    """Add ``slot``, gapless from 0 in each shard; only ``shard`` and ``order`` columns are kept.

    Equal rows are counted first and unfolded last, in spans of at most SPAN slots that are dealt over the tasks, so a
    row repeated without bound costs one row a span in the shuffles and no long array.
    A shard is numbered in ``pieces`` pieces by digest, each starting at the total of those before it: the totals
    are at most shards x pieces rows.
    """
    order = list(order)
    digest = F.md5(F.concat_ws("#", *[F.coalesce(F.col(c).cast("string"), F.lit(NULL_KEY)) for c in order]))
    piece = (F.conv(F.substring(digest, 1, 6), 16, 10).cast("long") % pieces).cast("int")
    counted = rows.groupBy(shard, *order).agg(F.count(F.lit(1)).alias("_n")).withColumn("_piece", piece)
    totals = counted.groupBy(shard, "_piece").agg(F.sum("_n").alias("_total"))
    before = Window.partitionBy(shard).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(shard, "_piece", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy(shard, "_piece").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = counted.withColumn("_local", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
    placed = local.join(F.broadcast(offsets), [shard, "_piece"])
    start = F.col("_offset") + F.col("_local")
    spans = placed.select(shard, *order, (start + F.col("_n")).alias("_end"), F.explode(F.sequence(start, start + F.col("_n") - 1, F.lit(SPAN).cast("long"))).alias("_start"))
    # an explicit number, since small partitions would be put together again before they unfold
    spans = spans.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), shard, "_start")
    slots = F.sequence("_start", F.least(F.col("_start") + SPAN, F.col("_end")) - 1)
    return spans.select(shard, *order, F.explode(slots).alias("slot"))


def place(documents: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Digest rows of all documents with their shard, slot and the shard after one more shard is added.

    Null texts count as no bytes (checksum 0), a null doc_id is a key of its own, repeated rows get slots of their
    own, an empty table gives no rows; further input columns are not read.
    """
    content = F.coalesce(F.col("text"), F.lit(""))
    rows = documents.select(
        "doc_id",
        (F.octet_length(content).cast("long") + 16).alias("size"),
        F.crc32(content.cast("binary")).alias("text_crc32"),
    )
    best = shard_of(key_text("doc_id"), [1.0] * shards)
    added = shard_of(key_text("doc_id"), [1.0], first=shards)
    chosen = rows.withColumn("_best", best).withColumn("_grown", F.least("_best", added)["shard"])
    chosen = chosen.select("doc_id", "size", "text_crc32", F.col("_best.shard").alias("shard"), F.col("_grown").alias("grown_shard"))
    slots = number_slots(chosen, "shard", ["doc_id", "size", "text_crc32", "grown_shard"])
    return slots.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


_CRC_TABLE = (
    "list_transform(range(256), lambda n: list_reduce(range(8), "
    "lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n))"
)

SQL = f"""
WITH table_ AS (SELECT {_CRC_TABLE} AS t),
docs AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, octet_length(encode(coalesce(text, ''))) AS n, hex(encode(coalesce(text, ''))) AS h, coalesce(CAST(doc_id AS VARCHAR), '\\N') AS key FROM documents),
costs AS (
  SELECT rid, CAST(i AS INTEGER) AS i,
    -ln((CAST(CAST('0x' || substr(md5(key || '#' || i), 1, 13) AS BIGINT) AS DOUBLE) + 0.5) / 4503599627370496.0) AS cost
  FROM docs, range({SHARDS + 1}) AS s(i)),
best AS (
  SELECT rid, arg_min(i, cost) FILTER (WHERE i < {SHARDS}) AS shard, arg_min(i, cost) AS grown_shard FROM costs GROUP BY rid),
rows_ AS (
  SELECT doc_id, n + 16 AS size, shard, grown_shard,
    CAST(xor(list_reduce(list_transform(range(n), lambda k: CAST(CAST('0x' || substr(h, 2 * k + 1, 2) AS INTEGER) AS BIGINT)),
      lambda c, b: xor(t[xor(c & 255, b) + 1], c >> 8), CAST(4294967295 AS BIGINT)), 4294967295) AS BIGINT) AS text_crc32
  FROM docs JOIN best USING (rid), table_),
pieces AS (
  SELECT *, CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '\\N') || '#' || size || '#' || text_crc32 || '#' || grown_shard), 1, 6) AS BIGINT) % 256 AS piece FROM rows_)
SELECT doc_id, size, text_crc32, 'key' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY piece, doc_id NULLS FIRST, size, text_crc32, grown_shard) - 1 AS slot, grown_shard
FROM pieces
"""


@query("op4_rendezvous_shards", SQL)
def _op4(spark, sf_dir):
    return place(table(spark, sf_dir, "documents"))
