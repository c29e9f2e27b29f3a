"""Exact top-k search that prunes with segment means and deviations, coarse to fine."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewloom.llm.blocks import FIELDS, pack, unpack
from reviewloom.llm.registry import query, table
from reviewloom.session import settle

TOP = 5
EVERY = 50
SCALE = 256
# segments of the coarse and the fine bound
LEVELS = (4, 16)
VECTORS_IN_BLOCK = 8192
QUERIES_IN_BLOCK = 1024
# pairs of a block whose bounds are looked up one by one instead of all together
SPARSE = 1 / 16

HITS = "q_rid long, query_id long, v_rid long, vec_id long, score long"


def statistics(x: np.ndarray, segments: int) -> np.ndarray:
    """For each segment its mean and its deviation, both scaled by the root of its length."""
    cuts = np.linspace(0, x.shape[1], min(segments, max(1, x.shape[1])) + 1).astype(int)
    parts = []
    for a, b in zip(cuts[:-1], cuts[1:]):
        piece = x[:, a:b]
        root = np.sqrt(max(1, b - a))
        mean = piece.sum(1) / max(1, b - a)
        parts += [mean * root, np.sqrt(((piece - mean[:, None]) ** 2).sum(1))]
    return np.stack(parts, 1)


def _exact(q: np.ndarray, v: np.ndarray, pairs: tuple[np.ndarray, np.ndarray] | None = None):
    """Integer inner products, of all pairs or the given ones; results outside 64 bits stop at its ends."""
    high = float(np.abs(q.astype(np.float64)).max(initial=0)) * float(np.abs(v.astype(np.float64)).max(initial=0)) * max(1, q.shape[1])
    if high < 2.0**53:
        fq, fv = q.astype(np.float64), v.astype(np.float64)
        if pairs is None:
            return (fq @ fv.T).astype(np.int64)
        return np.einsum("ij,ij->i", fq[pairs[0]], fv[pairs[1]]).astype(np.int64)
    oq, ov = q.astype(object), v.astype(object)
    out = oq @ ov.T if pairs is None else (oq[pairs[0]] * ov[pairs[1]]).sum(1)
    return np.clip(out, -(2**63), 2**63 - 1).astype(np.int64)


def best_of_block(q: np.ndarray, q_rids: np.ndarray, v: np.ndarray, v_rids: np.ndarray, v_ids: np.ndarray, k: int):
    """(query row, vector row, score) of the k best partners of each query within the block, ties to the smaller id.

    For one segment of l components the inner product is at most l * (mean * mean + deviation * deviation), that is
    the squared distance is at least l * ((difference of means)^2 + (difference of deviations)^2). Pairs whose bound
    stays below a score that k partners reach are dropped at each level; the rest is computed exactly.
    """
    if not len(q) or not len(v):
        return np.zeros(0, int), np.zeros(0, int), np.zeros(0, np.int64)
    fq, fv = q.astype(np.float64), v.astype(np.float64)
    # rounding of the bounds, far above what doubles lose
    slack = 1e-9 * np.outer(np.sqrt((fq**2).sum(1)), np.sqrt((fv**2).sum(1))) + 0.5
    own = q_rids[:, None] == v_rids[None, :]
    bound = statistics(fq, LEVELS[0]) @ statistics(fv, LEVELS[0]).T + slack
    bound[own] = -np.inf
    take = min(k, len(v))
    # the most promising partners give a score that the k best reach
    tried = np.argpartition(-bound, take - 1, axis=1)[:, :take]
    at = np.repeat(np.arange(len(q)), take), tried.ravel()
    reached = _exact(q, v, at).reshape(len(q), take).astype(np.float64)
    reached[np.take_along_axis(own, tried, 1)] = -np.inf
    least = reached.min(1) if take == k else np.full(len(q), -np.inf)
    alive = (bound >= least[:, None]) & ~own
    for segments in LEVELS[1:]:
        sq, sv = statistics(fq, segments), statistics(fv, segments)
        if alive.mean() > SPARSE:
            alive &= sq @ sv.T + slack >= least[:, None]
        else:
            rows, cols = np.nonzero(alive)
            gone = np.einsum("ij,ij->i", sq[rows], sv[cols]) + slack[rows, cols] < least[rows]
            alive[rows[gone], cols[gone]] = False
    if alive.mean() > SPARSE:
        every = _exact(q, v)
        # of the many that are left only those that may be among the k best are sorted
        every[~alive] = np.iinfo(np.int64).min
        alive &= every >= np.partition(every, -take, axis=1)[:, -take, None]
        rows, cols = np.nonzero(alive)
        scores = every[rows, cols]
    else:
        rows, cols = np.nonzero(alive)
        scores = _exact(q, v, (rows, cols))
    order = np.lexsort((v_rids[cols], v_ids[cols], ~scores, rows))
    rows, cols, scores = rows[order], cols[order], scores[order]
    first = np.searchsorted(rows, rows)
    keep = np.arange(len(rows)) - first < k
    return rows[keep], cols[keep], scores[keep]


def _search(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pair in batch.to_pylist():
                width = max(pair["q_width"], pair["width"])
                q_ids, q_rids, _, q = unpack(pair, "q_", width)
                v_ids, v_rids, _, v = unpack(pair, "", width)
                rows, cols, scores = best_of_block(q, q_rids, v, v_rids, v_ids, k)
                yield pa.RecordBatch.from_pydict(
                    {"q_rid": q_rids[rows], "query_id": q_ids[rows], "v_rid": v_rids[cols], "vec_id": v_ids[cols], "score": scores}
                )

    return run


def top_k(vectors: DataFrame, k: int = TOP, every: int = EVERY) -> DataFrame:
    """query_id, rank, vec_id, score: the k best partners of every row whose id is divisible by ``every``.

    Vectors are floored to integers after scaling; the score is the integer inner product. Vectors that are null or
    hold null or non-finite components, and rows without an id, take no part. Rows are told apart by position: a row
    that repeats an id is a partner like any other, and each query row gets results of its own. A shorter vector
    counts as padded with zeros. Components and scores outside 64 bits stop at its ends. Ties go to the smaller id.
    Other columns are not read; empty tables give no rows.

    Queries and vectors are packed into bounded blocks, integers in the narrowest type; each block of queries meets each
    block of vectors once, without a broadcast. A pair of blocks keeps k rows for each query, so what is shuffled is
    small, and groups of equal vectors are spread like any others.
    """
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE).cast("long"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    rows = vectors.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & finite)
    narrow = [F.col("vec_id").cast("long").alias("id"), F.monotonically_increasing_id().alias("rid"), F.lit(0).cast("long").alias("label")]
    rows = settle(rows.select(*narrow, whole.alias("vector")))
    queries = rows.filter(F.col("id") % every == 0)
    sizes = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("id") % every == 0).alias("q")).first()
    cores = rows.sparkSession.sparkContext.defaultParallelism
    n_parts = max(1, -(-sizes["n"] // VECTORS_IN_BLOCK), min(2 * cores, -(-sizes["n"] // 512)))
    q_parts = max(1, -(-sizes["q"] // QUERIES_IN_BLOCK))
    blocks = pack(rows, n_parts, VECTORS_IN_BLOCK)
    asked = pack(queries, q_parts, QUERIES_IN_BLOCK).select(
        F.explode(F.sequence(F.lit(0), F.lit(n_parts - 1))).alias("part"), *[F.col(c).alias(f"q_{c}") for c in FIELDS if c != "part"]
    )
    # a copy of the queries for every block of vectors: Spark can't tell their size, and broadcasting would bring all of them to the driver
    pairs = blocks.join(asked.hint("merge"), "part").repartition(max(1, min(n_parts * q_parts, 20_000)))
    hits = pairs.mapInArrow(_search(k), HITS)
    place = Window.partitionBy("q_rid").orderBy(F.desc("score"), "vec_id", "v_rid")
    ranked = hits.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


SQL = f"""
WITH v AS (
  SELECT row_number() OVER () AS rid, CAST(vec_id AS BIGINT) AS id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS ints
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c AS (SELECT rid, id, unnest(ints) AS x, unnest(range(len(ints))) AS i FROM v),
s AS (
  SELECT q.rid AS q_rid, q.id AS query_id, c.rid AS v_rid, c.id AS vec_id, CAST(sum(q.x * c.x) AS BIGINT) AS score
  FROM c AS q JOIN c ON q.i = c.i AND q.rid <> c.rid WHERE q.id % {EVERY} = 0 GROUP BY ALL)
SELECT query_id, CAST(row_number() OVER (PARTITION BY q_rid ORDER BY score DESC, vec_id, v_rid) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= {TOP}
"""


@query("op9_segment_top_k", SQL)
def _op9(spark, sf_dir):
    return top_k(table(spark, sf_dir, "embeddings"))
