"""Hard negatives from a vertical scan: columns in each anchor's order, a bitmap of candidates that shrinks.

For each anchor the columns are read in descending magnitude of the anchor's own components, a few at a time. After each
step the part of the inner product that is still unread lies between bounds: the sum over unread columns of the least and
the greatest product that the column's minimum and maximum allow, and the product of the unread lengths of both vectors.
Candidates whose bounds leave the wanted window lose their bit, and later columns are read for the rest only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewloom.llm.blocks import every_block, finite, members, pack, unpack
from reviewloom.llm.registry import query, table
from reviewloom.session import settle

POSITIVES = 5
NEGATIVES = 5
EVERY = 100
SCALE = 256
# a negative scores at least FLOOR / 100 of its positive, and at most as much as it
FLOOR = 80
# columns read between two looks at the bounds
STEP = 8
ROWS_IN_BLOCK = 8192
ANCHORS_IN_BLOCK = 256
# products above this are not whole in doubles and take Python's integers
EXACT = 2.0**53
LIMITS = -(2**63), 2**63 - 1

SAME = "a_rid long, anchor_id long, p_rid long, positive_id long, positive_score long"
OTHER = "a_rid long, anchor_id long, p_rid long, positive_id long, positive_score long, n_rid long, negative_id long, negative_score long"


class Columns:
    """A block of integer vectors by column, with what the bounds need."""

    def __init__(self, x: np.ndarray):
        self.rows = x
        self.x = np.ascontiguousarray(x.T, np.float64)
        self.low, self.high = self.x.min(1, initial=np.inf), self.x.max(1, initial=-np.inf)
        self.energy = (self.x**2).sum(0)
        self.most = float(np.abs(self.x).max(initial=0))
        self.read = self.whole = 0

    def scan(self, q: np.ndarray, alive: np.ndarray, wanted) -> tuple[np.ndarray, np.ndarray]:
        """(rows, scores) of the candidates left in the bitmap ``alive`` when all columns are read.

        ``wanted(lower, upper)`` tells from the bounds which candidates may still matter.
        """
        self.whole += int(alive.sum()) * len(q)
        if float(np.abs(q.astype(np.float64)).max(initial=0)) * self.most * max(1, len(q)) >= EXACT:
            at = np.flatnonzero(alive)
            self.read += len(at) * len(q)
            scores = (self.rows[at].astype(object) * q.astype(object)).sum(1) if len(q) else np.zeros(len(at), object)
            return at, np.array([min(max(int(s), LIMITS[0]), LIMITS[1]) for s in scores], np.int64)
        q = q.astype(np.float64)
        order = np.argsort(-np.abs(q), kind="stable")
        ends = np.stack([q * self.low, q * self.high])[:, order]
        # what the columns from each place on may add at least and at most, and the anchor's length in them
        least, most = (np.append(np.cumsum(e[::-1])[::-1], 0) for e in (ends.min(0), ends.max(0)))
        length = np.append(np.cumsum((q[order] ** 2)[::-1])[::-1], 0)
        at = np.flatnonzero(alive)
        # a little more energy than there is covers rounding
        partial, energy = np.zeros(len(at)), self.energy[at] * (1 + 1e-12)
        for i in range(0, len(q), STEP):
            if not len(at):
                break
            columns, j = order[i : i + STEP], min(i + STEP, len(q))
            part = self.x[columns] if len(at) == self.x.shape[1] else self.x[columns[:, None], at]
            self.read += part.size
            partial = partial + q[columns] @ part
            energy = energy - (part**2).sum(0)
            reach = np.sqrt(length[j] * np.maximum(energy, 0)) * (1 + 1e-9)
            keep = wanted(partial + np.maximum(least[j], -reach), partial + np.minimum(most[j], reach))
            if not keep.all():
                at, partial, energy = at[keep], partial[keep], energy[keep]
        alive[:] = False
        alive[at] = True
        return at, partial.astype(np.int64)


def _kth(values: np.ndarray, k: int) -> float:
    return np.partition(values, len(values) - k)[len(values) - k] if len(values) >= k else -np.inf


def _first(k: int, scores: np.ndarray, ids: np.ndarray, rids: np.ndarray) -> np.ndarray:
    return np.lexsort((rids, ids, ~scores))[:k]


def nearest(block: Columns, q: np.ndarray, alive: np.ndarray, ids: np.ndarray, rids: np.ndarray, k: int):
    """(rows, scores) of the k highest scores among the candidates, ties to the smaller id."""
    at, scores = block.scan(q, alive, lambda lower, upper: upper >= _kth(lower, k))
    best = _first(k, scores, ids[at], rids[at])
    return at[best], scores[best]


def in_windows(block: Columns, q: np.ndarray, alive: np.ndarray, ids: np.ndarray, rids: np.ndarray, tops: np.ndarray, k: int, floor: int):
    """For each window (floor percent of a top, the top) the (rows, scores) of its k highest scores, ties to the smaller id."""
    highest = sorted({int(t) for t in tops if t >= 0})

    def wanted(lower, upper):
        keep = np.zeros(len(lower), bool)
        for top in highest:
            bottom = floor * top / 100 * (1 - 1e-12)
            sure = lower[(lower >= floor * top / 100 * (1 + 1e-12)) & (upper <= top)]
            keep |= (upper >= max(bottom, _kth(sure, k))) & (lower <= top)
        return keep

    at, scores = block.scan(q, alive, wanted)
    whole = [int(s) for s in scores]
    found = []
    for top in map(int, tops):
        fits = np.array([floor * top <= 100 * s <= 100 * top for s in whole], bool)
        inside = at[fits]
        best = _first(k, scores[fits], ids[inside], rids[inside])
        found.append((inside[best], scores[fits][best]))
    return found


def _batch(schema: str, columns: list[list[np.ndarray]]) -> pa.RecordBatch:
    names = [f.split()[0] for f in schema.split(", ")]
    arrays = [pa.array(np.concatenate([np.zeros(0, np.int64), *c]), pa.int64()) for c in columns]
    return pa.RecordBatch.from_arrays(arrays, names)


def _opened(pair: dict):
    width = max(pair["width"], pair["q_width"])
    return unpack(pair, "q_", width), unpack(pair, "", width)


def _same_label(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                (a_ids, a_rids, a_labels, q), (ids, rids, labels, x) = _opened(batch.slice(i, 1).to_pylist()[0])
                block, out = Columns(x), [[] for _ in range(5)]
                for row in range(len(q)):
                    at, scores = nearest(block, q[row], (labels == a_labels[row]) & (rids != a_rids[row]), ids, rids, k)
                    same = np.ones(len(at), np.int64)
                    for column, value in zip(out, (a_rids[row] * same, a_ids[row] * same, rids[at], ids[at], scores)):
                        column.append(value)
                yield _batch(SAME, out)

    return run


def _other_labels(k: int, floor: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                pair = batch.slice(i, 1).to_pylist()[0]
                (a_ids, a_rids, a_labels, q), (ids, rids, labels, x) = _opened(pair)
                positives = {}
                for p in pair["q_positives"]:
                    positives.setdefault(p["a_rid"], []).append((p["p_rid"], p["positive_id"], p["positive_score"]))
                block, out = Columns(x), [[] for _ in range(8)]
                for row in range(len(q)):
                    mine = positives.get(int(a_rids[row]), [])
                    if not mine:
                        continue
                    found = in_windows(block, q[row], labels != a_labels[row], ids, rids, np.array([p[2] for p in mine]), k, floor)
                    for (p_rid, p_id, p_score), (at, scores) in zip(mine, found):
                        same = np.ones(len(at), np.int64)
                        values = [v * same for v in (int(a_rids[row]), int(a_ids[row]), p_rid, p_id, p_score)] + [rids[at], ids[at], scores]
                        for column, value in zip(out, values):
                            column.append(value)
                yield _batch(OTHER, out)

    return run


def _ranked(hits: DataFrame, keys: list[str], score: str, ids: list[str], k: int) -> DataFrame:
    place = Window.partitionBy(*keys).orderBy(F.desc(score), *ids)
    return hits.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= k)


def hard_negatives(
    vectors: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES, every: int = EVERY, floor: int = FLOOR,
    rows_in_block: int = ROWS_IN_BLOCK,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score of every anchor and each of its positives.

    ``vectors`` holds vec_id, embedding and label. Anchors are the rows whose id is divisible by ``every``. An anchor's
    positives are its ``positives`` highest-scoring other rows of its label; the negatives of a positive are the first
    ``negatives`` rows of other labels with floor * positive_score <= 100 * negative_score <= 100 * positive_score.
    Scores are inner products of components floored after scaling; ties go to the smaller id.

    Rows with a null id, label or vector, or with null or non-finite components, take no part. Rows are told apart by
    position: a repeated id is a candidate like any other, and each anchor row gets results of its own. Shorter vectors
    count as filled up with zeros; components and scores outside 64 bits stop at its ends. An anchor without positives,
    and a positive without negatives (one with a negative score, for one), has no rows. Other columns are not read; empty
    tables give no rows.

    Bounded blocks of anchors meet bounded blocks of rows twice, for positives and then for negatives; a pair of blocks
    hands on a few rows for each anchor. Rows are dealt to blocks evenly, so a label that holds most rows, or a group of
    equal vectors, fills no block more than others.
    """
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE).cast("long"))
    rows = vectors.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite("embedding"))
    rows = settle(
        rows.select(
            F.col("vec_id").cast("long").alias("id"), F.monotonically_increasing_id().alias("rid"), F.col("label").cast("long").alias("label"), whole.alias("vector")
        )
    )
    chosen = rows.filter(F.col("id") % every == 0)
    sizes = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("id") % every == 0).alias("q")).first()
    cores = rows.sparkSession.sparkContext.defaultParallelism
    n_parts = max(1, -(-sizes["n"] // rows_in_block), min(2 * cores, -(-sizes["n"] // 512)))
    q_parts = max(1, -(-sizes["q"] // ANCHORS_IN_BLOCK))
    blocks = settle(pack(rows, n_parts, rows_in_block))
    anchors = settle(pack(chosen, q_parts, ANCHORS_IN_BLOCK))
    same = every_block(blocks, anchors, n_parts, q_parts).mapInArrow(_same_label(positives), SAME)
    best = settle(_ranked(same, ["a_rid"], "positive_score", ["positive_id", "p_rid"], positives).drop("rank"))
    # a block of anchors carries the positives of its rows, at most ``positives`` for each
    positive = F.struct("a_rid", "p_rid", "positive_id", "positive_score")
    carried = members(anchors).withColumnRenamed("rid", "a_rid").join(best, "a_rid").groupBy("part").agg(F.collect_list(positive).alias("positives"))
    other = every_block(blocks, anchors.join(carried, "part"), n_parts, q_parts).mapInArrow(_other_labels(negatives, floor), OTHER)
    ranked = _ranked(other, ["a_rid", "p_rid"], "negative_score", ["negative_id", "n_rid"], negatives)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


SQL = f"""
WITH v AS (
  SELECT row_number() OVER () AS rid, CAST(vec_id AS BIGINT) AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS ints
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c AS (SELECT rid, id, label, unnest(ints) AS x, unnest(range(len(ints))) AS i FROM v),
s AS (
  SELECT a.rid AS a_rid, a.id AS anchor_id, a.label = c.label AS same, c.rid, c.id, CAST(sum(a.x * c.x) AS BIGINT) AS score
  FROM c AS a JOIN c ON a.i = c.i AND a.rid <> c.rid WHERE a.id % {EVERY} = 0 GROUP BY ALL),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a_rid ORDER BY score DESC, id, rid) <= {POSITIVES})
SELECT p.anchor_id, p.id AS positive_id,
  CAST(row_number() OVER (PARTITION BY p.a_rid, p.rid ORDER BY n.score DESC, n.id, n.rid) AS INTEGER) AS rank,
  n.id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM p JOIN s AS n ON n.a_rid = p.a_rid AND NOT n.same AND {FLOOR} * p.score <= 100 * n.score AND n.score <= p.score
QUALIFY rank <= {NEGATIVES}
"""


@query("op11_bond_negatives", SQL)
def _op11(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(vectors.withColumn("label", moved))
