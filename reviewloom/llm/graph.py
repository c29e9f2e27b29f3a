"""Approximate nearest neighbours by inner product: a robust-pruned directed graph for each shard of the vectors.

The largest inner product becomes the least distance when each vector gets one more component, the root of what its
squared length lacks of the greatest in its shard. The graph is built over the distinct vectors of a shard: greedy
searches from the entry points propose neighbours, and a proposal is dropped when a neighbour already taken lies nearer to
it, by the relaxing factor, than the node itself. A query runs a beam search over the graph of every shard.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewloom.llm.blocks import every_block, finite, pack, unpack
from reviewloom.llm.registry import query, table
from reviewloom.session import scratch_path, settle

TOP = 20
EVERY = 20
SHARD_ROWS = 8192
QUERIES_IN_BLOCK = 1024
# edges of a node, beam of the searches that build and that answer, relaxing factors of the two rounds
DEGREE = 32
BUILD_BEAM = 48
BEAM = 160
RELAXED = (1.2, 2.0)
# beam entries followed in one step, entry points, searches side by side, proposals looked at for one node
FOLLOWED = 4
ENTRIES = 32
TOGETHER = 256
PROPOSED = 128

INDEX = "part int, n int, width int, kind string, ids binary, rids binary, labels binary, data binary, starts binary, members binary, nodes int, edges binary"
HITS = "q_rid long, query_id long, v_rid long, vec_id long, score double"


class Graph:
    """Distinct vectors of a shard and their edges."""

    def __init__(self, x: np.ndarray, edges: np.ndarray | None = None):
        x = x.astype(np.float64)
        self.scale = float(np.abs(x).max(initial=0)) or 1.0
        x = x / self.scale
        squared = (x**2).sum(1)
        more = np.sqrt(np.maximum(squared.max(initial=0) - squared, 0))
        self.points = np.concatenate([x, more[:, None]], 1).astype(np.float32)
        self.norms = (self.points**2).sum(1)
        self.edges = edges
        # entry points all over the shard, and the longest vectors, near which many queries end
        spread = np.linspace(0, max(0, len(x) - 1), min(len(x), ENTRIES)).astype(np.int64)
        self.entries = np.union1d(spread, np.argsort(-squared, kind="stable")[:ENTRIES])

    def raised(self, q: np.ndarray) -> np.ndarray:
        """Queries in the space of the points; each is brought to length one, which leaves its order of points alone."""
        q = q.astype(np.float64)
        q = q / np.maximum(np.abs(q).max(1, initial=0), 1e-300)[:, None]
        q = q / np.maximum(np.sqrt((q**2).sum(1)), 1e-300)[:, None]
        return np.concatenate([q, np.zeros((len(q), 1))], 1).astype(np.float32)

    def beam(self, q: np.ndarray, width: int, own: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(nodes, distances) of the ``width`` nearest nodes that greedy searches meet, nearest first; -1 where there are fewer.

        The distance leaves out the square of the query. ``own`` names nodes that are not to be returned.
        """
        n, entries = len(self.points), self.entries if len(self.points) > width else np.arange(len(self.points))
        rows = np.arange(len(q))[:, None]
        seen = np.zeros((len(q), n + 1), bool)
        seen[:, n] = True
        seen[:, entries] = True
        if own is not None:
            # it is passed through at the start, since its edges lead to its neighbourhood
            seen[rows[:, 0], own] = True
        nodes = np.broadcast_to(entries, (len(q), len(entries)))
        away = self.norms[entries] - 2 * (q @ self.points[entries].T)
        if own is not None:
            away = np.where(nodes == own[:, None], np.inf, away)
        nodes, away, open_ = self._trimmed(nodes, away, np.isfinite(away), width)
        while True:
            turn = np.argsort(~open_, 1, kind="stable")[:, :FOLLOWED]
            going = open_[rows, turn]
            if not going.any():
                return np.where(np.isfinite(away), nodes, -1), away
            open_[rows, turn] = False
            new = np.where(going[:, :, None], self.edges[nodes[rows, turn]], -1).reshape(len(q), -1)
            new = np.sort(np.where(new < 0, n, new), 1)
            fresh = ~seen[rows, new]
            fresh[:, 1:] &= new[:, 1:] != new[:, :-1]
            at, place = np.nonzero(fresh)
            found = new[at, place]
            seen[at, found] = True
            distances = np.full(new.shape, np.inf, np.float32)
            distances[at, place] = self.norms[found] - 2 * np.einsum("ij,ij->i", self.points[found], q[at])
            nodes, away, open_ = self._trimmed(
                np.concatenate([nodes, new], 1), np.concatenate([away, distances], 1), np.concatenate([open_, fresh], 1), width
            )

    @staticmethod
    def _trimmed(nodes, away, open_, width):
        order = np.argsort(away, 1, kind="stable")[:, :width]
        rows = np.arange(len(nodes))[:, None]
        return nodes[rows, order], away[rows, order], open_[rows, order]

    def pruned(self, node: np.ndarray, proposed: np.ndarray, relaxed: float) -> np.ndarray:
        """At most DEGREE diverse neighbours of each node out of its proposals (-1: none)."""
        n = len(self.points)
        proposed = np.sort(np.where((proposed < 0) | (proposed == node[:, None]), n, proposed), 1)
        proposed[:, 1:][proposed[:, 1:] == proposed[:, :-1]] = n
        points = np.concatenate([self.points, np.zeros((1, self.points.shape[1]), np.float32)])
        norms = np.append(self.norms, np.inf).astype(np.float32)
        rows = np.arange(len(node))[:, None]
        away = norms[proposed] - 2 * np.einsum("ijk,ik->ij", points[proposed], self.points[node]) + self.norms[node][:, None]
        order = np.argsort(away, 1, kind="stable")[:, :PROPOSED]
        proposed, away = proposed[rows, order], away[rows, order]
        there = points[proposed]
        apart = np.matmul(there, there.transpose(0, 2, 1))
        square = np.where(proposed < n, norms[np.minimum(proposed, n - 1)], 0)
        apart = square[:, :, None] + square[:, None, :] - 2 * apart
        alive = proposed < n
        edges = np.full((len(node), DEGREE), -1, np.int32)
        one = rows[:, 0]
        for i in range(DEGREE):
            if not alive.any():
                break
            first = alive.argmax(1)
            some = alive[one, first]
            edges[some, i] = proposed[one, first][some]
            alive &= (relaxed**2 * apart[one, first] > away) | ~some[:, None]
            alive[one, first] = False
        return edges

    def build(self, seed: int = 0) -> Graph:
        """Random edges at first, then a round of searches and pruning for each relaxing factor."""
        n, draw = len(self.points), np.random.default_rng(seed)
        self.edges = draw.integers(0, max(1, n), (n, DEGREE)).astype(np.int32)
        if n <= DEGREE:
            self.edges = np.where(np.arange(DEGREE) < n, np.arange(DEGREE), -1) * np.ones((n, 1), int)
            self.edges[self.edges == np.arange(n)[:, None]] = -1
            return self
        for relaxed in RELAXED:
            for lo in range(0, n, TOGETHER):
                node = np.arange(lo, min(n, lo + TOGETHER))
                # a point is searched for as a point, with its last component
                met, _ = self.beam(self.points[node], BUILD_BEAM, node)
                self.edges[node] = self.pruned(node, np.concatenate([met, self.edges[node]], 1), relaxed)
                self._backwards(node, relaxed)
        return self

    def _backwards(self, node: np.ndarray, relaxed: float) -> None:
        """Edges from the new neighbours back to the nodes; full lists are pruned again."""
        source = np.repeat(node, DEGREE)
        target = self.edges[node].ravel()
        source, target = source[target >= 0], target[target >= 0]
        have = (self.edges[target] == source[:, None]).any(1)
        source, target = source[~have], target[~have]
        order = np.argsort(target, kind="stable")
        source, target = source[order], target[order]
        heads, first, counts = np.unique(target, return_index=True, return_counts=True)
        for lo in range(0, len(heads), TOGETHER):
            some = slice(lo, lo + TOGETHER)
            more = np.full((len(heads[some]), counts[some].max()), -1, np.int64)
            inside = np.arange(more.shape[1]) < counts[some][:, None]
            more[inside] = source[np.repeat(first[some], counts[some]) + np.nonzero(inside)[1]]
            wide = np.concatenate([self.edges[heads[some]], more], 1)
            fits = (wide >= 0).sum(1) <= DEGREE
            kept = np.take_along_axis(wide, np.argsort(wide < 0, 1, kind="stable"), 1)[:, :DEGREE]
            if not fits.all():
                kept[~fits] = self.pruned(heads[some][~fits], wide[~fits], relaxed)
            self.edges[heads[some]] = kept


def _distinct(x: np.ndarray, ids: np.ndarray, rids: np.ndarray):
    """Distinct vectors; rows in the order of (vector, id, rid) and where each vector's rows start."""
    x = np.ascontiguousarray(x + 0.0)
    as_bytes = x.view(np.dtype((np.void, max(1, x.dtype.itemsize * x.shape[1])))).ravel() if x.shape[1] else np.zeros(len(x), "V1")
    _, first, which = np.unique(as_bytes, return_index=True, return_inverse=True)
    order = np.lexsort((rids, ids, which))
    return x[first], order, np.searchsorted(which[order], np.arange(len(first) + 1))


def _indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            cell = batch.slice(i, 1)
            ids, rids, _, x = unpack(cell.to_pylist()[0])
            vectors, order, starts = _distinct(x, ids, rids)
            edges = Graph(vectors).build().edges.astype(np.int32)
            more = [starts.astype(np.int32).tobytes(), order.astype(np.int32).tobytes(), len(vectors), edges.tobytes()]
            arrays = [pa.array([v], t) for v, t in zip(more, (pa.binary(), pa.binary(), pa.int32(), pa.binary()))]
            yield pa.RecordBatch.from_arrays([*cell.columns, *arrays], [*cell.schema.names, "starts", "members", "nodes", "edges"])


def answer(cell: dict, k: int, beam: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, row of the shard, score) of the k nearest rows that a beam search of one shard finds, without the query's own."""
    width = max(cell["width"], cell["q_width"])
    q_ids, q_rids, _, q = unpack(cell, "q_", width)
    ids, rids, _, x = unpack(cell, "", width)
    starts, order = (np.frombuffer(cell[c], np.int32).astype(np.int64) for c in ("starts", "members"))
    x64, q64 = x.astype(np.float64), q.astype(np.float64)
    graph = Graph(x[order[starts[:-1]]], np.frombuffer(cell["edges"], np.int32).reshape(cell["nodes"], DEGREE))
    out = []
    for lo in range(0, len(q), TOGETHER):
        met, _ = graph.beam(graph.raised(q[lo : lo + TOGETHER]), max(beam, k + 1))
        at, place = np.nonzero(met >= 0)
        node = met[at, place]
        # equal vectors share their score: the k + 1 of the least ids are enough
        copies = np.minimum(starts[node + 1] - starts[node], k + 1)
        at, begin = np.repeat(at, copies) + lo, np.repeat(starts[node], copies)
        row = order[begin + np.arange(len(begin)) - np.repeat(np.cumsum(copies) - copies, copies)]
        other = rids[row] != q_rids[at]
        at, row = at[other], row[other]
        score = np.einsum("ij,ij->i", q64[at], x64[row])
        best = np.lexsort((rids[row], ids[row], -score, at))
        at, row, score = at[best], row[best], score[best]
        keep = np.arange(len(at)) - np.searchsorted(at, at) < k
        out.append((at[keep], row[keep], score[keep]))
    return tuple(np.concatenate(c) for c in zip(*out))


def _answered(k: int, beam: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                cell = batch.slice(i, 1).to_pylist()[0]
                at, row, score = answer(cell, k, beam)
                names = ["q_rid", "query_id", "v_rid", "vec_id", "score"]
                q_ids, q_rids, ids, rids = (np.frombuffer(cell[c], np.int64) for c in ("q_ids", "q_rids", "ids", "rids"))
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in (q_rids[at], q_ids[at], rids[row], ids[row], score)], names)

    return run


def usable(vectors: DataFrame) -> DataFrame:
    """id, rid, label (0) and vector of the rows that take part."""
    some = F.exists("embedding", lambda x: x != 0)
    rows = vectors.filter(F.col("vec_id").isNotNull() & finite("embedding") & some)
    return settle(
        rows.select(
            F.col("vec_id").cast("long").alias("id"), F.monotonically_increasing_id().alias("rid"), F.lit(0).cast("long").alias("label"), F.col("embedding").alias("vector")
        )
    )


def _parts(rows: DataFrame, n: int, size: int) -> int:
    return max(1, -(-n // size), min(rows.sparkSession.sparkContext.defaultParallelism, n // 2048))


def build_index(rows: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row for each shard of :func:`usable` rows: its vectors and its graph, stored in the shared folder."""
    path = scratch_path(rows.sparkSession, "graph")
    kind = np.float32 if rows.schema["vector"].dataType.elementType.typeName() == "float" else np.float64
    parts = _parts(rows, rows.count(), shard_rows)
    pack(rows, parts, shard_rows, kind).mapInArrow(_indexed, INDEX).write.parquet(path)
    return rows.sparkSession.read.schema(INDEX).parquet(path)


def search(index: DataFrame, rows: DataFrame, k: int = TOP, beam: int = BEAM) -> DataFrame:
    """query_id, rank, vec_id and score of the k nearest rows found for each of the query rows (as :func:`usable` gives them)."""
    parts = (index.agg(F.max("part")).first()[0] or 0) + 1
    q_parts = max(1, -(-rows.count() // QUERIES_IN_BLOCK))
    kind = np.float32 if rows.schema["vector"].dataType.elementType.typeName() == "float" else np.float64
    pairs = every_block(index, pack(rows, q_parts, QUERIES_IN_BLOCK, kind), parts, q_parts)
    place = Window.partitionBy("q_rid").orderBy(F.desc("score"), "vec_id", "v_rid")
    ranked = pairs.mapInArrow(_answered(k, beam), HITS).withColumn("rank", F.row_number().over(place))
    return ranked.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def neighbours(vectors: DataFrame, k: int = TOP, every: int = EVERY, beam: int = BEAM, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest other rows found for every row whose id is divisible by ``every``.

    Nearness is the largest inner product in double precision of the vectors as given; ties go to the smaller id. Rows
    with a null id, and vectors that are null, all zero or hold null or non-finite components, take no part. Rows are told
    apart by position: a repeated id is a candidate like any other, and each query row gets results of its own. Equal
    vectors of a shard are one node, whose rows are all found with it. Shorter vectors count as filled up with zeros.
    With k candidates or fewer in all, all are returned. Other columns are not read; empty tables give no rows.

    All rows are indexed, dealt evenly over shards of at most ``shard_rows``; nothing is sampled. The index is a table in
    the shared folder, one row a shard. Bounded blocks of queries visit every shard, and a visit hands on k rows a query.
    """
    rows = usable(vectors)
    return search(build_index(rows, shard_rows), rows.filter(F.col("id") % every == 0), k, beam)


@query("op12_pruned_graph")
def _op12(spark, sf_dir):
    return neighbours(table(spark, sf_dir, "embeddings"))
