"""Nearest documents for a whole table of queries: bounded blocks of queries meet bounded blocks of vectors."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewloom.session import settle

VECTORS_IN_BLOCK = 8192
QUERIES_IN_BLOCK = 1024
# queries of a block that meet a block of vectors at once: bounds the matrix of scores, some 8 MB
QUERIES_AT_ONCE = 128
# rounding of a matrix product; candidates this close to the last place are scored again one by one
SLACK = 1e-9
FACETS = ("category", "year", "month")
PLACE = ("category", "year", "month", "subcategory")


def _packed(rows: DataFrame, parts: int, size: int) -> DataFrame:
    """Rows (id, values, one text for each facet) dealt evenly over numbered parts, at most ``size`` of them in a row."""
    lists = ["id", *[c for c in rows.columns if c not in ("id", "values")]]
    fields = [T.StructField("part", T.IntegerType()), T.StructField("width", T.IntegerType()), T.StructField("data", T.BinaryType()), T.StructField("sizes", T.BinaryType())]
    schema = T.StructType(fields + [T.StructField(c, T.ArrayType(rows.schema[c].dataType)) for c in lists])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, size):
                piece = batch.slice(lo, size)
                sizes = np.diff(np.asarray(piece["values"].offsets))
                x = np.zeros((piece.num_rows, sizes.max(initial=0)))
                x[np.arange(x.shape[1]) < sizes[:, None]] = np.asarray(piece["values"].flatten())
                ends = pa.array([0, piece.num_rows], pa.int32())
                first = [pa.array([piece["part"][0].as_py()], pa.int32()), pa.array([x.shape[1]], pa.int32()), pa.array([x.tobytes()]), pa.array([sizes.tobytes()])]
                # an offset keeps a slice from being read whole
                columns = [pa.ListArray.from_arrays(ends, pa.concat_arrays([piece[c]])) for c in lists]
                yield pa.RecordBatch.from_arrays(first + columns, schema.names)

    dealt = rows.repartition(parts).select(F.spark_partition_id().alias("part"), *rows.columns)
    return dealt.mapInArrow(run, schema)


def _matrix(row: dict, width: int) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.frombuffer(row["sizes"], np.int32)
    x = np.frombuffer(row["data"], np.float64).reshape(len(sizes), row["width"])
    return np.pad(x, ((0, 0), (0, width - x.shape[1]))), sizes


def _sequential(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row inner products, added from the first component to the last."""
    return np.cumsum(a * b, axis=1)[:, -1] if a.shape[1] else np.zeros(len(a))


def _allowed(asked: dict, held: dict, facets: Sequence[str]) -> np.ndarray | bool:
    """Which rows each query's own facets let in; a facet without a value lets all in, a category is contained in the row's."""
    out = True
    for c in facets:
        wants, held_values = sorted({v for v in asked[c] if v is not None}), sorted({v for v in held[c] if v is not None})
        table = np.zeros((len(wants) + 1, len(held_values) + 1), bool)
        table[-1] = True
        for i, want in enumerate(wants):
            table[i, :-1] = [want.lower() in v.lower() if c == "category" else want == v for v in held_values]
        want_code = {v: i for i, v in enumerate(wants)} | {None: len(wants)}
        have_code = {v: i for i, v in enumerate(held_values)} | {None: len(held_values)}
        out = out & table[np.ix_([want_code[v] for v in asked[c]], [have_code[v] for v in held[c]])]
    return out


def _best(asked: dict, held: dict, k: int, facets: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, score) of the k most similar rows of a block for each query, best first, ties to the smaller id."""
    width = max(asked["width"], held["width"])
    (q, q_sizes), (v, v_sizes) = _matrix(asked, width), _matrix(held, width)
    q_norm, v_norm = np.sqrt(_sequential(q, q)), np.sqrt(_sequential(v, v))
    with np.errstate(divide="ignore", invalid="ignore"):
        q_unit, v_unit = q / q_norm[:, None], (v / v_norm[:, None]).T
    place = np.empty(v.shape[0], np.int64)
    place[sorted(range(len(place)), key=held["id"].__getitem__)] = np.arange(len(place))
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
    for lo in range(0, len(q), QUERIES_AT_ONCE):
        now = slice(lo, lo + QUERIES_AT_ONCE)
        some = {c: asked[c][now] for c in facets}
        fits = (q_sizes[now, None] == v_sizes) & (q_norm[now] > 0)[:, None] & (v_norm > 0) & _allowed(some, held, facets)
        with np.errstate(divide="ignore", invalid="ignore"):
            rough = np.where(fits, q_unit[now] @ v_unit, -np.inf)
        if rough.shape[1] > k:
            least = np.partition(rough, rough.shape[1] - k, axis=1)[:, rough.shape[1] - k]
            fits &= rough >= least[:, None] - SLACK
        at, row = np.nonzero(fits)
        at += lo
        score = np.concatenate([np.zeros(0), *[_sequential(q[at[i : i + 65536]], v[row[i : i + 65536]]) for i in range(0, len(at), 65536)]])
        score = score / (q_norm[at] * v_norm[row])
        order = np.lexsort((place[row], -score, at))
        at, row, score = at[order], row[order], score[order]
        keep = np.arange(len(at)) - np.searchsorted(at, at) < k
        found.append((at[keep], row[keep], score[keep]))
    return tuple(np.concatenate(parts) for parts in zip(*found))


def top_k_table(
    queries: DataFrame, vectors: DataFrame, k: int = 10, query_id: str = "query_id", row_id: str = "id", query_values: str = "values",
    values: str = "values", facets: Sequence[str] = (), rows_in_block: int = VECTORS_IN_BLOCK, queries_in_block: int = QUERIES_IN_BLOCK,
) -> DataFrame:
    """query_id, row_id, score and rank of the ``k`` most similar rows of every query; ties to the smaller id.

    The score is the cosine. Each facet is a column of both tables: a query sees only rows with its own value there (a
    category may also be part of the row's, in any case), and all rows where it has none. Ids are unique and not null. Vectors that are null, of length zero, or hold null or
    non-finite components take no part; rows of another number of components than the query are not compared with it.

    Both tables are dealt to bounded blocks. A pair of blocks is one matrix product, of which each query keeps ``k`` rows;
    these are merged for each query. No vector goes through the driver, and equal rows spread over blocks like any others.
    """
    def usable(df, id_, vec):
        finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
        rows = df.filter(F.col(id_).isNotNull() & F.col(vec).isNotNull() & finite)
        return settle(rows.select(F.col(id_).alias("id"), F.col(vec).cast("array<double>").alias("values"), *[F.col(c).cast("string").alias(c) for c in facets]))

    asked, held = usable(queries, query_id, query_values), usable(vectors, row_id, values)
    parts = max(1, -(-held.count() // rows_in_block))
    ask_parts = max(1, -(-asked.count() // queries_in_block))
    to = F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part")
    blocks = _packed(asked, ask_parts, queries_in_block)
    blocks = blocks.select(to, *[F.col(c).alias(f"q_{c}") for c in blocks.columns if c != "part"])
    pairs = _packed(held, parts, rows_in_block).join(blocks, "part")
    schema = T.StructType([T.StructField(query_id, asked.schema["id"].dataType), T.StructField(row_id, held.schema["id"].dataType), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                pair = batch.slice(i, 1).to_pylist()[0]
                asked_block = {c[2:]: v for c, v in pair.items() if c.startswith("q_")}
                at, row, score = _best(asked_block, pair, k, facets)
                ids = batch["q_id"][i].values.take(pa.array(at)), batch["id"][i].values.take(pa.array(row))
                yield pa.RecordBatch.from_arrays([*ids, pa.array(score)], schema.names)

    # pairs are few and heavy: each gets a task of its own while there are not too many
    hits = pairs.repartition(max(1, min(parts * ask_parts, 20_000))).mapInArrow(run, schema)
    place = Window.partitionBy(query_id).orderBy(F.desc("score"), row_id)
    return hits.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= k)


def search_table(
    queries: DataFrame, vectors: DataFrame, docs: DataFrame, k: int = 25, prefilter: bool = False, query_id: str = "query_id",
    row_id: str = "id", query_values: str = "values", values: str = "values",
) -> DataFrame:
    """The documents that answer each query, with query_id and rank: :func:`~reviewloom.operators.retrieval.search` for a table of queries.

    A query brings its own category, year and month; one without a value, or with month ALL, is no condition. The ``k`` best
    rows are ranked first and then filtered, or only matching rows are ranked with ``prefilter``. A query with nothing left
    gets all documents that meet its conditions, their category in full, at rank 1.
    """
    asked = settle(
        queries.select(
            F.col(query_id), F.col(query_values).alias("_values"), 
            *[F.nullif(F.col(c).cast("string"), F.lit("ALL" if c == "month" else "")).alias(c) for c in FACETS],
        )
    )
    found = top_k_table(asked, vectors, k, query_id, row_id, "_values", values, FACETS if prefilter else ())
    # hits are at most k rows a query; their places are looked up by id
    placed = found.join(vectors.select(row_id, *PLACE), row_id)
    conditions = asked.select(query_id, *[F.col(c).alias(f"_{c}") for c in FACETS])
    meets = F.lit(True)
    for c in FACETS:
        own, here = F.col(f"_{c}"), F.col(c).cast("string")
        meets = meets & (own.isNull() | (F.contains(F.lower(here), F.lower(own)) if c == "category" else own == here))
    hits = settle(placed.join(conditions, query_id).filter(meets).select(query_id, "rank", *PLACE))
    answered = docs.join(hits, list(PLACE))
    left = conditions.join(hits.select(query_id).distinct(), query_id, "left_anti")
    # documents meet the queries that are left on the conditions these have, one join key for each combination in use
    mask = F.concat(*[F.col(f"_{c}").isNotNull().cast("int").cast("string") for c in FACETS])
    left = settle(left.withColumn("_mask", mask))
    masks = [r["_mask"] for r in left.select("_mask").distinct().collect()]
    if not masks:
        return answered.select(query_id, "rank", *docs.columns)
    keys = docs.withColumn("_mask", F.explode(F.array(*[F.lit(m) for m in masks])))
    for i, c in enumerate(FACETS):
        keys = keys.withColumn(f"_{c}", F.when(F.substring("_mask", i + 1, 1) == "1", F.coalesce(F.col(c).cast("string"), F.lit("\0"))).otherwise(F.lit("")))
    left = left.fillna("", [f"_{c}" for c in FACETS])
    rest = keys.join(left, ["_mask", *[f"_{c}" for c in FACETS]]).withColumn("rank", F.lit(1))
    return answered.select(query_id, "rank", *docs.columns).unionByName(rest.select(query_id, "rank", *docs.columns))
