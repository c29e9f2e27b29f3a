"""Vectors packed into bounded blocks, so that a task works on matrices instead of rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK = "part int, n int, width int, kind string, ids binary, rids binary, labels binary, data binary"
FIELDS = [f.split()[0] for f in BLOCK.split(", ")]


def finite(vector: str) -> Column:
    """True for vectors that are there and hold finite numbers only."""
    x_ok = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return F.col(vector).isNotNull() & x_ok


def smallest(x: np.ndarray) -> np.ndarray:
    """The same integers in the narrowest of the types that hold them."""
    low, high = (int(x.min()), int(x.max())) if x.size else (0, 0)
    return x.astype(next(t for t in (np.int8, np.int16, np.int32, np.int64) if np.iinfo(t).min <= low and high <= np.iinfo(t).max))


def pack(rows: DataFrame, parts: int, size: int, kind: type = np.int64) -> DataFrame:
    """Rows (id, rid, label, vector) dealt evenly over numbered parts, in blocks of at most ``size`` rows.

    Shorter vectors are filled up with zeros; integers are kept in the narrowest type.
    """

    def block(piece: pa.Table) -> pa.RecordBatch:
        vectors = pa.concat_arrays(piece["vector"].chunks)
        lengths = np.diff(np.asarray(vectors.offsets))
        width = int(lengths.max(initial=0))
        x = np.zeros((piece.num_rows, width), kind)
        x[np.arange(width) < lengths[:, None]] = np.asarray(vectors.flatten())
        x = smallest(x) if np.issubdtype(kind, np.integer) else x
        cells = [piece["part"][0].as_py(), piece.num_rows, width, x.dtype.str]
        cells += [np.asarray(piece[c].cast(pa.int64())).tobytes() for c in ("id", "rid", "label")] + [x.tobytes()]
        types = [pa.int32(), pa.int32(), pa.int32(), pa.string()] + 4 * [pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(cells, types)], FIELDS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # all rows of a task are of one part; blocks are as long as they may be, however rows come in
        held: list[pa.RecordBatch] = []
        n = 0
        for batch in batches:
            while batch.num_rows:
                take = min(size - n, batch.num_rows)
                held.append(batch.slice(0, take))
                n, batch = n + take, batch.slice(take)
                if n == size:
                    yield block(pa.Table.from_batches(held))
                    held, n = [], 0
        if n:
            yield block(pa.Table.from_batches(held))

    dealt = rows.repartition(parts).select(F.spark_partition_id().alias("part"), "id", "rid", "label", "vector")
    return dealt.mapInArrow(run, BLOCK)


def unpack(cell: dict, prefix: str = "", width: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """ids, rids, labels and the matrix of a block, filled up with zeros to ``width`` columns."""
    ids, rids, labels = (np.frombuffer(cell[prefix + c], np.int64) for c in ("ids", "rids", "labels"))
    x = np.frombuffer(cell[prefix + "data"], cell[prefix + "kind"]).reshape(cell[prefix + "n"], cell[prefix + "width"])
    if x.shape[1] < width:
        x = np.pad(x, ((0, 0), (0, width - x.shape[1])))
    return ids, rids, labels, x


def members(blocks: DataFrame) -> DataFrame:
    """part and rid of every row in the blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, cell in zip(batch["part"].to_pylist(), batch["rids"].to_pylist()):
                rids = np.frombuffer(cell, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(rids), part, np.int32)), pa.array(rids)], ["part", "rid"])

    return blocks.select("part", "rids").mapInArrow(run, "part int, rid long")


def every_block(blocks: DataFrame, asked: DataFrame, parts: int, asked_parts: int) -> DataFrame:
    """Each of the few blocks of queries (columns prefixed with q_) beside each block of vectors."""
    to = F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part")
    named = [F.col(c).alias(f"q_{c}") for c in asked.columns if c != "part"]
    return blocks.join(asked.select(to, *named), "part").repartition(max(1, min(parts * asked_parts, 20_000)))
