"""Token ids packed into fixed-width rows by best-fit decreasing."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from reviewloom.llm.registry import query, table

WIDTH = 8192
# ids that are packed together; what a task holds
GROUP_IDS = 8_000_000

# fixed values: ids of byte-level models, a byte b is b + 3
PAD, END, FIRST_BYTE = 0, 1, 3


class Capacities:
    """Open rows by free places, with a segment tree over the capacities 0..width.

    A node tells whether any row below it is open, so the least capacity that holds a piece is one descent away.
    """

    def __init__(self, width: int):
        self.leaves = 1 << width.bit_length()
        self.any = bytearray(2 * self.leaves)
        self.rows: dict[int, list[int]] = {}

    def add(self, capacity: int, row: int) -> None:
        held = self.rows.setdefault(capacity, [])
        held.append(row)
        node = self.leaves + capacity
        while node and not self.any[node]:
            self.any[node] = 1
            node >>= 1

    def take(self, size: int) -> tuple[int, int] | None:
        """Remove and return (capacity, row) of the tightest row with ``size`` free places."""
        node = self.leaves + size
        while not self.any[node]:
            # the next subtree to the right
            while node & 1:
                node >>= 1
            if not node:
                return None
            node += 1
            if node & (node - 1) == 0:
                return None
        while node < self.leaves:
            node = 2 * node if self.any[2 * node] else 2 * node + 1
        capacity = node - self.leaves
        held = self.rows[capacity]
        row = held.pop()
        if not held:
            while node and not (node < self.leaves and (self.any[2 * node] or self.any[2 * node + 1])):
                self.any[node] = 0
                node >>= 1
        return capacity, row


def best_fit(sizes: list[int], width: int) -> tuple[list[tuple[int, int]], int]:
    """(row, start) of each piece, and the number of rows; larger pieces first, each into the tightest row."""
    open_rows, places, n = Capacities(width), [(0, 0)] * len(sizes), 0
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        size = sizes[i]
        found = open_rows.take(size) if size < width else None
        if found is None:
            found, n = (width, n), n + 1
        capacity, row = found
        places[i] = (row, width - capacity)
        if capacity > size:
            open_rows.add(capacity - size, row)
    return places, n


def byte_ids(texts: pa.Array) -> list[np.ndarray | None]:
    """Byte-level ids and an end id; null stays null."""
    out = []
    for value in texts:
        raw = value.as_buffer() if value.is_valid else None
        if raw is None:
            out.append(None)
            continue
        ids = np.empty(raw.size + 1, np.uint16)
        ids[:-1] = np.frombuffer(raw, np.uint8)
        ids[:-1] += FIRST_BYTE
        ids[-1] = END
        out.append(ids)
    return out


def given_ids(lists: pa.Array) -> list[np.ndarray | None]:
    """Ids that the column holds, as uint32; null entries count as padding."""
    return [None if x is None else np.array([PAD if i is None else i for i in x], np.uint32) for x in lists.to_pylist()]


class Group:
    """Documents of a bounded number of ids, and the packed rows they make."""

    def __init__(self, width: int):
        self.width, self.size = width, 0
        self.docs: list = []
        self.ids: list[np.ndarray] = []

    def add(self, doc, ids: np.ndarray) -> None:
        self.docs.append(doc)
        self.ids.append(ids)
        self.size += len(ids)

    def rows(self) -> list[dict]:
        pieces = [(d, a, min(a + self.width, len(x))) for d, x in enumerate(self.ids) for a in range(0, len(x), self.width)]
        places, n = best_fit([b - a for _, a, b in pieces], self.width)
        if not n:
            return []
        matrix = np.full((n, self.width), PAD, self.ids[0].dtype)
        held: list[list] = [[] for _ in range(n)]
        for (d, a, b), (row, start) in zip(pieces, places):
            matrix[row, start : start + b - a] = self.ids[d][a:b]
            held[row].append((start, start + b - a, self.docs[d], a))
        out = []
        for row, segments in enumerate(held):
            segments.sort(key=lambda s: s[0])
            out.append({
                "ids": matrix[row].tobytes(),
                "cu_seqlens": [0, *(s[1] for s in segments)],
                "resets": [s[0] for s in segments] + ([segments[-1][1]] if segments[-1][1] < self.width else []),
                "doc_ids": [s[2] for s in segments],
                "doc_starts": [s[3] for s in segments],
                "n_ids": segments[-1][1],
            })
        return out


def pack(
    documents: DataFrame, column: str = "text", to_ids: Callable[[pa.Array], list] = byte_ids, width: int = WIDTH, group_ids: int = GROUP_IDS
) -> DataFrame:
    """One row for each packed row of ``width`` ids.

    ``ids`` is the row of the id matrix, little-endian, two bytes an id for ``byte_ids`` and four for ``given_ids``;
    places past ``n_ids`` hold the padding id. ``cu_seqlens`` starts at 0 and ends each segment; ``resets`` are the
    places where position ids start at 0 again, the padding included; ``doc_ids`` and ``doc_starts`` name the document
    and the id of it with which each segment begins. A document longer than a row is split into full rows and a rest,
    without loss.

    Documents are packed best-fit decreasing in groups of ``group_ids`` ids as a task reads them, so there is no
    shuffle, no task holds more than a group and the longest document, and at most the last rows of a group stay
    loose. Null texts and empty id lists make no segment, an empty text is its end id; repeated rows are packed each;
    a null doc_id stays null; empty tables give no rows. Other columns are not read.
    """
    if width < 1:
        raise ValueError("rows need at least one place")
    rows = documents.select("doc_id", column)
    schema = T.StructType([
        T.StructField("ids", T.BinaryType()), T.StructField("cu_seqlens", T.ArrayType(T.IntegerType())), T.StructField("resets", T.ArrayType(T.IntegerType())),
        T.StructField("doc_ids", T.ArrayType(rows.schema["doc_id"].dataType)), T.StructField("doc_starts", T.ArrayType(T.LongType())), T.StructField("n_ids", T.IntegerType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def emitted(group: Group, ids: pa.DataType) -> Iterator[pa.RecordBatch]:
            out = group.rows()
            for lo in range(0, len(out), 256):
                part = out[lo : lo + 256]
                kinds = {"ids": pa.binary(), "cu_seqlens": pa.list_(pa.int32()), "resets": pa.list_(pa.int32()), "doc_ids": pa.list_(ids), "doc_starts": pa.list_(pa.int64()), "n_ids": pa.int32()}
                yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in part], kind) for c, kind in kinds.items()], list(kinds))

        group, kind = Group(width), pa.int64()
        for batch in batches:
            kind = batch.schema.field("doc_id").type
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                for doc, ids in zip(part["doc_id"].to_pylist(), to_ids(part[column])):
                    if ids is not None and len(ids):
                        group.add(doc, ids)
                        if group.size >= group_ids:
                            yield from emitted(group, kind)
                            group = Group(width)
        yield from emitted(group, kind)

    return rows.mapInArrow(run, schema)


def position_ids(resets: list[int], width: int) -> np.ndarray:
    """Position of every place of a row: counted from the last reset."""
    at = np.zeros(width, np.int64)
    at[list(resets)] = list(resets)
    return np.arange(width) - np.maximum.accumulate(at)


MATRICES = "n_rows int, width int, ids binary, positions binary, cu_seqlens binary, row_splits binary"


def write_matrices(packed: DataFrame, path: str, width: int = WIDTH, rows_in_block: int = 256) -> None:
    """Write blocks of packed rows: id and position matrices row by row, segment ends of all rows, and their splits.

    ``ids`` keeps its two or four bytes an id; positions, ``cu_seqlens`` and ``row_splits`` are int32. A block never
    holds more than ``rows_in_block`` rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, rows_in_block):
                part = batch.slice(lo, rows_in_block).to_pydict()
                ends = part["cu_seqlens"]
                made = {
                    "ids": b"".join(part["ids"]),
                    "positions": b"".join(position_ids(r, width).astype("<i4").tobytes() for r in part["resets"]),
                    "cu_seqlens": np.array([x for e in ends for x in e], "<i4").tobytes(),
                    "row_splits": np.cumsum([0, *map(len, ends)]).astype("<i4").tobytes(),
                }
                n = len(ends)
                yield pa.RecordBatch.from_pydict({"n_rows": pa.array([n], pa.int32()), "width": pa.array([width], pa.int32()), **{k: pa.array([v], pa.binary()) for k, v in made.items()}})

    packed.select("ids", "resets", "cu_seqlens").mapInArrow(run, MATRICES).write.mode("overwrite").parquet(path)


@query("op3_packed_ids")
def _op3(spark, sf_dir):
    return pack(table(spark, sf_dir, "documents"))
