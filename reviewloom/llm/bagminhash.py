"""Near-duplicates by BagMinHash: weighted-Jaccard signatures, bands, exact multiset overlap, classes."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewloom.llm.registry import query, sheltered, table
from reviewloom.llm.textbytes import LOWER, WORD, chunks, gram_hashes, mix, span_hashes, spans
from reviewloom.plans.skew import join_small
from reviewloom.session import scratch_path

SHINGLE = 5
SIMILARITY = 0.8
# a pair of similarity 0.8 misses all bands with a chance of 3e-6
BANDS, ROWS = 32, 5
TEXTS_AT_ONCE = 2048
# rows and bytes of text of a block of a band, texts in a batch that goes to Python, shingles a cell remembers
CELL_ROWS, CELL_BYTES = 1024, 32_000_000
TEXTS_IN_BATCH = 128
BAGS_AT_ONCE = 4_000_000
LINKS = "a long, b long"
# so many deviations below the agreement of a pair of just the wanted similarity, signatures rule a pair out (2.4e-7)
DEVIATIONS = 5.5

_STEP = np.uint64(0x9E3779B97F4A7C15)


def shingles(words: np.ndarray, rows: np.ndarray, n_rows: int, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of every run of ``size`` words; a shorter text is one shingle of all its words."""
    grams = gram_hashes(words, size)
    ends = np.arange(len(grams)) + size - 1
    whole = rows[: len(grams)] == rows[ends] if len(grams) else np.zeros(0, bool)
    out_rows, out = [rows[: len(grams)][whole]], [grams[whole]]
    counts = np.bincount(rows, minlength=n_rows)
    starts = np.cumsum(counts) - counts
    for n in range(1, size):
        few = np.flatnonzero(counts == n)
        if len(few):
            lines = np.stack([words[starts[few] + i] for i in range(n)], 1)
            out_rows.append(few)
            out.append(gram_hashes(np.ascontiguousarray(lines).ravel(), n)[::n])
    return np.concatenate(out_rows), np.concatenate(out)


def weighted(rows: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, hash, multiplicity) of the distinct shingles of each row."""
    order = np.lexsort((hashes, rows))
    rows, hashes = rows[order], hashes[order]
    first = np.ones(len(rows), bool)
    first[1:] = (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1])
    at = np.flatnonzero(first)
    return rows[at], hashes[at], np.diff(np.append(at, len(rows)))


def signatures(rows: np.ndarray, hashes: np.ndarray, weights: np.ndarray, n_rows: int, size: int = BANDS * ROWS) -> np.ndarray:
    """The signature of each row of weighted elements; equal components have a chance of the weighted Jaccard index.

    The weight axis of an element is cut at 1, 2, 4, 8, ... A block between two cuts carries a Poisson process whose
    rate is its width; each point falls on one of the block's unit levels and on one signature component, all drawn
    from the element and block alone. A point counts if its level lies within the weight, so two texts see the same
    points up to the smaller weight. A component is the time of its first point. Points of a block come in order of time,
    so a block is left once its time passes the row's largest component, and blocks above a weight are never opened.
    """
    least = np.full((n_rows, size), np.inf)
    top = np.ceil(np.log2(np.maximum(weights, 1))).astype(np.int64)
    element = np.repeat(np.arange(len(rows)), top + 1)
    block = np.arange(len(element)) - np.repeat(np.cumsum(top + 1) - top - 1, top + 1)
    low = np.where(block == 0, 0, 1 << np.maximum(block - 1, 0))
    width = np.where(block == 0, 1, low)
    seed = mix(hashes[element] + block.astype(np.uint64) * _STEP)
    row, weight = rows[element], weights[element]
    time = np.zeros(len(element))
    step = 0
    while len(row):
        step += 1
        drawn = mix(seed + np.uint64(step * int(_STEP) % (1 << 64)))
        time = time - np.log1p(-(drawn >> np.uint64(11)).astype(np.float64) * 2.0**-53) / width
        place = mix(drawn)
        level = low + 1 + ((place >> np.uint64(40)) % width.astype(np.uint64)).astype(np.int64)
        counts = level <= weight
        np.minimum.at(least, (row[counts], ((place & np.uint64(0xFFFFFFFF)) % np.uint64(size)).astype(np.int64)[counts]), time[counts])
        live = time < least.max(1)[row]
        row, weight, seed, time, low, width = row[live], weight[live], seed[live], time[live], low[live], width[live]
    return least


def band_keys(signature: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """One key for each band of a row's signature; equal keys of different bands don't meet."""
    n, size = signature.shape
    keys = np.zeros((n, bands), np.uint64) + np.arange(bands, dtype=np.uint64)
    bits = signature.view(np.uint64).reshape(n, bands, size // bands)
    for i in range(size // bands):
        keys = mix(keys * _STEP ^ bits[:, :, i])
    return keys.view(np.int64)


def short_signature(signature: np.ndarray) -> list[bytes]:
    """One byte of each component; unlike components still agree in one of 256 cases."""
    return [x.tobytes() for x in (mix(signature.view(np.uint64)) & np.uint64(255)).astype(np.uint8)]


def overlap(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard index of two sorted multisets (hashes, multiplicities)."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    common = np.minimum(a[1][i], b[1][j]).sum()
    return common / max(1, a[1].sum() + b[1].sum() - common)


def _nodes(words: np.ndarray, rows: np.ndarray, n_rows: int, buf: np.ndarray, offsets: np.ndarray) -> list[bytes]:
    """16 bytes that name the word sequence of each text; a text without words is named by its bytes."""
    counts = np.bincount(rows, minlength=n_rows)
    at = np.arange(len(words)) - np.repeat(np.cumsum(counts) - counts, counts)
    halves = []
    for salt in (np.uint64(1), np.uint64(2)):
        placed = mix((words + salt) ^ mix(at.astype(np.uint64) * _STEP + salt))
        ends = np.concatenate([[0], np.cumsum(counts)])
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(placed)])
        halves.append(mix(total[ends[1:]] - total[ends[:-1]] + counts.astype(np.uint64)))
    bare = span_hashes(buf, offsets[:-1], offsets[1:])
    out = np.stack(halves, 1)
    none = counts == 0
    out[none, 0], out[none, 1] = bare[none], (offsets[1:] - offsets[:-1]).astype(np.uint64)[none]
    return [x.tobytes() for x in out]


def sketch(documents: DataFrame) -> DataFrame:
    """Add ``_node`` (name of the word sequence, null for a null text), ``_bands`` and ``_short`` (null without words)."""
    rows = documents.drop("_node", "_bands", "_short")
    schema = T.StructType([
        *rows.schema.fields, T.StructField("_node", T.BinaryType()), T.StructField("_bands", T.ArrayType(T.LongType())), T.StructField("_short", T.BinaryType())
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, TEXTS_AT_ONCE):
                part = batch.slice(lo, TEXTS_AT_ONCE)
                present = part["text"].is_valid().to_pylist()
                nodes: list = []
                bands: list = []
                shorts: list = []
                for _, n, buf, offsets in ((a, b - a, x, o) for a, b, x, o in chunks(part["text"])):
                    lowered = LOWER[buf]
                    starts, ends, at = spans(lowered, offsets, WORD)
                    words = span_hashes(lowered, starts, ends)
                    nodes += _nodes(words, at, n, buf, offsets)
                    elements = weighted(*shingles(words, at, n))
                    some = np.unique(elements[0])
                    place = np.searchsorted(some, elements[0])
                    signed = signatures(place, elements[1], elements[2], len(some))
                    keys, short = dict(zip(some.tolist(), band_keys(signed))), dict(zip(some.tolist(), short_signature(signed)))
                    bands += [keys.get(i) for i in range(n)]
                    shorts += [short.get(i) for i in range(n)]
                yield pa.RecordBatch.from_arrays(
                    [
                        *part.columns,
                        pa.array([x if ok else None for x, ok in zip(nodes, present)], pa.binary()),
                        pa.array(bands, pa.list_(pa.int64())),
                        pa.array(shorts, pa.binary()),
                    ],
                    [*part.schema.names, "_node", "_bands", "_short"],
                )

    return rows.mapInArrow(run, schema)


def multiset(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of a text's distinct shingles and how often each occurs."""
    buf = LOWER[np.frombuffer(text.encode(), np.uint8)]
    starts, ends, at = spans(buf, np.array([0, len(buf)]), WORD)
    _, hashes, counts = weighted(*shingles(span_hashes(buf, starts, ends), at, 1))
    return hashes, counts


def _alike(similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, name = None, None
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                a, b = part["a"].to_pylist(), part["b"].to_pylist()
                good = []
                for i, (left, right) in enumerate(zip(part["text_a"].to_pylist(), part["text_b"].to_pylist())):
                    if b[i] != name:
                        held, name = multiset(right), b[i]
                    # a multiset can't be this alike to one of a very different size
                    good.append(overlap(multiset(left), held) >= similarity)
                keep = [i for i, g in enumerate(good) if g]
                yield pa.RecordBatch.from_pydict({"a": pa.array([a[i] for i in keep], pa.int64()), "b": pa.array([b[i] for i in keep], pa.int64())})

    return run


def _agreeing(similarity: float):
    size, least = BANDS * ROWS, _least(similarity)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (np.frombuffer(b"".join(batch[c].to_pylist()), np.uint8).reshape(batch.num_rows, size) for c in ("short_a", "short_b"))
            yield batch.select(["a", "b"]).filter(pa.array((left == right).sum(1) >= least))

    return run


def _root(up: dict, x):
    while up[x] != x:
        up[x] = up[up[x]]
        x = up[x]
    return x


def _by_cell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each (band, lo, hi), which come sorted by it."""
    held: list[pa.RecordBatch] = []
    name = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([np.asarray(batch[c]).astype(np.int64) for c in ("band", "lo", "hi")])
        cuts = np.append(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1, batch.num_rows)
        lo = 0
        for hi in cuts:
            here = tuple(keys[:, lo])
            if held and here != name:
                yield pa.Table.from_batches(held)
                held = []
            name = here
            held.append(batch.slice(lo, hi - lo))
            lo = hi
    if held:
        yield pa.Table.from_batches(held)


def _close(cell: pa.Table, least: float) -> Iterator[tuple[int, np.ndarray]]:
    """(row, other rows) of a cell whose signatures may belong to alike texts of different groups.

    A cell compares all its rows, or those of its one block with those of the other. A pair counts in the first band that
    it shares, so it comes up in one cell only.
    """
    n = cell.num_rows
    short = np.frombuffer(b"".join(cell["short"].to_pylist()), np.uint8).reshape(n, BANDS * ROWS)
    own, at = np.asarray(cell["own"]), int(cell["at"][0].as_py())
    lo, hi = int(cell["lo"][0].as_py()), int(cell["hi"][0].as_py())
    group = np.asarray(cell["group"])
    rows = np.flatnonzero(own == lo)
    others = rows if lo == hi else np.flatnonzero(own == hi)
    for place, x in enumerate(rows):
        rest = others[place + 1 :] if lo == hi else others
        rest = rest[group[rest] != group[x]]
        if not len(rest):
            continue
        same = short[rest] == short[x]
        near = np.flatnonzero(same.sum(1) >= least)
        if len(near):
            first = same[near].reshape(len(near), BANDS, ROWS).all(2).argmax(1)
            near = near[first == at]
            if len(near):
                yield int(x), rest[near]


def _least(similarity: float) -> float:
    size = BANDS * ROWS
    return size * similarity - DEVIATIONS * np.sqrt(size * similarity * (1 - similarity))


def _kept_in_cells(similarity: float):
    """Only those rows of a cell that have a possible partner there."""
    least = _least(similarity)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in _by_cell(batches):
            keep = np.zeros(cell.num_rows, bool)
            for x, near in _close(cell, least):
                keep[x] = True
                keep[near] = True
            if keep.any():
                yield from cell.filter(pa.array(keep)).to_batches()

    return run


def _links_in_cells(similarity: float):
    """Links (a, b) of alike texts that join the groups of a cell; a pair of groups already joined needs no other."""
    least = _least(similarity)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in _by_cell(batches):
            group, up = cell["group"].to_pylist(), {}
            for g in group:
                up[g] = g
            bags: dict[int, tuple[np.ndarray, np.ndarray]] = {}
            held, links = 0, []

            def bag(i: int):
                nonlocal held
                if i not in bags:
                    if held > BAGS_AT_ONCE:
                        bags.clear()
                        held = 0
                    bags[i] = multiset(cell["text"][i].as_py())
                    held += len(bags[i][0])
                return bags[i]

            for x, near in _close(cell, least):
                for y in near.tolist():
                    a, b = _root(up, group[x]), _root(up, group[y])
                    if a != b and overlap(bag(x), bag(y)) >= similarity:
                        up[a] = b
                        links.append((x, y))
            if links:
                nodes = cell["node"].to_pylist()
                yield pa.RecordBatch.from_pydict({c: pa.array([nodes[p[i]] for p in links], pa.int64()) for i, c in enumerate("ab")})

    return run


def likely(pairs: DataFrame, shorts: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose signatures don't rule the similarity out; ``shorts`` holds (node, short)."""
    left = pairs.join(shorts.select(F.col("node").alias("a"), F.col("short").alias("short_a")), "a")
    both = left.join(shorts.select(F.col("node").alias("b"), F.col("short").alias("short_b")), "b")
    return both.select("a", "b", "short_a", "short_b").mapInArrow(_agreeing(similarity), LINKS)


def verified(pairs: DataFrame, sketched: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) of nodes whose texts' shingle multisets overlap enough."""
    needed = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
    texts = _texts(sketched, needed)
    left = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
    both = left.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
    return both.select("a", "b", "text_a", "text_b").mapInArrow(_alike(similarity), LINKS)


def _texts(sketched: DataFrame, needed: DataFrame) -> DataFrame:
    """node and text of the nodes that are ``needed``."""
    return join_small(sketched.select(F.col("_rid").alias("node"), "text"), needed, "node")


def stored(rows: DataFrame) -> DataFrame:
    """The rows as a table in the shared folder. A checkpoint would hand on what the planner knows of its origin, which
    after some rounds of joins takes longer to work through than the joins."""
    path = scratch_path(rows.sparkSession, "classes")
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def unite(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """Join the groups of ``labels`` (node, group) that edges (a, b) connect; a group's name is its least node.

    Every group with a lesser neighbour hangs itself under its least one, chains are cut short by doubling, and this
    repeats on the groups that remain. Rows are pre-aggregated, and no group ever stands in one place.
    """
    while True:
        ends = edges.join(labels.select(F.col("node").alias("a"), F.col("group").alias("ga")), "a").join(
            labels.select(F.col("node").alias("b"), F.col("group").alias("gb")), "b")
        across = stored(ends.filter("ga <> gb").select(F.greatest("ga", "gb").alias("group"), F.least("ga", "gb").alias("up")).distinct())
        if across.isEmpty():
            return labels
        up = stored(across.groupBy("group").agg(F.min("up").alias("up")))
        while True:
            further = up.select(F.col("group").alias("up"), F.col("up").alias("next"))
            longer = stored(up.join(further, "up", "left").select("group", F.coalesce("next", "up").alias("up"), F.col("next").isNotNull().alias("_moved")))
            up = longer.select("group", "up")
            if longer.filter("_moved").isEmpty():
                break
        labels = stored(labels.join(up, "group", "left").select("node", F.coalesce("up", "group").alias("group")))


def _members(keys: DataFrame) -> DataFrame:
    """The ``keys`` (node, at, band) of bands that several nodes share, with the band's least node as ``hub``.

    Keys are dealt by band once, for counting and for the join with what was counted: both need every column, so Spark
    takes the second reading from the first exchange.
    """
    dealt = keys.repartition("band")
    shared = dealt.groupBy("band").agg(F.min(F.struct("node", "at")).alias("least"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    return dealt.join(shared.select("band", F.col("least.node").alias("hub")), "band")


def _linked(sketched: DataFrame, first: DataFrame, similarity: float) -> DataFrame:
    """(node, group) of all nodes that share a band with another; groups are connected by verified pairs.

    A node goes by the number of its first row, as ``first`` holds them.
    """
    keys = sketched.select("_rid", "_bands").join(first, "_rid", "left_semi")
    keys = keys.select(F.col("_rid").alias("node"), F.posexplode("_bands").alias("at", "band"))
    members = stored(_members(keys))
    labels = stored(members.select("node").distinct().select("node", F.col("node").alias("group")))
    sizes = sketched.select(F.col("_rid").alias("node"), F.col("_short").alias("short"), F.octet_length("text").cast("long").alias("size"))
    shorts = stored(join_small(sizes, labels.select("node"), "node"))
    # first each node next to the least node that it shares most bands with
    counted = members.filter("node <> hub").groupBy("node", "hub").agg(F.count(F.lit(1)).alias("n"))
    best = counted.groupBy("node").agg(F.max(F.struct("n", "hub")).alias("best"))
    pairs = stored(best.select(F.col("node").alias("a"), F.col("best.hub").alias("b")))
    labels = unite(labels, _checked(pairs, shorts, sketched, similarity))
    # then one node of each group in a band next to one of the band's largest group
    groups = members.join(labels, "node").groupBy("band", "group").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("node"))
    largest = groups.groupBy("band").agg(F.max(F.struct("n", "group", "node")).alias("top"), F.count(F.lit(1)).alias("groups"))
    stars = groups.join(largest.filter("groups > 1"), "band").filter("group <> top.group")
    pairs = stored(stars.select(F.greatest("node", "top.node").alias("a"), F.least("node", "top.node").alias("b")).distinct())
    labels = unite(labels, _checked(pairs, shorts, sketched, similarity))
    # at last everything that is left across groups, so that no link between different texts is lost
    return unite(labels, _across(members, labels, shorts, sketched, similarity))


def _checked(pairs: DataFrame, shorts: DataFrame, sketched: DataFrame, similarity: float) -> DataFrame:
    with _small_batches(pairs.sparkSession):
        return stored(verified(stored(likely(pairs, shorts, similarity)), sketched, similarity))


@contextmanager
def _small_batches(spark: SparkSession):
    """Python workers take few texts at a time while tables are written inside."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(TEXTS_IN_BATCH))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _across(members: DataFrame, labels: DataFrame, shorts: DataFrame, sketched: DataFrame, similarity: float) -> DataFrame:
    """Links (a, b) between groups that share a band, found inside bounded cells.

    The members of a band outside its largest group form blocks, those inside form others; a block of the former and any
    other block meet in a cell. Signatures are compared in the cell's task, and only rows with a possible partner move
    on, to meet again with their texts. So rows are never paired up in a table, whatever the size of a band; a cell holds
    at most two blocks, bounded in rows and in bytes of text but for a single longer one.
    """
    placed = members.join(labels, "node")
    groups = placed.groupBy("band", "group").agg(F.count(F.lit(1)).alias("n"))
    largest = groups.groupBy("band").agg(F.max(F.struct("n", "group")).alias("top"), F.count(F.lit(1)).alias("groups"))
    mixed = stored(largest.filter("groups > 1").select("band", F.col("top.group").alias("top")))
    split = placed.join(mixed, "band").join(shorts, "node")
    split = stored(split.select("band", "at", "node", "group", (F.col("group") == F.col("top")).alias("inner"), "short", "size"))

    def blocks(inner: bool):
        mine = F.col("inner") if inner else ~F.col("inner")
        rows, size = F.count_if(mine), F.sum(F.when(mine, F.col("size")).otherwise(0))
        return F.greatest(F.ceil(rows / CELL_ROWS), F.ceil(size / CELL_BYTES), F.lit(1)).cast("int")

    counts = split.groupBy("band").agg(blocks(False).alias("outer_blocks"), blocks(True).alias("inner_blocks"))
    cut = split.join(counts, "band")
    hashed = F.xxhash64("node")
    own = F.when(F.col("inner"), F.col("outer_blocks") + F.pmod(hashed, "inner_blocks")).otherwise(F.pmod(hashed, "outer_blocks")).cast("int")
    last = F.when(F.col("inner"), F.col("outer_blocks") - 1).otherwise(F.col("outer_blocks") + F.col("inner_blocks") - 1)
    met = cut.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), last)))
    names = ["band", "lo", "hi", "at", "node", "group", "own", "short"]
    cells = met.withColumn("lo", F.least("own", "other")).withColumn("hi", F.greatest("own", "other")).select(*names)

    def sorted_cells(rows: DataFrame) -> DataFrame:
        return rows.repartition("band", "lo", "hi").sortWithinPartitions("band", "lo", "hi")

    kept = stored(sorted_cells(cells).mapInArrow(_kept_in_cells(similarity), cells.schema))
    texts = _texts(sketched, kept.select("node").distinct())
    with _small_batches(members.sparkSession):
        return stored(sorted_cells(kept.join(texts, "node")).mapInArrow(_links_in_cells(similarity), LINKS))


def classes(documents: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """All rows and columns of ``documents`` with ``_class`` (least doc_id of the class), ``_size`` and ``_keep``.

    Texts are alike when the multisets of their runs of five words (lower-cased) overlap by ``similarity`` or more;
    classes are what such pairs connect. A text of fewer words is one shingle. Texts of equal words are one node from
    the start. Texts without words, the empty one included, are alike only if equal; a null text is a class of its
    own. ``_keep`` marks one row of each class, that of the least id (null ids last), also when rows repeat. Where all ids
    of a class are null, ``_class`` is null. Empty tables give no rows. Input columns named ``_node``, ``_bands``,
    ``_short``, ``_rid``, ``_class``, ``_size`` or ``_keep`` are replaced.

    The rows are written once to the shared folder with their sketch, so that they keep an identity. Everything after
    it moves row numbers, and the texts of candidate pairs only.
    """
    spark = documents.sparkSession
    path = scratch_path(spark, "sketched")
    names = [c for c in documents.columns if c not in ("_node", "_bands", "_short", "_rid", "_class", "_size", "_keep")]
    rows = sketch(documents.select(*[F.col(f"`{c}`") for c in names])).withColumn("_rid", F.monotonically_increasing_id())
    rows.write.parquet(path)
    sketched = spark.read.schema(rows.schema).parquet(path)
    order = F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id").alias("doc_id"), F.col("_rid").alias("rid"))
    nodes = stored(sketched.filter("_node is not null").groupBy("_node").agg(F.min(order).alias("best"), F.count(F.lit(1)).alias("n")))
    numbered = nodes.withColumn("node", F.col("best.rid"))
    labels = _linked(sketched, numbered.select(F.col("node").alias("_rid")), similarity)
    grouped = numbered.join(labels, "node", "left").withColumn("group", F.coalesce("group", "node"))
    merged = stored(grouped.groupBy("group").agg(F.min("best").alias("top"), F.sum("n").alias("size")))
    named = stored(grouped.select("_node", "group").join(merged, "group").select("_node", F.col("top.doc_id").alias("_class"), F.col("size").alias("_size"), F.col("top.rid").alias("_first")))
    out = sketched.join(named, "_node", "left")
    lone = F.col("_node").isNull()
    return out.select(
        *[F.col(f"`{c}`") for c in names],
        F.when(lone, F.col("doc_id")).otherwise(F.col("_class")).alias("_class"),
        F.coalesce("_size", F.lit(1)).cast("long").alias("_size"),
        (lone | (F.col("_rid") == F.col("_first"))).alias("_keep"),
    )


def deduplicated(documents: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One document, all columns, of each class."""
    return sheltered(documents, lambda rows: classes(rows, similarity).filter("_keep"))


@query("op8_bagminhash_classes")
def _op8(spark, sf_dir):
    found = classes(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.col("_class").alias("class_id"), F.col("_size").alias("class_size"), F.col("_keep").alias("representative"))
