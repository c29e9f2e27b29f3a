"""Exact building blocks that stay parallel when one key holds most rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewloom.session import settle

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 16_000_000
SORT_ROWS = 200_000


def join_small(big: DataFrame, small: DataFrame, on, how: str = "inner", max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Join a derived table, broadcast only after its rows and bytes were counted.

    Past ``max_rows`` or BROADCAST_BYTES the join is left to Spark, which
    shuffles both sides and splits hot partitions at run time.
    """
    small = settle(small)
    if may_broadcast(small, max_rows):
        small = F.broadcast(small)
    return big.join(small, on, how)


def may_broadcast(small: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Is the table, measured row by row, small enough for every executor; one pass over a settled table."""
    wide = [F.octet_length(F.to_json(F.struct(f.name))) for f in small.schema if f.dataType.typeName() in ("array", "map", "struct")]
    text = [F.octet_length(f.name) for f in small.schema if f.dataType.typeName() in ("string", "binary")]
    size = sum((F.coalesce(c, F.lit(0)) for c in wide + text), F.lit(8 * len(small.columns)).cast("long"))
    measured = small.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(size), F.lit(0)).alias("size")).first()
    return measured["n"] <= max_rows and measured["size"] <= max_bytes


def _range_pieces(rows: DataFrame, cols: Sequence[str], weight: str | None, buckets: int):
    """Row totals and key bounds of an ordered split into ``buckets`` pieces."""
    size = F.sum(weight) if weight else F.count(F.lit(1))
    return (
        rows.repartitionByRange(buckets, *cols)
        .groupBy(F.spark_partition_id().alias("piece"))
        .agg(size.alias("size"), F.min(F.struct(*cols)).alias("lo"), F.max(F.struct(*cols)).alias("hi"))
        .orderBy("lo")
        .collect()
    )


def order_statistics(
    rows: DataFrame,
    cols: Sequence[str],
    positions: Sequence[int],
    weight: str | None = None,
    buckets: int = 256,
    sort_rows: int = SORT_ROWS,
) -> dict[int, tuple]:
    """Exact keys at 0-based ``positions`` of ``rows`` ordered by ``cols``.

    The keys must be unique numbers or strings (add the row id, or pre-aggregate
    and pass the count as ``weight``). Each step range-partitions the keys, brings one total per
    piece to the driver and goes on inside the piece that holds the position, so
    neither a task nor the driver ever sees more than a piece.
    """
    cols = list(cols)
    if not positions:
        return {}
    rows = rows.select(*cols, *([weight] if weight else []))
    if rows.limit(sort_rows + 1).count() <= sort_rows:
        return _sorted_piece(rows, cols, positions, weight)
    pieces = _range_pieces(rows, cols, weight, buckets)
    # positions grouped by the piece they fall into
    wanted: dict[int, list[int]] = {}
    starts, before = [], 0
    for piece in pieces:
        starts.append(before)
        before += piece["size"]
    for position in positions:
        if not 0 <= position < before:
            raise ValueError(f"position {position} is outside the rows")
        wanted.setdefault(max(i for i, s in enumerate(starts) if s <= position), []).append(position)
    found: dict[int, tuple] = {}
    for i, inside in wanted.items():
        low, high = pieces[i]["lo"], pieces[i]["hi"]
        # filter on the leading column too: it reaches the file scan
        part = rows.filter(
            F.col(cols[0]).between(F.lit(low[0]), F.lit(high[0]))
            & F.struct(*cols).between(_literal(low, cols), _literal(high, cols))
        )
        rest = {p: p - starts[i] for p in inside}
        got = order_statistics(part, cols, sorted(set(rest.values())), weight, buckets, sort_rows)
        found.update({p: got[r] for p, r in rest.items()})
    return found


def _sorted_piece(rows: DataFrame, cols: list[str], positions: Sequence[int], weight: str | None) -> dict[int, tuple]:
    """Positions inside a piece small enough to sort in one task."""
    size = F.col(weight) if weight else F.lit(1)
    reach = F.sum("_w").over(Window.partitionBy(F.lit(0)).orderBy(*cols))
    hit = F.lit(False)
    for p in positions:
        hit = hit | ((F.col("_reach") > p) & (F.col("_reach") - F.col("_w") <= p))
    rows = rows.select(*cols, size.alias("_w")).withColumn("_reach", reach).filter(hit).collect()
    found = {p: tuple(r[c] for c in cols) for r in rows for p in positions if r["_reach"] - r["_w"] <= p < r["_reach"]}
    if len(found) < len(set(positions)):
        raise ValueError(f"positions {sorted(set(positions) - set(found))} are outside the rows")
    return found


def _literal(bound, cols: Sequence[str]) -> Column:
    return F.struct(*[F.lit(bound[i]).alias(c) for i, c in enumerate(cols)])


def with_bucket(rows: DataFrame, keys: Sequence[str], order: str, buckets: int, name: str) -> DataFrame:
    """Number the pieces of each key along a numeric column, evenly filled.

    Cut points come from a mergeable quantile sketch per key and are found again
    by halving steps over the sorted array.
    """
    value = F.col(order).cast("double")
    shares = F.array(*[F.lit(i / buckets) for i in range(1, buckets)])
    cuts = rows.groupBy(*keys).agg(F.percentile_approx(value, shares, F.lit(20 * buckets)).alias("_cuts"))
    steps = [2**i for i in reversed(range((buckets - 1).bit_length()))]

    def advance(at: Column, step: Column) -> Column:
        there = F.get(F.col("_cuts"), at + step - 1)
        return F.when(there <= value, at + step).otherwise(at)

    place = F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), advance)
    # a row of cuts is wide, so fewer of them are broadcast
    return join_small(rows, cuts, list(keys), max_rows=5_000).withColumn(name, place).drop("_cuts")


HOT_ROWS = 200_000


def running_total(
    rows: DataFrame, keys: Sequence[str], order: str, value: str, name: str = "before",
    buckets: int = 512, hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Sum of ``value`` over earlier rows of the same (non-null) key.

    ``order`` is numeric and unique within a key. A plain window serves keys of
    up to ``hot_rows`` rows. Larger ones are cut into buckets along ``order``;
    a bucket starts from the total of the buckets before it and is handled the
    same way, so no task ever holds more than ``hot_rows`` rows of a key.
    """
    keys = list(keys)
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    hot = settle(sizes.filter(F.col("_n") > hot_rows).select(*keys))
    n_hot = hot.limit(BROADCAST_ROWS + 1).count()
    if n_hot == 0:
        return _plain_total(rows, keys, order, value, name)
    if n_hot <= BROADCAST_ROWS:
        hot = F.broadcast(hot)
    cold = _plain_total(rows.join(hot, keys, "left_anti"), keys, order, value, name)
    return cold.unionByName(_bucketed_total(rows.join(hot, keys, "left_semi"), keys, order, value, name, buckets, hot_rows))


def _plain_total(rows: DataFrame, keys: list[str], order: str, value: str, name: str) -> DataFrame:
    earlier = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return rows.select("*", F.coalesce(F.sum(value).over(earlier), F.lit(0)).alias(name))


def _bucketed_total(
    rows: DataFrame, keys: list[str], order: str, value: str, name: str, buckets: int, hot_rows: int
) -> DataFrame:
    bucket, local = f"_bucket{len(keys)}", f"_local{len(keys)}"
    inner = [*keys, bucket]
    marked = with_bucket(rows, keys, order, buckets, bucket)
    totals = marked.groupBy(*inner).agg(F.sum(value).alias("_total"))
    along = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*inner, F.coalesce(F.sum("_total").over(along), F.lit(0)).alias("_offset"))
    inside = running_total(marked, inner, order, value, local, buckets, hot_rows)
    joined = join_small(inside, offsets, inner)
    return joined.select(*rows.columns, (F.col("_offset") + F.col(local)).alias(name))
