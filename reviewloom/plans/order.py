"""Exact order statistics of many columns at once, by radix selection."""

from __future__ import annotations

import struct
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# bits that a pass reads of a key; a piece of keys splits into at most twice as many buckets as they count
DIGIT = 11
FIRST_SHIFT = 52
INTEGRAL = {"tinyint", "smallint", "int", "bigint"}


@dataclass(frozen=True)
class Place:
    """A value in order, with the number of values below it and of its copies."""

    value: float | int
    below: int
    copies: int


@dataclass
class _Piece:
    """A range of keys of one column that holds wanted positions."""

    spots: list[int]
    start: int = 0
    shift: int = FIRST_SHIFT
    below: int = 0
    bounds: tuple | None = None
    buckets: list = field(default_factory=list)


def double_key(value: Column) -> Column:
    """A non-null double as a long of the same order: zeros are equal, NaN comes last."""
    bits = F.java_method(F.lit("java.lang.Double"), F.lit("doubleToLongBits"), value + F.lit(0.0)).cast("long")
    return F.when(bits < 0, bits.bitwiseXOR(F.lit(2**63 - 1))).otherwise(bits)


def _double_of(key: int) -> float:
    return struct.unpack(">d", struct.pack(">q", key if key >= 0 else key ^ (2**63 - 1)))[0]


def order_values(
    rows: DataFrame, columns: Sequence[str], spots_of: Callable[[int], Sequence[int]], totals: dict[str, int] | None = None
) -> dict[str, dict[int, Place]]:
    """The values at 0-based positions of each column's non-null values in order.

    ``spots_of`` gets the number of a column's values, which is noted in ``totals``, and names positions. Whole numbers stay exact, other columns are read
    as doubles. All columns share the passes: a pass reads the rows once, counts values by column and by the next bits of
    their keys, map-side, and goes on only inside the buckets that hold positions. A pass brings at most 4,096 counts per
    column and position to the driver; six passes settle every 64-bit key, fewer where values lie close. Nothing is sorted,
    shuffled or kept. Rows that come from a costly plan are better settled first, since each pass reads them.
    """
    integral = {c: kind in INTEGRAL for c, kind in rows.select(*columns).dtypes}
    values = rows.select(*[F.col(c).cast("long" if integral[c] else "double").alias(f"v{i}") for i, c in enumerate(columns)])
    found: dict[str, dict[int, Place]] = {c: {} for c in columns}
    pieces = {c: [_Piece([])] for c in columns}
    first = True
    while any(pieces.values()):
        _count(values, columns, pieces, integral)
        following: dict[str, list[_Piece]] = {c: [] for c in columns}
        for c in columns:
            for piece in pieces[c]:
                if first:
                    total = sum(n for n, _, _ in piece.buckets)
                    piece.spots = sorted(set(spots_of(total)))
                    if totals is not None:
                        totals[c] = total
                following[c] += _inside(piece, found[c], integral[c])
        pieces, first = following, False
    return found


def _count(values: DataFrame, columns: Sequence[str], pieces: dict[str, list[_Piece]], integral: dict[str, bool]) -> None:
    """One pass: fill the buckets of all pieces with (count, least key, greatest key)."""
    marks, wanted = [], F.lit(False)
    for i, c in enumerate(columns):
        value = F.col(f"v{i}")
        for no, piece in enumerate(pieces[c]):
            inside = value.isNotNull() if piece.bounds is None else value.between(*[F.lit(b) for b in piece.bounds])
            wanted = wanted | inside
            key = value if integral[c] else double_key(value)
            marks.append(F.when(inside, F.struct(F.lit(i).alias("col"), F.lit(no).alias("piece"), key.alias("key"), F.lit(piece.start).cast("long").alias("start"), F.lit(piece.shift).alias("shift"))))
    each = values.filter(wanted).select(F.explode(F.array_compact(F.array(*marks))).alias("m")).select("m.*")
    bucket = F.expr("shiftright(key - start, shift)")
    counted = each.groupBy("col", "piece", bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("low"), F.max("key").alias("high"))
    for r in sorted(counted.collect(), key=lambda r: r["low"]):
        pieces[columns[r["col"]]][r["piece"]].buckets.append((r["n"], r["low"], r["high"]))


def _inside(piece: _Piece, found: dict[int, Place], integral: bool) -> list[_Piece]:
    """Positions that fall on one value are found; buckets of several values that hold positions become pieces."""
    value = (lambda key: key) if integral else _double_of
    rest, below, left = [], piece.below, list(piece.spots)
    for n, low, high in piece.buckets:
        here = [s for s in left if s < below + n]
        left = left[len(here):]
        if here and low == high:
            found.update({s: Place(value(low), below, n) for s in here})
        elif here:
            shift = max(0, (high - low).bit_length() - DIGIT)
            rest.append(_Piece(here, low, shift, below, (value(low), value(high))))
        below += n
    if left:
        raise ValueError(f"positions {left} are outside the values")
    return rest
