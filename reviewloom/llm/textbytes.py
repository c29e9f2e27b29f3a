"""UTF-8 text columns as numpy bytes: words, positions and hashes for a whole batch at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 2_000_000

# 64-bit odd multiplier of the rolling hash and its inverse modulo 2**64
_FACTOR = 0x9E3779B97F4A7C15
_INVERSE = pow(_FACTOR, -1, 1 << 64)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

# bytes of [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing A-Z; every byte of a longer character belongs to it
WORD = np.zeros(256, bool)
WORD[48:58] = WORD[97:123] = WORD[128:] = True

# bytes of [^\x20\x09-\x0D]+
INK = np.ones(256, bool)
INK[32] = INK[9:14] = False


def chunks(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of rows; null counts as empty.

    A run ends before it passes ``limit`` bytes, so only a single longer text makes a larger one.
    """
    texts = pa.concat_arrays([texts.cast(pa.large_string())]).fill_null("")
    if texts.offset:
        texts = pa.array(texts.to_pylist(), pa.large_string())
    _, offsets, data = texts.buffers()
    n = len(texts)
    at = np.frombuffer(offsets, np.int64, n + 1) if n else np.zeros(1, np.int64)
    everything = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + limit, "right")) - 1)
        yield lo, hi, everything[at[lo] : at[hi]], at[lo : hi + 1] - at[lo]
        lo = hi


def spans(buf: np.ndarray, offsets: np.ndarray, member: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and row numbers of the maximal runs of member bytes; runs end with their text."""
    inside = member[buf]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(buf))]
    first[cuts] = inside[cuts]
    last[cuts - 1] = inside[cuts - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def mix(x: np.ndarray) -> np.ndarray:
    """Finishing steps of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _grown(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, CHUNK_BYTES + 1)
        for k, factor in enumerate((_FACTOR, _INVERSE)):
            steps = np.full(size, factor, np.uint64)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span, the same wherever the span stands."""
    up, down = _grown(len(buf) + 1)
    total = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * up[: len(buf)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of k neighbouring word hashes, in order; len(words) - k + 1 of them."""
    n = max(0, len(words) - k + 1)
    out = np.zeros(n, np.uint64)
    for i in range(k):
        out = (out ^ words[i : i + n]) * np.uint64(_FACTOR)
        out ^= out >> np.uint64(32)
    return mix(out)
