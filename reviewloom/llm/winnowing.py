"""Benchmark decontamination by winnowed k-gram fingerprints whose hits are extended to whole windows."""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewloom.llm.registry import query, sheltered, table
from reviewloom.llm.textbytes import LOWER, WORD, chunks, gram_hashes, span_hashes, spans
from reviewloom.session import settle

WINDOW = 10
GRAM = 5
# benchmark text that one pass over the documents carries along
BLOCK_BYTES = 2_000_000


def minima(grams: np.ndarray, wide: int) -> np.ndarray:
    """Mask of the k-grams that are least in some run of ``wide`` neighbours (equal ones all count)."""
    n = len(grams) - wide + 1
    keep = np.zeros(len(grams), bool)
    if n <= 0:
        return keep
    least = grams[:n].copy()
    for i in range(1, wide):
        np.minimum(least, grams[i : i + n], out=least)
    for i in range(wide):
        keep[i : i + n] |= grams[i : i + n] == least
    return keep


def member(values: np.ndarray, table_: np.ndarray) -> np.ndarray:
    """Which values stand in the sorted table."""
    if not len(table_):
        return np.zeros(len(values), bool)
    at = np.searchsorted(table_, values)
    at[at == len(table_)] = 0
    return table_[at] == values


class ItemIndex:
    """Windows and fingerprints of a block of items, by window length.

    A window of n words is found through k-grams of min(n, GRAM) words, of which n - k + 1 fit into it. A text that
    holds the window has the same least k-gram there as the item, so every occurrence shares a fingerprint.
    """

    def __init__(self, items: list[tuple[str, str]], window: int, gram: int):
        self.items: dict[int, dict[bytes, set[str]]] = {}
        prints: dict[int, list[np.ndarray]] = {}
        hashes: dict[int, list[np.ndarray]] = {}
        self.gram = gram
        for name, text in items:
            buf = LOWER[np.frombuffer(text.encode(), np.uint8)]
            starts, ends, _ = spans(buf, np.array([0, len(buf)]), WORD)
            if not len(starts):
                continue
            n = min(window, len(starts))
            words = span_hashes(buf, starts, ends)
            k = min(n, gram)
            grams = gram_hashes(words, k)
            prints.setdefault(n, []).append(grams[minima(grams, n - k + 1)])
            hashes.setdefault(n, []).append(gram_hashes(words, n))
            raw = buf.tobytes()
            parts = [raw[a:b] for a, b in zip(starts, ends)]
            known = self.items.setdefault(n, {})
            for i in range(len(parts) - n + 1):
                known.setdefault(b" ".join(parts[i : i + n]), set()).add(name)
        self.prints = {n: np.unique(np.concatenate(x)) for n, x in prints.items()}
        self.hashes = {n: np.unique(np.concatenate(x)) for n, x in hashes.items()}

    def starts(self, n: int, words: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """First words of the places that may hold a window of n words: fingerprint hits, extended to both sides."""
        k = min(n, self.gram)
        wide = n - k + 1
        grams = gram_hashes(words, k)
        # the run of a text's last k-grams reaches into the next text; what it picks there is harmless
        picked = np.flatnonzero(minima(grams, wide))
        seeds = picked[member(grams[picked], self.prints[n])]
        around = np.unique((seeds[:, None] - np.arange(wide)[None, :]).ravel())
        around = around[(around >= 0) & (around + n <= len(words))]
        around = around[rows[around] == rows[around + n - 1]]
        if not len(around):
            return around
        whole = np.stack([words[around + i] for i in range(n)], 1)
        return around[member(_window_hashes(whole), self.hashes[n])]


def _window_hashes(words: np.ndarray) -> np.ndarray:
    """gram_hashes of separate windows, one per line."""
    return gram_hashes(np.ascontiguousarray(words).ravel(), words.shape[1])[:: words.shape[1]]


def _scan(index: ItemIndex, texts: pa.Array) -> Iterator[tuple[int, list[int], dict[int, tuple[list, set]]]]:
    """(first row, words of each row, row -> (covered spans, items)) of runs of rows."""
    for lo, hi, buf, offsets in chunks(texts):
        buf = LOWER[buf]
        starts, ends, rows = spans(buf, offsets, WORD)
        counts = np.bincount(rows, minlength=hi - lo)
        first = np.concatenate([[0], np.cumsum(counts)])
        words = span_hashes(buf, starts, ends)
        found: dict[int, tuple[list, set]] = {}
        for n in index.prints:
            places = index.starts(n, words, rows)
            for row in np.unique(rows[places]):
                a, b = first[row], first[row + 1]
                raw = buf[starts[a] : ends[b - 1]].tobytes()
                parts = [raw[s:e] for s, e in zip(starts[a:b] - starts[a], ends[a:b] - starts[a])]
                covered, items = found.setdefault(int(row), ([], set()))
                for i in places[rows[places] == row] - a:
                    names = index.items[n].get(b" ".join(parts[i : i + n]))
                    if names is not None:
                        covered.append((int(i), int(i) + n))
                        items |= names
        yield lo, counts.tolist(), found


def merged(covered: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(covered):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


FOUND = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("spans", T.ArrayType(T.ArrayType(T.IntegerType()))),
        T.StructField("item_ids", T.ArrayType(T.StringType())),
    ]
)


def _step(rows: DataFrame, items: list[tuple[str, str]], window: int, gram: int) -> DataFrame:
    """Add what one block of items finds to ``_found``."""
    shared = rows.sparkSession.sparkContext.broadcast(pickle.dumps(items))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = ItemIndex(pickle.loads(shared.value), window, gram)
        for batch in batches:
            before = batch["_found"].to_pylist()
            out = []
            for lo, counts, found in _scan(index, batch["_text"]):
                for i, n in enumerate(counts):
                    covered, names = found.get(i, ((), ()))
                    old = before[lo + i]
                    if covered or old["n_words"] is None:
                        covered = merged([*map(tuple, old["spans"]), *covered])
                        names = sorted({*old["item_ids"], *names})
                        old = {"n_words": n, "spans": covered, "item_ids": names}
                    out.append(old)
            yield batch.set_column(batch.schema.get_field_index("_found"), batch.schema.field("_found"), pa.array(out, batch.schema.field("_found").type))

    return rows.mapInArrow(scan, rows.schema)


def find_contamination(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """All rows and columns of ``documents`` with ``_found``: words, covered word spans, items with occurring windows.

    Words are lower-cased (A-Z) runs of letters, digits and non-ASCII characters. A window is ``window`` neighbouring
    words of an item, or the whole of a shorter item. Every occurrence is found (see ItemIndex) and then compared word
    by word. The benchmark is carried along in blocks of bounded bytes, one pass over the documents each; there is no
    shuffle, so hot passages and copies cost their own scan only.

    Null and empty texts have no words and no hits; an item without words has no window; a null item_id is named by the
    empty string; items that repeat an id count once. Empty tables give no hits or no rows. Input columns named
    ``_text`` or ``_found`` are replaced.
    """
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), F.coalesce("text", F.lit("")).alias("text"))
    total = items.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    blocks = max(1, -(-int(total) // BLOCK_BYTES))
    empty = F.struct(
        F.lit(None).cast("long").alias("n_words"),
        F.array().cast("array<array<int>>").alias("spans"),
        F.array().cast("array<string>").alias("item_ids"),
    )
    names = documents.drop("_text", "_found").columns
    rows = documents.select(*[F.col(f"`{c}`") for c in names], F.col("text").alias("_text"), empty.cast(FOUND).alias("_found"))
    place = F.pmod(F.xxhash64("item", "text"), F.lit(blocks))
    for i in range(blocks):
        block = [(r["item"], r["text"]) for r in items.filter(place == i).toLocalIterator()]
        rows = _step(rows, block, window, gram)
        if i + 1 < blocks:
            rows = settle(rows)
    return rows.drop("_text")


def hit_words(found: str = "_found"):
    """Number of covered words; the spans don't overlap."""
    return F.aggregate(F.col(f"{found}.spans"), F.lit(0).cast("long"), lambda s, x: s + F.get(x, 1) - F.get(x, 0))


def contamination(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One digest row for each document."""
    found = find_contamination(documents.select("doc_id", "text"), benchmark)
    n = hit_words()
    return found.select(
        "doc_id",
        F.col("_found.n_words").alias("n_words"),
        n.alias("n_hit"),
        F.size("_found.item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("_found.item_ids", ","), 256).alias("items_sha256"),
        (n > 0).alias("contaminated"),
    )


def decontaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents, all columns, in which no window of the benchmark occurs."""
    return sheltered(documents, lambda rows: find_contamination(rows, benchmark).filter(F.size("_found.spans") == 0))


_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
)
CONTAMINATED_SQL = f"""
items AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_WORDS} AS w FROM benchmark),
windows AS (
  SELECT item, least(len(w), {WINDOW}) AS n, unnest(list_transform(range(1, len(w) - least(len(w), {WINDOW}) + 2), lambda i: array_to_string(w[i:i + least(len(w), {WINDOW}) - 1], ' '))) AS win
  FROM items WHERE len(w) > 0),
docs AS (SELECT *, row_number() OVER () AS rid, {_WORDS} AS w FROM source_documents),
places AS (
  SELECT rid, n, i, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, (SELECT DISTINCT n FROM windows))),
hits AS (SELECT rid, places.n, i, item FROM places JOIN (SELECT DISTINCT item, n, win FROM windows) v ON v.win = places.win AND v.n = places.n),
words AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT rid, i, n FROM hits)) GROUP BY rid),
named AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT rid, item FROM hits) GROUP BY rid)
"""
SQL = f"""
WITH source_documents AS (SELECT doc_id, text FROM documents),
{CONTAMINATED_SQL}
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN words USING (rid) LEFT JOIN named USING (rid)
"""


@query("op6_winnowing_contamination", SQL)
def _op6(spark, sf_dir):
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
