"""Language-model scores by context-tree weighting over bytes, learned and applied as Spark jobs."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from reviewloom.llm.registry import query, table
from reviewloom.llm.textbytes import INK, LOWER, chunks, mix, span_hashes, spans
from reviewloom.session import scratch_path

# bytes of context; context and next byte fill a key of 48 bits
DEPTH = 5
# bytes that no UTF-8 text holds: before the start, and at the end
START, END = 0xFE, 0xFF
BATCH_BYTES = 16_000_000
BYTES_PER_BUCKET = 4_000_000_000
LEAST_BUCKETS = 32
GRAMS, WORDS = 0, 1
END_WORD = np.uint64(0x454E44)
SPACE = 32


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Logarithm of the gamma function for positive arguments."""
    shifted = x + 8.0
    below = x * (x + 1) * (x + 2) * (x + 3) * (x + 4) * (x + 5) * (x + 6) * (x + 7)
    square = 1.0 / (shifted * shifted)
    series = (1.0 / 12 - square * (1.0 / 360 - square * (1.0 / 1260 - square / 1680))) / shifted
    return (shifted - 0.5) * np.log(shifted) - shifted + 0.5 * np.log(2 * np.pi) + series - np.log(below)


def log_estimate(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Krichevsky-Trofimov estimate, as a logarithm, of a sequence of so many zeros and ones."""
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - log_gamma(zeros + ones + 1.0) - np.log(np.pi)


def _weight(zeros: np.ndarray, ones: np.ndarray, below: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """log P_w = log(P_e / 2 + product of children / 2), and the share of P_e in it."""
    own = log_estimate(zeros, ones)
    both = np.logaddexp(own, below)
    return both - np.log(2.0), np.exp(own - both)


def canonical(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, row of each scored byte, its place, word hashes, word rows).

    A text becomes its words, A-Z lower-cased, one space between them, and an end byte; DEPTH start bytes precede it.
    """
    buf = LOWER[buf]
    n = len(offsets) - 1
    starts, ends, rows = spans(buf, offsets, INK)
    sizes = ends - starts
    counts = np.bincount(rows, minlength=n)
    lengths = np.bincount(rows, weights=sizes + 1, minlength=n).astype(np.int64) + (counts == 0)
    text_at = np.cumsum(lengths + DEPTH) - lengths
    total = int((lengths + DEPTH).sum())
    out = np.full(total, START, np.uint8)
    inside = np.cumsum(sizes + 1) - (sizes + 1)
    first = np.cumsum(counts) - counts
    if len(starts):
        word_at = text_at[rows] + inside - inside[first[rows]]
        ink = np.flatnonzero(INK[buf])
        out[ink + np.repeat(word_at - starts, sizes)] = buf[ink]
        out[word_at + sizes] = SPACE
    out[text_at + lengths - 1] = END
    scored = np.ones(total, bool)
    scored[(text_at[:, None] - 1 - np.arange(DEPTH)).ravel()] = False
    place = np.flatnonzero(scored)
    return out, np.repeat(np.arange(n), lengths), place, span_hashes(buf, starts, ends) | np.uint64(1 << 63), rows


def gram_keys(text: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Context, latest byte first, and the byte itself, as one number."""
    wide = text.astype(np.uint64)
    key = wide[place].copy()
    for back in range(1, DEPTH + 1):
        key |= wide[place - back] << np.uint64(8 * (DEPTH + 1 - back))
    return key


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def _distinct(texts: pa.Array, training: np.ndarray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Distinct keys of a batch of texts, sorted, with their counts in the training texts, for grams and words."""
    parts: dict[int, list] = {GRAMS: [], WORDS: []}
    for lo, hi, buf, offsets in chunks(texts):
        text, rows, place, words, word_rows = canonical(buf, offsets)
        learnt = training[lo:hi].astype(np.uint64)
        # the training mark in the lowest bit keeps both counts in one sort
        both, n = np.unique(gram_keys(text, place) << np.uint64(1) | learnt[rows], return_counts=True)
        parts[GRAMS].append(_summed(both >> np.uint64(1), n * (both & np.uint64(1)).astype(np.int64)))
        ends = np.full(hi - lo, END_WORD)
        parts[WORDS].append(_summed(np.concatenate([words, ends]), np.concatenate([learnt[word_rows], learnt]).astype(np.int64)))
    return {k: _summed(np.concatenate([x[0] for x in p]), np.concatenate([x[1] for x in p])) if p else (np.zeros(0, np.uint64), np.zeros(0, np.int64)) for k, p in parts.items()}


def _bucket(kind: int, keys: np.ndarray, buckets: int) -> np.ndarray:
    """Grams of the same two latest context bytes, a whole subtree, stay together."""
    return (mix(keys >> np.uint64(8 * (DEPTH - 1)) if kind == GRAMS else keys) % np.uint64(buckets)).astype(np.int64)


BLOCKS = "batch long, kind int, bucket int, keys binary, counts binary"
MODEL = "kind int, bucket int, keys binary, counts binary"
ANSWERS = "batch long, kind int, bucket int, answers binary"


def _blocks(buckets: int):
    """A batch of documents -> its distinct keys and training counts by bucket."""

    def run(docs: pa.Table) -> pa.Table:
        docs = docs.combine_chunks()
        batch = docs["batch"][0].as_py()
        found = _distinct(docs["text"].combine_chunks(), docs["training"].to_numpy())
        out = []
        for kind, (keys, counts) in found.items():
            place = _bucket(kind, keys, buckets)
            order = np.argsort(place, kind="stable")
            cuts = np.searchsorted(place[order], np.arange(buckets + 1))
            for b in np.flatnonzero(np.diff(cuts)):
                at = order[cuts[b] : cuts[b + 1]]
                out.append((batch, kind, int(b), keys[at].tobytes(), counts[at].astype(np.uint32).tobytes()))
        columns = list(zip(*out))
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["batch", "kind", "bucket", "keys", "counts"])

    return run


def _merge(blocks: pa.Table) -> pa.Table:
    """All blocks of a bucket -> its distinct keys with their summed counts."""
    keys = np.concatenate([np.frombuffer(x, np.uint64) for x in blocks["keys"].to_pylist()])
    counts = np.concatenate([np.frombuffer(x, np.uint32) for x in blocks["counts"].to_pylist()]).astype(np.int64)
    keys, counts = _summed(keys, counts)
    row = {"kind": blocks["kind"][0].as_py(), "bucket": blocks["bucket"][0].as_py(), "keys": keys.tobytes(), "counts": counts.tobytes(), "n": int(counts.sum()), "v": int((counts > 0).sum())}
    return pa.Table.from_pylist([row], pa.schema([("kind", pa.int32()), ("bucket", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary()), ("n", pa.int64()), ("v", pa.int64())]))


class Subtrees:
    """The context trees below some pairs of latest bytes, one tree for each of the 255 binary decisions of a byte.

    A decision is numbered by a leading one and the bits of the byte before it. ``levels[i][d]`` holds, for the i-th
    bit and contexts of d bytes, node numbers (context << 8 | decision), counts, the product of the children and the
    share of the own estimate in the weighted probability; ``of[i][d]`` is the node of each key.
    """

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        self.bits, self.levels, self.of = [], [], []
        byte, context = (keys & np.uint64(255)).astype(np.int64), (keys >> np.uint64(8)).astype(np.int64)
        for i in range(8):
            decision = (1 << i) | (byte >> (8 - i))
            bit = (byte >> (7 - i)) & 1
            node, of = np.unique(context << 8 | decision, return_inverse=True)
            zeros = np.bincount(of, weights=counts * (1 - bit), minlength=len(node))
            ones = np.bincount(of, weights=counts * bit, minlength=len(node))
            weighted, share = log_estimate(zeros, ones), np.ones(len(node))
            levels, maps = {DEPTH: (node, zeros, ones, weighted, share)}, {DEPTH: of}
            for d in range(DEPTH - 1, 1, -1):
                parent, up = np.unique(node >> 16 << 8 | node & 255, return_inverse=True)
                zeros, ones, below = (np.bincount(up, weights=x, minlength=len(parent)) for x in (zeros, ones, weighted))
                weighted, share = _weight(zeros, ones, below)
                node, of = parent, up[of]
                levels[d], maps[d] = (node, zeros, ones, weighted, share), of
            self.bits.append(bit)
            self.levels.append(levels)
            self.of.append(maps)
        self.decisions = [(1 << i) | (byte >> (8 - i)) for i in range(8)]
        self.latest = context >> (8 * (DEPTH - 1))

    def roots(self) -> list[tuple[np.ndarray, ...]]:
        """(latest byte << 8 | decision, zeros, ones, log P_w) of the contexts of two bytes."""
        return [(x[2][0] >> 16 << 8 | x[2][0] & 255, *x[2][1:4]) for x in self.levels]

    def log_probabilities(self, top: Top) -> np.ndarray:
        """log10 P(byte | context) of each key: eight decisions, each mixed over all depths at which it was seen."""
        out = np.zeros(len(self.latest))
        for i, bit in enumerate(self.bits):
            chance, seen = np.full(len(bit), 0.5), np.zeros(len(bit), bool)
            for d in range(DEPTH, 1, -1):
                _, zeros, ones, _, share = self.levels[i][d]
                at = self.of[i][d]
                chance, seen = _mixed(chance, seen, bit, zeros[at], ones[at], share[at])
            for zeros, ones, share, at in ((top.zeros, top.ones, top.share, self.latest << 8 | self.decisions[i]), (top.zeros0, top.ones0, top.share0, self.decisions[i])):
                chance, seen = _mixed(chance, seen, bit, zeros[at], ones[at], share[at])
            out += np.log10(chance)
        return out


def _mixed(chance, seen, bit, zeros, ones, share):
    """Mix a node's own estimate with that of the deeper node; a deeper node without counts has no say."""
    own = (np.where(bit == 1, ones, zeros) + 0.5) / (zeros + ones + 1.0)
    return np.where(seen, share * own + (1 - share) * chance, own), seen | (zeros + ones > 0)


class Top:
    """The nodes of contexts of one byte and of none: at most 257 x 255, whatever the corpus."""

    def __init__(self, at: np.ndarray, zeros: np.ndarray, ones: np.ndarray, below: np.ndarray):
        n = 1 << 16
        self.zeros, self.ones, products = (np.bincount(at, weights=x, minlength=n) for x in (zeros, ones, below))
        weighted, self.share = _weight(self.zeros, self.ones, products)
        decision = np.arange(n) & 255
        self.zeros0, self.ones0, products = (np.bincount(decision, weights=x, minlength=256) for x in (self.zeros, self.ones, np.where(self.zeros + self.ones > 0, weighted, 0.0)))
        _, self.share0 = _weight(self.zeros0, self.ones0, products)


def _roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for keys, counts in zip(batch["keys"].to_pylist(), batch["counts"].to_pylist()):
            for at, zeros, ones, weighted in Subtrees(np.frombuffer(keys, np.uint64), np.frombuffer(counts, np.int64)).roots():
                yield pa.RecordBatch.from_pydict({"at": at, "zeros": zeros, "ones": ones, "below": weighted})


def _answers(top):
    """Blocks next to the model of their bucket -> the value of each key: its count, or its log10 probability."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, values, known = None, None, None
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch[c][i] for c in batch.schema.names}
                kind, bucket = row["kind"].as_py(), row["bucket"].as_py()
                if held != (kind, bucket):
                    known = np.frombuffer(row["known"].as_py(), np.uint64)
                    counts = np.frombuffer(row["total"].as_py(), np.int64)
                    values = counts.astype(np.float64) if kind == WORDS else Subtrees(known, counts).log_probabilities(top.value)
                    held = kind, bucket
                asked = np.frombuffer(row["keys"].as_py(), np.uint64)
                yield pa.RecordBatch.from_pydict({
                    "batch": pa.array([row["batch"].as_py()], pa.int64()), "kind": pa.array([kind], pa.int32()), "bucket": pa.array([bucket], pa.int32()),
                    "answers": pa.array([values[np.searchsorted(known, asked)].tobytes()], pa.binary()),
                })

    return run


def _scored(buckets: int, n_tokens: int, n_words: int, schema: pa.Schema):
    """A batch of documents and the answers to its keys -> one row for each document."""
    unit = np.log10(float(n_tokens + n_words + 1))

    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return schema.empty_table()
        docs = docs.combine_chunks()
        texts = docs["text"].combine_chunks()
        found = _distinct(texts, np.zeros(docs.num_rows, bool))
        values = {}
        rows = sorted(zip(*(answers[c].to_pylist() for c in ("kind", "bucket", "answers"))))
        for kind, (keys, _) in found.items():
            order = np.argsort(_bucket(kind, keys, buckets), kind="stable")
            values[kind] = np.empty(len(keys))
            values[kind][order] = np.concatenate([np.frombuffer(x, np.float64) for k, _, x in rows if k == kind])
        out = {c: np.zeros(docs.num_rows) for c in ("score", "base_score", "n_tokens", "n_known", "n_bytes")}
        for lo, hi, buf, offsets in chunks(texts):
            text, at, place, words, word_rows = canonical(buf, offsets)
            n = hi - lo
            each = values[GRAMS][np.searchsorted(found[GRAMS][0], gram_keys(text, place))]
            out["score"][lo:hi] = np.bincount(at, weights=each, minlength=n)
            out["n_bytes"][lo:hi] = np.bincount(at, minlength=n)
            tokens, token_rows = np.concatenate([words, np.full(n, END_WORD)]), np.concatenate([word_rows, np.arange(n)])
            count = values[WORDS][np.searchsorted(found[WORDS][0], tokens)]
            out["base_score"][lo:hi] = np.bincount(token_rows, weights=np.log10(count + 1) - unit, minlength=n)
            out["n_tokens"][lo:hi] = np.bincount(token_rows, minlength=n)
            out["n_known"][lo:hi] = np.bincount(token_rows[count > 0], minlength=n)
        made = [docs["doc_id"], docs["held_out"], *(pa.array(out[f.name].astype(np.int64) if pa.types.is_int64(f.type) else out[f.name], f.type) for f in list(schema)[2:])]
        return pa.Table.from_arrays([x.cast(f.type) for x, f in zip(made, schema)], schema=schema)

    return run


def scores(documents: DataFrame, held_out=None, batch_bytes: int = BATCH_BYTES, buckets: int | None = None) -> DataFrame:
    """Score every text with a model learned from those outside the held-out fold.

    ``held_out`` is a condition on doc_id (default: crc32 of the id as text, modulo 7, is 2; null ids are in training);
    a null condition counts as training. Columns: doc_id, held_out, n_tokens (words and the end), n_known,
    train_tokens, base_score (add-one word model), score (log10 probability of the canonical text, see ``canonical``),
    n_bytes and bits_per_byte, the code length for each of its bytes.

    Null and empty texts are an end alone; repeated rows are scored, and counted in training, each; with nothing to
    learn from every bit costs one bit; an empty table gives no rows. Other columns are not read.

    Texts are dealt into batches by content. A batch asks for its distinct keys only; keys are merged by bucket, grams
    by the two latest bytes of context, so a bucket holds whole subtrees and the driver sees only the 65,280 nodes above
    them. The answers return to the batch in the order it asked. Nothing that grows with the corpus is broadcast.
    """
    spark = documents.sparkSession
    if held_out is None:
        held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    rows = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.coalesce(held_out, F.lit(False)).alias("held_out"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_batches = max(1, -(-int(total) // batch_bytes))
    buckets = buckets or LEAST_BUCKETS + int(total) // BYTES_PER_BUCKET
    docs = rows.select(F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_batches)).alias("batch"), "doc_id", "text", "held_out", (~F.col("held_out")).alias("training"))
    path = scratch_path(spark, "grams")
    docs.groupBy("batch").applyInArrow(_blocks(buckets), BLOCKS).write.parquet(path)
    blocks = spark.read.schema(BLOCKS).parquet(path)
    merged = blocks.groupBy("kind", "bucket").applyInArrow(_merge, MODEL + ", n long, v long")
    path = scratch_path(spark, "model")
    merged.write.parquet(path)
    model = spark.read.schema(MODEL + ", n long, v long").parquet(path)
    words = model.filter(F.col("kind") == WORDS).agg(F.sum("n").alias("n"), F.sum("v").alias("v")).first()
    n_tokens, n_words = int(words["n"] or 0), int(words["v"] or 0)
    roots = model.filter(F.col("kind") == GRAMS).mapInArrow(_roots, "at long, zeros double, ones double, below double")
    upper = roots.groupBy("at").agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum("below").alias("below")).orderBy("at").toArrow()
    top = spark.sparkContext.broadcast(Top(*(upper[c].to_numpy() for c in ("at", "zeros", "ones", "below"))))
    asked = blocks.select("batch", "kind", "bucket", "keys").join(model.select("kind", "bucket", F.col("keys").alias("known"), F.col("counts").alias("total")), ["kind", "bucket"])
    answers = asked.mapInArrow(_answers(top), ANSWERS)
    out = T.StructType([
        documents.select("doc_id").schema["doc_id"], T.StructField("held_out", T.BooleanType()), T.StructField("n_tokens", T.LongType()), T.StructField("n_known", T.LongType()),
        T.StructField("base_score", T.DoubleType()), T.StructField("score", T.DoubleType()), T.StructField("n_bytes", T.LongType()),
    ])
    scored = docs.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(_scored(buckets, n_tokens, n_words, to_arrow_schema(out)), out)
    bits = -F.col("score") / F.lit(float(np.log10(2))) / F.col("n_bytes")
    return scored.withColumn("train_tokens", F.lit(n_tokens).cast("long")).withColumn("bits_per_byte", bits)


@query("op5_context_tree_scores")
def _op5(spark, sf_dir):
    return scores(table(spark, sf_dir, "documents"))
