"""Sentiment classifier over text and four numeric features.

Training and scoring work on texts, not on rows: rows of a batch that share title and text are counted, hashed and weighed
once, and only their numbers are handled row by row. In training a text is hashed and weighed once for all of its titles, as no
word reaches from a title into its text. The sums are those over all rows.
"""

from __future__ import annotations

from collections.abc import Callable, Generator, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import RDD, StorageLevel
from pyspark.ml.feature import HashingTF
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewloom.functions.text import tokens
from reviewloom.functions.vectors import class_confidences, predicted_class
from reviewloom.operators.features import model_input
from reviewloom.session import settle

NUMERIC = ["price", "price_missing", "helpful_vote", "verified_purchase"]
TEXT = ["title", "text"]

# training stops here unless it has converged before
MAX_ITER = 100
# as pyspark.ml's regression: relative tolerance, steps over which the value must stand still, pairs kept of the descent
TOLERANCE, STANDSTILL, MEMORY = 1e-6, 20, 10
TEXTS_IN_BLOCK = 4096
# partial sums of more tasks than this are added up by tasks before they reach the driver
DIRECT_SUMS = 64


@dataclass
class TextModel:
    """Weights (class, hashed term or number), intercepts and the steps that training took."""

    n_features: int
    weights: np.ndarray
    intercepts: np.ndarray
    steps: int


def iterations(model: TextModel) -> int:
    """Training steps of the fitted regression; below its limit it converged."""
    return model.steps


def _lists(batch: pa.RecordBatch, carried: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.StructArray]:
    """Groups of rows that share title and text, those of a text in sequence: a row of each, its number of text, how many rows it has, all their other columns."""
    titles, texts = (pc.dictionary_encode(batch[c], null_encoding="encode") for c in TEXT)
    text = texts.indices.to_numpy().astype(np.int64)
    _, first, group = np.unique(text * (len(titles.dictionary) + 1) + titles.indices.to_numpy(), return_index=True, return_inverse=True)
    order = pa.array(np.argsort(group, kind="stable"))
    held = pa.StructArray.from_arrays([batch[c].take(order) for c in carried], carried)
    return first, text[first], np.bincount(group, minlength=len(first)), held


def _ends(sizes: np.ndarray) -> pa.Array:
    return pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))


def by_text(rows: DataFrame) -> DataFrame:
    """One row per title and text of a batch, the other columns of its rows as a list ``rows``; nothing is shuffled."""
    carried = [c for c in rows.columns if c not in TEXT]
    inner = T.StructType([rows.schema[c] for c in carried])
    schema = T.StructType([*[rows.schema[c] for c in TEXT], T.StructField("rows", T.ArrayType(inner))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first, _, sizes, held = _lists(batch, carried)
            lists = pa.ListArray.from_arrays(_ends(sizes), held)
            yield pa.RecordBatch.from_arrays([*[batch[c].take(pa.array(first)) for c in TEXT], lists], schema.names)

    return rows.select(*TEXT, *carried).mapInArrow(run, schema)


def by_piece(rows: DataFrame) -> DataFrame:
    """Each text of a batch as a row of its own (``whole``) without ``rows``, followed by a row per title with the list of rows that have both."""
    carried = [c for c in rows.columns if c not in TEXT]
    inner = T.StructType([rows.schema[c] for c in carried])
    schema = T.StructType([T.StructField("said", T.StringType()), T.StructField("whole", T.BooleanType()), T.StructField("rows", T.ArrayType(inner))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first, text, sizes, held = _lists(batch, carried)
            new = np.flatnonzero(np.diff(text, prepend=-1))
            # the place of a text is before its first title
            order = np.argsort(np.concatenate([2 * new, 2 * np.arange(len(first)) + 1]), kind="stable")
            said = pa.concat_arrays([batch["text"].take(pa.array(first[new])), batch["title"].take(pa.array(first))]).take(pa.array(order))
            sizes = np.concatenate([np.zeros(len(new), np.int64), sizes])[order]
            yield pa.RecordBatch.from_arrays([said, pa.array(order < len(new)), pa.ListArray.from_arrays(_ends(sizes), held)], schema.names)

    return rows.select(*TEXT, *carried).mapInArrow(run, schema)


def _hashed(rows: DataFrame, said: Column, n_features: int) -> DataFrame:
    spoken = rows.withColumn("_tokens", tokens(F.lower(said)))
    counted = HashingTF(inputCol="_tokens", outputCol="_tf", numFeatures=n_features).transform(spoken).withColumn("_tf", F.unwrap_udt("_tf"))
    return counted.select(*rows.columns, F.col("_tf.indices").alias("terms"), F.col("_tf.values").alias("counts"))


def with_terms(texts: DataFrame, n_features: int) -> DataFrame:
    """Add the hashed terms of title and text and how often each occurs."""
    return _hashed(model_input(texts, "_combined"), F.col("_combined"), n_features).drop("_combined")


def _held(n_features: int) -> dict[str, type]:
    """What a block holds, as bytes: rows and terms per piece (a text or title), terms and their counts, numbers, labels and parts of rows,
    which pieces are texts."""
    term = np.uint16 if n_features <= 1 << 16 else np.int32
    return {"n_rows": np.int32, "n_terms": np.int32, "terms": term, "counts": np.uint32, "numbers": np.float64, "labels": np.int32, "parts": np.bool_, "whole": np.bool_}


def _blocks(features: DataFrame, label: str, n_features: int, train_share: float, seed: int) -> RDD:
    """Blocks of texts with their labelled rows, written once: training passes over them many times."""
    kinds = _held(n_features)
    rows = features.filter(F.col(label).isNotNull()).select(
        *TEXT, *[F.col(c).cast("double") for c in NUMERIC], F.col(label).cast("int").alias("_label"), (F.rand(seed) < train_share).alias("_part")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text = None
        for batch in batches:
            for lo in range(0, batch.num_rows, TEXTS_IN_BLOCK):
                piece = batch.slice(lo, TEXTS_IN_BLOCK)
                if not piece["whole"][0].as_py():
                    # titles of a text that the block before has
                    piece = pa.concat_batches([text, piece])
                at = int(np.flatnonzero(piece["whole"].to_numpy(zero_copy_only=False))[-1])
                text = piece.slice(at, 1)
                if not len(piece["rows"].flatten()):
                    continue
                *numbers, labels, parts = piece["rows"].flatten().flatten()
                table = np.stack([c.to_numpy(zero_copy_only=False).astype(np.float64) for c in numbers], 1)
                if np.isnan(table).any():
                    raise ValueError(f"null or NaN among {NUMERIC}")
                values = [
                    pc.list_value_length(piece["rows"]).to_numpy(), pc.list_value_length(piece["terms"]).to_numpy(), piece["terms"].flatten().to_numpy(),
                    piece["counts"].flatten().to_numpy(), table, labels.to_numpy(), parts.to_numpy(zero_copy_only=False),
                    piece["whole"].to_numpy(zero_copy_only=False),
                ]
                held = {name: [np.ascontiguousarray(v, dtype).tobytes()] for v, (name, dtype) in zip(values, kinds.items())}
                yield pa.RecordBatch.from_pydict(held)

    told = _hashed(by_piece(rows), F.coalesce("said", F.lit("")), n_features).select("whole", "rows", "terms", "counts")
    blocks = settle(told.mapInArrow(run, ", ".join(f"{name} binary" for name in kinds))).rdd
    return blocks.coalesce(2 * blocks.context.defaultParallelism).map(tuple).persist(StorageLevel.MEMORY_AND_DISK)


class _Block:
    """A block of texts and their titles in numbers. ``part``: the rows of which part count, or None for all."""

    def __init__(self, held: tuple, n_features: int, part: bool | None):
        kinds = _held(n_features).values()
        self.n_rows, self.n_terms, terms, counts, numbers, self.labels, parts, self.whole = (np.frombuffer(b, t) for b, t in zip(held, kinds))
        # widened here once; every class and penalty looks them up
        self.terms, self.counts = terms.astype(np.intp), counts.astype(np.float64)
        self.numbers = numbers.reshape(-1, len(NUMERIC))
        self.n_features = n_features
        self.counted = np.ones(len(parts), bool) if part is None else parts == part
        self.piece = np.repeat(np.arange(len(self.n_rows)), self.n_rows)
        self.texts = np.flatnonzero(self.whole)
        self.text = np.cumsum(self.whole) - 1
        self.spoken = np.flatnonzero(self.n_terms)
        self.first_term = (np.cumsum(self.n_terms) - self.n_terms)[self.spoken]

    def margins(self, weights: np.ndarray, intercepts: np.ndarray) -> np.ndarray:
        """(class, row): the shares of a text and of a title are found once for all of their rows."""
        told = np.zeros((len(weights), len(self.n_rows)))
        for k, w in enumerate(weights):
            if len(self.spoken):
                told[k, self.spoken] = np.add.reduceat(w[: self.n_features][self.terms] * self.counts, self.first_term)
        told += told[:, self.texts[self.text]]
        return told[:, self.piece] + weights[:, self.n_features :] @ self.numbers.T + intercepts[:, None]

    def by_piece(self, per_row: np.ndarray) -> np.ndarray:
        """Sum of a number for each row over the rows of a title, and of a text."""
        per_piece = np.bincount(self.piece, per_row, len(self.n_rows))
        per_piece[self.texts] = np.bincount(self.text, per_piece, len(self.texts))
        return per_piece

    def sums(self, per_row: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Sum over rows of a number for each row times the row's counts of terms."""
        return np.bincount(self.terms, np.repeat(self.by_piece(per_row), self.n_terms) * counts, self.n_features)

    def squares(self, per_row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same with whether a row holds a term, and with its squared counts: terms that a title shares with its text are one term of the row."""
        entry = np.repeat(np.arange(len(self.n_terms)), self.n_terms)
        key, of_text = self.text[entry] * self.n_features + self.terms, self.whole[entry]
        # terms of a piece are in order, so keys of texts are
        keys, known = key[of_text], self.counts[of_text]
        at = np.minimum(np.searchsorted(keys, key), max(len(keys) - 1, 0))
        shared = np.where(~of_text & (keys[at] == key), known[at], 0) if len(keys) else np.zeros(len(key))
        weight = self.by_piece(per_row)[entry]
        return tuple(np.bincount(self.terms, weight * x, self.n_features) for x in (shared == 0, self.counts * (self.counts + 2 * shared)))


def _total(blocks: RDD, per_block: Callable[[tuple], list[np.ndarray]]) -> list[np.ndarray]:
    """Sums of arrays over all blocks."""

    def run(held: Iterator[tuple]) -> Iterator[list[np.ndarray]]:
        total = None
        for block in held:
            found = per_block(block)
            total = found if total is None else [a + b for a, b in zip(total, found)]
        if total is not None:
            yield total

    parts = blocks.mapPartitions(run)
    return parts.treeReduce(lambda a, b: [x + y for x, y in zip(a, b)], depth=1 if blocks.getNumPartitions() <= DIRECT_SUMS else 2)


@dataclass
class _Scale:
    """Rows, rows by class, means of all columns, and one over their deviations (0: the column says nothing)."""

    n: float
    classes: np.ndarray
    mean: np.ndarray
    inverse: np.ndarray


def _scale(blocks: RDD, n_features: int, part: bool | None) -> _Scale:
    """A term that every row holds has no inverse document frequency and no say, as a column of one value."""
    pivot = np.frombuffer(blocks.first()[4], np.float64)[: len(NUMERIC)]
    n_classes = blocks.map(lambda held: int(np.frombuffer(held[5], np.int32).max())).max() + 1

    def per_block(held: tuple) -> list[np.ndarray]:
        b = _Block(held, n_features, part)
        rows = b.counted.astype(np.float64)
        moved = (b.numbers - pivot)[b.counted]
        holding, squared = b.squares(rows)
        return [np.bincount(b.labels[b.counted], minlength=n_classes), holding, b.sums(rows, b.counts), squared, moved.sum(0), (moved**2).sum(0)]

    classes, holding, once, squared, once_numbers, squared_numbers = _total(blocks, per_block)
    n = float(classes.sum())
    sums, squares = np.concatenate([once, once_numbers]), np.concatenate([squared, squared_numbers])
    spread = (squares - sums**2 / n) / max(n - 1, 1)
    says = spread > 1e-12 * squares / n
    says[:n_features] &= holding < n
    inverse = np.where(says, 1 / np.sqrt(np.where(says, spread, 1)), 0)
    mean = sums / n + np.concatenate([np.zeros(n_features), pivot])
    return _Scale(n, classes, mean, inverse)


def _descent(x: np.ndarray, max_iter: int) -> Generator[np.ndarray, tuple[float, np.ndarray], tuple[np.ndarray, int]]:
    """Limited-memory BFGS. Yields points, is sent the value and gradient there; returns the last point and the steps."""
    f, g = yield x
    start, seen, pairs = abs(f), [], []
    for step in range(max_iter):
        if np.linalg.norm(g) <= max(TOLERANCE * abs(f), 1e-8):
            return x, step
        d, kept = -g, []
        for s, y in reversed(pairs):
            kept.append((s @ d) / (s @ y))
            d = d - kept[-1] * y
        if pairs:
            s, y = pairs[-1]
            d = d * ((s @ y) / (y @ y))
        for (s, y), a in zip(pairs, reversed(kept)):
            d = d + (a - (y @ d) / (s @ y)) * s
        # a length that lowers the value enough and flattens the slope enough
        slope, length, low, high = g @ d, 1.0 if pairs else 1 / np.linalg.norm(g), 0.0, np.inf
        for _ in range(30):
            f_new, g_new = yield x + length * d
            if not f_new <= f + 1e-4 * length * slope:
                high = length
            elif g_new @ d < 0.9 * slope:
                low = length
            else:
                break
            length = (low + high) / 2 if high < np.inf else 2 * low
        else:
            return x, step
        s, y = length * d, g_new - g
        x, f, g = x + s, f_new, g_new
        if s @ y > 0:
            pairs = [*pairs, (s, y)][-MEMORY:]
        seen.append(f)
        if len(seen) > 1 and max(seen[-STANDSTILL:]) - f <= TOLERANCE * start:
            return x, step + 1
    return x, max_iter


def _trained(blocks: RDD, n_features: int, penalties: Sequence[float], max_iter: int, part: bool | None) -> list[TextModel]:
    """Multinomial regressions on standardised columns, one for each penalty; a pass over the blocks serves all of them."""
    scale = _scale(blocks, n_features, part)
    k, width = len(scale.classes), n_features + len(NUMERIC)

    def plain(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Weights and intercepts for columns as they are."""
        weights = x[: k * width].reshape(k, width) * scale.inverse
        return weights, x[k * width :] - weights @ scale.mean

    def evaluated(points: dict[int, np.ndarray]) -> dict[int, tuple[float, np.ndarray]]:
        tried = {i: plain(x) for i, x in points.items()}

        def per_block(held: tuple) -> list[np.ndarray]:
            b, found = _Block(held, n_features, part), []
            row = np.arange(len(b.labels))
            for weights, intercepts in tried.values():
                # margins beside that of the last class, whose slope is what the others leave: all classes together have none
                margin = np.concatenate([b.margins(weights[:-1] - weights[-1], intercepts[:-1] - intercepts[-1]), np.zeros((1, len(row)))])
                margin -= margin.max(0)
                share = np.exp(margin)
                whole = share.sum(0)
                loss = (np.log(whole) - margin[b.labels, row])[b.counted].sum()
                share /= whole
                share[b.labels, row] -= 1
                share[:, ~b.counted] = 0
                slopes = np.zeros((k, n_features))
                for j, m in enumerate(share[:-1]):
                    slopes[j] = b.sums(m, b.counts)
                slopes[-1] = -slopes[:-1].sum(0)
                slopes = np.concatenate([slopes, share @ b.numbers], 1)
                found += [np.array(loss), slopes, share.sum(1)]
            return found

        sums, out = _total(blocks, per_block), {}
        for (i, x), (loss, slopes, level) in zip(points.items(), zip(sums[::3], sums[1::3], sums[2::3])):
            beta = x[: k * width]
            steep = ((slopes - level[:, None] * scale.mean) * scale.inverse).ravel() / scale.n + penalties[i] * beta
            out[i] = float(loss) / scale.n + penalties[i] / 2 * float(beta @ beta), np.concatenate([steep, level / scale.n])
        return out

    shares = np.log1p(scale.classes)
    start = np.concatenate([np.zeros(k * width), shares - shares.mean()])
    runs = [_descent(start, max_iter) for _ in penalties]
    points, ended = {i: next(run) for i, run in enumerate(runs)}, {}
    while points:
        values, after = evaluated(points), {}
        for i, value in values.items():
            try:
                after[i] = runs[i].send(value)
            except StopIteration as end:
                ended[i] = end.value
        points = after
    return [TextModel(n_features, *plain(ended[i][0]), ended[i][1]) for i in range(len(penalties))]


def _weighted_f1(blocks: RDD, models: Sequence[TextModel], part: bool) -> list[float]:
    """F1 by class, weighted by the rows of a class, over the rows of one part."""
    k = len(models[0].intercepts)

    def per_block(held: tuple) -> list[np.ndarray]:
        b = _Block(held, models[0].n_features, part)
        guessed = [np.argmax(b.margins(m.weights, m.intercepts), axis=0) for m in models]
        return [np.bincount((b.labels * k + g)[b.counted], minlength=k * k).reshape(k, k) for g in guessed]

    out = []
    for table in _total(blocks, per_block):
        hits, support = table.diagonal(), table.sum(1)
        f1 = 2 * hits / np.maximum(support + table.sum(0), 1)
        out.append(float((f1 * support).sum() / max(support.sum(), 1)))
    return out


def fit_classifier(features: DataFrame, label: str = "label", n_features: int = 4096, max_iter: int = MAX_ITER) -> TextModel:
    """``iterations`` of the result tells whether training stopped at ``max_iter``. Rows without a label are left out."""
    blocks = _blocks(features, label, n_features, 1.0, 0)
    try:
        return _trained(blocks, n_features, [0.0], max_iter, None)[0]
    finally:
        blocks.unpersist()


def tune_classifier(
    features: DataFrame, label: str = "label", n_features: int = 4096, penalties: Sequence[float] = (0.0, 0.01, 0.1), seed: int = 42,
    max_iter: int = MAX_ITER,
) -> tuple[TextModel, dict[float, float]]:
    """Grid over the penalty by weighted F1 on a held-out fifth; the model is trained on all rows with the best one."""
    blocks = _blocks(features, label, n_features, 0.8, seed)
    try:
        scores = _weighted_f1(blocks, _trained(blocks, n_features, penalties, max_iter, True), False)
        best = penalties[int(np.argmax(scores))]
        return _trained(blocks, n_features, [best], max_iter, None)[0], dict(zip(penalties, scores))
    finally:
        blocks.unpersist()


def score(model: TextModel, features: DataFrame, classes: Sequence[str]) -> DataFrame:
    """Batch scoring: ``prediction`` holds ``["LABEL", {"POS":…}]`` per row."""
    shared = features.sparkSession.sparkContext.broadcast(model)
    n = model.n_features

    told = with_terms(by_text(features), n)
    schema = T.StructType([*told.schema.fields[:-2], T.StructField("_told", T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = shared.value.weights
        for batch in batches:
            sizes = pc.list_value_length(batch["terms"]).to_numpy()
            terms, counts = (batch[c].flatten().to_numpy() for c in ("terms", "counts"))
            ends = np.cumsum(sizes)
            sums = [weights[:, terms[lo:hi]] @ counts[lo:hi] for lo, hi in zip(ends - sizes, ends)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], pa.array(sums, pa.list_(pa.float64()))], schema.names)

    told = told.mapInArrow(run, schema)
    rows = told.select(*TEXT, "_told", F.explode("rows").alias("_row")).select(*TEXT, "_told", "_row.*")

    def logit(k: int):
        numbers = (F.col(c).cast("double") * F.lit(float(w)) for c, w in zip(NUMERIC, model.weights[k, n:]))
        return sum(numbers, F.get("_told", F.lit(k)) + F.lit(float(model.intercepts[k])))

    scored = rows.withColumn("_logits", F.array(*[logit(k) for k in range(len(model.intercepts))]))
    confidences = class_confidences("_logits", classes)
    text = F.concat(F.lit('["'), predicted_class("_logits", classes), F.lit('", '), F.to_json(confidences), F.lit("]"))
    return scored.select(*features.columns, text.alias("prediction"))
