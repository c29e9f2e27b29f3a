"""Quality classification by importance resampling with hashed n-gram models."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewloom.llm.registry import query, sheltered, table
from reviewloom.llm.textbytes import WORD, chunks, mix, span_hashes
from reviewloom.plans.skew import order_statistics
from reviewloom.session import settle

BUCKETS = 1 << 20
# labelled rows that a fit may use, about
FIT_ROWS = 200_000
TEMPERATURE = 0.25
# a bucket counts once its target count is this many deviations from what the raw text foretells
DEVIATIONS = 5.0
# the first round: target, least log ratio, least deviations within the labelled texts
ROUNDS = (("_good", 0.0, 3.0),)
# the second round: target, deviations by which the interval of an n-gram's target share is drawn
BOUNDED = ("_clean", 2.5)
SEED = 17
# a document is rejected only on this much evidence, whatever the labelled sample would allow
EVIDENCE = 1.0

# word bytes, other visible bytes, blanks
_KIND = np.full(256, 2, np.uint8)
_KIND[WORD] = _KIND[65:91] = 1
_KIND[32] = _KIND[9:14] = 0
_REPEAT = np.uint64(0x52455045)
_OTHER = np.uint64(0xD6E8FEB86659FD93)


def grams(buf: np.ndarray, offsets: np.ndarray, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, bucket, other bucket) of every n-gram: each token, and a mark for a token that repeats the one before.

    Tokens are runs of letters, digits and non-ASCII characters, or of other visible characters, as written. Two
    independent hashes place an n-gram in the lower and in the upper half of the buckets.
    """
    kind = _KIND[buf]
    first = np.ones(len(buf), bool)
    first[1:] = kind[1:] != kind[:-1]
    cuts = offsets[1:-1]
    first[cuts[(cuts > 0) & (cuts < len(buf))]] = True
    starts = np.flatnonzero(first)
    ends = np.append(starts[1:], len(buf))
    visible = kind[starts] > 0
    starts, ends = starts[visible], ends[visible]
    rows = np.searchsorted(offsets, starts, "right") - 1
    hashes = span_hashes(buf, starts, ends)
    again = (hashes[1:] == hashes[:-1]) & (rows[1:] == rows[:-1])
    every = np.concatenate([hashes, np.full(int(again.sum()), _REPEAT)])
    half = np.uint64(buckets // 2)
    lower, upper = mix(every) % half, mix(every ^ _OTHER) % half + half
    return np.concatenate([rows, rows[1:][again]]), lower.astype(np.int64), upper.astype(np.int64)


@dataclass
class Round:
    """Log ratios by bucket (0 elsewhere) and the least key that stays."""

    target: str
    buckets: np.ndarray
    ratios: np.ndarray
    cut: float = float("-inf")


@dataclass
class Model:
    size: int = BUCKETS
    temperature: float = TEMPERATURE
    rounds: list[Round] = field(default_factory=list)


def _cautious(ratios: np.ndarray, lower: np.ndarray, upper: np.ndarray) -> np.ndarray:
    """The ratio of each n-gram: the smaller of its two buckets', 0 where they disagree, since one is then borrowed
    from an n-gram that shares the bucket."""
    a, b = ratios[lower], ratios[upper]
    return np.where(a * b > 0, np.where(np.abs(a) < np.abs(b), a, b), 0.0)


def _scores(texts: pa.Array, tables: list[np.ndarray], size: int) -> Iterator[tuple[int, int, list[np.ndarray], np.ndarray, np.ndarray]]:
    """(first row, end row, scores for each table, rows, buckets) of runs of rows."""
    for lo, hi, buf, offsets in chunks(texts):
        rows, lower, upper = grams(buf, offsets, size) if len(buf) else [np.zeros(0, np.int64)] * 3
        scores = [np.bincount(rows, weights=_cautious(t, lower, upper), minlength=hi - lo) for t in tables]
        yield lo, hi, scores, np.concatenate([rows, rows]), np.concatenate([lower, upper])


def _tables(model: Model) -> list[np.ndarray]:
    out = []
    for r in model.rounds:
        dense = np.zeros(model.size)
        dense[r.buckets] = r.ratios
        out.append(dense)
    return out


def _noise(temperature: float) -> Column:
    """Gumbel noise that a document's id and a seed decide."""
    u = (F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(1 << 52)).cast("double") + 0.5) / float(1 << 52)
    return F.lit(temperature) * -F.log(-F.log(u))


def score(documents: DataFrame, model: Model) -> DataFrame:
    """Add ``_keys``, for each round the log importance weight plus noise; a text without tokens weighs 0.

    An input column named ``_keys``, ``_noise`` or ``_weights`` is replaced.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)
    rows = documents.drop("_weights", "_noise", "_keys")
    schema = T.StructType([*rows.schema.fields, T.StructField("_weights", T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = _tables(shared.value)
        for batch in batches:
            weights = np.zeros((batch.num_rows, len(tables)))
            for lo, hi, scores, _, _ in _scores(batch["text"], tables, shared.value.size):
                weights[lo:hi] = np.stack(scores, 1) if scores else 0
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(list(weights), pa.list_(pa.float64()))], [*batch.schema.names, "_weights"])

    scored = rows.mapInArrow(run, schema).withColumn("_noise", _noise(model.temperature))
    return scored.withColumn("_keys", F.transform("_weights", lambda w: w + F.col("_noise"))).drop("_noise")


def stays(model: Model) -> Column:
    """Do all keys of a scored document reach their cuts."""
    out = F.lit(True)
    for i, r in enumerate(model.rounds):
        if r.cut > float("-inf"):
            out = out & (F.get("_keys", F.lit(i)) >= F.lit(r.cut))
    return out


def _ratios(labelled: DataFrame, target: str, model: Model, least: float, borne_out: float) -> Round:
    """Log ratio of the target model to that of the raw text, which is all documents that the rounds so far keep.

    log((t + 1) / (e + 1)) with t the target count of a bucket and e the count that its share of the raw text foretells; a
    bucket whose t lies within DEVIATIONS of e, or whose ratio is below ``least``, is taken as equal. So is one whose t
    lies within ``borne_out`` deviations of what its count in all labelled texts foretells: then copies that happen to
    have no label, or a few copied texts, made the difference.
    """
    context = labelled.sparkSession.sparkContext
    size, shared = model.size, context.broadcast(model)
    noisy = labelled.select("text", F.col(target).alias("_target"), _noise(model.temperature).alias("_noise"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model_ = shared.value
        tables = _tables(model_)
        raw, known, wanted = (np.zeros(size, np.int64) for _ in range(3))
        for batch in batches:
            noise = batch["_noise"].to_numpy(zero_copy_only=False)
            labelled_ = batch["_target"].is_valid().to_numpy(zero_copy_only=False)
            is_target = batch["_target"].fill_null(False).to_numpy(zero_copy_only=False)
            for lo, hi, scores, rows, buckets in _scores(batch["text"], tables, size):
                kept = np.ones(hi - lo, bool)
                for s, r in zip(scores, model_.rounds):
                    kept &= s + noise[lo:hi] >= r.cut
                raw += np.bincount(buckets[kept[rows]], minlength=size)
                known += np.bincount(buckets[(kept & labelled_[lo:hi])[rows]], minlength=size)
                wanted += np.bincount(buckets[(kept & is_target[lo:hi])[rows]], minlength=size)
        at = np.flatnonzero(raw)
        for lo in range(0, len(at), 100_000):
            part = at[lo : lo + 100_000]
            yield pa.RecordBatch.from_pydict({"bucket": part, "raw": raw[part], "known": known[part], "target": wanted[part]})

    sums = [F.sum(c).alias(c) for c in ("raw", "known", "target")]
    counts = settle(noisy.mapInArrow(run, "bucket long, raw long, known long, target long").groupBy("bucket").agg(*sums))
    total = counts.agg(*sums).first()
    if not total["target"] or total["target"] == total["known"]:
        return Round(target, np.zeros(0, np.int64), np.zeros(0))

    def off(count: str, share: float) -> Column:
        """Deviations between the target count and the one that a share of ``count`` foretells."""
        return (F.col("target") - F.col(count) * share) / F.sqrt(F.col(count) * (share * (1 - share)))

    share = total["target"] / total["raw"]
    ratio = F.log((F.col("target") + 1) / (F.col("raw") * share + 1))
    in_raw, in_known = off("raw", share), off("known", total["target"] / total["known"])
    clear = (F.abs(in_raw) >= DEVIATIONS) & (F.col("known") > 0) & (F.abs(in_known) >= borne_out) & (F.signum(in_raw) == F.signum(in_known))
    found = counts.select("bucket", ratio.alias("ratio")).filter(clear & (F.abs("ratio") >= least)).toArrow()
    return Round(target, found["bucket"].to_numpy(), found["ratio"].to_numpy())


def _bound(target: np.ndarray, known: np.ndarray, share: float, deviations: float) -> np.ndarray:
    """Log ratio to ``share`` of the nearest end of Wilson's interval for each target share; 0 where it holds ``share``.

    Fewer counts give a smaller ratio, none is cut off: an n-gram that occurs in no target text weighs
    log(deviations^2 / (known + deviations^2) / share).
    """
    z = deviations * deviations
    middle = (target + z / 2) / (known + z)
    half = deviations * np.sqrt(target * (known - target) / np.maximum(known, 1) + z / 4) / (known + z)
    return np.log(np.maximum(np.minimum(middle + half, share), middle - half) / share)


def _bounded(texts: DataFrame, target: str, size: int, deviations: float) -> tuple[Round, Model]:
    """Log ratios of a target among labelled texts, and two rounds of those without one target or one other text.

    A bucket counts once a text. Shares come from the labelled texts alone, so neither the size of the table nor the
    part of it that has labels changes a ratio.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, wanted = (np.zeros(size, np.int64) for _ in range(2))
        for batch in batches:
            is_target = batch["_target"].to_numpy(zero_copy_only=False).astype(bool)
            for lo, _, _, rows, buckets in _scores(batch["text"], [], size):
                pairs = np.unique(rows * size + buckets)
                at = pairs % size
                known += np.bincount(at, minlength=size)
                wanted += np.bincount(at[is_target[lo + pairs // size]], minlength=size)
        at = np.flatnonzero(known)
        for lo in range(0, len(at), 100_000):
            part = at[lo : lo + 100_000]
            yield pa.RecordBatch.from_pydict({"bucket": part, "known": known[part], "target": wanted[part]})

    sums = [F.sum(c).alias(c) for c in ("known", "target")]
    counted = texts.select("text", F.col(target).alias("_target")).mapInArrow(run, "bucket long, known long, target long")
    counts = counted.groupBy("bucket").agg(*sums).toArrow()
    bucket, known, wanted = (counts[c].to_numpy() for c in ("bucket", "known", "target"))
    share = wanted.sum() / max(1, known.sum())
    if share in (0, 1):
        return Round(target, np.zeros(0, np.int64), np.zeros(0)), Model(size)
    # a bucket may lack the text that is left out, then nothing asks for its ratio
    without = [
        Round(target, bucket, _bound(np.maximum(wanted - 1, 0), np.maximum(known - 1, 0), share, deviations)),
        Round(target, bucket, _bound(np.minimum(wanted, known - 1), known - 1, share, deviations)),
    ]
    return Round(target, bucket, _bound(wanted, known, share, deviations)), Model(size, rounds=without)


def best_cut(good: np.ndarray, bad: np.ndarray) -> float:
    """The cut with the fewest labelled documents on the wrong side, in the middle of the widest such gap."""
    if not len(good) or not len(bad):
        return float("-inf")
    keys = np.concatenate([good, bad])
    order = np.argsort(keys, kind="stable")
    keys, is_good = keys[order], np.concatenate([np.ones(len(good)), np.zeros(len(bad))])[order]
    # wrong[i]: good ones below the cut and bad ones above it, when i keys lie below
    wrong = np.concatenate([[0], np.cumsum(is_good)]) + len(bad) - np.concatenate([[0], np.cumsum(1 - is_good)])
    edges = np.concatenate([[keys[0] - 2.0], keys, [keys[-1] + 2.0]])
    gaps = edges[1:] - edges[:-1]
    gaps[wrong > wrong[gaps > 0].min()] = -1
    at = int(np.argmax(gaps))
    return float(edges[at] + gaps[at] / 2)


def fit(documents: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, buckets: int = BUCKETS, temperature: float = TEMPERATURE) -> Model:
    """Two rounds of resampling: for quality first, then, among what stays, against toxicity.

    The first round's counts of the raw text cover all documents. The second round's background are the labelled texts
    that the first keeps, each distinct one once; gross junk would otherwise make every ordinary word speak for a
    document. Its cut is learnt from keys that leave a text's own counts out. Labels are thinned by a hash of their id to about
    ``fit_rows`` rows, the bound of what is broadcast and of the keys that set a cut. Conflicting labels of one id
    count as the worse. Labels without id or quality are left out; without labels of both kinds a round keeps all. A cut
    is at most -EVIDENCE, so a text without any known n-gram stays.
    """
    usable = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
    kept = usable.groupBy("doc_id").agg(F.min("quality").alias("_quality"), F.max(F.coalesce("toxic", F.lit(0))).alias("_toxic"))
    n = kept.count()
    if n > fit_rows:
        kept = kept.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int((1 << 30) * fit_rows / n))
    sample = settle(kept.select("doc_id", (F.col("_quality") > 0).alias("_good"), ((F.col("_quality") > 0) & (F.col("_toxic") == 0)).alias("_clean")))
    rows = documents.select("doc_id", "text")
    labelled = rows.join(F.broadcast(sample), "doc_id", "left")
    model = Model(buckets, temperature)
    for target, least, borne_out in ROUNDS:
        model.rounds.append(_ratios(labelled, target, model, least, borne_out))
        known = score(rows.join(F.broadcast(sample), "doc_id"), model).filter(stays(model))
        keys = known.select(F.get("_keys", F.lit(len(model.rounds) - 1)).alias("key"), target).toArrow()
        is_good = keys[target].to_numpy(zero_copy_only=False).astype(bool)
        key = keys["key"].to_numpy()
        model.rounds[-1].cut = min(-EVIDENCE, best_cut(key[is_good], key[~is_good]))
    target, deviations = BOUNDED
    known = score(rows.join(F.broadcast(sample), "doc_id"), model).filter(stays(model))
    texts = known.groupBy("text").agg(F.min(target).alias(target), F.min("doc_id").alias("doc_id"))
    last, without = _bounded(texts, target, buckets, deviations)
    if without.rounds:
        own = F.when(F.col(target), F.get("_keys", F.lit(0))).otherwise(F.get("_keys", F.lit(1)))
        keys = score(texts, Model(buckets, temperature, without.rounds)).select(own.alias("key"), target).toArrow()
        is_good = keys[target].to_numpy(zero_copy_only=False).astype(bool)
        key = keys["key"].to_numpy()
        last.cut = min(-EVIDENCE, best_cut(key[is_good], key[~is_good]))
    model.rounds.append(last)
    return model


def resample(documents: DataFrame, model: Model, k: int | None = None) -> DataFrame:
    """A sample of the documents by their Gumbel keys, all columns, with their last ``_keys``.

    By default the documents whose keys reach the cuts of all rounds of the fit stay: a threshold on each round's key, not
    the k largest of one. With a given ``k`` the k largest keys of the last round stay, fewer if there are fewer; equal
    keys that straddle the bound stay together. A null doc_id draws noise like an id of its own; repeated rows share their
    fate; null and empty texts weigh 0; an empty table gives no rows.
    """
    scored = score(documents, model)
    if k is None:
        return scored.filter(stays(model))
    last = len(model.rounds) - 1
    counted = scored.withColumn("_key", F.get("_keys", F.lit(last)))
    groups = settle(counted.groupBy("_key").agg(F.count(F.lit(1)).alias("n")))
    total = groups.agg(F.sum("n")).first()[0] or 0
    if k >= total:
        return scored
    bound = order_statistics(groups, ["_key"], [total - k], weight="n")[total - k][0] if k > 0 else float("inf")
    return counted.filter(F.col("_key") >= bound).drop("_key")


def accepted(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents, all columns, that the fitted resampling keeps."""
    model = fit(documents, labels)
    return sheltered(documents, lambda rows: resample(rows, model))


@query("op7_importance_resampling")
def _op7(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    model = fit(documents, table(spark, sf_dir, "labels"))
    sample = resample(documents.select("doc_id", "text"), model)
    return sample.select(
        "doc_id",
        F.get("_weights", F.lit(0)).alias("quality_log_weight"),
        F.get("_weights", F.lit(1)).alias("clean_log_weight"),
        F.get("_keys", F.lit(1)).alias("gumbel_key"),
    )
