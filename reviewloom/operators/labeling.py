"""Weak labels: rule matrix, label model, votes, lexicon scores."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewloom.functions.columns import label_name
from reviewloom.functions.labels import DEFAULT_RULES, ROW_MAPS, RULES, compound, lexicon_maps, map_value, row_maps, score_label, valence_sum
from reviewloom.functions.sentiment import literal_valence, scoped_valence, spoken_tokens
from reviewloom.functions.text import tokens
from reviewloom.plans.skew import may_broadcast
from reviewloom.session import settle


def label_matrix(
    df: DataFrame, rules: Sequence[str] | dict[str, Column] = tuple(DEFAULT_RULES), lexicon: dict[str, float] | DataFrame | None = None
) -> DataFrame:
    """One vote column per labelling rule; a given lexicon serves the rules named lexicon and scoped_lexicon."""
    exprs = rules if isinstance(rules, dict) else {name: RULES[name]() for name in rules}
    out = df.withColumns(exprs)
    for name in ("lexicon", "scoped_lexicon"):
        if lexicon is not None and name in exprs:
            out = _with_valence(out, "text", lexicon, name, lambda v: score_label(compound(v)), scoped=name == "scoped_lexicon")
    return out


def vote_patterns(df: DataFrame, votes: Sequence[str]) -> DataFrame:
    """Distinct vote combinations with counts: at most classes ** rules rows."""
    return df.groupBy(*votes).agg(F.count(F.lit(1)).alias("n"))


def fit_label_model(df: DataFrame, votes: Sequence[str], classes: int = 3, rounds: int = 100) -> dict[tuple, int]:
    """Generative label model by weighted expectation-maximisation.

    The data enters only through the counts of its vote combinations, so the fit
    is exact and of constant size whatever the number of rows. Ties go to the
    smallest class.
    """
    rows = vote_patterns(df, votes).orderBy(*votes).collect()
    patterns = np.array([[r[v] for v in votes] for r in rows], dtype=int).reshape(len(rows), len(votes))
    weight = np.array([r["n"] for r in rows], dtype=float)
    # start from the vote shares of each combination
    belief = np.stack([(patterns == k).sum(axis=1) for k in range(classes)], axis=1) + 0.1
    belief = belief / belief.sum(axis=1, keepdims=True)
    for _ in range(rounds):
        mass = belief * weight[:, None]
        prior = (mass.sum(axis=0) + 1.0) / (mass.sum() + classes)
        score = np.log(prior)[None, :].repeat(len(rows), axis=0)
        for j in range(len(votes)):
            seen = np.stack([mass[patterns[:, j] == v].sum(axis=0) for v in range(classes)]) + 1.0
            likelihood = seen / seen.sum(axis=0, keepdims=True)
            score += np.log(likelihood[patterns[:, j]])
        score -= score.max(axis=1, keepdims=True)
        updated = np.exp(score)
        updated /= updated.sum(axis=1, keepdims=True)
        if np.abs(updated - belief).max() < 1e-10:
            belief = updated
            break
        belief = updated
    return {tuple(int(x) for x in p): int(np.argmax(np.round(b, 9))) for p, b in zip(patterns, belief)}


def apply_label_model(df: DataFrame, votes: Sequence[str], model: dict[tuple, int], name: str = "sentiment_label") -> DataFrame:
    """Label per row from the fitted table, as one literal expression."""
    expr = F.lit(None).cast("int")
    for pattern, label in sorted(model.items()):
        hit = F.lit(True)
        for vote, value in zip(votes, pattern):
            hit = hit & (F.col(vote) == value)
        expr = F.when(hit, F.lit(label)).otherwise(expr)
    return df.withColumn(name, label_name(expr))


def weak_labels(
    df: DataFrame, rules: Sequence[str] = tuple(DEFAULT_RULES), keep_votes: bool = False, lexicon: dict[str, float] | DataFrame | None = None
) -> DataFrame:
    """Votes, fitted label model and its label in one step."""
    matrix = label_matrix(df, rules, lexicon)
    labelled = apply_label_model(matrix, rules, fit_label_model(matrix, rules))
    return labelled if keep_votes else labelled.drop(*rules)


def majority_label(df: DataFrame, votes: Sequence[str], name: str = "majority", classes: int = 3) -> DataFrame:
    """Most frequent vote; ties go to the smallest code."""
    counts = [sum(((F.col(v) == k).cast("int") for v in votes), F.lit(0)) for k in range(classes)]
    most = F.greatest(*counts)
    expr = F.lit(classes - 1)
    for k in reversed(range(classes - 1)):
        expr = F.when(counts[k] == most, F.lit(k)).otherwise(expr)
    return df.withColumn(name, expr)


def lexicon_label(
    df: DataFrame, lexicon: dict[str, float] | DataFrame | None = None, text: str = "text", name: str = "sentiment_label",
    scoped: bool = False, row_id: str = "row_id",
) -> DataFrame:
    """Compound lexicon score and its label.

    The built-in lexicon is a literal. A given one, a mapping or a table (word, valence), is measured: while it is small it
    becomes one value of short maps that every row reads, and no id is needed and no column moves; beyond, each row's words
    are joined with the table by ``row_id``, which must be unique then. Both give the same scores. ``scoped`` counts
    negation, strength and contrast as well (:func:`~reviewloom.functions.sentiment.scoped_valence`).
    """
    return _with_valence(df, text, lexicon, "compound", compound, scoped, row_id).withColumn(name, label_name(score_label("compound")))


def _with_valence(
    df: DataFrame, text: str, lexicon: dict[str, float] | DataFrame | None, name: str, of: Callable, scoped: bool = False, row_id: str = "row_id"
) -> DataFrame:
    """Add ``of`` the valence sum of a text."""
    if lexicon is None:
        return df.withColumn(name, of(scoped_valence(text, literal_valence()) if scoped else valence_sum(text)))
    if isinstance(lexicon, dict):
        lexicon = df.sparkSession.createDataFrame([(w, float(v)) for w, v in lexicon.items()], "word string, valence double")
    known = lexicon.filter("word is not null").groupBy("word").agg(F.sum(F.col("valence").cast("double")).alias("valence"))
    known = settle(known)
    if may_broadcast(known):
        held, value = df.withColumn("_maps", lexicon_maps(known)), map_value("_maps")
    else:
        said = F.transform(spoken_tokens(text), F.lower) if scoped else tokens(F.lower(F.coalesce(F.col(text), F.lit(""))))
        pairs = df.select(row_id, F.explode(F.array_distinct(said)).alias("word")).join(known, "word")
        held = df.join(row_maps(pairs, row_id, "word", "valence", "_maps"), row_id, "left").select(*df.columns, "_maps")
        value = map_value("_maps", ROW_MAPS)
    total = scoped_valence(text, value) if scoped else valence_sum(text, value=value)
    return held.withColumn(name, of(total)).drop("_maps")


def with_known(df: DataFrame, said: Column, known: DataFrame, row_id: str, name: str) -> DataFrame:
    """Add a map from those words of a row that a table of any size (word, value) holds to their values.

    Only ids and words meet the table; a map is no larger than its row's distinct words. A row's id is unique and not null.
    """
    word, value = known.columns
    pairs = df.select(row_id, F.explode(F.array_distinct(said)).alias(word))
    held = pairs.join(known, word).groupBy(row_id).agg(F.map_from_entries(F.collect_list(F.struct(word, value))).alias(name))
    empty = F.create_map().cast(dict(held.dtypes)[name])
    return df.join(held, row_id, "left").withColumn(name, F.coalesce(name, empty)).select(*df.columns, name)


def label_by_rating(df: DataFrame, label: str = "sentiment_label", rating: str = "rating") -> DataFrame:
    return df.groupBy(label, rating).agg(F.count(F.lit(1)).alias("n"))


def aspect_labels(df: DataFrame, lexicon: dict[str, float] | DataFrame | None = None, scoped: bool = False, row_id: str = "row_id") -> DataFrame:
    """Lexicon label of each aspect row's sentences; every row gets one. ``row_id`` names a unique column where the lexicon is large."""
    return _with_valence(df, "relevant_sentences", lexicon, "sentiment_label", lambda v: label_name(score_label(compound(v))), scoped, row_id)
