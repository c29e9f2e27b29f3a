"""Sentiment labelling rules as column expressions."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewloom.functions.constants import NEGATIVE, NEGATIVE_WORDS, NEUTRAL, POSITIVE, POSITIVE_WORDS
from reviewloom.functions.text import count_substring, tokens

# Default valences: the two keyword lists at equal strength. Callers pass their
# own table for a richer lexicon.
DEFAULT_LEXICON = {
    **{w: 2.0 for w in POSITIVE_WORDS if " " not in w},
    **{w: -2.0 for w in NEGATIVE_WORDS if " " not in w},
}


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _hits(text: Column, vocabulary: list[str]) -> Column:
    low = F.lower(text)
    return reduce(add, [count_substring(low, w) for w in vocabulary])


def keyword_ratio(text="text") -> Column:
    """Positive against negative keyword counts; within ten percent is neutral."""
    text = F.coalesce(_col(text), F.lit(""))
    good, bad = _hits(text, POSITIVE_WORDS), _hits(text, NEGATIVE_WORDS)
    ratio = F.when(bad > 0, good / bad)
    return (
        F.when((good > 0) & (bad > 0), F.when(ratio.between(0.9, 1.1), NEUTRAL).when(ratio > 1.1, POSITIVE).otherwise(NEGATIVE))
        .when(good > 0, POSITIVE)
        .when(bad > 0, NEGATIVE)
        .otherwise(NEUTRAL)
    )


def high_rating(rating="rating") -> Column:
    return F.when(_col(rating) >= 4, POSITIVE).otherwise(NEUTRAL)


def low_rating(rating="rating") -> Column:
    return F.when(_col(rating) <= 2, NEGATIVE).otherwise(NEUTRAL)


def _any(text: Column, vocabulary: list[str]) -> Column:
    low = F.lower(F.coalesce(text, F.lit("")))
    return reduce(or_, [low.contains(w) for w in vocabulary])


def has_positive(text="text") -> Column:
    return F.when(_any(_col(text), POSITIVE_WORDS), POSITIVE).otherwise(NEUTRAL)


def has_negative(text="text") -> Column:
    return F.when(_any(_col(text), NEGATIVE_WORDS), NEGATIVE).otherwise(NEUTRAL)


def compound(total) -> Column:
    """Squash a valence sum into -1..1 (the published s / sqrt(s^2 + 15))."""
    s = _col(total)
    return s / F.sqrt(s * s + F.lit(15.0))


# words of a lexicon are dealt into so many short maps, since a map is searched entry by entry
LEXICON_MAPS = 1024


# and those of one row into so many
ROW_MAPS = 64


def _place(word: Column, maps: int = LEXICON_MAPS) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(maps)).cast("int")


def lexicon_maps(words: DataFrame) -> Column:
    """A table (word, valence) as one value: an array of short maps. Repeated words add up; null words don't count."""
    known = words.filter("word is not null").groupBy("word").agg(F.sum(F.col("valence").cast("double")).alias("valence"))
    short = known.groupBy(_place(F.col("word")).alias("_at")).agg(F.map_from_entries(F.collect_list(F.struct("word", "valence"))).alias("_map"))
    return short.agg(F.map_from_entries(F.collect_list(F.struct("_at", "_map"))).alias("maps")).select(
        F.transform(F.sequence(F.lit(0), F.lit(LEXICON_MAPS - 1)), lambda i: F.try_element_at("maps", i)).alias("maps")
    ).scalar()


def map_value(maps, n_maps: int = LEXICON_MAPS):
    """Looks a word up in a column from ``lexicon_maps``, or of as many short maps."""
    return lambda t: F.try_element_at(F.get(_col(maps), _place(t, n_maps)), t)


def row_maps(pairs: DataFrame, row_id: str, word: str, value: str, name: str) -> DataFrame:
    """An array of short maps for each row id, from its distinct words and their values."""
    at = F.struct(_place(F.col(word), ROW_MAPS).alias("at"), F.col(word).alias("word"), F.col(value).alias("value"))
    held = pairs.groupBy(row_id, at["at"].alias("_at")).agg(F.map_from_entries(F.collect_list(F.struct(at["word"], at["value"]))).alias("_map"))
    dealt = held.groupBy(row_id).agg(F.map_from_entries(F.collect_list(F.struct("_at", "_map"))).alias("_dealt"))
    return dealt.select(row_id, F.transform(F.sequence(F.lit(0), F.lit(ROW_MAPS - 1)), lambda i: F.try_element_at("_dealt", i)).alias(name))


def valence_sum(text="text", lexicon: dict[str, float] | None = None, value: Callable | None = None) -> Column:
    """Sum of word valences: of a short literal lexicon, or as ``value`` gives them word by word."""
    found = tokens(F.lower(F.coalesce(_col(text), F.lit(""))))
    if value is None:
        lookup = F.create_map(*[F.lit(x) for w, v in sorted((lexicon or DEFAULT_LEXICON).items()) for x in (w, float(v))])
        value = lambda t: F.try_element_at(lookup, t)
    return F.aggregate(found, F.lit(0.0), lambda acc, t: acc + F.coalesce(value(t), F.lit(0.0)))


def score_label(score) -> Column:
    score = _col(score)
    return F.when(score >= 0.05, POSITIVE).when(score <= -0.05, NEGATIVE).otherwise(NEUTRAL)


def lexicon_rule(text="text", lexicon: dict[str, float] | None = None) -> Column:
    return score_label(compound(valence_sum(text, lexicon)))


def scoped_rule(text="text", lexicon: dict[str, float] | None = None) -> Column:
    """As :func:`lexicon_rule`, with negation, strength and contrast."""
    from reviewloom.functions.sentiment import literal_valence, scoped_valence

    return score_label(compound(scoped_valence(text, literal_valence(lexicon))))


def rating_class(rating) -> Column:
    r = _col(rating)
    return F.when(r >= 4, "POSITIVE").when(r <= 2, "NEGATIVE").otherwise("NEUTRAL")


# Rules by name; the default vote list leaves the keyword rules out.
RULES: dict[str, Callable[..., Column]] = {
    "high_rating": high_rating,
    "low_rating": low_rating,
    "lexicon": lexicon_rule,
    "scoped_lexicon": scoped_rule,
    "keyword_ratio": keyword_ratio,
    "has_positive": has_positive,
    "has_negative": has_negative,
}
DEFAULT_RULES = ["high_rating", "low_rating", "lexicon"]
