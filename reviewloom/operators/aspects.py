"""Aspect tagging: which sentences of a review speak about what.

Sentences, tokens and the keyword test are array expressions inside the row; only a keyword table too large to go
along with every row is joined.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewloom.functions.constants import ASPECT_PHRASES, ASPECT_WORDS
from reviewloom.functions.text import sentences, tokens
from reviewloom.operators.labeling import with_known
from reviewloom.plans.skew import may_broadcast
from reviewloom.session import settle


def aspect_table(seeds: Mapping[str, Sequence[str]] = ASPECT_WORDS, synonyms: Mapping[str, Sequence[str]] | None = None) -> dict:
    """Aspect to keywords: seed words joined by the synonyms the caller has."""
    extra = synonyms or {}
    return {a: sorted({*words, *(s for w in words for s in extra.get(w, ()))}) for a, words in seeds.items()}


# keywords of a table are dealt into so many short maps, since a map is searched entry by entry
KEYWORD_MAPS = 1024


def _place(word: Column) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(KEYWORD_MAPS)).cast("int")


def keyword_maps(pairs: DataFrame) -> Column:
    """A table (aspect, keyword) as one value: short maps from a keyword to its aspects' numbers, and the aspect names.

    Aspects go by name, or by ``aspect_no`` where the table has one.
    """
    order = "aspect_no" if "aspect_no" in pairs.columns else "aspect"
    known = pairs.filter("aspect is not null and keyword is not null").groupBy("aspect").agg(F.min(order).alias("_order"), F.collect_set("keyword").alias("_words"))
    listed = known.agg(F.array_sort(F.collect_list(F.struct("_order", "aspect", "_words"))).alias("_all"))
    words = listed.select("_all", F.posexplode("_all").alias("_no", "_one")).select("_all", "_no", F.explode("_one._words").alias("word"))
    numbers = words.groupBy("word").agg(F.array_sort(F.collect_list("_no")).alias("_nos"))
    short = numbers.groupBy(_place(F.col("word")).alias("_at")).agg(F.map_from_entries(F.collect_list(F.struct("word", "_nos"))).alias("_map"))
    maps = short.agg(F.map_from_entries(F.collect_list(F.struct("_at", "_map"))).alias("_maps"))
    value = F.transform(F.sequence(F.lit(0), F.lit(KEYWORD_MAPS - 1)), lambda i: F.try_element_at("_maps", i))
    names = listed.select(F.transform("_all", lambda x: x["aspect"]).alias("names")).scalar()
    return F.struct(maps.select(value.alias("maps")).scalar().alias("maps"), names.alias("names"))


def spoken_keys(words: Column, lengths: Sequence[int]) -> Column:
    """A sentence's keys: its tokens, and its runs of so many tokens, joined by blanks."""
    runs = [words if n == 1 else _runs(words, n) for n in sorted(lengths)]
    return runs[0] if len(runs) == 1 else F.flatten(F.array(*runs))


def _runs(words: Column, n: int) -> Column:
    starts = F.when(F.size(words) >= n, F.sequence(F.lit(1), F.size(words) - (n - 1))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.array_join(F.slice(words, i, n), " "))


def _sentences_of(df: DataFrame, text: str) -> Column:
    """The sentences of a text column, or those that were cut before, where the column holds arrays."""
    return F.col(text) if dict(df.dtypes)[text] == "array<string>" else sentences(F.col(text))


def _marked_sentences(said: Column, lower: bool, lengths: Sequence[int]) -> Column:
    tested = (lambda s: F.lower(s)) if lower else (lambda s: s)
    return F.transform(said, lambda s: F.struct(s.alias("s"), spoken_keys(tokens(tested(s)), lengths).alias("t")))


def _known_aspects(cut: Column, lower: bool, lengths: Sequence[int], numbers_of) -> Column:
    """Sentences with the numbers (or other marks, which sort alike) of the aspects that their tokens are keywords of."""

    def numbers(s: Column) -> Column:
        said = F.array_distinct(spoken_keys(tokens(F.lower(s) if lower else s), lengths))
        return F.array_distinct(F.flatten(F.array_compact(F.transform(said, numbers_of))))

    return F.transform(cut, lambda s: F.struct(s.alias("s"), numbers(s).alias("nos")))


def _spelled(keyword) -> Column:
    """A keyword as its tokens joined by blanks, the form in which sentences are searched."""
    return F.array_join(tokens(keyword), " ")


def _tag_by_table(df: DataFrame, table: DataFrame, text: str, lower: bool, several_words: bool, row_id: str):
    """``df`` with ``_marked`` (sentences with marks of aspects), and what gives the name of a mark."""
    pairs = table.filter("aspect is not null and keyword is not null")
    lengths = [1]
    if several_words:
        pairs = settle(pairs.withColumn("keyword", _spelled("keyword")).filter("keyword != ''"))
        lengths = sorted({1, *(r[0] for r in pairs.select(F.size(F.split("keyword", " "))).distinct().collect())})
    ordered = "aspect_no" in pairs.columns
    pairs = settle(pairs.groupBy("aspect", "keyword").agg(F.min("aspect_no" if ordered else "aspect").alias("aspect_no")))
    if may_broadcast(pairs):
        held = df.withColumn("_known", keyword_maps(pairs))
        of = lambda t: F.try_element_at(F.get(F.col("_known.maps"), _place(t)), t)
        return held.withColumn("_marked", _known_aspects(_sentences_of(df, text), lower, lengths, of)), lambda no: F.get(F.col("_known.names"), no)
    # a long table: only ids and words meet it, and a mark is the aspect's place and name
    least = pairs.groupBy("aspect").agg(F.min("aspect_no").alias("_order"))
    mark = F.struct(F.col("_order").alias("order"), F.col("aspect").alias("name"))
    words = pairs.select("aspect", "keyword").join(least, "aspect").groupBy("keyword").agg(F.array_sort(F.collect_list(mark)).alias("_marks"))
    # word by word of each sentence, so that a run never crosses from one into the next
    each = F.transform(_sentences_of(df, text), lambda s: spoken_keys(tokens(F.lower(s) if lower else s), lengths))
    held = with_known(df, F.flatten(each), words, row_id, "_known")
    of = lambda t: F.try_element_at("_known", t)
    return held.withColumn("_marked", _known_aspects(_sentences_of(df, text), lower, lengths, of)), lambda mark: mark["name"]


def _matching(marked: Column, keywords: Sequence[str]) -> Column:
    wanted = F.array(*[F.lit(k) for k in keywords])
    hits = F.filter(marked, lambda m: F.arrays_overlap(m["t"], wanted))
    return F.array_join(F.transform(hits, lambda m: m["s"]), " ")


def tag_aspects(
    df: DataFrame,
    keywords: Mapping[str, Sequence[str]] | DataFrame | None = None,
    text: str = "text",
    lower: bool = False,
    per: str = "aspect",
    several_words: bool = False,
    row_id: str = "row_id",
) -> DataFrame:
    """Rows per (review, aspect) with the joined matching sentences, in aspect order.

    ``text`` may also name an array of sentences, as :func:`~reviewloom.operators.sentence_ends.with_sentences` cuts them.
    A keyword matches a whole token, case-sensitively unless ``lower``.
    ``per="review"`` gives one row per review with its set of aspects instead.
    With ``several_words`` a keyword of several tokens matches where they follow one another in a sentence.
    A keyword table (aspect, keyword) is measured: while it is small it is one value that is looked up inside the row;
    beyond, each row's words are joined with it by ``row_id``, which must be unique then. Its aspects come in name order,
    or by its column ``aspect_no``.
    """
    kept = [c for c in df.columns]
    if isinstance(keywords, DataFrame):
        marked, name_of = _tag_by_table(df, keywords, text, lower, several_words, row_id)
        found = F.transform(
            F.array_sort(F.array_distinct(F.flatten(F.transform("_marked", lambda m: m["nos"])))),
            lambda no: F.struct(
                no.alias("aspect_no"), name_of(no).alias("aspect"),
                F.array_join(F.transform(F.filter("_marked", lambda m: F.array_contains(m["nos"], no)), lambda m: m["s"]), " ").alias("relevant_sentences"),
            ),
        )
    else:
        table = dict(keywords or ASPECT_WORDS)
        if several_words:
            # the same spelling as that of a sentence's tokens
            table = {a: [w for w in (" ".join(re.findall(r"[^\W_]+(?:-[^\W_]+)*|\$", k)) for k in words) if w] for a, words in table.items()}
        lengths = sorted({1, *(len(k.split(" ")) for words in table.values() for k in words)}) if several_words else [1]
        marked = df.withColumn("_marked", _marked_sentences(_sentences_of(df, text), lower, lengths))
        found = F.array(*[
            F.struct(F.lit(i).alias("aspect_no"), F.lit(a).alias("aspect"), _matching(F.col("_marked"), k).alias("relevant_sentences"))
            for i, (a, k) in enumerate(table.items())
        ])
    hits = F.filter(found, lambda h: h["relevant_sentences"] != "")
    if per == "aspect":
        # the generator takes the expression itself: a column in between would
        # be filtered, and so computed, once more below it
        return marked.select(*kept, F.inline(hits)).drop("aspect_no")
    per_review = marked.select(*kept, F.explode(F.filter(F.array(hits), lambda h: F.size(h) > 0)).alias("_hits"))
    return per_review.select(
        *kept,
        F.array_join(F.transform("_hits", lambda h: h["aspect"]), ", ").alias("matched_aspects"),
        F.array_join(F.transform("_hits", lambda h: h["relevant_sentences"]), " ").alias("relevant_sentences"),
    )


def phrase_sentences(
    df: DataFrame, phrases: Mapping[str, Sequence[str]] | None = None, text: str = "text"
) -> DataFrame:
    """Rows per (review, aspect, sentence) by lower-case substring."""
    table = phrases or ASPECT_PHRASES
    split = df.withColumn("sentence", F.explode(_sentences_of(df, text)))
    low = F.lower("sentence")
    found = []
    for aspect, words in table.items():
        hit = F.lit(False)
        for w in words:
            hit = hit | low.contains(w)
        found.append(F.when(hit, F.lit(aspect)))
    return split.withColumn("aspect", F.explode(F.array_compact(F.array(*found))))


def aspect_counts(tagged: DataFrame) -> DataFrame:
    return tagged.groupBy("aspect").agg(F.count(F.lit(1)).alias("n"))
