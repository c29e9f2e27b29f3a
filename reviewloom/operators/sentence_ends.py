"""Sentence ends learnt from the corpus: abbreviations by log-likelihood, then a split inside the row.

Statistics follow the published unsupervised method (Kiss and Strunk, 2006): a word that nearly always carries a period is
an abbreviation if the likelihood ratio, weighted by shortness, inner periods and occurrences without a period, is high.
A period after an abbreviation ends a sentence only where an upper-case word follows that the corpus also writes in lower
case, and never in upper case inside a sentence. Words after a number are counted apart, so that units are learnt there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewloom.functions.constants import WHITESPACE
from reviewloom.functions.labels import lexicon_maps, map_value
from reviewloom.functions.text import words
from reviewloom.operators.labeling import with_known
from reviewloom.plans.skew import may_broadcast
from reviewloom.session import settle

# fixed values of the method: the score from which a word is an abbreviation, the share of periods it then carries
LEAST_SCORE = 0.3
ABBREVIATED = 0.99

OPENING, CLOSING = "\"'([{", "\"')]},;:"
SHUT = "\"')]}"
NUMBER = r"^[0-9][0-9.,]*\z"
AFTER_NUMBER = "# "
# marks of a word in the learnt table; both may hold
IS_ABBREVIATION, IS_STARTER = 1.0, 2.0


def _core(word: Column) -> Column:
    """A word without quotes and brackets around it."""
    return F.ltrim(F.rtrim(word, F.lit(CLOSING)), F.lit(OPENING))


def _type(core: Column, behind_number: Column) -> Column:
    """The word as it is counted: lower case, without its last period, marked when a number stands before it."""
    bare = F.lower(F.when(core.endswith("."), F.substring(core, F.lit(1), F.length(core) - 1)).otherwise(core))
    return F.when(behind_number, F.concat(F.lit(AFTER_NUMBER), bare)).otherwise(bare)


def _is_number(core: Column) -> Column:
    """Most words are told by their first character, without a pattern."""
    return F.coalesce(core.between("0", ":") & core.rlike(NUMBER), F.lit(False))


def word_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """Per word: occurrences, those with a period, in lower case, in upper case inside a sentence and after a period.

    Words as they are written are counted map-side, with three marks of the word before; only distinct ones are looked at
    closer. Words without a letter don't count; null texts have none.
    """

    def seen(said: Column) -> Column:
        return F.transform(said, lambda word, i: F.struct(word.alias("w"), F.when(i > 0, F.get(said, i - 1)).alias("before")))

    # the one-element array keeps the word list from being built again per word
    each = df.select(F.explode(F.flatten(F.transform(F.array(words(text)), seen))).alias("w")).select("w.*")
    inner, shut = _core(F.col("before")), F.rtrim(F.col("before"), F.lit(SHUT))
    ended = F.substring(shut, -1, 1).isin(".", "!", "?", ":")
    written = each.groupBy("w", _is_number(inner).alias("number"), F.coalesce(ended, F.lit(True)).alias("ended"), F.coalesce(inner.endswith("."), F.lit(False)).alias("behind"))
    core = _core(F.col("w"))
    typed = written.agg(F.count(F.lit(1)).alias("k")).select(
        "k", "ended", "behind", _type(core, F.col("number")).alias("word"), core.endswith(".").alias("dotted"),
        core.rlike(r"^\p{Ll}").alias("lower"), core.rlike(r"^\p{Lu}").alias("upper"),
    )
    flags = {"dotted": F.col("dotted"), "lower": F.col("lower"), "inner": F.col("upper") & ~F.col("ended"), "after": F.col("upper") & F.col("behind")}
    sums = [F.coalesce(F.sum(F.when(flag, F.col("k"))), F.lit(0)).alias(f"n_{name}") for name, flag in flags.items()]
    return typed.filter(F.col("word").rlike(r"\p{L}")).groupBy("word").agg(F.sum("k").alias("n"), *sums)


def abbreviation_scores(counts: DataFrame) -> DataFrame:
    """Every word ever seen with a period, with its score and the verdict; ``counts`` is read twice."""
    share = counts.select(F.sum("n_dotted") / F.sum("n")).scalar()
    bare = F.regexp_replace("word", f"^{AFTER_NUMBER}", "")
    size = F.length(F.replace(bare, F.lit("."), F.lit("")))
    without = F.col("n") - F.col("n_dotted")
    # a corpus in which every word carries a period says nothing about one of them
    ratio = -2 * (F.col("n_dotted") * (F.log("_p") - F.log(F.lit(ABBREVIATED))) + without * (F.log(F.greatest(1 - F.col("_p"), F.lit(1e-9))) - F.log(F.lit(1 - ABBREVIATED))))
    score = ratio * F.exp(-size) * (F.length(bare) - size + 1) * F.pow(size.cast("double"), -without)
    scored = counts.filter("n_dotted > 0").withColumn("_p", share).withColumn("score", score)
    return scored.withColumn("is_abbreviation", F.col("score") >= LEAST_SCORE).drop("_p")


def learnt_ends(counts: DataFrame) -> DataFrame:
    """The table (word, mark) that the split reads: abbreviations, and words that begin sentences after one."""
    abbreviations = abbreviation_scores(counts).filter("is_abbreviation").select("word", F.lit(IS_ABBREVIATION).alias("mark"))
    starters = counts.filter("n_lower > 0 and n_inner = 0 and n_after > 0").select("word", F.lit(IS_STARTER).alias("mark"))
    return abbreviations.unionByName(starters).groupBy("word").agg(F.sum("mark").alias("mark"))


# a piece ends after a mark and the blanks behind it, where a plain split would cut
PIECE = rf"(?s).+?(?:(?<=[.!?]){WHITESPACE}+|\z)"


def _edges(piece: Column) -> Column:
    """The words by which pieces are told apart: how the last is counted, if it carries a period, and the first."""

    def edges(said: Column) -> Column:
        last = _core(F.try_element_at(said, F.lit(-1)))
        counted = F.when(last.endswith("."), _type(last, _is_number(_core(F.try_element_at(said, F.lit(-2))))))
        return F.struct(piece.alias("piece"), counted.alias("last"), _core(F.get(said, F.lit(0))).alias("first"))

    return F.get(F.transform(F.array(words(piece)), edges), F.lit(0))


def with_sentences(df: DataFrame, counts: DataFrame | None = None, text: str = "text", name: str = "sentences", row_id: str = "row_id") -> DataFrame:
    """Add the array of a text's sentences, by what its own corpus, or that of ``counts``, taught.

    Where nothing was learnt the sentences are those of :func:`~reviewloom.functions.text.sentences`, except that blanks
    after an abbreviation stay inside. The table of learnt words is measured: a small one is a value inside the row, a
    larger one is joined with the few words at the edges by ``row_id``, which must be unique then. Null texts give null.
    """
    counts = settle(word_counts(df, text) if counts is None else counts)
    learnt = settle(learnt_ends(counts))
    cut = F.transform(F.regexp_extract_all(F.col(text), F.lit(PIECE), F.lit(0)), _edges)
    if may_broadcast(learnt):
        held = df.withColumn("_marks", lexicon_maps(learnt.withColumnRenamed("mark", "valence")))
        mark = lambda word: F.coalesce(map_value("_marks")(word), F.lit(0.0))
    else:
        edges = F.array_compact(F.flatten(F.transform(cut, lambda e: F.array(e["last"], _type(e["first"], F.lit(False))))))
        held = with_known(df, edges, learnt, row_id, "_marks")
        mark = lambda word: F.coalesce(F.try_element_at("_marks", word), F.lit(0.0))

    def joined(pieces: Column) -> Column:
        def ends(piece: Column, i: Column) -> Column:
            following = F.get(pieces, i + 1)["first"]
            short = piece["last"].isNotNull() & mark(piece["last"]).isin(IS_ABBREVIATION, IS_ABBREVIATION + IS_STARTER)
            starts = following.rlike(r"^\p{Lu}") & (mark(_type(following, F.lit(False))) >= IS_STARTER)
            return (i + 1 == F.size(pieces)) | ~F.coalesce(short, F.lit(False)) | F.coalesce(starts, F.lit(False))

        # places after which a sentence ends, counted from 1, then the run of pieces up to each
        last = F.array_compact(F.transform(pieces, lambda p, i: F.when(ends(p, i), i + 1)))

        def together(stops: Column) -> Column:
            def run(stop: Column, k: Column) -> Column:
                before = F.when(k > 0, F.get(stops, k - 1)).otherwise(F.lit(0))
                whole = F.array_join(F.transform(F.slice(pieces, before + 1, stop - before), lambda p: p["piece"]), "")
                return F.regexp_replace(whole, rf"([.!?]){WHITESPACE}+\z", "$1")

            return F.transform(stops, run)

        return F.flatten(F.transform(F.array(last), together))

    split = F.flatten(F.transform(F.array(cut), joined))
    return held.withColumn(name, split).drop("_marks")
