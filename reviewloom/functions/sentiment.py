"""Sentiment of a text by word valences in their scope: negation, strength, capitals, contrast and exclamation.

The text is folded from the first token to the last. What the fold carries is the total so far and the scope: of the last
three tokens, how much each strengthens what follows and whether it negates it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from reviewloom.functions.labels import DEFAULT_LEXICON

# fixed values: the published strengths of the rules
BOOST, CAPITALS, NEGATED = 0.293, 0.733, -0.74
FADE = (1.0, 0.95, 0.9)
BEFORE_CONTRAST, AFTER_CONTRAST = 0.5, 1.5
EXCLAMATION, EXCLAMATIONS = 0.292, 4
QUESTION, QUESTIONS, MANY_QUESTIONS = 0.18, 3, 0.96

# fixed values: words that negate, strengthen and weaken what follows them; any word in n't negates as well
NEGATIONS = [
    "not", "no", "never", "none", "nope", "nor", "neither", "nothing", "nowhere", "without", "rarely", "seldom", "hardly", "scarcely", "despite", "cannot",
    "aint", "arent", "cant", "couldnt", "didnt", "doesnt", "dont", "hadnt", "hasnt", "havent", "isnt", "mustnt", "neednt", "shouldnt", "wasnt", "werent", "wont", "wouldnt",
]
STRONGER = [
    "absolutely", "amazingly", "awfully", "completely", "considerably", "decidedly", "deeply", "enormously", "entirely", "especially", "exceptionally", "extremely", "fully",
    "greatly", "highly", "hugely", "incredibly", "intensely", "more", "most", "particularly", "purely", "quite", "really", "remarkably", "so", "substantially", "thoroughly",
    "totally", "tremendously", "unbelievably", "unusually", "utterly", "very",
]
WEAKER = ["almost", "barely", "kinda", "kindof", "less", "little", "marginally", "occasionally", "partly", "scarce", "slightly", "somewhat", "sorta", "sortof"]
CONTRAST = "but"

# a word with inner apostrophes or hyphens, or a lone dollar sign
SPOKEN = r"[\p{L}\p{N}]+(?:['’-][\p{L}\p{N}]+)*|\$"


def spoken_tokens(text) -> Column:
    """Words as they stand, apostrophes made straight."""
    text = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract_all(F.replace(F.coalesce(text, F.lit("")), F.lit("’"), F.lit("'")), F.lit(SPOKEN), F.lit(0))


def literal_valence(lexicon: dict[str, float] | None = None):
    """Looks a lower-case word up in a short lexicon."""
    by_value: dict[float, list[str]] = {}
    for word, v in sorted((lexicon or DEFAULT_LEXICON).items()):
        by_value.setdefault(float(v), []).append(word)

    def value(word: Column) -> Column:
        # sets of words are hashed, where a map would be searched entry by entry
        found = F.lit(None).cast("double")
        for v, words in by_value.items():
            found = F.when(word.isin(words), F.lit(v)).otherwise(found)
        return found

    return value


def emphasis(text) -> Column:
    """What exclamation and question marks add to the strength of a text."""
    text = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    calls, asks = (F.length(text) - F.length(F.replace(text, F.lit(c), F.lit(""))) for c in "!?")
    doubt = F.when(asks <= 1, 0.0).when(asks <= QUESTIONS, asks * QUESTION).otherwise(MANY_QUESTIONS)
    return F.least(calls, F.lit(EXCLAMATIONS)) * EXCLAMATION + doubt


def scoped_valence(text="text", valence=None) -> Column:
    """Total valence of a text; ``valence`` gives the value of a lower-case word, or null.

    A word in capitals counts more when others are not. A strengthening or weakening word up to three tokens ahead adds to
    the strength, less with distance, unless it has a valence itself. Each negation up to three tokens ahead turns the value
    round and weakens it. What stands before the first "but" counts half, what stands after it half as much again. Exclamation
    and question marks strengthen the total. Null and empty texts have 0.
    """
    valence = valence or literal_valence()
    text = F.col(text) if isinstance(text, str) else text
    loud = lambda w: (F.upper(w) == w) & (F.lower(w) != w)

    def mixed(words: Column) -> Column:
        n_loud = F.size(F.filter(words, loud))
        return (n_loud > 0) & (n_loud < F.size(words))

    def told(w: Column, some_loud: Column) -> Column:
        return F.struct(F.lower(w).alias("low"), F.coalesce(valence(F.lower(w)), F.lit(0.0)).alias("v"), F.when(some_loud & loud(w), CAPITALS).otherwise(0.0).alias("shout"))

    def marked(w: Column) -> Column:
        low, value, shout = w["low"], w["v"], w["shout"]
        push = F.when(value != 0, 0.0).when(low.isin(STRONGER), BOOST + shout).when(low.isin(WEAKER), -BOOST - shout).otherwise(0.0)
        turns = low.isin(NEGATIONS) | low.endswith("n't")
        return F.struct((value + F.signum(value) * shout).alias("v"), push.alias("b"), F.when(turns, NEGATED).otherwise(1.0).alias("n"), (low == CONTRAST).alias("c"))

    start = F.struct(
        F.lit(0.0).alias("total"), F.lit(1.0).alias("weight"), *[F.lit(x).alias(f"{c}{d}") for d in (1, 2, 3) for c, x in (("b", 0.0), ("n", 1.0))]
    )

    def step(s: Column, t: Column) -> Column:
        pushed = sum((s[f"b{d}"] * fade for d, fade in zip((1, 2, 3), FADE)), F.lit(0.0))
        value = (t["v"] + F.signum(t["v"]) * pushed) * s["n1"] * s["n2"] * s["n3"]
        turn = t["c"] & (s["weight"] == 1.0)
        total = F.when(turn, s["total"] * BEFORE_CONTRAST).otherwise(s["total"] + F.when(t["v"] != 0, value * s["weight"]).otherwise(0.0))
        return F.struct(
            total.alias("total"), F.when(turn, AFTER_CONTRAST).otherwise(s["weight"]).alias("weight"),
            t["b"].alias("b1"), t["n"].alias("n1"), s["b1"].alias("b2"), s["n1"].alias("n2"), s["b2"].alias("b3"), s["n2"].alias("n3"),
        )

    def folded(words: Column, some_loud: Column) -> Column:
        return F.aggregate(F.transform(F.transform(words, lambda w: told(w, some_loud)), marked), start, step, lambda s: s["total"])

    # one-element arrays keep what stands in them from being found again for each use
    per_text = F.transform(F.array(spoken_tokens(text)), lambda words: F.transform(F.array(mixed(words)), lambda some: folded(words, some)))
    return F.transform(F.flatten(per_text), lambda s: s + F.signum(s) * emphasis(text))[0]
