"""Text cleaning, splitting and pattern tests, all inside the JVM."""

from __future__ import annotations

import json
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from reviewloom.functions.constants import EMOJI_NARROW, EMOJI_SEQUENCE, HTML_TAG, WHITESPACE

# a word, a hyphenated word, or a lone dollar sign
TOKEN = r"[\p{L}\p{N}]+(?:-[\p{L}\p{N}]+)*|\$"
SENTENCE_END = rf"(?<=[.!?]){WHITESPACE}+"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# The white-space class for Java alone: printable ASCII is ruled out first and
# the Latin-1 members are listed singly, which Java tests with one bit lookup.
_BLANKS = r"\t\n\x0B\f\r\x1c\x1d\x1e\x1f\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_ANY_BLANK = f"[[^!-~]&&[ {_BLANKS}]]"
_OTHER_BLANK = f"[[^ -~]&&[{_BLANKS}]]"
# every run of white space except a lone plain blank, which needs no replacing
SPACE_RUN = f"{_OTHER_BLANK}{_ANY_BLANK}*| {_ANY_BLANK}+"


def collapse_space(c) -> Column:
    return F.regexp_replace(_col(c), SPACE_RUN, " ")


def strip_tags(c) -> Column:
    return F.regexp_replace(_col(c), HTML_TAG, " ")


def clean_text(c) -> Column:
    """Collapse blanks, then replace tags: the gaps tags leave behind stay."""
    return strip_tags(collapse_space(c))


def words(c) -> Column:
    return F.array_remove(F.split(F.trim(collapse_space(c)), " "), "")


def word_count(c) -> Column:
    return F.size(words(c))


def sentences(c) -> Column:
    return F.filter(F.split(_col(c), SENTENCE_END), lambda s: s != "")


def tokens(c) -> Column:
    return F.regexp_extract_all(_col(c), F.lit(TOKEN), F.lit(0))


def chunks(c, n_words: int = 12000) -> Column:
    """Arrays of ``n_words`` words re-joined by single blanks; the last may be shorter."""

    def cut(all_words: Column) -> Column:
        n = F.size(all_words)
        starts = F.when(n > 0, F.sequence(F.lit(1), n, F.lit(n_words))).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.array_join(F.slice(all_words, i, n_words), " "))

    # the one-element array keeps the word list from being built again per chunk
    return F.flatten(F.transform(F.array(words(c)), cut))


def count_substring(c, needle: str) -> Column:
    """Non-overlapping occurrences, as a plain substring."""
    text = _col(c)
    gone = F.length(text) - F.length(F.replace(text, F.lit(needle), F.lit("")))
    return (gone / F.lit(len(needle))).cast("int")


def emoji_characters(c) -> Column:
    return F.regexp_extract_all(_col(c), F.lit(EMOJI_NARROW), F.lit(0))


# Emoji whose customary short name is not their Unicode name.
EMOJI_NAMES = {
    "❤": "red_heart", "☀": "sun", "☁": "cloud", "☹": "frowning_face",
    "☺": "smiling_face", "✊": "raised_fist", "✋": "raised_hand", "✌": "victory_hand",
    "✔": "check_mark", "✖": "multiply", "✨": "sparkles", "⚠": "warning",
    "\U0001f44d": "thumbs_up", "\U0001f44e": "thumbs_down", "\U0001f44c": "OK_hand",
    "\U0001f44f": "clapping_hands", "\U0001f64c": "raising_hands", "\U0001f64f": "folded_hands",
    "\U0001f4af": "hundred_points", "\U0001f525": "fire", "\U0001f389": "party_popper",
    "\U0001f602": "face_with_tears_of_joy", "\U0001f60d": "smiling_face_with_heart-eyes",
    "\U0001f60a": "smiling_face_with_smiling_eyes", "\U0001f622": "crying_face",
    "\U0001f62d": "loudly_crying_face", "\U0001f621": "enraged_face", "\U0001f620": "angry_face",
    "\U0001f618": "face_blowing_a_kiss", "\U0001f60e": "smiling_face_with_sunglasses",
    "\U0001f495": "two_hearts", "\U0001f44b": "waving_hand", "\U0001f4aa": "flexed_biceps",
    "\u2b50": "star", "\u231b": "hourglass_done", "\u23f3": "hourglass_not_done",
    "\U0001f3fb": "light_skin_tone", "\U0001f3fc": "medium-light_skin_tone", "\U0001f3fd": "medium_skin_tone",
    "\U0001f3fe": "medium-dark_skin_tone", "\U0001f3ff": "dark_skin_tone",
    "\U0001f648": "see-no-evil_monkey", "\U0001f61e": "disappointed_face", "\U0001f615": "confused_face",
}
VARIATION_SELECTOR = "\ufe0f"
JOINER = "\u200d"


def emoji_table() -> dict[str, str]:
    """Emoji to short name, by rule from the Unicode names of the symbol ranges."""
    ranges = [(0x231A, 0x231B), (0x23E9, 0x23FA), (0x25FB, 0x25FE), (0x2600, 0x27BF), (0x2934, 0x2935), (0x2B05, 0x2B55), (0x1F300, 0x1F64F), (0x1F680, 0x1F6FF), (0x1F700, 0x1F8FF), (0x1F900, 0x1FAFF)]
    table = {}
    for low, high in ranges:
        for code in range(low, high + 1):
            name = unicodedata.name(chr(code), "")
            if name:
                table[chr(code)] = name.lower().replace(" ", "_")
    return {**table, **EMOJI_NAMES}


REGIONAL = "".join(chr(0x1F1E6 + i) for i in range(26))
TAGS = "".join(chr(0xE0061 + i) for i in range(26)) + "".join(chr(0xE0030 + i) for i in range(10))
LETTERS = "abcdefghijklmnopqrstuvwxyz"


def _sequence_name(seq: Column, names: Column, by_rule: bool) -> Column:
    """A sequence's own name, that of its flag or key, or those of its characters; null where one has none."""
    parts = F.transform(
        F.filter(F.regexp_extract_all(seq, F.lit("(?s)."), F.lit(0)), lambda c: ~c.isin(VARIATION_SELECTOR, JOINER)),
        lambda c: F.try_element_at(names, c),
    )
    composed = F.when(~F.exists(parts, lambda p: p.isNull()), F.array_join(parts, "_"))
    own = F.try_element_at(names, seq)
    if not by_rule:
        return F.coalesce(own, composed)
    # signs beyond the letters have nothing to become and vanish
    flag = F.translate(F.translate(seq, REGIONAL, LETTERS), f"{TAGS}\U0001f3f4\U000e007f", f"{LETTERS}0123456789")
    special = F.when(seq.rlike(r"^[\x{1F1E6}-\x{1F1FF}]|\x{E007F}\z"), F.concat(F.lit("flag_"), flag)).when(
        seq.endswith("\u20e3"), F.concat(F.lit("keycap_"), F.substring(seq, 1, 1))
    )
    return F.coalesce(own, special, composed)


def name_emoji(c, table: dict[str, str] | None = None) -> Column:
    """Replace each emoji by ``:name:``; unknown ones stay.

    The longest sequence counts as one emoji: families and others joined by U+200D, skin tones, flags and keycaps. A table
    may name whole sequences; otherwise one is named by its characters, a flag by its letters, a keycap by its key.
    """
    text = _col(c)
    names = F.from_json(F.lit(json.dumps(table or emoji_table())), "map<string,string>")

    def named(found: Column) -> Column:
        def after(piece: Column, i: Column) -> Column:
            seq = F.get(found, i)
            short = F.concat(F.lit(":"), _sequence_name(seq, names, table is None), F.lit(":"))
            return F.concat(piece, F.coalesce(short, seq, F.lit("")))

        return F.transform(F.split(text, EMOJI_SEQUENCE, -1), after)

    # the one-element array keeps the sequences from being searched again per piece
    found = F.regexp_extract_all(text, F.lit(EMOJI_SEQUENCE), F.lit(0))
    return F.when(text.rlike(EMOJI_SEQUENCE), F.array_join(F.flatten(F.transform(F.array(found), named)), "")).otherwise(text)


def matches(c, pattern: str) -> Column:
    return F.coalesce(F.regexp_like(_col(c), F.lit(pattern)), F.lit(False))


def non_ascii_class(cls: str) -> str:
    """The same character class, testing the ASCII range away first."""
    return rf"[[^\x00-\x7F]&&{cls}]"
