"""J and K: weak labels and aspects."""

from __future__ import annotations

from pyspark.sql import functions as F

from reviewloom.catalog import query
from reviewloom.catalog import sql as S
from reviewloom.functions import constants as C
from reviewloom.functions import labels as L
from reviewloom.functions import sentiment as SC
from reviewloom.functions.constants import WHITESPACE as WS
from reviewloom.functions.text import sentences
from reviewloom.operators import aggregates, aspects, labeling, sentence_ends
from reviewloom.session import settle

# the given prose is invented, so every text ends with words the rules know
PHRASES = [
    "The delivery was fast. Great quality and a great price!",
    "Terrible support, a waste. The service is bad.",
    "Good look and good value. Install was easy to use?",
    "Not worth the refund. Delivery took long, no shipping.",
    "Nothing to add.",
    "Love the design but it arrived broken. Costs $ 5.",
]


def spoken(t):
    phrase = F.element_at(F.array(*[F.lit(p) for p in PHRASES]), (F.col("doc_id") % len(PHRASES) + 1).cast("int"))
    return t.documents.select(
        F.col("doc_id").alias("row_id"),
        F.concat("text", F.lit(" "), phrase).alias("text"),
        (F.col("doc_id") % 5 + 1).cast("double").alias("rating"),
    )


SPOKEN = (
    "spoken AS (SELECT doc_id AS row_id, CAST(doc_id % 5 + 1 AS DOUBLE) AS rating, text || ' ' || CASE doc_id % 6 "
    + " ".join(f"WHEN {i} THEN '{p}'" for i, p in enumerate(PHRASES))
    + " END AS text FROM documents)"
)


def _count_sql(words) -> str:
    return " + ".join(
        f"(length(low) - length(replace(low, '{w}', ''))) // {len(w)}" for w in words
    )


RATIO = f"""ratios AS (SELECT row_id, CAST(CASE WHEN g > 0 AND b > 0 THEN CASE WHEN g / b BETWEEN 0.9 AND 1.1 THEN 0 WHEN g / b > 1.1 THEN 1 ELSE 2 END
    WHEN g > 0 THEN 1 WHEN b > 0 THEN 2 ELSE 0 END AS INTEGER) AS keyword_ratio
    FROM (SELECT row_id, {_count_sql(C.POSITIVE_WORDS)} AS g, {_count_sql(C.NEGATIVE_WORDS)} AS b FROM (SELECT row_id, lower(text) AS low FROM spoken)))"""


@query("J01_keyword_ratio", f"WITH {SPOKEN}, {RATIO} SELECT * FROM ratios")
def keyword_ratio(t):
    return spoken(t).select("row_id", L.keyword_ratio("text").alias("keyword_ratio"))


@query("J02_high_rating", f"WITH {S.RAW} SELECT row_id, CAST(CASE WHEN rating >= 4 THEN 1 ELSE 0 END AS INTEGER) AS vote FROM raw_reviews")
def high_rating(t):
    return t.raw_reviews().select("row_id", L.high_rating().alias("vote"))


@query("J03_low_rating", f"WITH {S.RAW} SELECT row_id, CAST(CASE WHEN rating <= 2 THEN 2 ELSE 0 END AS INTEGER) AS vote FROM raw_reviews")
def low_rating(t):
    return t.raw_reviews().select("row_id", L.low_rating().alias("vote"))


def _any_sql(words) -> str:
    return " OR ".join(f"contains(lower(text), '{w}')" for w in words)


@query(
    "J04_contains_keywords",
    f"""WITH {SPOKEN} SELECT row_id, CAST(CASE WHEN {_any_sql(C.POSITIVE_WORDS)} THEN 1 ELSE 0 END AS INTEGER) AS positive,
    CAST(CASE WHEN {_any_sql(C.NEGATIVE_WORDS)} THEN 2 ELSE 0 END AS INTEGER) AS negative FROM spoken""",
)
def contains_keywords(t):
    return spoken(t).select("row_id", L.has_positive().alias("positive"), L.has_negative().alias("negative"))


def _single(words):
    return S.quoted(w for w in words if " " not in w)


def _valence(col: str) -> str:
    found = S.tokens(f"lower({col})")
    return (
        f"2.0::DOUBLE * (len(list_filter({found}, lambda w: w IN ({_single(C.POSITIVE_WORDS)})))"
        f" - len(list_filter({found}, lambda w: w IN ({_single(C.NEGATIVE_WORDS)}))))"
    )


_NAME = "CASE WHEN compound >= 0.05 THEN 'POSITIVE' WHEN compound <= -0.05 THEN 'NEGATIVE' ELSE 'NEUTRAL' END"
SCORES = f"scores AS (SELECT row_id, rating, s / sqrt(s * s + 15) AS compound FROM (SELECT row_id, rating, {_valence('text')} AS s FROM spoken))"


@query("J05_lexicon_label", f"WITH {SPOKEN}, {SCORES} SELECT row_id, round(compound, 6) AS compound, {_NAME} AS sentiment_label FROM scores")
def lexicon_label(t):
    return labeling.lexicon_label(spoken(t)).select("row_id", F.round("compound", 6).alias("compound"), "sentiment_label")


@query(
    "J05_lexicon_table",
    """WITH lexicon AS (SELECT p_name AS phrase, split_part(p_name, ' ', 1) AS word, 1.0 AS v FROM part),
    words AS (SELECT word, max(CAST(len(word) AS DOUBLE)) - 4 AS valence FROM lexicon GROUP BY word),
    sums AS (SELECT p_partkey, sum(valence) AS s FROM (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part) JOIN words USING (word) GROUP BY 1)
    SELECT p_partkey AS row_id, round(coalesce(s, 0) / sqrt(coalesce(s, 0) * coalesce(s, 0) + 15), 6) AS compound FROM part LEFT JOIN sums USING (p_partkey)""",
)
def lexicon_table(t):
    first = F.split_part("p_name", F.lit(" "), F.lit(1))
    lexicon = t.part.select(first.alias("word")).distinct().withColumn("valence", F.length("word").cast("double") - 4)
    rows = t.part.select(F.col("p_partkey").alias("row_id"), F.col("p_name").alias("text"))
    return labeling.lexicon_label(rows, lexicon).select("row_id", F.round("compound", 6).alias("compound"))


# further endings for the rules of scope
SCOPED_PHRASES = [
    "This is not good at all.", "It ISN'T a great value, but the quality is VERY good!", "I never had bad service...", "REALLY GREAT and fast!!!",
    "Good? Bad? Who knows??", "It was slightly bad but not terrible", "GOOD AND EASY", "Hardly any good quality, so very broken!", "Don’t love it.",
]


def emphatic(t):
    phrase = F.element_at(F.array(*[F.lit(p) for p in SCOPED_PHRASES]), (F.col("doc_id") % len(SCOPED_PHRASES) + 1).cast("int"))
    return t.documents.select(F.col("doc_id").alias("row_id"), F.concat("text", F.lit(" "), phrase).alias("text"))


def _scoped_sql(valence: str) -> str:
    """The scores by neighbours of each token, where the operator folds; ``valence`` gives v for the lower-case ``low``."""
    spoken_words = r"regexp_extract_all(replace(text, '’', ''''), '[\p{L}\p{N}]+(?:[''’-][\p{L}\p{N}]+)*|\$')"
    return f"""emphatic AS (SELECT doc_id AS row_id, text || ' ' || CASE doc_id % {len(SCOPED_PHRASES)}
      {" ".join(f"WHEN {i} THEN {S.quoted([p])}" for i, p in enumerate(SCOPED_PHRASES))} END AS text FROM documents),
    cut AS (SELECT row_id, {spoken_words} AS ws FROM emphatic),
    loud AS (SELECT *, len(list_filter(ws, lambda w: upper(w) = w AND lower(w) <> w)) AS n_loud FROM cut),
    words AS (SELECT row_id, unnest(ws) AS w, unnest(range(len(ws))) AS pos, n_loud > 0 AND n_loud < len(ws) AS mixed FROM loud),
    valued AS (SELECT row_id, pos, lower(w) AS low, CASE WHEN mixed AND upper(w) = w AND lower(w) <> w THEN {SC.CAPITALS} ELSE 0 END AS shout, {valence}),
    marked AS (SELECT row_id, pos, v + sign(v) * shout AS v, low = '{SC.CONTRAST}' AS c,
      CASE WHEN v <> 0 THEN 0 WHEN low IN ({S.quoted(SC.STRONGER)}) THEN {SC.BOOST} + shout WHEN low IN ({S.quoted(SC.WEAKER)}) THEN -{SC.BOOST} - shout ELSE 0 END AS b,
      CASE WHEN low IN ({S.quoted(SC.NEGATIONS)}) OR low LIKE '%n''t' THEN {SC.NEGATED} ELSE 1 END AS n FROM valued),
    scope AS (SELECT row_id, pos, v,
      {" + ".join(f"{f} * coalesce(lag(b, {d}) OVER o, 0)" for d, f in zip((1, 2, 3), SC.FADE))} AS push,
      {" * ".join(f"coalesce(lag(n, {d}) OVER o, 1)" for d in (1, 2, 3))} AS turn, min(CASE WHEN c THEN pos END) OVER (PARTITION BY row_id) AS but
      FROM marked WINDOW o AS (PARTITION BY row_id ORDER BY pos)),
    totals AS (SELECT row_id, sum((v + sign(v) * push) * turn * CASE WHEN pos < but THEN {SC.BEFORE_CONTRAST} WHEN pos > but THEN {SC.AFTER_CONTRAST} ELSE 1 END) AS s FROM scope GROUP BY row_id),
    marks AS (SELECT row_id, len(text) - len(replace(text, '!', '')) AS calls, len(text) - len(replace(text, '?', '')) AS asks FROM emphatic),
    scored AS (SELECT row_id, s + sign(s) * (least(calls, {SC.EXCLAMATIONS}) * {SC.EXCLAMATION}
      + CASE WHEN asks <= 1 THEN 0 WHEN asks <= {SC.QUESTIONS} THEN asks * {SC.QUESTION} ELSE {SC.MANY_QUESTIONS} END) AS s FROM totals JOIN marks USING (row_id)),
    squashed AS (SELECT row_id, s / sqrt(s * s + 15) AS compound FROM scored)"""


_LITERAL = f"CAST(CASE WHEN low IN ({_single(C.POSITIVE_WORDS)}) THEN 2 WHEN low IN ({_single(C.NEGATIVE_WORDS)}) THEN -2 ELSE 0 END AS DOUBLE) AS v FROM words"


@query("J05_scoped_label", f"WITH {_scoped_sql(_LITERAL)} SELECT row_id, round(compound, 6) AS compound, {_NAME} AS sentiment_label FROM squashed")
def scoped_label(t):
    """Scores with negation, strength, capitals, contrast and exclamation."""
    return labeling.lexicon_label(emphatic(t), scoped=True).select("row_id", F.round("compound", 6).alias("compound"), "sentiment_label")


_TABLE = """coalesce(valence, 0) AS v FROM words LEFT JOIN (SELECT word, sum(valence) AS valence FROM (
      SELECT word, CAST(len(word) % 7 AS DOUBLE) - 3 AS valence FROM (SELECT DISTINCT unnest(string_split(lower(text), ' ')) AS word FROM documents)
      UNION ALL SELECT 'good', 1.5 UNION ALL SELECT 'bad', -1.5) GROUP BY word) ON word = lower(w)"""


@query("J05_scoped_table", f"WITH {_scoped_sql(_TABLE)} SELECT row_id, round(compound, 6) AS compound, {_NAME} AS sentiment_label FROM squashed")
def scoped_table(t):
    """The same with a table of all words of the corpus."""
    words = t.documents.select(F.explode(F.split(F.lower("text"), " ")).alias("word")).distinct()
    more = t.spark.createDataFrame([("good", 1.5), ("bad", -1.5)], "word string, valence double")
    table = words.withColumn("valence", F.length("word") % 7 - F.lit(3.0)).unionByName(more)
    return labeling.lexicon_label(emphatic(t), table, scoped=True).select("row_id", F.round("compound", 6).alias("compound"), "sentiment_label")


VOTES = f"""{SPOKEN}, {SCORES}, votes AS (SELECT row_id, rating, CAST(CASE WHEN rating >= 4 THEN 1 ELSE 0 END AS INTEGER) AS high_rating,
    CAST(CASE WHEN rating <= 2 THEN 2 ELSE 0 END AS INTEGER) AS low_rating,
    CAST(CASE WHEN compound >= 0.05 THEN 1 WHEN compound <= -0.05 THEN 2 ELSE 0 END AS INTEGER) AS lexicon FROM scores)"""


@query("J06_label_matrix", f"WITH {VOTES} SELECT row_id, high_rating, low_rating, lexicon FROM votes")
def label_matrix(t):
    return labeling.label_matrix(spoken(t)).select("row_id", "high_rating", "low_rating", "lexicon")


@query("J07_label_model")
def label_model(t):
    """Generative model fitted on all rows; the fit is iterative, so rows only."""
    return labeling.weak_labels(spoken(t), keep_votes=True).select("row_id", "high_rating", "low_rating", "lexicon", "sentiment_label")


MAJORITY = f"""{VOTES}, counted AS (SELECT *, (high_rating = 0)::INT + (low_rating = 0)::INT + (lexicon = 0)::INT AS n0,
    (high_rating = 1)::INT + (lexicon = 1)::INT AS n1, (low_rating = 2)::INT + (lexicon = 2)::INT AS n2 FROM votes),
    majority AS (SELECT row_id, rating, CAST(CASE WHEN n0 >= n1 AND n0 >= n2 THEN 0 WHEN n1 >= n2 THEN 1 ELSE 2 END AS INTEGER) AS majority FROM counted)"""


def _majority(t):
    return labeling.majority_label(labeling.label_matrix(spoken(t)), L.DEFAULT_RULES)


@query("J07b_majority_vote", f"WITH {MAJORITY} SELECT row_id, majority FROM majority")
def majority_vote(t):
    return _majority(t).select("row_id", "majority")


@query("J08_label_distribution", f"WITH {MAJORITY} SELECT majority, count(*) AS n FROM majority GROUP BY ALL")
def label_distribution(t):
    return aggregates.value_counts(_majority(t), "majority")


@query("J09_label_by_rating", f"WITH {MAJORITY} SELECT majority, rating, count(*) AS n FROM majority GROUP BY ALL")
def label_by_rating(t):
    return labeling.label_by_rating(_majority(t), "majority")


# --- K: aspects ---------------------------------------------------------------

SENTENCES = f"cut AS (SELECT row_id, {S.sentences('text')} AS ss FROM spoken), numbered AS (SELECT row_id, unnest(ss) AS s, unnest(range(0, len(ss))) AS pos FROM cut)"


@query("K01_sentences", f"WITH {SPOKEN}, {SENTENCES} SELECT row_id, CAST(pos AS INTEGER) AS pos, s AS sentence FROM numbered")
def split_sentences(t):
    return spoken(t).select("row_id", F.posexplode(sentences("text")).alias("pos", "sentence"))


# periods that end no sentence, in the middle of every text
SHORTENED = [
    "We asked Dr. Smith about it. He paid approx. 3.5 in. of cloth, etc. The price is good.",
    "Some colors, e.g. blue or red, fade. Dr. Brown agrees. Cost is low.",
    "It is 12 in. wide and approx. 3 ft. long. Great size! The design holds.",
    "Mr. Smith went in. Then he read it, etc. The quality was e.g. Fine.",
    "We went in. Mr. Brown looked at 5 ft. of it? Good value.",
]


def shortened(t):
    phrase = F.element_at(F.array(*[F.lit(p) for p in SHORTENED]), (F.col("doc_id") % len(SHORTENED) + 1).cast("int"))
    return t.documents.select(F.col("doc_id").alias("row_id"), F.concat(phrase, F.lit("\n"), "text").alias("text"))


def _core_sql(w: str) -> str:
    return f"ltrim(rtrim({w}, '{S.escaped(sentence_ends.CLOSING)}'), '{S.escaped(sentence_ends.OPENING)}')"


def _type_sql(core: str, before: str) -> str:
    return f"CASE WHEN regexp_matches({_core_sql(before)}, '{sentence_ends.NUMBER}') THEN '# ' ELSE '' END || lower(CASE WHEN {core}[-1] = '.' THEN {core}[:-2] ELSE {core} END)"


_PHRASES_SQL = " ".join(f"WHEN {i} THEN '{p}'" for i, p in enumerate(SHORTENED))
WORD_COUNTS = f"""spoken AS (SELECT doc_id AS row_id, CASE doc_id % {len(SHORTENED)} {_PHRASES_SQL} END || chr(10) || text AS text FROM documents),
    said AS (SELECT {S.words('text')} AS ws FROM spoken), each_ AS (SELECT ws[i] AS w, CASE WHEN i > 1 THEN ws[i - 1] END AS before FROM (SELECT ws, unnest(range(1, len(ws) + 1)) AS i FROM said)),
    cores AS (SELECT {_core_sql('w')} AS core, before FROM each_),
    typed AS (SELECT {_type_sql('core', "coalesce(before, '')")} AS word, core[-1] = '.' AS dotted, regexp_matches(core, '^\\p{{Ll}}') AS lower_, regexp_matches(core, '^\\p{{Lu}}') AS upper_,
      coalesce(regexp_matches(before, '[.!?:]["'')\\]}}]*\\z'), true) AS ended, coalesce({_core_sql('before')}[-1] = '.', false) AS behind FROM cores),
    counts AS (SELECT word, count(*) AS n, count(*) FILTER (dotted) AS n_dotted, count(*) FILTER (lower_) AS n_lower, count(*) FILTER (upper_ AND NOT ended) AS n_inner,
      count(*) FILTER (upper_ AND behind) AS n_after FROM typed WHERE regexp_matches(word, '\\p{{L}}') GROUP BY word),
    measured AS (SELECT *, regexp_replace(word, '^# ', '') AS bare, length(replace(regexp_replace(word, '^# ', ''), '.', '')) AS size, (SELECT sum(n_dotted) / sum(n) FROM counts) AS p FROM counts WHERE n_dotted > 0),
    scored AS (SELECT *, -2 * (n_dotted * (ln(p) - ln(0.99)) + (n - n_dotted) * (ln(greatest(1 - p, 1e-9)) - ln(0.01))) * exp(-size) * (length(bare) - size + 1) * pow(CAST(size AS DOUBLE), n_dotted - n) AS score FROM measured)"""


@query("K01_abbreviations", f"WITH {WORD_COUNTS} SELECT word, n, n_dotted, n_lower, n_inner, n_after, round(score, 4) AS score, score >= 0.3 AS is_abbreviation FROM scored")
def abbreviations(t):
    """Scores of all words that ever carry a period."""
    got = sentence_ends.abbreviation_scores(settle(sentence_ends.word_counts(shortened(t))))
    return got.withColumn("score", F.round("score", 4))


@query(
    "K01_learnt_sentences",
    f"""WITH {WORD_COUNTS},
    pieces AS (SELECT row_id, list_filter(string_split(regexp_replace(text, '([.!?]{WS}+)', '\\1' || chr(1), 'g'), chr(1)), lambda s: s <> '') AS ps FROM spoken),
    numbered AS (SELECT row_id, ps[i] AS piece, {S.words('ps[i]')} AS ws, i, len(ps) AS total FROM (SELECT row_id, ps, unnest(range(1, len(ps) + 1)) AS i FROM pieces)),
    edges AS (SELECT *, {_core_sql('ws[-1]')} AS last, CASE WHEN len(ws) > 1 THEN ws[-2] ELSE '' END AS before, lead({_core_sql('ws[1]')}) OVER (PARTITION BY row_id ORDER BY i) AS first FROM numbered),
    looked AS (SELECT *, CASE WHEN last[-1] = '.' THEN {_type_sql('last', 'before')} END AS last_type, {_type_sql('first', "''")} AS first_type FROM edges),
    ended AS (SELECT row_id, i, piece, i = total OR NOT coalesce(last_type IN (SELECT word FROM scored WHERE score >= 0.3), false)
        OR coalesce(regexp_matches(first, '^\\p{{Lu}}') AND first_type IN (SELECT word FROM counts WHERE n_lower > 0 AND n_inner = 0 AND n_after > 0), false) AS ends FROM looked),
    grouped AS (SELECT *, coalesce(sum(ends::INT) OVER (PARTITION BY row_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos FROM ended)
    SELECT row_id, CAST(pos AS INTEGER) AS pos, regexp_replace(string_agg(piece, '' ORDER BY i), '([.!?]){WS}+\\z', '\\1') AS sentence FROM grouped GROUP BY row_id, pos""",
)
def learnt_sentences(t):
    """Sentences of texts whose abbreviations were learnt from the same texts."""
    return sentence_ends.with_sentences(shortened(t)).select("row_id", F.posexplode("sentences").alias("pos", "sentence"))


def _tag_sql(table) -> str:
    pairs = ", ".join(f"('{a}', {i}, [{S.quoted(k)}])" for i, (a, k) in enumerate(table.items()))
    return f"""aspects(aspect, no, keywords) AS (VALUES {pairs}),
    hits AS (SELECT row_id, aspect, no, pos, s FROM numbered, aspects WHERE list_has_any({S.tokens('s')}, keywords)),
    tagged AS (SELECT row_id, aspect, no, string_agg(s, ' ' ORDER BY pos) AS relevant_sentences FROM hits GROUP BY ALL)"""


@query("K02_tag_aspects", f"WITH {SPOKEN}, {SENTENCES}, {_tag_sql(C.ASPECT_WORDS)} SELECT row_id, aspect, relevant_sentences FROM tagged")
def tag_aspects(t):
    return aspects.tag_aspects(spoken(t)).select("row_id", "aspect", "relevant_sentences")


_PHRASE_PAIRS = ", ".join(f"('{a}', [{S.quoted(k)}])" for a, k in C.ASPECT_PHRASES.items())


@query(
    "K03_phrase_sentences",
    f"""WITH {SPOKEN}, {SENTENCES}, phrases(aspect, keywords) AS (VALUES {_PHRASE_PAIRS})
    SELECT row_id, aspect, s AS sentence FROM numbered, phrases WHERE len(list_filter(keywords, lambda k: contains(lower(s), k))) > 0""",
)
def phrase_sentences(t):
    return aspects.phrase_sentences(spoken(t)).select("row_id", "aspect", "sentence")


DURABLE = {k: v for k, v in C.ASPECT_WORDS.items() if k != "cost"} | C.DURABILITY_ASPECT


@query(
    "K04_aspects_per_review",
    f"""WITH {SPOKEN}, {SENTENCES}, {_tag_sql(DURABLE)} SELECT row_id, string_agg(aspect, ', ' ORDER BY no) AS matched_aspects,
    string_agg(relevant_sentences, ' ' ORDER BY no) AS relevant_sentences FROM tagged GROUP BY row_id""",
)
def aspects_per_review(t):
    return aspects.tag_aspects(spoken(t), DURABLE, per="review").select("row_id", "matched_aspects", "relevant_sentences")


@query(
    "K05_keyword_table",
    """WITH k AS (SELECT p_type AS aspect, list_sort(list(DISTINCT split_part(p_name, ' ', 2))) AS words FROM part GROUP BY 1)
    SELECT p_partkey AS row_id, k.aspect, p_name AS relevant_sentences FROM part, k WHERE list_has_any(string_split(p_name, ' '), words)""",
)
def keyword_table(t):
    """Keywords come from a table; the SQL twin joins it, the operator folds it in while it is short."""
    table = t.part.select(F.col("p_type").alias("aspect"), F.split_part("p_name", F.lit(" "), F.lit(2)).alias("keyword"))
    rows = t.part.select(F.col("p_partkey").alias("row_id"), F.col("p_name").alias("text"))
    return aspects.tag_aspects(rows, table).select("row_id", "aspect", "relevant_sentences")


@query(
    "K05_phrase_table",
    """WITH k AS (
      SELECT DISTINCT p_type AS aspect, split_part(p_name, ' ', 1) || ' ' || split_part(p_name, ' ', 2) AS phrase FROM part WHERE p_partkey % 3 = 0
      UNION SELECT p_type, split_part(p_name, ' ', 1) || ' ' || split_part(p_name, ' ', 2) || ' ' || split_part(p_name, ' ', 3) FROM part WHERE p_partkey % 3 = 1
      UNION SELECT p_type, split_part(p_name, ' ', 3) FROM part WHERE p_partkey % 30 = 2),
    hits AS (SELECT DISTINCT p_partkey, aspect, p_name FROM part, k WHERE phrase <> '' AND contains(' ' || p_name || ' ', ' ' || trim(phrase) || ' '))
    SELECT p_partkey AS row_id, aspect, p_name AS relevant_sentences FROM hits""",
)
def phrase_table(t):
    """Keywords of one, two and three words from a table; the SQL twin searches the text for them."""
    part = lambda *ns: F.concat_ws(" ", *[F.split_part("p_name", F.lit(" "), F.lit(n)) for n in ns])
    rows = lambda cond, keyword: t.part.filter(cond).select(F.col("p_type").alias("aspect"), keyword.alias("keyword"))
    table = rows("p_partkey % 3 = 0", part(1, 2)).union(rows("p_partkey % 3 = 1", part(1, 2, 3))).union(rows("p_partkey % 30 = 2", part(3)))
    texts = t.part.select(F.col("p_partkey").alias("row_id"), F.col("p_name").alias("text"))
    return aspects.tag_aspects(texts, table, several_words=True).select("row_id", "aspect", "relevant_sentences")


@query(
    "K06_tag_conversations",
    f"""WITH spoken AS (SELECT conv_id * 1000 + turn AS row_id, text || ' Fast shipping. Cheap Price.' AS text FROM conversations),
    {SENTENCES}, {_tag_sql({k: [w.lower() for w in v] for k, v in C.ASPECT_WORDS.items()}).replace(S.tokens('s'), S.tokens('lower(s)'))}
    SELECT row_id, aspect, relevant_sentences FROM tagged""",
)
def tag_conversations(t):
    rows = t.conversations.select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("row_id"), F.concat("text", F.lit(" Fast shipping. Cheap Price.")).alias("text")
    )
    return aspects.tag_aspects(rows, lower=True).select("row_id", "aspect", "relevant_sentences")


@query("E17_aspect_counts", f"WITH {SPOKEN}, {SENTENCES}, {_tag_sql(C.ASPECT_WORDS)} SELECT aspect, count(*) AS n FROM tagged GROUP BY ALL")
def aspect_counts(t):
    return aspects.aspect_counts(aspects.tag_aspects(spoken(t)))


@query(
    "J05_aspect_labels",
    f"""WITH {SPOKEN}, {SENTENCES}, {_tag_sql(C.ASPECT_WORDS)}, scored AS (SELECT *, {_valence('relevant_sentences')} AS v FROM tagged),
    squashed AS (SELECT *, v / sqrt(v * v + 15) AS compound FROM scored)
    SELECT row_id, aspect, {_NAME} AS sentiment_label FROM squashed""",
)
def aspect_labels(t):
    return labeling.aspect_labels(aspects.tag_aspects(spoken(t))).select("row_id", "aspect", "sentiment_label")
