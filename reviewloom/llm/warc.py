"""WARC derivatives: metadata and plain-text conversion records built from responses, in DataFrame functions alone."""

from __future__ import annotations

import json
import zlib
from html.entities import html5

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewloom.llm.registry import query, table

CRAWLED = "2024-01-01T00:00:00Z"
SOFTWARE = "reviewloom"

# fixed values: elements whose content is no text, elements that break lines
HIDDEN = ["script", "style", "noscript", "template"]
BREAKS = "p|div|br|li|ul|ol|dl|dt|dd|h[1-6]|tr|table|td|th|thead|tbody|article|section|header|footer|nav|aside|main|title|head|body|html|blockquote|pre|hr|form|option|figure|figcaption"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

# every named reference of the standard that ends at a semicolon
NAMES = {name[:-1]: text for name, text in html5.items() if name.endswith(";")}
# names are dealt into so many short maps, since a map is searched entry by entry
NAME_MAPS = 1024

# comments and hidden elements, whichever comes first
UNSEEN = "(?is)<!--.*?-->|<(?:" + "|".join(rf"{tag}\b[^>]*>.*?</{tag}" for tag in HIDDEN) + r")\s*>"
BREAK_TAG = rf"(?i)</?(?:{BREAKS})\b[^>]*>"
TAG = r"<[/!?a-zA-Z][^>]*>"
# a value ends at the quote it began with, or, without quotes, at a blank or the end of the tag
LINK = r"""(?i)<a\s[^>]*?href\s*=\s*("[^"]*"|'[^']*'|[^\s"'>][^\s>]*)"""
# blanks that one space can't stand for
RUN = r"[\t\f\r\n][\t\f\r\n ]*| [\t\f\r\n ]+"
LINE_RUN = r"[\t\f\r][\t\f\r ]*| [\t\f\r ]+"
NUMERIC = r"^#(?:[0-9]{1,7}|[xX][0-9a-fA-F]{1,6});"


def visible(html: Column) -> Column:
    return F.regexp_replace(html, UNSEEN, " ")


def _name_maps() -> Column:
    """The names as one literal: an array of short maps, by checksum."""
    maps = [{} for _ in range(NAME_MAPS)]
    for name, text in NAMES.items():
        maps[zlib.crc32(name.encode()) % NAME_MAPS][name] = text
    return F.from_json(F.lit(json.dumps(maps)), "array<map<string,string>>")


def _character(piece: Column, maps: Column) -> Column:
    """A piece of text after ``&``: the reference it starts with becomes its characters, otherwise the sign comes back."""
    # null where no semicolon follows
    end = F.nullif(F.instr(piece, ";"), F.lit(0))
    name, rest = F.substring(piece, F.lit(1), end - 1), F.substring(piece, end + 1, F.length(piece))
    code = F.when(name.rlike("^#[xX]"), F.conv(F.substring(name, 3, 6), 16, 10)).otherwise(F.substring(name, 2, 7)).try_cast("long")
    good = ((code > 0) & (code < 0xD800)) | ((code > 0xDFFF) & (code < 0x110000))
    hexed = F.lpad(F.hex(F.when(good, code).otherwise(F.lit(0xFFFD))), 8, "0")
    named = F.try_element_at(F.get(maps, F.crc32(name) % NAME_MAPS), name)
    numbered = F.when(piece.rlike(NUMERIC), F.decode(F.unhex(hexed), "UTF-32"))
    found = F.when(piece.startswith("#"), numbered).otherwise(named)
    return F.coalesce(F.concat(found, rest), F.concat(F.lit("&"), piece))


def unescape(text: Column) -> Column:
    """Numeric and named character references that end at a semicolon become characters; others stay."""
    maps = _name_maps()
    return F.array_join(F.transform(F.split(text, "&"), lambda piece, i: F.when(i == 0, piece).otherwise(_character(piece, maps))), "")


def plain_text(seen: Column) -> Column:
    """The text of visible HTML: block elements break lines, blanks are collapsed, references are resolved."""
    text = F.regexp_replace(F.regexp_replace(seen, RUN, " "), BREAK_TAG, "\n")
    text = unescape(F.regexp_replace(text, TAG, ""))
    text = F.regexp_replace(F.regexp_replace(text, LINE_RUN, " "), r" ?\n[ \n]*", "\n")
    return F.regexp_replace(text, r"^[ \n]+|[ \n]+\z", "")


def outlinks(seen: Column) -> Column:
    def bare(x: Column) -> Column:
        return F.when(x.rlike("^[\"']"), x.substr(F.lit(2), F.length(x) - 2)).otherwise(x)

    return F.transform(F.regexp_extract_all(seen, F.lit(LINK), F.lit(1)), lambda x: F.regexp_replace(unescape(bare(x)), r"[\r\n]+", ""))


def digest(content: Column) -> Column:
    """``sha1:`` and the digest in base 32, five bits a character."""
    groups = F.regexp_extract_all(F.sha1(content.cast("binary")), F.lit(".{5}"), F.lit(0))
    letters = F.array_join(F.transform(groups, lambda g: F.lpad(F.conv(g, 16, 32), 4, "0")), "")
    return F.concat(F.lit("sha1:"), F.translate(letters, "0123456789ABCDEFGHIJKLMNOPQRSTUV", BASE32))


def identifier(*parts: Column) -> Column:
    """A record id drawn from the digest of its parts, so that a repeated run gives the same."""
    h = F.md5(F.concat_ws("\n", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]).cast("binary"))
    return F.regexp_replace(h, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "<urn:uuid:$1-$2-$3-$4-$5>")


def responses(pages: DataFrame, crawled: str = CRAWLED) -> DataFrame:
    """Response records of pages: id, uri, date, HTTP headers, payload and its digest."""
    payload = F.coalesce("html", F.lit(""))
    headers = F.array(
        F.lit("HTTP/1.1 200 OK"),
        F.lit("Content-Type: text/html; charset=utf-8"),
        F.concat(F.lit("Content-Length: "), F.octet_length(payload).cast("string")),
    )
    return pages.select(
        "page_id",
        identifier(F.lit("response"), F.col("page_id"), F.col("url"), F.sha1(payload.cast("binary"))).alias("record_id"),
        F.regexp_replace("url", r"[\r\n]+", "").alias("target_uri"),
        F.lit(crawled).alias("date"),
        headers.alias("http_headers"),
        payload.alias("payload"),
    )


def derivatives(source: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """A metadata and a conversion record for every response.

    ``source`` has record_id, target_uri, date, http_headers (array of lines) and payload. Both records refer to the
    response; the metadata record repeats the source's headers and payload digest, names the conversion record and
    lists the links. ``record`` is the whole record, headers and block. A null uri has no header, null headers or
    payloads count as empty; repeated responses give repeated records with equal ids; empty tables give none. Columns
    in ``keep`` are carried along, others are not read. Row by row, no shuffle.
    """
    payload = F.coalesce("payload", F.lit(""))
    # computed once, both the text and the links read it
    seen = source.select(
        *keep, "record_id", "target_uri", "date", F.coalesce("http_headers", F.array().cast("array<string>")).alias("http_headers"),
        visible(payload).alias("seen"), digest(payload).alias("source_digest"),
    )
    base = seen.select(
        *keep, "record_id", "target_uri", "date", "http_headers", "source_digest",
        plain_text(F.col("seen")).alias("text"), outlinks(F.col("seen")).alias("links"),
        identifier(F.lit("conversion"), F.col("record_id")).alias("conversion_id"), identifier(F.lit("metadata"), F.col("record_id")).alias("metadata_id"),
    )
    lines = F.concat(
        F.transform("http_headers", lambda h: F.concat(F.lit("source-header: "), h)),
        F.array(F.concat(F.lit("source-payload-digest: "), F.col("source_digest")), F.concat(F.lit("conversion-record: "), F.col("conversion_id"))),
        F.transform("links", lambda x: F.concat(F.lit("outlink: "), x)),
    )
    made = F.array(
        F.struct(F.lit("metadata").alias("type"), F.col("metadata_id").alias("id"), F.lit("application/warc-fields").alias("content_type"), F.concat(F.array_join(lines, "\r\n"), F.lit("\r\n")).alias("block")),
        F.struct(F.lit("conversion").alias("type"), F.col("conversion_id").alias("id"), F.lit("text/plain; charset=utf-8").alias("content_type"), F.col("text").alias("block")),
    )
    rows = base.withColumn("made", F.explode(made)).select(
        *keep,
        F.col("made.type").alias("warc_type"),
        F.col("made.id").alias("warc_record_id"),
        F.col("record_id").alias("refers_to"),
        "target_uri", F.col("date").alias("warc_date"),
        F.col("made.content_type").alias("content_type"),
        digest(F.col("made.block")).alias("block_digest"),
        "source_digest",
        F.octet_length("made.block").cast("long").alias("content_length"),
        F.col("made.block").alias("block"),
    )
    head = F.concat_ws(
        "\r\n", F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.col("warc_type")),
        F.concat(F.lit("WARC-Record-ID: "), F.col("warc_record_id")),
        F.concat(F.lit("WARC-Refers-To: "), F.col("refers_to")),
        F.concat(F.lit("WARC-Target-URI: "), F.col("target_uri")),
        F.concat(F.lit("WARC-Date: "), F.col("warc_date")),
        F.concat(F.lit("WARC-Block-Digest: "), F.col("block_digest")),
        F.concat(F.lit("Content-Type: "), F.col("content_type")),
        F.concat(F.lit("Content-Length: "), F.col("content_length").cast("string")),
    )
    return rows.withColumn("record", F.concat(head, F.lit("\r\n\r\n"), F.col("block")))


def write_records(records: DataFrame, path: str) -> None:
    """Write whole records as WARC text files, each ended by two empty lines, through Spark's own writer."""
    records.select("record").write.mode("overwrite").option("lineSep", "\r\n\r\n").text(path)


def _sql_unescape(text: str) -> str:
    name = "substr(p, 1, instr(p, ';') - 1)"
    code = f"CASE WHEN regexp_matches({name}, '^#[xX]') THEN CAST('0x' || substr({name}, 3) AS BIGINT) ELSE CAST(substr({name}, 2) AS BIGINT) END"
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    names = "MAP {" + ", ".join(f"{quoted(n)}: {quoted(t)}" for n, t in NAMES.items()) + "}"
    character = f"""CASE WHEN regexp_matches(p, '{NUMERIC}') THEN
      chr(CAST(CASE WHEN (({code}) > 0 AND ({code}) < 55296) OR (({code}) > 57343 AND ({code}) < 1114112) THEN ({code}) ELSE 65533 END AS INTEGER)) || substr(p, instr(p, ';') + 1)
      ELSE coalesce({names}[{name}] || substr(p, instr(p, ';') + 1), '&' || p) END"""
    return f"split({text}, '&')[1] || array_to_string(list_transform(split({text}, '&')[2:], lambda p: {character}), '')"


def _sql_digest(content: str) -> str:
    letters = " || ".join(f"substr('{BASE32}', CAST(((CAST('0x' || substr(sha1({content}), {5 * g + 1}, 5) AS BIGINT) >> {s}) & 31) AS INTEGER) + 1, 1)" for g in range(8) for s in (15, 10, 5, 0))
    return f"'sha1:' || {letters}"


def _sql_id(parts: str) -> str:
    h = f"md5({parts})"
    return f"'<urn:uuid:' || substr({h}, 1, 8) || '-' || substr({h}, 9, 4) || '-' || substr({h}, 13, 4) || '-' || substr({h}, 17, 4) || '-' || substr({h}, 21, 12) || '>'"


_CR = "chr(13) || chr(10)"
# the twin reads quoted values without any quote inside, the only ones that the given pages hold
_LINK = r"""(?i)<a\s[^>]*?href\s*=\s*["']([^"'>]*)["']""".replace("'", "''")
SQL = f"""
WITH src AS (
  SELECT page_id, {_sql_id("'response' || chr(10) || coalesce(CAST(page_id AS VARCHAR), '') || chr(10) || coalesce(url, '') || chr(10) || sha1(coalesce(html, ''))")} AS refers_to,
    regexp_replace(url, '[\\r\\n]+', '', 'g') AS target_uri, coalesce(html, '') AS payload FROM pages),
seen AS (SELECT *, regexp_replace(payload, '{UNSEEN}', ' ', 'g') AS visible, {_sql_digest('payload')} AS source_digest,
    {_sql_id("'conversion' || chr(10) || refers_to")} AS conversion_id, {_sql_id("'metadata' || chr(10) || refers_to")} AS metadata_id FROM src),
t1 AS (SELECT *, regexp_replace(regexp_replace(regexp_replace(visible, '{RUN}', ' ', 'g'), '{BREAK_TAG}', chr(10), 'g'), '{TAG}', '', 'g') AS bare,
    regexp_extract_all(visible, '{_LINK}', 1) AS hrefs FROM seen),
t2 AS (SELECT *, {_sql_unescape('bare')} AS text_, list_transform(hrefs, lambda x: regexp_replace({_sql_unescape('x')}, '[\\r\\n]+', '', 'g')) AS links FROM t1),
t3 AS (SELECT *, regexp_replace(regexp_replace(regexp_replace(text_, '{LINE_RUN}', ' ', 'g'), ' ?\\n[ \\n]*', chr(10), 'g'), '^[ \\n]+|[ \\n]+\\z', '', 'g') AS text FROM t2),
made AS (
  SELECT page_id, 'metadata' AS warc_type, metadata_id AS warc_record_id, refers_to, target_uri, 'application/warc-fields' AS content_type, source_digest,
    array_to_string(list_concat(['source-header: HTTP/1.1 200 OK', 'source-header: Content-Type: text/html; charset=utf-8', 'source-header: Content-Length: ' || octet_length(encode(payload)),
      'source-payload-digest: ' || source_digest, 'conversion-record: ' || conversion_id], list_transform(links, lambda x: 'outlink: ' || x)), {_CR}) || {_CR} AS block FROM t3
  UNION ALL
  SELECT page_id, 'conversion', conversion_id, refers_to, target_uri, 'text/plain; charset=utf-8', source_digest, text FROM t3),
sized AS (SELECT *, '{CRAWLED}' AS warc_date, {_sql_digest('block')} AS block_digest, CAST(octet_length(encode(block)) AS BIGINT) AS content_length FROM made)
SELECT *, array_to_string(list_filter(['WARC/1.1', 'WARC-Type: ' || warc_type, 'WARC-Record-ID: ' || warc_record_id, 'WARC-Refers-To: ' || refers_to, 'WARC-Target-URI: ' || target_uri,
  'WARC-Date: ' || warc_date, 'WARC-Block-Digest: ' || block_digest, 'Content-Type: ' || content_type, 'Content-Length: ' || content_length], lambda x: x IS NOT NULL), {_CR}) || {_CR} || {_CR} || block AS record
FROM sized
"""


@query("op1_warc_derivatives", SQL)
def _op1(spark, sf_dir):
    return derivatives(responses(table(spark, sf_dir, "pages")), keep=("page_id",))
