"""WARC records: linked ids, digests, lengths, and files that parse back."""

import base64
import hashlib
import re

from pyspark.sql import functions as F

from reviewloom.llm.warc import derivatives, responses, write_records

HTML = """<html><head><title>T &amp; U</title><style>p{x}</style><script>var a="</p>";</script></head><body><!-- no <p> --><p>Caf&eacute; &#233;&#x1F44D; &#0; &#xD800; &#99999999; a&lt;b &amp;lt;</p>
<a href="/one?a=1&amp;b=2">one</a><a class=x HREF='two'>two</a><br/>3 < 4 <NoScript>hidden</noscript>end&#xzz;</body></html>"""
TEXT = "T & U\nCafé é👍 � � &#99999999; a<b &lt;\none two\n3 < 4 end&#xzz;"


def sha1(text):
    return "sha1:" + base64.b32encode(hashlib.sha1(text.encode()).digest()).decode()


def made(rows):
    pages = rows(
        "page_id long, url string, html string, record_id string, block string",
        (1, "http://a/é", HTML, "x", "y"), (2, None, None, "x", "y"), (None, "http://b\r\nEvil: 1", "", "x", "y"),
        (4, "http://c", "<p>same</p>", "", ""), (4, "http://c", "<p>same</p>", "", ""), (5, "http://d", "<div>" + "word <b>x</b> " * 50_000, "", ""),
    )
    return pages, derivatives(responses(pages), keep=("page_id",)).collect()


def test_records(rows):
    pages, out = made(rows)
    assert len(out) == 12
    sources = {str(r.page_id): r for r in responses(pages).collect()}
    for r in out:
        head, block = r.record.split("\r\n\r\n", 1)
        assert block == r.block
        fields = dict(line.split(": ", 1) for line in head.split("\r\n")[1:])
        assert int(fields["Content-Length"]) == len(block.encode()) == r.content_length
        assert fields["WARC-Block-Digest"] == sha1(block) == r.block_digest
        source = sources[str(r.page_id)]
        assert fields["WARC-Refers-To"] == source.record_id
        assert r.source_digest == sha1(source.payload)
        assert ("WARC-Target-URI" in fields) == (r.target_uri is not None)
        assert "Evil" not in fields and re.fullmatch(r"<urn:uuid:[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}>", r.warc_record_id)
    one = {r.warc_type: r for r in out if r.page_id == 1}
    meta = one["metadata"].block.split("\r\n")
    assert f"conversion-record: {one['conversion'].warc_record_id}" in meta
    assert f"source-payload-digest: {sha1(HTML)}" in meta and f"source-header: Content-Length: {len(HTML.encode())}" in meta
    assert [x for x in meta if x.startswith("outlink")] == ["outlink: /one?a=1&b=2", "outlink: two"]
    assert re.sub(r"(?m) +$", "", one["conversion"].block) == TEXT.replace("one two", "onetwo")
    assert {r.block for r in out if r.page_id == 2 and r.warc_type == "conversion"} == {""}
    assert len({r.warc_record_id for r in out if r.page_id == 4}) == 2


def test_empty(rows):
    assert derivatives(responses(rows("page_id long, url string, html string"))).count() == 0


def test_written_files_parse_back(rows, tmp_path):
    pages, out = made(rows)
    df = derivatives(responses(pages))
    write_records(df, str(tmp_path / "warc"))
    found = []
    for path in sorted((tmp_path / "warc").glob("part-*")):
        data, at = path.read_bytes(), 0
        while at < len(data):
            end = data.index(b"\r\n\r\n", at)
            n = int(re.search(rb"Content-Length: (\d+)", data[at:end])[1])
            found.append(data[end + 4 : end + 4 + n].decode())
            assert data[end + 4 + n : end + 8 + n] == b"\r\n\r\n"
            at = end + 8 + n
    assert sorted(found) == sorted(r.block for r in out)


def test_references_are_those_of_the_standard(rows):
    from html import unescape

    from reviewloom.llm.warc import NAMES
    from reviewloom.llm.warc import unescape as resolved

    every = " ".join(f"&{name};" for name in NAMES)
    texts = [every, "&copy; &middot; &hellip;&mdash;&Eacute;&NotEqualTilde;", "&amp;copy; &amp;amp; a & b; c &; &nosuchname; &#; &#x; &#xg; && &lt", "", "x", "&", "&#12a; &#00000065; &#65;;&lt;;"]
    got = [r.r for r in rows("t string", *[(t,) for t in texts], (None,)).select(resolved(F.col("t")).alias("r")).collect()]
    assert got[:2] == [unescape(t) for t in texts[:2]]
    assert got[2] == "&copy; &amp; a & b; c &; &nosuchname; &#; &#x; &#xg; && &lt"
    assert got[3:] == ["", "x", "&", "&#12a; &#00000065; A;<;", None]


def test_links_with_other_quotes_or_none(rows):
    html = """<a href="/o'brien">1</a><a href='/say "hi"'>2</a><a href=/plain/x.html>3</a><a class=b href=it's id=c>4</a><a HREF = "">5</a>
    <a href="/a>b">6</a><a name=top>7</a><a href=/q?a=1&amp;b=2
    rel=x>8</a>"""
    out = derivatives(responses(rows("page_id long, url string, html string", (1, "http://a", html)))).filter("warc_type = 'metadata'").first()
    links = [x.removeprefix("outlink: ") for x in out.block.split("\r\n") if x.startswith("outlink")]
    assert links == ["/o'brien", '/say "hi"', "/plain/x.html", "it's", "", "/a>b", "/q?a=1&b=2"]
