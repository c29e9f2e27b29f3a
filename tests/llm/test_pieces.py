"""Streaming segmentation next to the library, a full search, and the round trip."""

import itertools
import random

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2 as pb

from reviewloom.llm import pieces
from reviewloom.llm.pieces import MODEL, PieceModel, decode, encode, encoded

ODD = [
    "", " ", "    ", " lead", "trail  ", "two  blanks   three", "tab\tnew\nline\r\n", "naïve É größer ñandú", "中文字符 ゼ 벨", "👩‍👩‍👧 x",
    "a" * 300, " " * 500 + "x", "!!!%%%$$$", "\x00\x01", "aaaa bbbb abababab", "http://example.com/a?b=c&d=1234567890", "<s>x</s><unk><0x0A>",
]


@pytest.fixture(scope="module")
def model():
    return PieceModel(open(MODEL, "rb").read())


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def ids(model, text):
    return [i for s in model.spans(text) for i in model.ids_of(s)]


def test_ids_are_the_librarys(model, library):
    draw = random.Random(4)
    texts = ODD + ["".join(draw.choices("aetinosrh  é\n.1中!", k=draw.randint(1, 80))) for _ in range(1500)]
    for text in texts:
        assert ids(model, text) == library.encode(text), repr(text)


def test_side_by_side_agrees(model, library, monkeypatch):
    draw = random.Random(6)
    spans = ["▁" + "".join(draw.choices("aetinosrhñé中1.!x", k=draw.randint(0, 40))) for _ in range(3000)] + ["▁", "▁▁▁", "x"]
    assert [list(memoryview(b).cast("i")) for b in model.packed_many(spans)] == [model.ids_of(s) for s in spans]
    monkeypatch.setattr(pieces, "REMEMBERED", 50)
    encoder, texts = pieces.Encoder(model), [" ".join(spans[i : i + 40]).replace("▁", "") for i in range(0, 3000, 40)]
    for lo in range(0, len(texts), 5):
        got = [list(memoryview(b).cast("i")) for b in encoder.encode(texts[lo : lo + 5])]
        assert got == [library.encode(t) for t in texts[lo : lo + 5]]


def test_streaming_commits_before_the_end_and_agrees(model, library):
    text = "".join(random.Random(9).choices("theandoringtions", k=6000))
    seen = 0

    def characters():
        nonlocal seen
        for c in "▁" + text:
            seen += 1
            yield c

    stream = model.stream(characters())
    first = [next(stream) for _ in range(20)]
    assert seen <= 30 * model.longest
    assert [model.ids[p] for p in [*first, *stream]] == library.encode(text)


def test_spans_of_many_texts_at_once(model):
    draw = random.Random(11)
    texts = [None, *ODD, "▁x ▁▁", "\n", " \n x", "\t\t", *("".join(draw.choices("ab  \n\t▁é中", k=draw.randint(0, 30))) for _ in range(2000)), None]
    data, starts, first = model.cut_many(pa.array(texts).slice(1))
    whole = [data[a:b].tobytes().decode().replace(" ", "▁") for a, b in zip(starts, starts[1:])]
    assert [whole[a:b] for a, b in zip(first, first[1:])] == [model.spans(t or "") for t in texts[1:]]
    empty = model.cut_many(pa.array([None, ""], pa.string()))
    assert len(empty[0]) == 0 and empty[2].tolist() == [0, 0, 0]


def test_many_lists_of_ids_at_once(model, library):
    lists = [library.encode(t) for t in ODD] + [[], [model.unknown], [0, 1, 2, 5]]
    offsets = list(itertools.accumulate(map(len, lists), initial=0))
    flat = np.array([i for x in lists for i in x])
    assert model.decode_many(flat, np.array(offsets)) == [library.decode(x) for x in lists]


def test_decoding_in_the_same_pass_and_in_place(rows, library):
    texts = ["a b", None, "", "▁x", "lange  wörter\n" * 3, "x" * 5000]
    df = rows("Text string, IDS int, decoded int", *((t, 1, 1) for t in texts))
    both = encode(df, decoded="decoded")
    assert both.columns == ["Text", "ids", "decoded"]
    assert [(r.Text, r.ids, r.decoded) for r in both.collect()] == [(r.Text, r.ids, r.decoded) for r in decode(encode(df)).collect()]
    assert [r.ids for r in decode(both.select("ids"), out="ids").collect()] == [None if t is None else t.replace("▁", " ") for t in texts]
    assert [r.text for r in encode(df.select("text"), out="text").collect()] == [None if t is None else library.encode(t) for t in texts]
    gaps = rows("ids array<int>", ([None, 400],)).transform(decode).first().decoded
    assert gaps.strip().startswith("⁇")


def scored(pieces):
    proto = pb.ModelProto()
    proto.trainer_spec.model_type = 1
    proto.normalizer_spec.add_dummy_prefix = False
    proto.normalizer_spec.remove_extra_whitespaces = False
    proto.normalizer_spec.escape_whitespaces = True
    proto.pieces.add(piece="<unk>", score=0, type=2)
    for piece, score in pieces.items():
        proto.pieces.add(piece=piece, score=score, type=1)
    return PieceModel(proto.SerializeToString())


def test_scored_pieces_against_all_segmentations():
    draw = random.Random(8)
    pieces = {"".join(p): -draw.random() * 5 for n in (1, 2, 3, 4) for p in itertools.product("ab", repeat=n) if draw.random() < 0.6}
    pieces |= {"a": -4.0, "b": -4.5}
    m = scored(pieces)

    def best(text):
        if not text:
            return 0.0
        return max(pieces[text[:n]] + best(text[n:]) for n in range(1, 5) if text[:n] in pieces and len(text) >= n)

    for _ in range(200):
        text = "".join(draw.choices("ab", k=draw.randint(1, 12)))
        got = list(m.stream(text))
        assert "".join(got) == text
        assert sum(pieces[p] for p in got) == pytest.approx(best(text))
    long = "".join(draw.choices("ab", k=2000))
    totals = [0.0]
    for p in range(1, 2001):
        totals.append(max(totals[p - n] + pieces[long[p - n : p]] for n in range(1, 5) if n <= p and long[p - n : p] in pieces))
    assert sum(pieces[p] for p in m.stream(long)) == pytest.approx(totals[-1])
    assert m.ids_of("azb")[1] == m.unknown


def test_rows(rows, library):
    df = rows("doc_id long, text string, ids string, decoded int", (1, None, "x", 1), (2, "", "x", 1), (None, "a  b", None, 1), (4, "rep", "", 1), (4, "rep", "", 1), (5, "word é\n" * 20_000, "", 1))
    got = {str(r.doc_id): r for r in decode(encode(df)).collect()}
    assert got["1"].ids is None and got["1"].decoded is None
    assert got["2"].ids == [] and got["2"].decoded == ""
    assert got["None"].decoded == "a  b" and got["4"].ids == library.encode("rep")
    assert got["5"].decoded == "word é\n" * 20_000
    assert all(r.round_trip for r in encoded(df).collect())
    assert encoded(df).count() == 6 and encoded(df.limit(0)).count() == 0


def test_given_documents(spark, library):
    from reviewloom.llm.registry import QUERIES

    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    for r in QUERIES["op2_streaming_pieces"](spark, folder).collect():
        assert r.ids == library.encode(texts[r.doc_id]) and r.round_trip
