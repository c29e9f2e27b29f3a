"""The pipeline next to plain versions of its stages; odd rows through every stage."""

import random

import pytest
import sentencepiece

import corpus_pipeline
from corpus_pipeline import STAGES, run
from reviewloom.llm.pieces import MODEL
from tests.llm import test_bagminhash, test_winnowing

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, _keep string, _found string"


@pytest.fixture
def folder(rows, tmp_path):
    def make(docs, labels, items):
        rows(COLUMNS, *[(d, t, "en", "s", None, "k", "f") for d, t in docs]).write.parquet(f"{tmp_path}/documents.parquet")
        rows("doc_id long, quality int, toxic int, text string", *[(*x, "t") for x in labels]).write.parquet(f"{tmp_path}/labels.parquet")
        rows("item_id long, text string, doc_id long", *[(*x, 1) for x in items]).write.parquet(f"{tmp_path}/benchmark.parquet")
        return str(tmp_path)

    return make


def staged(spark, path):
    docs = spark.read.parquet(f"{path}/documents.parquet")
    kept = [docs]
    for i, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, path)
        out.write.parquet(f"{path}/out{i}")
        docs = spark.read.parquet(f"{path}/out{i}")
        kept.append(docs)
    return kept


def test_each_stage_against_a_plain_version(spark, folder):
    draw = random.Random(3)
    words = [a + b + c for a in ("ba", "ke", "lo") for b in ("ra", "so", "ti") for c in ("n", "m", "", "s")]
    docs, labels, bad = [], [], set()
    for i in range(600):
        body = draw.choices(words, k=draw.randint(30, 90))
        if i % 7 == 0:
            body, kind = [w.upper() + "!!" for w in body], 0
            bad.add(i)
        else:
            kind = 1
        docs.append((i, " ".join(body)))
        labels.append((i, kind, 0))
    docs += [(1000 + i, docs[i][1].replace(" ", "  ", 1)) for i in range(1, 100, 9)]
    item = " ".join(draw.choices(words, k=14))
    docs += [(2000, f"{docs[2][1]} x y z {item} and so on {docs[3][1]}"), (2001, docs[10][1] + " " + item[:20])]
    path = folder(docs, labels[:400], [(1, item)])
    start, good, unique, clean, coded = staged(spark, path)
    for before, after in zip([start, good, unique], [good, unique, clean]):
        assert after.columns == before.columns
    kept = {r.doc_id: r.text for r in good.collect()}
    ids = {d for d, _ in docs}
    assert len(bad & set(kept)) <= 2 and len((ids - bad) - set(kept)) <= 6
    rest = [(d, t) for d, t in kept.items()]
    group = test_bagminhash.brute(rest)
    least = {}
    for (d, _), g in zip(rest, group):
        least[g] = min(d, least.get(g, d))
    assert {r.doc_id for r in unique.collect()} == set(least.values())
    rest = [(r.doc_id, r.text) for r in unique.collect()]
    assert {r.doc_id for r in clean.collect()} == {r[0] for r in test_winnowing.brute(rest, [(1, item)]) if not r[5]}
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    out = coded.collect()
    assert len(out) == clean.count() and all(r.ids == library.encode(r.text) for r in out)
    again = {r.doc_id: r.ids for r in run(spark, path).collect()}
    assert again == {r.doc_id: r.ids for r in out}


def test_odd_rows(spark, folder):
    docs = [(None, None), (None, "x y"), (1, None), (2, ""), (3, ""), (4, "same words here now ok"), (4, "same words here now ok"), (5, "w " * 50_000)]
    path = folder(docs, [(None, 1, 0), (4, None, None)], [(None, None), (1, "")])
    assert sorted(str(r.doc_id) for r in run(spark, path).collect()) == ["1", "2", "4", "5", "None", "None"]


def test_empty_tables(spark, folder):
    out = run(spark, folder([], [], []))
    assert out.count() == 0 and "ids" in out.columns


def test_contract():
    assert [s for s, _ in STAGES][1] == "MinHash near-dedup" and len(STAGES) == 4 and corpus_pipeline.ORACLE_SQL is None
