"""Stored upserts and files per key."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from reviewloom.sources import keyed_files, readers, stored
from reviewloom.sources.keyed_files import file_name, write_file_per_key
from reviewloom.sources.stored import read_stored, upsert_stored

DDL = "k string, n int, t int, v string"


def folders(path):
    return {p.name: sorted(f.name for f in p.glob("*.parquet")) for p in Path(path).glob("_bucket=*")}


def content(spark, path, df):
    return sorted((tuple(r) for r in read_stored(spark, path, df.schema).collect()), key=str)


def test_only_touched_buckets_are_rewritten(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    first = rows(DDL, *[(f"k{i}", i % 3, 1, "old") for i in range(200)], (None, None, 1, "null key"))
    assert len(upsert_stored(first, path, ["k", "n"], ["t"], 32)) > 25
    before = folders(path)
    new = rows(DDL, ("k7", 1, 2, "new"), ("k8", 2, 0, "late"), ("fresh", 0, 1, "new"), (None, None, 3, "newer null"), ("k7", 1, 1, "between"))
    touched = upsert_stored(new, path, ["k", "n"], ["t"], 32)
    after = folders(path)
    assert 1 <= len(touched) <= 4
    assert {n for n in before | after if before.get(n) != after.get(n)} == {f"_bucket={b}" for b in touched}
    want = {(f"k{i}", i % 3): (1, "old") for i in range(200)} | {("k7", 1): (2, "new"), ("fresh", 0): (1, "new"), (None, None): (3, "newer null")}
    assert content(spark, path, new) == sorted(((*k, *v) for k, v in want.items()), key=str)
    # the same run again changes nothing
    assert upsert_stored(new, path, ["k", "n"], ["t"], 32) == touched
    assert content(spark, path, new) == sorted(((*k, *v) for k, v in want.items()), key=str)


def test_a_run_that_died_is_finished_by_the_next(spark, rows, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    upsert_stored(rows(DDL, ("a", 1, 1, "x"), ("b", 1, 1, "x")), path, ["k"], ["t"], 4)
    replace = stored._replace
    calls = []

    def dies(*args):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("lost")
        replace(*args)

    monkeypatch.setattr(stored, "_replace", dies)
    with pytest.raises(RuntimeError):
        upsert_stored(rows(DDL, ("a", 1, 2, "y")), path, ["k"], ["t"], 4)
    monkeypatch.setattr(stored, "_replace", replace)
    nothing = rows(DDL)
    assert upsert_stored(nothing, path, ["k"], ["t"], 4) == []
    assert content(spark, path, nothing) == [("a", 1, 2, "y"), ("b", 1, 1, "x")]


def test_first_upsert_without_rows(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    assert upsert_stored(rows(DDL), path, ["k"], ["t"]) == []
    assert content(spark, path, rows(DDL)) == []


TREE = "category string, year int, month int, subcategory string, no int, note string"
NAMES = ["plain", "with blank", "a/b", "..", "_hidden", ".dot", "50%", "x.y.json", "ümlaut", "a+b", "", None, "q?#*", "{[x]}", "\\"]


def tree(root):
    return sorted(str(p.relative_to(root)) for p in Path(root).rglob("*") if p.is_file() and not p.name.startswith((".", "_")))


def test_file_per_key_round_trip(spark, rows, tmp_path):
    root = str(tmp_path / "RAG")
    data = [(c, 2018, 1, n, i, f"{c} {n}") for c in ("cat 1", "c/2", None) for n in NAMES for i in range(3)]
    write_file_per_key(rows(TREE, *data), root, order=["no"])
    assert len(tree(root)) == 3 * len(NAMES) and (Path(root) / "_SUCCESS").exists() and not (Path(root) / "_staging").exists()
    found = readers.read_json_tree(spark, root)
    parts = F.split(F.substring_index(keyed_files.decoded("path"), "/", -4), "/")
    name = F.substring_index(parts[3], ".json", 1)
    got = found.select(keyed_files.original(parts[0]).alias("c"), keyed_files.original(name).alias("n"), F.from_json("record", "no int, note string").alias("r"))
    assert sorted(((r.c, r.n, r.r.no, r.r.note) for r in got.collect()), key=str) == sorted(((c, n, i, f"{c} {n}" if c and n is not None else f"{c} {n}") for c, _, _, n, i, _ in data), key=str)
    file = next(p for p in Path(root).rglob("plain.json"))
    assert [r["no"] for r in json.loads(file.read_text())] == [0, 1, 2]


def test_append_keeps_and_overwrite_clears(spark, rows, tmp_path):
    root = str(tmp_path / "RAG")
    row = lambda name, note: rows(TREE, ("c", 1, 1, name, 0, note))
    write_file_per_key(row("a", "1"), root)
    write_file_per_key(row("b", "2"), root, mode="append")
    write_file_per_key(row("b", "3"), root, mode="append")
    assert tree(root) == ["c/1/1/a.json", "c/1/1/b.json"]
    assert json.loads((Path(root) / "c/1/1/b.json").read_text()) == [{"no": 0, "note": "3"}]
    write_file_per_key(row("d", "4"), root)
    assert tree(root) == ["c/1/1/d.json"]
    write_file_per_key(row("d", "4").limit(0), root)
    assert tree(root) == []


def test_a_failed_task_leaves_nothing_behind(spark, rows, tmp_path):
    root = str(tmp_path / "RAG")
    data = rows(TREE, *[("c", 1, 1, f"s{i}", i, "x") for i in range(50)])
    write_file_per_key(data.filter("no < 3"), root)
    before = tree(root)
    failing = data.withColumn("note", F.when(F.col("no") == 49, F.raise_error(F.lit("broken"))).otherwise(F.col("note")))
    with pytest.raises(Exception, match="broken"):
        write_file_per_key(failing, root)
    assert tree(root) == before and not (Path(root) / "_staging").exists()


def test_names_are_path_parts():
    for name in NAMES:
        part = file_name(name)
        assert part and "/" not in part and part[0] not in "._"
    assert len({file_name(n) for n in NAMES}) == len(NAMES)
