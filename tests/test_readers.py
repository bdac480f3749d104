"""Files as they come: encodings, JSON of both kinds, first matches, numbered lines, archives."""

from __future__ import annotations

import io
import json
import tarfile
import zipfile

import pytest

from decisionframe.sources import archives, readers


def shown(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


def test_tables_of_either_encoding_and_kind(spark, tmp_path):
    (tmp_path / "u.csv").write_bytes('name,text\na,"é, ""so""\nnext"\n'.encode())
    (tmp_path / "l.csv").write_bytes("name,text\na,é\n".encode("latin-1"))
    (tmp_path / "t.tsv").write_bytes(b"name\ttext\na\tx, y\n")
    (tmp_path / "lines.json").write_text('\n{"name": "a", "n": 1}\nbroken\n{"name": "é", "n": 2}\n')
    (tmp_path / "whole.json").write_text('[\n {"name": "a",\n  "n": 1},\n {"name": "b", "n": 2}\n]')
    (tmp_path / "latin.jsonl").write_bytes('{"name": "é", "n": 3}\n'.encode("latin-1"))
    read = lambda name, **o: readers.read_table(spark, str(tmp_path / name), **o)
    assert shown(read("u.csv"), "name", "text") == [("a", 'é, "so"\nnext')]
    assert shown(read("l.csv"), "text") == [("é",)] and shown(read("t.tsv"), "text") == [("x, y",)]
    assert shown(read("l.csv", encoding="ISO-8859-1"), "text") == [("é",)]
    assert shown(read("lines.json"), "name", "n") == [("a", 1), ("é", 2)]
    assert shown(read("whole.json"), "name", "n") == [("a", 1), ("b", 2)]
    assert shown(read("latin.jsonl"), "name", "n") == [("é", 3)]


def test_files_by_pattern(spark, tmp_path):
    for name, text in (("x/b_train.csv", "id,v\n1,p\n2,q\n"), ("x/y/a_train.csv", "id,v\n3,r\n"), ("x/test.csv", "id,v\n9,z\n"), ("x/.hidden_train.csv", "id,v\n7,h\n")):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(text)
    parts = {"*_train.csv": {"split": "train"}, "test.csv": {"split": "test"}}
    assert shown(readers.read_files(spark, str(tmp_path), parts), "id", "split") == [("1", "train"), ("2", "train"), ("3", "train"), ("9", "test")]
    assert shown(readers.read_files(spark, str(tmp_path), parts, all_files=False), "id", "split") == [("1", "train"), ("2", "train"), ("9", "test")]
    assert readers.read_files(spark, str(tmp_path), parts, prep=lambda df: df.where("v <> 'q'"), sample=2, key="id").count() == 2
    with pytest.raises(FileNotFoundError, match="none"):
        readers.read_files(spark, str(tmp_path), {"none*.csv": {}})


def record(i, **more):
    return {"id": f"r{i}", "type": "choice", "state": f"a state of record {i} here", "question": "Which one is it?", "options": ["red", "green"], "answer": i % 2, **more}


def test_lines_are_numbered_across_parts(spark, tmp_path):
    text = "".join(json.dumps(record(i)) + ("\r\n" if i % 3 else "\n\n") for i in range(400))
    (tmp_path / "many.jsonl").write_text(text, newline="")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        lines = readers.numbered_lines(spark, str(tmp_path / "many.jsonl"))
        want = [(i + 1, x) for i, x in enumerate(text.splitlines())]
        assert sorted((r["line"], r["value"]) for r in lines.collect()) == want
        assert spark.read.text(str(tmp_path / "many.jsonl")).rdd.getNumPartitions() > 5
        assert readers.load_records(spark, str(tmp_path / "many.jsonl")).count() == 400
        bad = text.splitlines()
        bad[300], bad[350] = json.dumps(record(1, options=["one"])), "{"
        (tmp_path / "bad.jsonl").write_text("\n".join(bad))
        with pytest.raises(ValueError, match=r"bad.jsonl:301: "):
            readers.load_records(spark, str(tmp_path / "bad.jsonl"))
        (tmp_path / "empty.jsonl").write_text("\n \n")
        with pytest.raises(ValueError, match="no records"):
            readers.load_records(spark, str(tmp_path / "empty.jsonl"))
        assert readers.load_records(spark, str(tmp_path / "m*.jsonl")).count() == 400
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_archives(spark, tmp_path):
    archives.register(spark)
    inner = io.BytesIO()
    with tarfile.open(fileobj=inner, mode="w:gz") as t:
        info = tarfile.TarInfo("deep.csv")
        info.size = 4
        t.addfile(info, io.BytesIO(b"x\ny\n"))
    with zipfile.ZipFile(tmp_path / "a.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("one.csv", "é\r\nb\n")
        z.writestr("../../two.csv", "c".encode())
        z.writestr("notes.md", "no")
        z.writestr("__MACOSX/one.csv", "no")
        z.writestr("in.tar.gz", inner.getvalue())
    for name, mode in (("b.tar", "w"), ("c.tgz", "w:gz")):
        with tarfile.open(tmp_path / name, mode) as t:
            for k in range(3):
                info = tarfile.TarInfo(f"d/{k}.csv")
                info.size = 3
                t.addfile(info, io.BytesIO(f"{k}\n\xe9".encode("latin-1")))
    read = lambda **o: spark.read.format("archive").options(**o).load(str(tmp_path))
    got = [(a.removeprefix(str(tmp_path)), *x) for a, *x in shown(read(members="*.csv"), "archive", "member", "line", "value")]
    want = [("/a.zip", "one.csv", 1, "é"), ("/a.zip", "one.csv", 2, "b"), ("/a.zip!in.tar.gz", "deep.csv", 1, "x"), ("/a.zip!in.tar.gz", "deep.csv", 2, "y")]
    want += [(f"/{a}", f"d/{k}.csv", n, v) for a in ("b.tar", "c.tgz") for k in range(3) for n, v in ((1, str(k)), (2, "é"))]
    assert got == sorted(want, key=str)
    pieces = shown(read(members="one.csv", nested="false", **{"as": "bytes", "piece": "4"}), "member", "piece", "content")
    assert [(m, k, bytes(c)) for m, k, c in pieces] == [("one.csv", 0, "é\r\n".encode()), ("one.csv", 1, b"b\n")]
    # a partition for each member of zip and tar, listed without reading them
    assert len(archives.ArchiveReader({"path": str(tmp_path), "members": "*.csv"}).partitions()) == 2 + 3 + 1
    with pytest.raises(Exception, match="maxNested"):
        read(maxNested="3").collect()
