"""Containers, reports, discovery and releases on small files."""

from __future__ import annotations

import gzip
import io
import sqlite3
import tarfile
import zipfile

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracewright.sources import records, sinks


def test_sqlite_record_sets_are_decoded(spark, tmp_path):
    db = sqlite3.connect(tmp_path / "a.sqlite")
    db.executescript("PRAGMA user_version = 7; CREATE TABLE items(id TEXT, ok INTEGER, tags TEXT, score REAL); INSERT INTO items VALUES ('a', 1, '[\"x\"]', 1.5), ('b', 0, NULL, NULL), ('c', NULL, '[]', 2);")
    db.close()
    files = records.binary_files(spark, str(tmp_path), "*.sqlite")
    schema = T.StructType().add("id", "string").add("ok", "boolean").add("tags", T.ArrayType(T.StringType())).add("score", "double")
    assert [tuple(r)[1:] for r in records.sqlite_table(files, "items", schema).orderBy("id").collect()] == [("a", True, ["x"], 1.5), ("b", False, None, None), ("c", None, [], 2.0)]
    found = records.sqlite_catalog(files).collect()
    assert [(r.kind, r.name, r.user_version) for r in found] == [("table", "items", 7)] and len(found[0].sha256) == 64
    db = sqlite3.connect(tmp_path / "a.sqlite")
    db.execute("UPDATE items SET ok = 2 WHERE id = 'a'")
    db.commit()
    db.close()
    with pytest.raises(PySparkException, match="no boolean"):
        records.sqlite_table(records.binary_files(spark, str(tmp_path), "*.sqlite"), "items", schema).collect()


def test_archives_give_their_members_and_refuse_unsafe_ones(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("d/x.txt", "hello")
    with tarfile.open(tmp_path / "b.tar.gz", "w:gz") as t:
        info = tarfile.TarInfo("y.txt")
        info.size = 3
        t.addfile(info, io.BytesIO(b"abc"))
    (tmp_path / "c.txt.gz").write_bytes(gzip.compress(b"zz"))
    files = records.binary_files(spark, str(tmp_path))
    got = {(r.path.rpartition("/")[2], r.member, r.bytes, bytes(r.content)) for r in records.archive_members(files, 100).collect()}
    assert got == {("a.zip", "d/x.txt", 5, b"hello"), ("b.tar.gz", "y.txt", 3, b"abc"), ("c.txt.gz", "c.txt", 2, b"zz")}
    with pytest.raises(PySparkException, match="over 4 bytes"):
        records.archive_members(files, 4).collect()
    with zipfile.ZipFile(tmp_path / "bad.zip", "w") as z:
        z.writestr("../x.txt", "hello")
    with pytest.raises(PySparkException, match="unsafe member"):
        records.archive_members(records.binary_files(spark, str(tmp_path), "bad.zip"), 100).collect()


def test_json_documents_and_statistics(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"a": 1,\n "b": "x"}')
    assert [(r.a, r.b) for r in records.json_documents(spark, str(tmp_path / "a.json"), "a int, b string", "environment").collect()] == [(1, "x")]
    (tmp_path / "b.json").write_text("[1, 2, 3]")
    with pytest.raises(PySparkException, match="environment: no JSON object"):
        records.json_documents(spark, str(tmp_path / "b.json"), "a int", "environment").collect()
    (tmp_path / "c.json").write_text('{"items": [1, 2]}')
    (tmp_path / "d.csv").write_text("h\n1\n\n2\n")
    (tmp_path / "e.jsonl").write_text("{}\n\n{}")
    found = {r.path.rpartition("/")[2]: r.records for r in records.file_statistics(records.binary_files(spark, str(tmp_path))).collect()}
    assert found == {"a.json": 1, "b.json": 3, "c.json": 2, "d.csv": 2, "e.jsonl": 2}


def test_junit_reports(spark, tmp_path):
    (tmp_path / "r.xml").write_text('<testsuites><testsuite name="s"><testcase classname="c" name="one" time="0.5"/><testcase classname="c" name="two" time="1"><error message="e"/><failure message="f">long</failure></testcase><testcase classname="d" name="three" time="0"><skipped/></testcase></testsuite></testsuites>')
    cases = records.junit_cases(spark, str(tmp_path / "r.xml"))
    assert sorted((r.suite, r.name, r.status, r.message) for r in cases.collect()) == [("c", "one", "passed", None), ("c", "two", "failed", "f"), ("d", "three", "skipped", None)]
    run = records.junit_runs(cases).first()
    assert (run.suites, run.cases, run.passed, run.failed, run.run_failed) == (2, 3, 1, 1, True)


def test_previews_keep_characters_whole(spark):
    texts = ["aé日🙂z" * 2, "", "abc"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    for most in range(1, 22):
        got = {r.t: r.p for r in rows.select("t", records.preview(F.encode("t", "UTF-8"), most).alias("p")).collect()}
        assert got == {t: t.encode()[:most].decode("utf-8", "ignore") for t in texts}


def test_releases_are_published_once_and_whole(spark, tmp_path):
    df = spark.createDataFrame([(1, None, "é"), (2, "x", "b")], "id long, note string, t string")
    folder = str(tmp_path / "release")
    told = sinks.published({"main": df, "strict": df.where("note IS NULL")}, folder, ["id", "note", "t"], {"seed": 1})
    assert sorted((r.output, r.rows, r.policy) for r in told.collect()) == [("main", 2, '{"seed": 1}'), ("strict", 1, '{"seed": 1}')]
    lines = sorted(line for p in (tmp_path / "release" / "main").glob("*.json") for line in p.read_text().splitlines())
    assert lines == ['{"id":1,"note":null,"t":"é"}', '{"id":2,"note":"x","t":"b"}']
    with pytest.raises(FileExistsError):
        sinks.published({"main": df}, folder, ["id"])
    with pytest.raises(PySparkException):
        sinks.published({"main": df.withColumn("id", F.raise_error(F.lit("broken")).cast("long"))}, str(tmp_path / "other"), ["id"])
    assert [p.name for p in tmp_path.iterdir()] == ["release"]
    assert [tuple(r) for r in sinks.grown(told.where("output = 'main'"), told.where("output = 'main'")).collect()] == [("main", 4)]


def test_routers_csv_and_reports(spark, tmp_path):
    df = spark.createDataFrame([(1, True, ["a", "b"]), (2, False, [])], "id long, ok boolean, tags array<string>")
    good, bad = sinks.routed(df, F.col("ok"))
    assert [r.id for r in good.collect()] == [1] and [r.id for r in bad.collect()] == [2]
    with pytest.raises(PySparkException, match="no verdict"):
        sinks.routed(df.withColumn("ok", F.lit(None).cast("boolean")), F.col("ok"))[0].collect()
    sinks.write_csv(df, str(tmp_path / "c"))
    text = "".join(p.read_text() for p in sorted((tmp_path / "c").glob("*.csv")))
    assert text.startswith("﻿id,ok,tags") and "1,true,a|b" in text
    sinks.write_by_decision(df.withColumn("decision", F.expr("CASE WHEN ok THEN 'keep' END")), "decision", str(tmp_path / "d"))
    assert spark.read.json(str(tmp_path / "d")).select("id", "decision").collect() == [(1, "keep")]
    assert [r.id for r in sinks.pending(df, spark.read.json(str(tmp_path / "d")), ["id"]).collect()] == [2]
    for _ in range(2):
        sinks.append_progress(df.select("id"), str(tmp_path / "p"))
    assert spark.read.json(str(tmp_path / "p")).count() == 4
    assert sinks.report_markdown(df.orderBy("id").select("id", "ok"), "T") == "# T\n\n| id | ok |\n| --- | --- |\n| 1 | True |\n| 2 | False |\n"
    with pytest.raises(ValueError):
        sinks.report_markdown(df, "T", most=1)
