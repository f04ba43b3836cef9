"""Null keys and values in differences, cuts of large values, repository URLs, and the tree without the corpus operators."""

from __future__ import annotations

import json
import shutil
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tracewright.functions import formats, json_values
from tracewright.operators import diff, duplicates, states

ROOT = Path(__file__).resolve().parent.parent


def test_null_keys_and_digests_are_values_in_differences(spark):
    schema = "asset string, key int, digest string"
    before = spark.createDataFrame([("a", None, "x"), ("a", 1, None), ("a", 2, "x"), ("a", 3, None), (None, 4, "x")], schema)
    after = spark.createDataFrame([("a", None, "x"), ("a", 1, None), ("a", 2, None), ("a", 5, None), (None, 4, "y")], schema)
    want = {("a", 2, "updated"), ("a", 3, "deleted"), ("a", 5, "inserted"), (None, 4, "updated")}
    assert {tuple(r) for r in states.state_diff(before, after, "asset", "key", "digest").collect()} == want
    assert {tuple(r) for r in diff.row_changes(before, after, ["asset", "key"]).collect()} == want
    assert {tuple(r)[:3] for r in diff.field_changes(before, after, ["asset", "key"]).collect()} == want
    assert states.state_diff(before, before, "asset", "key", "digest").collect() == []


def test_null_values_are_there_in_first_differences_receipts_and_audits(spark):
    left = spark.createDataFrame([(1, "/a", None), (1, "/b", "x"), (2, "/a", None)], "k int, pointer string, value string")
    right = spark.createDataFrame([(1, "/b", "x"), (2, "/a", None)], "k int, pointer string, value string")
    assert [tuple(r) for r in states.first_difference(left, right, ["k"]).collect()] == [(1, "/a", None, None)]
    files = spark.createDataFrame([("a", None), ("b", "1"), (None, "2"), ("d", "3")], "path string, sha256 string")
    receipts = spark.createDataFrame([("a", "0"), ("b", None), (None, "2"), ("c", "3")], "path string, sha256 string")
    assert {tuple(r) for r in states.receipt_integrity(files, receipts).collect()} == {("a", "mismatch"), ("b", "mismatch"), (None, "ok"), ("c", "no file"), ("d", "no receipt")}
    one, other = (spark.createDataFrame([(x,) for x in xs], "k string") for xs in (["a", None], [None, "b"]))
    assert {tuple(r) for r in states.presence_audit(one, other, "k").collect()} == {("a", "missing"), (None, "present"), ("b", "unselected")}


def test_rows_with_null_texts_stay_in_duplicate_classes(spark):
    got = duplicates.duplicate_classes(spark.createDataFrame([(1, "A a"), (2, "a-A"), (3, None), (4, None)], "id int, text string"), "id", "text")
    assert {tuple(r) for r in got.collect()} == {(1, 1, 1), (2, 1, 1), (3, None, None), (4, None, None)}


VALUES = ["x" * 400, "é🙂\"\n" * 60, ["abc"] * 90, {"a": 1, "big": "y" * 300, "list": list(range(200)), "n": None}, {f"k{i}": i for i in range(90)}, [["z" * 500], 1], {"deep": {"er": {"est": "q" * 500}}}, "short", 7, None, []]


@pytest.mark.parametrize("most", [20, 60, 120, 1000])
def test_cut_values_fit_and_small_ones_stay(spark, most):
    df = spark.createDataFrame([(k, json.dumps(v)) for k, v in enumerate(VALUES)], "k int, text string")
    for r in df.select("k", json_values.bounded(F.col("text"), most).alias("out")).collect():
        whole = json.dumps(VALUES[r.k], ensure_ascii=False, separators=(",", ":"))
        if len(whole.encode()) <= most:
            assert r.out == whole
        elif r.out is not None:
            assert len(r.out.encode()) <= most and json.loads(r.out) != VALUES[r.k]


def test_cuts_keep_heads_first_items_and_small_members():
    fitted = lambda v, room: json_values._fitted(json_values._measured(v), room)
    assert fitted("abcdefghij" * 5, 40) == {"cut_string": "abcdefghijab", "bytes": 50}
    assert fitted([1, 2, 3] * 20, 40) == {"cut_array": [1, 2, 3, 1, 2, 3, 1], "items": 60}
    got = fitted({"id": 12345, "body": "b" * 500, "tail": "t" * 500}, 150)
    assert got["id"] == 12345 and {"cut_string", "bytes"} == set(got["body"]) == set(got["tail"])


HEX = "0123456789abcdefABCD" * 2


@pytest.mark.parametrize(
    ("url", "want"),
    [
        (f"https://raw.githubusercontent.com/o/r/{HEX}/f.json", "immutable_repository"), ("https://raw.githubusercontent.com/o/r/main/f", "mutable_repository"), ("https://raw.githubusercontent.com/o/r", None),
        (f"https://GitHub.com/o/r/blob/{HEX}/f", "immutable_repository"), ("https://github.com/o/r/raw/v1/f", "mutable_repository"), (f"https://github.com/o/r/tree/{HEX}", None),
        (f"https://github.com/o/r/archive/{HEX}.zip", "immutable_repository"), (f"https://github.com/o/r/archive/refs/heads/{HEX}.tar.gz", "immutable_repository"), ("https://github.com/o/r", None),
        (f"https://codeload.github.com/o/r/zip/{HEX}", "immutable_repository"), ("https://codeload.github.com/o/r/zip", None), (f"https://api.github.com/repos/o/r/contents/f?ref={HEX}", "immutable_repository"),
        ("https://api.github.com/repos/o/r?x=1&ref=main", "mutable_repository"), ("https://api.github.com/repos/o/r", None), (f"https://api.github.com/users?ref={HEX}", None), (f"https://example.com/o/r/{HEX}/f", None), (None, None),
    ],
)
def test_stability_of_repository_urls(spark, url, want):
    assert spark.createDataFrame([(url,)], "u string").select(formats.url_stability(F.col("u")).alias("s")).first().s == want


def test_tests_are_collected_without_the_corpus_operators(tmp_path):
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__", ".pytest_cache"))
    done = subprocess.run([sys.executable, "-m", "pytest", "tests", "-q", "--collect-only", "-p", "no:cacheprovider"], cwd=copy, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stdout[-2000:]
