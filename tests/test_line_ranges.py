"""Numbers of lines in files that several tasks share."""

from __future__ import annotations

import random

import pytest

from tests import prose as fx
from tracewright.sources import jsonl


@pytest.fixture
def small_ranges(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {k: spark.conf.get(k) for k in names}
    for k, v in zip(names, ("4096", "1"), strict=True):
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_lines_of_one_file_are_numbered_across_its_ranges(spark, tmp_path, small_ranges):
    rng = random.Random(2)
    files = {"a.jsonl": [rng.choice(["", "\r", fx.prose(rng, rng.randrange(1, 60)).replace("\n", " "), "é🙂" * 50, "x" * 9000]) for _ in range(700)], "b.jsonl": ["only"], "sub/c.jsonl": ["", "", "z"], "d.jsonl": []}
    for name, lines in files.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes("\n".join(lines).encode() + (b"\n" if name != "b.jsonl" and lines else b""))
    (tmp_path / "other.txt").write_text("no\n")
    got = {(r.path.rpartition(f"{tmp_path.name}/")[2], r.line): r.value for r in jsonl.numbered_lines(spark, str(tmp_path)).collect()}
    assert got == {(name, k): line.removesuffix("\r") for name, lines in files.items() for k, line in enumerate(lines, 1)}
    shared = {r.path.rpartition("/")[2]: r.ranges for r in jsonl.lines_in_ranges(spark, str(tmp_path)).collect()}
    assert shared["a.jsonl"] > 20 and shared["b.jsonl"] == 1


def test_objects_keep_their_line_numbers_across_ranges(spark, tmp_path, small_ranges):
    (tmp_path / "x.jsonl").write_text("".join("\n" if k % 5 == 4 else '{"k": %d}\n' % k for k in range(4000)))
    rows = jsonl.strict_objects(jsonl.numbered_lines(spark, str(tmp_path)), "k long").collect()
    assert len(rows) == 3200 and all(r.line == r.k + 1 for r in rows)


def test_a_folder_without_lines_gives_no_rows(spark, tmp_path):
    (tmp_path / "e.jsonl").write_text("")
    assert jsonl.numbered_lines(spark, str(tmp_path)).collect() == []
