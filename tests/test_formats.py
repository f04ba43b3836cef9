"""Formats against the standard library, nested validation and JSON helpers on odd values."""

from __future__ import annotations

import ipaddress
from datetime import date, time

import pytest
from pyspark.sql import functions as F

from tracewright.functions import formats
from tracewright.functions import json_values as jv
from tracewright.operators import constraints

ADDRESSES = ["::", "::1", "1::", "1:2:3:4:5:6:7:8", "1:2:3:4:5:6:7", "1:2:3:4:5:6:7::", "::2:3:4:5:6:7:8", "1::8", "1::2::3", "12345::", "g::", "::ffff:1.2.3.4", "1:2:3:4:5:6:1.2.3.4", "1:2:3:4:5:6:7:1.2.3.4", "::1.2.3.256", "1.2.3.4", "01.2.3.4", "1.2.3", "", "1:", ":1", "fe80::1\n"]


def _is_address(text: str, version: int) -> bool:
    try:
        return ipaddress.ip_address(text).version == version
    except ValueError:
        return False


@pytest.mark.parametrize("version", [4, 6])
def test_addresses_match_the_standard_library(spark, version):
    rows = spark.createDataFrame([(a,) for a in ADDRESSES], "a string").select("a", formats.has_format(F.col("a"), f"ipv{version}").alias("ok")).collect()
    assert {r.a: r.ok for r in rows} == {a: _is_address(a, version) for a in ADDRESSES}


@pytest.mark.parametrize(("name", "kind"), [("date", date), ("time", time)])
def test_days_and_times_match_the_standard_library(spark, name, kind):
    texts = ["2024-02-29", "2023-02-29", "2024-13-01", "2024-00-10", "24-01-01", "2024-1-1", "12:30", "12:30:59", "24:00", "12:60", "12:30:59.123456", "12:30+02:00", "12", "x", "", "12:30Z"]
    texts = [t for t in texts if name == "time" or "-" in t]

    def valid(text: str) -> bool:
        try:
            kind.fromisoformat(text.replace("Z", "+00:00"))
        except ValueError:
            return False
        return True

    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", formats.has_format(F.col("t"), name).alias("ok")).collect()
    assert {r.t: r.ok for r in rows} == {t: valid(t) for t in texts}


def test_nested_violations_bear_nulls(spark):
    schema = {"properties": {"a": {"nullable": True, "minimum": 1}, "b": {"items": {"minLength": 2}}}}
    rows = spark.createDataFrame([(1, (None, ["x", "yy", None])), (2, (0, None)), (3, None), (4, (5, []))], "id long, v struct<a: int, b: array<string>>")
    found = {r.id: [tuple(x) for x in r.found] for r in rows.select("id", constraints.violations(F.col("v"), schema).alias("found")).collect()}
    assert found == {1: [("/b/0", "minLength"), ("/b/2", "null")], 2: [("/a", "minimum"), ("/b", "null")], 3: [("", "null")], 4: []}


def test_json_helpers_bear_odd_texts(spark):
    texts = [None, "", "NaN", "[1e400]", "{" * 3000, '{"a": "x\ny"}', '<think>{</think>{"b": [1', '{"a": }', "1", '"é"', '{"k~/": {"": 1.0}}']
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "id long, t string")
    canonical = {r.id: r.c for r in rows.select("id", jv.canonical_json(F.col("t")).alias("c")).collect()}
    assert [canonical[k] for k in (0, 1, 2, 4, 7)] == [None] * 5 and canonical[8] == "1" and canonical[9] == '"é"'
    found = {r.id: r.c for r in rows.select("id", jv.object_in_text(F.col("t")).alias("c")).collect()}
    assert found[5] == '{"a":"x\\ny"}' and found[6] == '{"b":[1]}' and found[7] is None and found[0] is None
    leaves = [tuple(r) for r in jv.leaves(rows.where("id = 10"), ["id"], "t").collect()]
    assert leaves == [(10, "/k~0~1/", "1.0")]
    assert jv.leaves(rows.limit(0), ["id"], "t").count() == 0
