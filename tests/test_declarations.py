"""Semantic checks of declared environments and rubric packages, by cases told by hand."""

from pyspark.sql import functions as F

from tracewright.functions.issues import found, issue
from tracewright.operators import declarations as d

PLAIN = {"type": "string", "nullable": False, "scope": None}


def _found(rows):
    return sorted((r.k, r.code, r.path, r.detail) for r in rows.collect())


def test_environments(spark):
    loose, nested = {**PLAIN, "nullable": True}, {**PLAIN, "type": "object"}
    sets = [{"id": "a", "fields": {"x": PLAIN, "y": loose, "o": nested, "f": {**PLAIN, "scope": "none"}, "g": {**PLAIN, "scope": "files"}}, "key_fields": ["x", "y", "z", None]}, {"id": "b", "fields": {"x": PLAIN}, "key_fields": ["x"]}, {"id": "temp", "fields": None, "key_fields": None}, {"id": "b", "fields": {}, "key_fields": None}, {"id": None, "fields": None, "key_fields": None}]
    links = [
        {"id": "r", "left": {"record_set": "a", "fields": ["x", "y"]}, "right": {"record_set": "b", "fields": ["x"]}},
        {"id": "s", "left": {"record_set": "c", "fields": ["x"]}, "right": {"record_set": "a", "fields": ["o"]}},
        {"id": "t", "left": {"record_set": "a", "fields": []}, "right": None},
        {"id": "u", "left": {"record_set": None, "fields": ["x"]}, "right": {"record_set": "temp", "fields": ["x"]}},
    ]
    df = spark.createDataFrame([(1, sets, ["files", "sqlite_x"], links), (2, None, None, None), (3, sets[1:2], ["s"], [])], f"k int, sets {d.RECORD_SETS}, scopes array<string>, links {d.RELATIONSHIPS}")
    assert _found(d.environment_issues(df, "k", "sets", "scopes", "links")) == sorted([
        (1, "duplicate_id", "/sets", "b"),
        (1, "reserved_id", "/sets/2", "temp"),
        (1, "reserved_id", "/scopes/1", "sqlite_x"),
        (1, "unknown_scope", "/sets/0/fields/f", "none"),
        (1, "invalid_key_field", "/sets/0/key_fields", "y"),
        (1, "unknown_key_field", "/sets/0/key_fields", "z"),
        (1, "unknown_key_field", "/sets/0/key_fields", ""),
        (1, "unequal_ends", "/links/0", "2:1"),
        (1, "unknown_record_set", "/links/1/left", "c"),
        (1, "invalid_end_field", "/links/1/right", "o"),
        (1, "empty_end", "/links/2/left", "a"),
        (1, "unknown_record_set", "/links/3/left", ""),
        (1, "invalid_end_field", "/links/3/right", "x"),
    ])
    assert d.environment_issues(df.limit(0), "k", "sets", "scopes", "links").collect() == []


def test_packages(spark):
    sound = {"id": "r1", "weight": 1.0, "scale": "binary", "criteria": {"0": "no", "1": "yes"}, "quotes": ["sum up"], "tools": ["t1"], "required": ["t1"]}
    bad = {"id": "r 2", "weight": float("nan"), "scale": "ordinal_5", "criteria": {"0": "no", "3": ""}, "quotes": ["sum up", "else"], "tools": ["t1", "t9"], "required": ["t2"]}
    task = "please sum up all"
    rows = [
        (1, [sound], [{"id": "t1", "rubrics": ["r1"]}], [{"quote": "all", "rubrics": ["r1"]}], task),
        (2, [sound, bad, {**sound, "weight": float("inf"), "scale": "x", "quotes": None}], [{"id": "t1", "rubrics": ["r1"]}, {"id": "t2", "rubrics": ["r1", "zz"]}, {"id": "t3", "rubrics": None}], [{"quote": " ", "rubrics": ["zz"]}, {"quote": "other", "rubrics": ["r1"]}], task),
        (3, None, None, None, None),
        (4, [{**sound, "quotes": ["not told"]}], [{"id": "t1", "rubrics": ["r1"]}], [{"quote": "any", "rubrics": ["r1"]}], None),
    ]
    df = spark.createDataFrame(rows, f"k int, rubrics {d.RUBRICS}, tools {d.TOOLS}, cover {d.COVERAGE}, task string")
    assert _found(d.package_issues(df, "k", "rubrics", "tools", "cover", "task")) == sorted([
        (2, "duplicate_id", "/rubrics", "r1"),
        (2, "invalid_id", "/rubrics/1", "r 2"),
        (2, "invalid_weight", "/rubrics/1/weight", "NaN"),
        (2, "missing_criteria", "/rubrics/1/criteria", "1,2,3,4,5"),
        (2, "invalid_quote", "/rubrics/1/quotes", "else"),
        (2, "unknown_tool", "/rubrics/1/tools", "t9"),
        (2, "undeclared_tool", "/rubrics/1/required", "t2"),
        (2, "one_way", "/rubrics/1/tools", "t1"),
        (2, "invalid_weight", "/rubrics/2/weight", "Infinity"),
        (2, "invalid_scale", "/rubrics/2/scale", "x"),
        (2, "invalid_quote", "/rubrics/2/quotes", ""),
        (2, "one_way", "/tools/1/rubrics", "r1,r1"),
        (2, "unknown_rubric", "/tools/1/rubrics", "zz"),
        (2, "unknown_rubric", "/tools/2/rubrics", ""),
        (2, "invalid_quote", "/cover/0/quote", " "),
        (2, "unknown_rubric", "/cover/0/rubrics", "zz"),
        (2, "invalid_quote", "/cover/1/quote", "other"),
        (2, "uncovered", "/cover", "r 2"),
        (3, "nothing", "/rubrics", ""),
        (3, "nothing", "/cover", ""),
    ])


def test_paths_and_details_are_made_only_for_what_is_found(spark):
    df = spark.createDataFrame([(1, "a")], "k int, t string")
    row = df.select(found(F.col("t") == "b", issue("c", F.raise_error(F.lit("made")).cast("string"), F.col("t"))).alias("e"), found(F.lit(None).cast("boolean"), issue("c", F.col("t"), F.col("t"))).alias("n")).first()
    assert row.e == [] and row.n == []
