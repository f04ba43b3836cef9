"""Acceptance tests of tools: the form of each test, what its members ask of each other, and the gate that a set must pass.

Tests are a variant, a list of objects; their form is a JSON Schema compiled to Columns, so no Python
runs a row. A null variant, or one that is no list, has the one issue ``not a list``; an empty list has none but does not pass
the gate. Equal rows give equal rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewright.functions import json_schema

_NAME, _TEXT, _SOME = {"type": "string", "minLength": 1}, {"type": "string", "pattern": r"\S"}, {"type": "object", "minProperties": 1}


def _closed(properties: dict, required: tuple[str, ...] = (), **more) -> dict:
    return {"type": "object", "properties": properties, "required": list(required), "additionalProperties": False, **more}


_CLOSE = _closed({"path": {"type": "string", "pattern": "^(/|$)"}, "op": {"const": "close"}, "value": {"type": "number"}, "atol": {"type": "number", "minimum": 0}, "rtol": {"type": "number", "minimum": 0}}, ("path", "op", "value"))
_RANGE = _closed({"path": {"type": "string", "pattern": "^(/|$)"}, "op": {"const": "range"}, "min": {"type": "number"}, "max": {"type": "number"}}, ("path", "op"), anyOf=[{"required": ["min"]}, {"required": ["max"]}])
_FILE = _closed({"scope_id": _NAME, "path": _NAME, "expected_json": {"not": {"enum": [None, False, 0, "", [], {}]}}, "contains_text": _NAME}, ("scope_id", "path"), anyOf=[{"required": ["expected_json"]}, {"required": ["contains_text"]}])
#: The members of a test and their form.
TEST = _closed(
    {
        "calls": {"type": "array", "minItems": 1, "items": _closed({"tool": _NAME, "arguments": {"type": "object"}}, ("tool",))},
        "expect_success": {"type": "boolean"},
        "expect_changed": {"type": "boolean"},
        "expected_data": {"type": ["object", "null"]},
        "expected_records": {"type": "array", "items": _closed({"record_set_id": _NAME, "key": _SOME, "values": _SOME}, ("record_set_id", "key", "values"))},
        "expected_error": _closed({"code": {"type": "string"}, "path": {"type": "string"}, "message": {"type": "string"}, "retryable": {"type": "boolean"}}),
        "expected_error_code": {},
        "data_checks": {"type": "array", "items": {"oneOf": [_CLOSE, _RANGE]}},
        "expected_files": {"type": "array", "items": _FILE},
        "description": _TEXT,
        "reference": _TEXT,
    },
    ("calls",),
)
#: Members that hold what a successful test asserts.
ASSERTIONS = ("expected_records", "data_checks", "expected_files")


def _list(v: Column, path: str = "$") -> Column:
    return F.try_variant_get(v, path, "array<variant>")


def _succeeds(test: Column) -> Column:
    """Whether a test expects success, as it does unless it says otherwise."""
    return F.coalesce(F.try_variant_get(test, "$.expect_success", "boolean"), F.lit(True))


def _size(test: Column, path: str) -> Column:
    members = F.size(F.try_variant_get(test, path, "map<string,variant>"))
    return F.greatest(F.coalesce(F.size(_list(test, path)), F.lit(0)), F.coalesce(members, F.lit(0)), F.lit(0))


def _error(bad: Column, path: Column, rule: str) -> Column:
    return F.filter(F.array(F.struct(path.alias("path"), F.lit(rule).alias("rule"))), lambda _: F.coalesce(bad, F.lit(False)))


def _upside_down(check: Column) -> Column:
    ends = [F.try_variant_get(check, f"$.{c}", "double") for c in ("min", "max")]
    return ends[0] > ends[1]


def _issues_of_test(test: Column) -> Column:
    """(path, rule) of one test, paths from the test on."""
    checks = F.coalesce(_list(test, "$.data_checks"), F.array().cast("array<variant>"))
    ranges = F.flatten(F.transform(checks, lambda c, j: _error(_upside_down(c), F.concat(F.lit("/data_checks/"), j.cast("string")), "empty range")))
    return F.concat(json_schema.schema_errors(test, TEST), _error((_size(test, "$.expected_error") > 0) & _succeeds(test), F.lit("/expected_error"), "error of a success"), ranges)


def issues_of_tests(df: DataFrame, key: str, tests: str) -> DataFrame:
    """(key, path, rule): where the tests break their form, expect an error of a success, or check an empty range.

    A check takes far longer than a shuffle of its test, and sets repeat tests: a test is checked once for all that its
    partition of ``df`` has of its JSON text, which decides what it is. A list of places is never longer than a partition's.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    listed = df.select(F.col(key).alias("tw_key"), F.spark_partition_id().alias("tw_part"), _list(F.col(tests)).alias("tw_tests"))
    # a null text stands for what is no list
    texts = F.when(F.col("tw_tests").isNull(), F.array(F.lit(None).cast("string"))).otherwise(F.transform("tw_tests", lambda t: F.to_json(t)))
    each = listed.select("tw_key", "tw_part", F.posexplode(texts).alias("tw_at", "tw_text"))
    # few bytes are much work here and would be merged into one task
    alike = each.groupBy("tw_part", "tw_text").agg(F.collect_list(F.struct("tw_key", "tw_at")).alias("tw_places")).repartition(n, "tw_part", "tw_text")
    parsed = alike.select("tw_places", F.parse_json("tw_text").alias("tw_test"))
    every = F.when(F.col("tw_test").isNull(), _error(F.lit(True), F.lit(None).cast("string"), "not a list")).otherwise(_issues_of_test(F.col("tw_test")))
    found = parsed.select("tw_places", F.explode(every).alias("tw_e")).select(F.explode("tw_places").alias("tw_place"), "tw_e")
    path = F.when(F.col("tw_e.path").isNull(), "").otherwise(F.concat(F.lit("/"), F.col("tw_place.tw_at").cast("string"), F.col("tw_e.path")))
    return found.select(F.col("tw_place.tw_key").alias(key), path.alias("path"), F.col("tw_e.rule").alias("rule"))


def gate(df: DataFrame, key: str, tests: str) -> DataFrame:
    """(key, gate): ``no tests``, ``no successful test``, ``nothing asserted`` by a successful one, or null where the set passes."""
    every = F.coalesce(_list(F.col(tests)), F.array().cast("array<variant>"))
    good = F.filter(every, _succeeds)
    data = lambda t: F.coalesce(F.size(F.try_variant_get(t, "$.expected_data", "map<string,variant>")), F.lit(0)) > 0
    lists = lambda t: F.exists(F.array(*(F.coalesce(F.size(_list(t, f"$.{c}")), F.lit(0)) for c in ASSERTIONS)), lambda n: n > 0)
    told = F.when(F.size(every) == 0, "no tests").when(F.size(good) == 0, "no successful test").when(~F.exists(good, lambda t: data(t) | lists(t)), "nothing asserted")
    return df.select(key, told.alias("gate"))
