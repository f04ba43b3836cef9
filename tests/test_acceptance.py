"""Acceptance tests: their form and their gate, by cases told by hand."""

import json

import pytest
from pyspark.sql import functions as F

from tracewright.operators import acceptance

CALL = {"calls": [{"tool": "t", "arguments": {}}]}
CASES = [
    (CALL, set()),
    ({}, {("", "required")}),
    ({"calls": []}, {("/calls", "minItems")}),
    ({"calls": [{"tool": "", "arguments": [], "x": 1}]}, {("/calls/0/tool", "minLength"), ("/calls/0/arguments", "type"), ("/calls/0", "additionalProperties")}),
    ({**CALL, "expect_success": 1, "expected_data": [], "odd": 1}, {("/expect_success", "type"), ("/expected_data", "type"), ("", "additionalProperties")}),
    ({**CALL, "expected_data": None, "reference": " "}, {("/reference", "pattern")}),
    ({**CALL, "expected_error": {"code": "c", "retryable": "no"}}, {("/expected_error/retryable", "type"), ("/expected_error", "error of a success")}),
    ({**CALL, "expected_error": {"code": "c"}, "expect_success": False}, set()),
    ({**CALL, "expected_error": {}}, set()),
    ({**CALL, "expected_records": [{"record_set_id": "r", "key": {}, "values": {"a": 1}}]}, {("/expected_records/0/key", "minProperties")}),
    ({**CALL, "data_checks": [{"path": "", "op": "close", "value": 1}, {"path": "/a", "op": "range", "min": 2}, {"path": "a", "op": "range", "min": 2}, {"path": "/a", "op": "range"}, {"path": "/a", "op": "range", "min": 2, "max": 1}]}, {("/data_checks/2", "oneOf"), ("/data_checks/3", "oneOf"), ("/data_checks/4", "empty range")}),
    ({**CALL, "expected_files": [{"scope_id": "s", "path": "p"}, {"scope_id": "s", "path": "p", "expected_json": {}}, {"scope_id": "s", "path": "p", "contains_text": "x"}]}, {("/expected_files/0", "anyOf"), ("/expected_files/1/expected_json", "not")}),
]


def _df(spark, values):
    return spark.createDataFrame([(k, None if v is None else json.dumps(v)) for k, v in enumerate(values)], "k int, text string").select("k", F.parse_json("text").alias("v"))


def test_forms(spark):
    rows = acceptance.issues_of_tests(_df(spark, [[test] for test, _ in CASES] + [None, {"a": 1}, []]), "k", "v").collect()
    got = {}
    for r in rows:
        got.setdefault(r.k, set()).add((r.path, r.rule))
    want = {k: {("/0" + path, rule) for path, rule in found} for k, (_, found) in enumerate(CASES) if found}
    n = len(CASES)
    assert got == {**want, n: {("", "not a list")}, n + 1: {("", "not a list")}}


@pytest.mark.parametrize("asserted", [{"expected_data": {"a": 1}}, {"expected_records": [1]}, {"data_checks": [{}]}, {"expected_files": [{}]}])
def test_gates(spark, asserted):
    sets = [[], None, [{**CALL, **asserted, "expect_success": False}], [CALL, {**CALL, **asserted, "expect_success": False}], [CALL, {**CALL, **asserted}], [{**CALL, "expected_data": {}, "data_checks": []}]]
    got = [r.gate for r in acceptance.gate(_df(spark, sets), "k", "v").orderBy("k").collect()]
    assert got == ["no tests", "no tests", "no successful test", "nothing asserted", None, "nothing asserted"]


def test_a_test_that_many_sets_repeat_is_checked_once(spark):
    bad, worse = {"calls": []}, {"calls": [], "odd": 1}
    df = _df(spark, [[CALL, bad]] * 40 + [[worse, bad, CALL, bad]] * 3 + [None]).coalesce(1)
    issues = acceptance.issues_of_tests(df, "k", "v")
    want = [(k, "/1/calls", "minItems") for k in range(40)] + [(k, f"/{i}/calls", "minItems") for k in range(40, 43) for i in (0, 1, 3)] + [(k, "/0", "additionalProperties") for k in range(40, 43)] + [(43, "", "not a list")]
    assert sorted(map(tuple, issues.collect())) == sorted(want)
    assert "collect_list" in issues._jdf.queryExecution().optimizedPlan().toString()
