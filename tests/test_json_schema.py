"""JSON Schema: a matrix of keywords with first errors found by hand."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from tracewright.functions.json_schema import first_error, schema_errors

TREE = {"$defs": {"node": {"type": "object", "required": ["v"], "properties": {"v": {"type": "integer"}, "next": {"$ref": "#/$defs/node"}}}}, "$ref": "#/$defs/node"}
#: (schema, document, first error as (path, rule) or None)
CASES = [
    (True, 1, None), (False, 1, ("", "false")), ({}, None, None),
    ({"type": "integer"}, 3, None), ({"type": "integer"}, 3.0, None), ({"type": "integer"}, 3.5, ("", "type")), ({"type": "number"}, True, ("", "type")), ({"type": ["string", "null"]}, None, None), ({"type": "object"}, [], ("", "type")), ({"type": "array"}, [], None), ({"type": "boolean"}, False, None),
    ({"nullable": True, "type": "string"}, None, None), ({"nullable": True, "type": "string"}, 1, ("", "anyOf")), ({"properties": {"a": {"type": "string", "nullable": True}}}, {"a": None}, None),
    ({"enum": [1, "a", None, [1], {"k": 2}]}, 1.0, None), ({"enum": [1, "a", None, [1], {"k": 2}]}, {"k": 2}, None), ({"enum": [1, "a", None]}, True, ("", "enum")), ({"enum": [1, "a", None]}, None, None), ({"const": "x"}, "y", ("", "const")), ({"const": False}, 0, ("", "const")),
    ({"minimum": 3}, 2, ("", "minimum")), ({"minimum": 3}, "2", None), ({"exclusiveMinimum": 3}, 3, ("", "exclusiveMinimum")), ({"maximum": 3}, 3, None), ({"exclusiveMaximum": 3}, 3, ("", "exclusiveMaximum")), ({"multipleOf": 0.1}, 0.3, None), ({"multipleOf": 2}, 3, ("", "multipleOf")),
    ({"minLength": 2}, "é", ("", "minLength")), ({"maxLength": 2}, "abc", ("", "maxLength")), ({"pattern": "^a"}, "ba", ("", "pattern")), ({"pattern": "a"}, "ba", None), ({"format": "date"}, "2024-02-30", ("", "format")), ({"format": "date"}, 5, None),
    ({"items": {"type": "integer"}}, [1, "x", "y"], ("/1", "type")), ({"prefixItems": [{"type": "string"}], "items": {"type": "integer"}}, ["a", 1, None], ("/2", "type")), ({"prefixItems": [{"type": "string"}]}, [], None),
    ({"contains": {"const": 1}}, [2, 3], ("", "contains")), ({"contains": {"const": 1}, "maxContains": 1}, [1, 1], ("", "contains")), ({"contains": {"const": 1}, "minContains": 0}, [], None),
    ({"minItems": 1}, [], ("", "minItems")), ({"maxItems": 1}, [1, 2], ("", "maxItems")), ({"uniqueItems": True}, [{"a": 1, "b": 2}, {"b": 2, "a": 1}], ("", "uniqueItems")), ({"uniqueItems": True}, [1, "1"], None),
    ({"required": ["a", "b"]}, {"a": 1}, ("", "required")), ({"required": ["a"]}, [1], None), ({"properties": {"a/b": {"properties": {"~": {"type": "string"}}}}}, {"a/b": {"~": 1}}, ("/a~1b/~0", "type")),
    ({"properties": {"a": True}, "additionalProperties": False}, {"a": 1, "b": 2}, ("", "additionalProperties")), ({"properties": {"a": True}, "patternProperties": {"^x": {"type": "integer"}}, "additionalProperties": {"type": "string"}}, {"a": 1, "x1": 2, "z": 3}, ("/z", "type")),
    ({"patternProperties": {"^x": {"type": "integer"}}}, {"x1": "2"}, ("/x1", "type")), ({"propertyNames": {"maxLength": 2}}, {"abc": 1}, ("", "maxLength")), ({"minProperties": 1}, {}, ("", "minProperties")), ({"maxProperties": 1}, {"a": 1, "b": 1}, ("", "maxProperties")),
    ({"dependentRequired": {"a": ["b"]}}, {"a": 1}, ("", "dependentRequired")), ({"dependentRequired": {"a": ["b"]}}, {"c": 1}, None), ({"dependentSchemas": {"a": {"required": ["b"]}}}, {"a": 1}, ("", "required")),
    ({"anyOf": [{"type": "string"}, {"minimum": 5}]}, 3, ("", "anyOf")), ({"anyOf": [{"type": "string"}, {"minimum": 5}]}, 7, None), ({"oneOf": [{"type": "integer"}, {"minimum": 5}]}, 7, ("", "oneOf")), ({"oneOf": [{"type": "integer"}, {"minimum": 5}]}, 3, None), ({"allOf": [{"minimum": 5}, {"maximum": 1}]}, 3, ("", "minimum")),
    ({"not": {"type": "string"}}, "x", ("", "not")), ({"if": {"type": "string"}, "then": {"minLength": 2}, "else": {"minimum": 2}}, "x", ("", "minLength")), ({"if": {"type": "string"}, "then": {"minLength": 2}, "else": {"minimum": 2}}, 1, ("", "minimum")), ({"if": {"type": "string"}}, "x", None),
    (TREE, {"v": 1, "next": {"v": 2, "next": {"v": "3"}}}, ("/next/next/v", "type")), (TREE, {"v": 1, "next": {"next": {}}}, ("/next", "required")), (TREE, {"v": 1, "next": {"v": 1, "next": {"v": 1, "next": {"v": 1}}}}, ("/next/next/next", "depth")),
    # in the schema's own order, not the document's
    ({"properties": {"b": {"type": "integer"}, "a": {"type": "integer"}}, "required": ["c"]}, {"a": "x", "b": "y"}, ("/b", "type")), ({"required": ["c"], "properties": {"b": {"type": "integer"}}}, {"b": "y"}, ("", "required")), ({"maximum": 1, "type": "string"}, 2, ("", "maximum")),
    ({"$comment": "x", "title": "t", "unknown": {"type": "string"}}, 5, None),
]


def test_first_errors_of_the_keyword_matrix(spark):
    groups = [CASES[k : k + 16] for k in range(0, len(CASES), 16)]
    for group in groups:
        df = spark.createDataFrame([tuple(json.dumps(d) for _, d, _ in group)], [f"d{k}" for k in range(len(group))])
        row = df.select(*(first_error(F.parse_json(f"d{k}"), s).alias(f"e{k}") for k, (s, _, _) in enumerate(group))).first()
        for k, (schema, document, want) in enumerate(group):
            got = row[f"e{k}"]
            assert (tuple(got) if got is not None else None) == want, (schema, document)


def test_all_errors_and_null_documents(spark):
    schema = {"type": "object", "required": ["a", "b"], "properties": {"c": {"items": {"type": "integer", "minimum": 2}}}}
    df = spark.createDataFrame([('{"c": [1, "x", 3]}',), (None,), ("[]",)], "t string").select(schema_errors(F.try_parse_json("t"), schema).alias("e"))
    assert [[tuple(x) for x in r.e] for r in df.collect()] == [[("", "required"), ("", "required"), ("/c/0", "minimum"), ("/c/1", "type")], [("", "document")], [("", "type")]]


def test_compiled_schemas_run_without_python(spark):
    plan = spark.createDataFrame([("{}",)], "t string").select(first_error(F.parse_json("t"), TREE))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan


@pytest.mark.parametrize("pointer", ["#/$defs/none", "#/x/y"])
def test_references_to_nothing_are_refused(spark, pointer):
    with pytest.raises((KeyError, TypeError)):
        first_error(F.lit(None), {"$ref": pointer, "x": 1})


def test_facts_of_a_value_are_computed_once(spark):
    df = spark.createDataFrame([("{}",)], "t string").select(F.parse_json("t").alias("v"))
    plan = lambda schema: df.select(schema_errors(F.col("v"), schema).alias("e"))._jdf.queryExecution().analyzed().toString()
    assert plan({"type": "string", "minLength": 1}).count("schema_of_variant(") == 1
    assert plan({"oneOf": [{"required": ["a"]}, {"required": ["b"]}]}).count("try_variant_get(") == 1
