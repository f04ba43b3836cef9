"""JSON values made of documents and events: canonical form, leaves, search, extraction, sums, bounds, schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewright.functions import json_values as jv
from tracewright.session import table

#: A JSON text of a document, in expressions that Spark and DuckDB read alike.
_JSON = """concat('{"z": [', doc_id % 7, ', {"a/b": "', source, '"}, []], "lang": "', lang, '", "n": {"input_tokens": ', n_chars, ', "deep": [{"input_tokens": 5, "output_tokens": ', doc_id, '}], "x": ', CASE WHEN doc_id % 3 = 0 THEN 'null' ELSE '1.50' END, '}}')"""
_TOKENS = ("input_tokens", "output_tokens", "total_tokens")
_X = "CASE WHEN doc_id % 3 = 0 THEN 'null' ELSE '1.5' END"
_CANONICAL = f"""concat('{{"lang":"', lang, '","n":{{"deep":[{{"input_tokens":5,"output_tokens":', doc_id, '}}],"input_tokens":', n_chars, ',"x":', {_X}, '}},"z":[', doc_id % 7, ',{{"a/b":"', source, '"}},[]]}}')"""
#: Free text with an object in it, in several states.
_SPOKEN = f"""CASE doc_id % 6 WHEN 0 THEN concat('<think>{{"no": 1}}</think>So: ', {_JSON}, ' I hope {{this}} helps') WHEN 1 THEN concat('```json\n', {_JSON}, '\n```') WHEN 2 THEN concat('{{"cut": [1, {{"s": "', lang)
  WHEN 3 THEN concat('[', doc_id, ']') WHEN 4 THEN concat('{{"broken": ]', lang) ELSE 'no object here' END"""


def _docs(spark: SparkSession, sf_dir: str, expression: str = _JSON) -> DataFrame:
    return table(spark, sf_dir, "documents").selectExpr("doc_id", "n_chars", "lang", "source", f"{expression} AS json")


def json_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jv.canonical_json(F.col("json"))
    return _docs(spark, sf_dir).select("doc_id", found.alias("canonical"), F.sha2(found, 256).alias("sha256"))


def json_leaves(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jv.leaves(_docs(spark, sf_dir), ["doc_id"], "json")


def json_value_pointers(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _docs(spark, sf_dir)
    wanted = docs.selectExpr("doc_id", "inline(array(struct('5' AS value), struct(concat('\"', lang, '\"') AS value), struct('\"none\"' AS value)))")
    return jv.pointers_to(jv.leaves(docs, ["doc_id"], "json"), wanted, ["doc_id"])


def json_objects_in_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _docs(spark, sf_dir, _SPOKEN).select("doc_id", jv.object_in_text(F.col("json")).alias("found"), jv.value_in_text(F.col("json")).alias("first_value"))


def json_usage_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _docs(spark, sf_dir).select("doc_id", jv.summed(F.col("json"), _TOKENS).alias("sums"))


def json_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = F.expr("CASE doc_id % 4 WHEN 0 THEN json WHEN 1 THEN concat('[', json, ', 2, 3, 4]') WHEN 2 THEN cast(doc_id AS string) ELSE 'not json' END")
    return _docs(spark, sf_dir).withColumn("json", kinds).select("doc_id", jv.type_name(F.col("json")).alias("type"), jv.container_summary(F.col("json")).alias("summary"))


def bounded_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrays of numbered strings, cut to 120 bytes where they are longer."""
    rows = table(spark, sf_dir, "orders").selectExpr("o_orderkey", "concat('[\"', array_join(transform(sequence(1, cast(1 + o_orderkey % 12 AS int)), i -> concat('item-000', i + 100)), '\",\"'), '\"]') AS json")
    return rows.select("o_orderkey", jv.bounded(F.col("json"), 120).alias("result"))


def typed_enums(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = """concat('{"type": "object", "properties": {"p": {"title": "t", "enum": ["', p_brand, '", ', p_size, CASE WHEN p_partkey % 2 = 0 THEN ', null' ELSE '' END, ', true, 0.5]}, "q": {"enum": ["a", "b"]}}}')"""
    return table(spark, sf_dir, "part").selectExpr("p_partkey", f"{schema} AS json").select("p_partkey", jv.typed_enums(F.col("json")).alias("schema"))


def stripped_descriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Schemas without their descriptions, which must leave what they mean as it is."""
    schema = """concat('{"description": "', p_name, '", "type": "object", "properties": {"size": {"type": "integer", "description": "d", "maximum": ', p_size, '}}}')"""
    return table(spark, sf_dir, "part").selectExpr("p_partkey", f"{schema} AS json").select("p_partkey", jv.without_keys(F.col("json"), ("description",)).alias("schema"))


QUERIES = {f.__name__: f for f in (json_canonical, json_leaves, json_value_pointers, json_objects_in_text, json_usage_sums, json_summaries, bounded_results, typed_enums, stripped_descriptions)}

_LEAVES = f"""(SELECT doc_id, unnest([
    {{'pointer': '/z/0', 'value': CAST(doc_id % 7 AS VARCHAR)}}, {{'pointer': '/z/1/a~1b', 'value': '"' || source || '"'}}, {{'pointer': '/z/2', 'value': '[]'}},
    {{'pointer': '/lang', 'value': '"' || lang || '"'}}, {{'pointer': '/n/input_tokens', 'value': CAST(n_chars AS VARCHAR)}}, {{'pointer': '/n/deep/0/input_tokens', 'value': '5'}},
    {{'pointer': '/n/deep/0/output_tokens', 'value': CAST(doc_id AS VARCHAR)}}, {{'pointer': '/n/x', 'value': {_X}}}], recursive := true) FROM documents)"""
_SUMMARY = """concat('{{"keys":["lang","n","z"],"longest":', {0}, ',"size":', {1}, ',"type":"', {2}, '"}}')"""
ORACLE_SQL = {
    "json_canonical": f"SELECT doc_id, {_CANONICAL} AS canonical, sha256({_CANONICAL}) AS sha256 FROM documents",
    "json_leaves": f"SELECT doc_id, pointer, value FROM {_LEAVES}",
    "json_value_pointers": f"""SELECT doc_id, value, string_agg(pointer, ',' ORDER BY pointer) AS pointers FROM {_LEAVES} l JOIN documents d USING (doc_id) WHERE value = '5' OR value = '"' || lang || '"' GROUP BY doc_id, value""",
    "json_objects_in_text": f"""SELECT doc_id, CASE doc_id % 6 WHEN 0 THEN {_CANONICAL} WHEN 1 THEN {_CANONICAL} WHEN 2 THEN concat('{{"cut":[1,{{"s":"', lang, '"}}]}}') END AS found,
        CASE doc_id % 6 WHEN 0 THEN '{{"no":1}}' WHEN 1 THEN {_CANONICAL} WHEN 3 THEN concat('[', doc_id, ']') END AS first_value FROM documents""",
    "json_usage_sums": """SELECT doc_id, concat('{"input_tokens":', n_chars + 5, ',"output_tokens":', doc_id, '}') AS sums FROM documents""",
    "json_summaries": f"""SELECT doc_id, ['object', 'array', 'integer', NULL][doc_id % 4 + 1] AS type, CASE doc_id % 4 WHEN 0 THEN {_SUMMARY.format(3, 3, "'object'")} WHEN 1 THEN {_SUMMARY.format(4, 4, "'array'")} WHEN 2 THEN '{{"keys":[],"longest":0,"size":null,"type":"scalar"}}' END AS summary FROM documents""",
    "bounded_results": """
        WITH items AS (SELECT o_orderkey, 1 + o_orderkey % 12 AS n, list_transform(range(1, CAST(2 + o_orderkey % 12 AS BIGINT)), lambda i: '"item-000' || (i + 100) || '"') AS list FROM orders)
        SELECT o_orderkey, CASE WHEN 14 * n + 1 <= 120 THEN '[' || array_to_string(list, ',') || ']'
          ELSE '{"cut_array":[' || array_to_string(list[1:(120 - length('{"cut_array":[],"items":' || n || '}') + 1) // 14], ',') || '],"items":' || n || '}' END AS result FROM items""",
    "typed_enums": """SELECT p_partkey, concat('{"properties":{"p":{"anyOf":[{"enum":["', p_brand, '"],"type":"string"},{"enum":[', p_size, ',0.5],"type":"number"}', CASE WHEN p_partkey % 2 = 0 THEN ',{"enum":[null],"type":"null"}' ELSE '' END, ',{"enum":[true],"type":"boolean"}],"title":"t"},"q":{"enum":["a","b"]}},"type":"object"}') AS schema FROM part""",
    "stripped_descriptions": """SELECT p_partkey, concat('{"properties":{"size":{"maximum":', p_size, ',"type":"integer"}},"type":"object"}') AS schema FROM part""",
}
