"""Trees in variants, coverage of requirements, counters, and fuzzy names, against plain rules."""

from __future__ import annotations

import json
import random
from collections import Counter
from difflib import SequenceMatcher

from pyspark.sql import functions as F

from tests import prose as fx
from tracewright.operators import coverage, fuzzy, trees

DOCS = ['{"a": {"b": [1, {"c/d": null, "e~": "x"}], "": {}}, "z": []}', "[[1], 2]", "7", "null", None, '"s"', "{}"]


def test_tree_walks_reach_every_node(spark):
    df = spark.createDataFrame(list(enumerate(DOCS)), "k int, t string").select("k", F.try_parse_json("t").alias("v"))
    got = {(r.k, r.pointer, r.depth, r.kind, r.value) for r in trees.tree_nodes(df, "k", "v").collect()}
    assert got == {
        (0, "", 0, "object", None), (0, "/a", 1, "object", None), (0, "/a/b", 2, "array", None), (0, "/a/b/0", 3, "scalar", "1"), (0, "/a/b/1", 3, "object", None), (0, "/a/b/1/c~1d", 4, "scalar", "null"),
        (0, "/a/b/1/e~0", 4, "scalar", '"x"'), (0, "/a/", 2, "object", None), (0, "/z", 1, "array", None), (1, "", 0, "array", None), (1, "/0", 1, "array", None), (1, "/0/0", 2, "scalar", "1"), (1, "/1", 1, "scalar", "2"),
        (2, "", 0, "scalar", "7"), (3, "", 0, "scalar", "null"), (5, "", 0, "scalar", '"s"'), (6, "", 0, "object", None),
    }


def test_schema_walks_follow_schemas_alone(spark):
    schema = {"type": "object", "properties": {"a": {"type": "array", "items": {"type": "string", "enum": [{"type": "no"}]}}, "b/c": {"oneOf": [{"type": "null"}, True, {"not": {"const": {"properties": {"x": {}}}}}]}}, "additionalProperties": False, "$defs": {"d": {"if": {"type": "integer"}, "dependentSchemas": {"q": {"allOf": []}}}}, "required": ["a"]}
    df = spark.createDataFrame([(1, json.dumps(schema)), (2, "[]"), (3, None)], "k int, t string").select("k", F.try_parse_json("t").alias("v"))
    got = {(r.pointer, r.type) for r in trees.schema_nodes(df, "k", "v").collect()}
    assert got == {("", "object"), ("/properties/a", "array"), ("/properties/a/items", "string"), ("/properties/b~1c", None), ("/properties/b~1c/oneOf/0", "null"), ("/properties/b~1c/oneOf/2", None), ("/properties/b~1c/oneOf/2/not", None), ("/$defs/d", None), ("/$defs/d/if", "integer"), ("/$defs/d/dependentSchemas/q", None)}


def test_flat_paths_stop_at_their_depth(spark):
    deep = {"properties": {"a": {"properties": {"b": {"properties": {"c": {"properties": {"d": {"properties": {"e": {}}}}}}}}}}}
    listed = {"properties": {"items": {"type": "array", "items": {"properties": {"run_id": {}, "tags": {"type": "array", "items": {"type": "string"}}}}}, "count": {"type": "integer"}}}
    cases = [(deep, ["a.b.c.d"]), (listed, ["count", "items[].run_id", "items[].tags"]), ({"type": "array", "items": {"type": "string"}}, ["[]"]), ({"type": "string"}, []), ([], []), ({"properties": {"x": True}}, ["x"]), ({"type": "array", "items": True, "properties": {"p": {}}}, ["p"])]
    wrapped = {"oneOf": [{"properties": {"success": {"const": False}, "data": {}}}, {"properties": {"success": {"const": True}, "data": listed}}]}
    df = spark.createDataFrame([(k, json.dumps(s)) for k, (s, _) in enumerate(cases)] + [(99, json.dumps(wrapped))], "k int, t string").withColumn("v", F.parse_json("t"))
    got = {r.k: (r.p, r.q) for r in df.select("k", trees.flat_paths(F.col("v")).alias("p"), trees.flat_paths(trees.success_data(F.col("v"))).alias("q")).collect()}
    assert [got[k][0] for k in range(len(cases))] == [want for _, want in cases]
    assert got[99][1] == cases[1][1] and got[0][1] == []


def test_division_gaps_and_bounded_reports(spark):
    need = spark.createDataFrame([("a", 1), ("a", 2), ("a", 2), ("b", 1), (None, 3), ("c", None)], "g string, i int")
    have = spark.createDataFrame([("a", 1), ("b", 1), ("b", 9), (None, 3), ("d", 1)], "g string, i int")
    assert {tuple(r) for r in coverage.uncovered(need, have, "g", "i").collect()} == {("a", 2), ("c", None)}
    assert {tuple(r) for r in coverage.divided(need, have, "g", "i").collect()} == {("a", 2, 1, False), ("b", 1, 0, True), (None, 1, 0, True), ("c", 1, 1, False)}
    low = coverage.below_floor(need.withColumn("f", F.lit(2)), ["g"], F.col("i") > 0, F.col("f"))
    assert {tuple(r) for r in low.collect()} == {("b", 1, 2), (None, 1, 2), ("c", 0, 2)}
    many = spark.range(100).selectExpr("concat('s', lpad(id, 3, '0')) AS s")
    got = [tuple(r) for r in coverage.readiness({"late": many.where("s < 's003'"), "none": many.limit(0), "gap": many}, "s", 5).orderBy("place").collect()]
    assert got == [(1, "late", "s000"), (2, "late", "s001"), (3, "late", "s002"), (4, "gap", "s000"), (5, "gap", "s001")]
    assert coverage.readiness({"none": many.limit(0)}, "s").collect() == []


def test_counters_with_open_names_are_summed(spark):
    rng = random.Random(1)
    rows = [(rng.choice(["x", None]), {f"n{rng.randrange(5)}": rng.randrange(9) for _ in range(rng.randrange(4))}) for _ in range(60)] + [("x", None), ("y", {})]
    want: Counter = Counter()
    for g, m in rows:
        for name, n in (m or {}).items():
            want[g, name] += n
    df = spark.createDataFrame(rows, "g string, m map<string,long>")
    assert {(r.g, r.name): r.total for r in coverage.counter_totals(df, ["g"], "m").collect()} == dict(want)
    assert {(r.g, k): v for r in coverage.counter_maps(df, ["g"], "m").collect() for k, v in r.totals.items()} == dict(want)
    texts = spark.createDataFrame([("a1 b22 <x>",), (None,), ("",)], "t string").select(coverage.replacement_counts(F.col("t"), {"digits": "[0-9]+", "marks": "[<>]", "none": "Q"}).alias("m"))
    assert [r.m for r in texts.collect()] == [{"digits": 2, "marks": 2}, {}, {}]


def test_similar_names_are_those_of_all_pairs_with_few_candidates(spark):
    rng = random.Random(11)
    names = set()
    for _ in range(60):
        name = fx.prose(rng, rng.randrange(1, 5)).lower()
        names |= {name, name[: rng.randrange(1, 9)]}
        for _ in range(3):
            cut = list(name)
            for _ in range(rng.randrange(1, 4)):
                cut[rng.randrange(len(cut))] = rng.choice(["", "x", "yy", "🙂"])
            names.add("".join(cut))
        names.add(name[3:] + name[:3])
    names |= {"a", "b", "ab", "aab", "x" * 230, "x" * 228 + "yz"}
    listed = sorted(n for n in names if n)
    same = lambda a, b: max(SequenceMatcher(None, a, b).ratio(), SequenceMatcher(None, b, a).ratio())
    want = {(a, b): same(a, b) for i, a in enumerate(listed) for b in listed[i + 1 :] if same(a, b) >= 0.9}
    df = spark.createDataFrame([(n,) for n in [*listed, *listed[:20], None, ""]], "name string")
    assert {(r.a, r.b): r.ratio for r in fuzzy.similar_names(df, "name").collect()} == want and len(want) > 60
    met = fuzzy.candidates(df, "name").count()
    assert met < 0.2 * len(listed) * (len(listed) - 1) / 2
    assert df.limit(1).select(fuzzy.normal_name(F.lit("The Official Foo-Bar MCP Server 2")).alias("n")).first().n == "the foo bar 2"
