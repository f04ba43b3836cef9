"""Seeds and themes from entries, migrated seeds, sets of seeds."""

import json

import pytest
from pyspark.sql import functions as F

from tracewright.operators import seeds


def _rows(spark, values):
    df = spark.createDataFrame([(k, None if v is None else json.dumps(v)) for k, v in enumerate(values)], "k int, text string")
    return df.select("k", F.parse_json("text").alias("v"), (F.col("k") + 1).alias("at"))


def _tool(name, **more):
    return {"name": name, "description": f"does {name}", **more}


def test_entries(spark):
    schema = {"properties": {"a": {"type": "string"}}}
    entries = [
        {"qualifiedName": " @x/Some-Name ", "description": "d", "useCount": 3, "iconUrl": "i", "isLive": True, "tools": [_tool("b", useCount=1, inputSchema=schema), _tool("c", useCount=5, outputSchema={"properties": 3}), _tool("a", useCount=1), _tool("", useCount=9), {"name": "z", "description": 7}, "t"]},
        {"qualifiedName": "n", "description": "d", "tools": [_tool("b", useCount=1), _tool("c", useCount=True), _tool("a", use_count=2)], "aB": 1, "a_b": 2},
        {"qualifiedName": "n", "description": " "},
        {"qualifiedName": "///", "description": "d"},
        None,
        {"qualifiedName": "n", "description": "d", "tools": {}},
    ]
    got = {r.k: r for r in seeds.seeds_of_entries(_rows(spark, entries), "k", "v", "at", "cat", "https://site/", 2).withColumns({"tools": F.to_json("tools"), "metadata": F.to_json("metadata")}).collect()}
    assert [got[k].reason for k in range(6)] == [None, None, "no name or description", "no id from the name", "no document", None]
    first = got[0]
    assert (first.global_id, first.url, first["index"], first.received, first.invalid, first.removed, first.rule) == ("cat_x_some_name_1", ["https://site/@x/Some-Name"], 1, 6, 3, 1, "useCount")
    tools = json.loads(first.tools)
    assert [t["name"] for t in tools] == ["c", "b"] and tools[1]["input"] == {"a": {"type": "string"}} and tools[0]["output"] == {} == tools[0]["input"]
    assert json.loads(first.metadata) == {"use_count": 3, "is_live": True}
    assert (got[1].rule, [t["name"] for t in json.loads(got[1].tools)], json.loads(got[1].metadata)) == ("source_order", ["b", "c"], {"a_b": 2})
    assert (got[5].rule, got[5].tools, got[5].received) == ("all", "[]", 0) and got[2].global_id is None
    assert seeds.seeds_of_entries(_rows(spark, [None]).limit(0), "k", "v", "at", "cat", "s", 2).collect() == []


def test_themes(spark):
    entries = [{"qualifiedName": "n", "displayName": "", "tools": [{"name": "a"}, {"x": 1}], "toolNames": ["q"], "homepage": "", "verified": False, "repository": None, "dataDirections": ["in", "", None]}, {"qualifiedName": "m", "displayName": "M", "toolNames": ["q", "r"]}, {"displayName": "M"}, None]
    got = {r.k: r for r in seeds.themes_of_entries(_rows(spark, entries), "k", "v", "https://site/").withColumn("metadata", F.to_json("metadata")).collect()}
    assert {k: (r.label, r.url, r.operations, r.directions, json.loads(r.metadata)) for k, r in got.items()} == {
        0: ("n", "https://site/n", ["a"], ["in"], {"qualifiedName": "n", "verified": False}),
        1: ("M", "https://site/m", ["q", "r"], [], {"qualifiedName": "m"}),
    }


def test_migration(spark):
    old = {"schema_version": "1.0", "environment": {"basic_info": {"url": "u"}}, "init_ref_tools": [_tool("a", inputSchema={"properties": {"p": {}}}, tag=1), {"name": "b", "type": "class", "description": "x", "input": {"q": {}}, "output": {}, "module": "m"}, 3], "others": {"tool_count": 2, "note": "n"}}
    got = seeds.migrated_seeds(_rows(spark, [old, {"environment": {"basic_info": {"url": ["u", "v"]}}}, None]), "k", "v").withColumns({"tools": F.to_json("tools"), "others": F.to_json("others")}).orderBy("k").collect()
    assert [(r.url, r.n_tools, json.loads(r.others)) for r in got] == [(["u"], 2, {"note": "n"}), (["u", "v"], 0, {})]
    a, b = json.loads(got[0].tools)
    assert (a["type"], a["input"], a["output"], a["rest"]) == ("function", {"p": {}}, {}, {"tag": 1}) and (b["type"], b["input"], b["rest"]) == ("class", {"q": {}}, {"module": "m"})


def test_sets_of_seeds(spark):
    rows = [(1, "s_a_1", "A", 1, [("x",), ("x",), ("y",)], 3), (2, "s_a_1", "a", 1, [("x",)], 1), (3, "s_b_2", "b!", 2, None, 0), (4, None, "c", None, [], 4)]
    df = spark.createDataFrame(rows, "k int, global_id string, name string, index int, tools array<struct<name:string>>, n_tools int")
    got = sorted((r.k, r.issue, r.detail) for r in seeds.seed_set_issues(df, "k", "s").collect())
    assert got == [(1, "repeated tools", "x"), (1, "shared global_id", "s_a_1"), (1, "shared index", "1"), (2, "shared global_id", "s_a_1"), (2, "shared index", "1"), (4, "id does not follow", "s_c"), (4, "wrong count", "4")]
    assert [r.k for r in seeds.selected_seed(df, "s_b_2").collect()] == [3]
    for name, n in (("s_a_1", 2), ("none", 0)):
        with pytest.raises(Exception, match=f"{n} seeds of the id"):
            seeds.selected_seed(df, name).collect()
