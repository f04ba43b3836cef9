"""Training records assembled from small trajectories, worked out by hand."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from tracewright.operators import assembly

CALL = "struct<id:string,name:string,arguments:struct<p:string>,output:string,is_error:boolean,started:long>"
TRAJECTORIES = f"t string, e string, tools array<string>, task string, prompt string, steps array<struct<text:string,calls:array<{CALL}>>>"
REQUESTS = "t string, line long, messages array<struct<role:string,content:string>>, defined array<string>"


def frames(spark):
    call = lambda i, n, p, out: (i, n, (p,), out, False, 7)
    steps = [("look", [call("c1", "mcp__read", "/home/u1/x", "in /home/u1/x")]), ("", [call("c2", "gone", "y", "/home/u1"), call("c3", "read", "z", None)]), ("done", [])]
    trajectories = [("a", "env", ["read", "write"], "task", "Prompt", steps), ("b", "env", ["read"], "task", "Prompt", steps), ("c", "env", ["write", "read"], "task", "Prompt", steps), ("d", "env", ["read", "write"], "task", "Prompt", [])]
    messages = [("system", "cwd=/home/u1 ok"), ("user", "task"), ("user", "other")]
    requests = [("a", 4, [("system", "late")], ["read"]), ("a", 2, messages, ["read"]), ("b", 1, messages, ["read"]), ("d", 1, [("system", "cwd=/p cwd=/q"), ("user", "Prompt"), ("user", "Prompt")], ["read"]), ("x", 1, messages, ["read"])]
    deliveries = [("env", "v2", ["write", "read"]), ("env", "v1", ["read", "write", "read"]), ("env", "v0", ["other"])]
    return spark.createDataFrame(trajectories, TRAJECTORIES), spark.createDataFrame(requests, REQUESTS), spark.createDataFrame(deliveries, "e string, path string, delivered array<string>")


def built(spark):
    rows = assembly.joined(*frames(spark), "t", "e")
    names = F.create_map(F.lit("mcp__read"), F.lit("read"))
    return rows, assembly.base_records(rows, "t", "steps", "messages", F.col("prompt"), F.col("task"), lambda n: F.when(n == "read", "domain").otherwise("other"), {"started"}, "cwd=([^ ]+)", names)


def test_records_are_cleaned_joined_and_annotated(spark):
    rows, records = built(spark)
    assert {tuple(r) for r in assembly.unassembled(rows, "t").collect()} == {("b", "no delivery with these tools"), ("c", "no request")}
    got = {r.t: r for r in records.collect()}
    assert set(got) == {"a", "d"} and got["a"].path == "v1"
    a = got["a"]
    assert [(m.role, m.content, m.tool_call_id) for m in a.messages] == [("system", "cwd=/workspace ok", None), ("user", "Prompt", None), ("user", "other", None), ("assistant", "look", None), ("tool", "in /workspace/x", "c1"), ("assistant", None, None), ("tool", "/workspace", "c2"), ("tool", None, "c3"), ("assistant", "done", None)]
    assert [(c.name, json.loads(c.arguments)) for m in a.messages for c in m.tool_calls or []] == [("read", {"p": "/workspace/x"}), ("gone", {"p": "y"}), ("read", {"p": "z"})]
    assert {k: (v["name"], v["kind"]) for k, v in a.annotations.items()} == {"c1": ("read", "domain"), "c2": ("gone", "other"), "c3": ("read", "domain")}
    assert a.flags == ["undefined:gone"] and a.issues == ["undefined tool"] and a.one_prompt and a.scrubbed == {"paths": 4, "names": 1}
    d = got["d"]
    assert d.scrubbed == {} and not d.one_prompt and d.issues == ["no assistant"] and d.messages[0].content == "cwd=/p cwd=/q"
    assert len(a.record_sha256) == 64 and a.record_sha256 != d.record_sha256


def test_continuations_hold_their_window_and_its_annotations(spark):
    _, records = built(spark)
    windows = spark.createDataFrame([("a", 0, 0, 1, "so far"), ("a", 1, 1, 2, "more"), ("z", 0, 0, 1, "none")], "t string, window int, first int, n int, summary string")
    got = {r.window: r for r in assembly.continuation_records(records, windows, "t").collect()}
    assert [(m.role, m.content) for m in got[0].messages] == [("user", "so far"), ("assistant", "look"), ("tool", "in /workspace/x")]
    assert set(got[0].annotations) == {"c1"} and set(got[1].annotations) == {"c2", "c3"} and got[1].issues == ["undefined tool"] and got[0].issues == []
    assert len(got) == 2 and got[0].parent_sha256 == got[1].parent_sha256


def test_no_trajectories_give_no_records(spark):
    trajectories, requests, deliveries = frames(spark)
    assert assembly.joined(trajectories.limit(0), requests, deliveries, "t", "e").collect() == []
