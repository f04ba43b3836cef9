"""Sources over written files, and streams against their batch results."""

from __future__ import annotations

import gzip
import hashlib

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tracewright.operators import constraints, records, releases, spans
from tracewright.sources import files, jsonl, streams
from tracewright.streaming import event_logs


def test_lines_keep_physical_numbers(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"id": 1}\n\n{"id": 2}\nbroken\n[3]\n')
    (tmp_path / "b.txt").write_text("not read")
    lines = jsonl.numbered_lines(spark, str(tmp_path))
    assert [(r.line, r.value) for r in lines.orderBy("line").collect()] == [(1, '{"id": 1}'), (2, ""), (3, '{"id": 2}'), (4, "broken"), (5, "[3]")]
    assert [(r.line, r.id) for r in jsonl.lenient_objects(lines, "id int").orderBy("line").collect()] == [(1, 1), (3, 2)]
    with pytest.raises(PySparkException, match="no JSON object"):
        jsonl.strict_objects(lines, "id int").collect()


def test_paired_scans_must_agree(spark, tmp_path):
    frames = {}
    for name, ids in (("l", "ab"), ("r", "ab"), ("x", "ac"), ("s", "a")):
        (tmp_path / f"{name}.jsonl").write_text("".join(f'{{"trajectory_id": "{i}"}}\n' for i in ids))
        frames[name] = jsonl.strict_objects(jsonl.numbered_lines(spark, str(tmp_path / f"{name}.jsonl")), "trajectory_id string")
    assert jsonl.paired(frames["l"], frames["r"], "trajectory_id").count() == 2
    for other in "xs":
        with pytest.raises(PySparkException, match="no pair at line 2"):
            jsonl.paired(frames["l"], frames[other], "trajectory_id").collect()


def test_stream_texts_and_errors(spark):
    body = ['event: delta', 'data: {"choices":[{"delta":{"reasoning_content":"a"}}]}', '', 'data: {"delta":{"text":"x"}}', 'data: {"choices":[{"delta":{"content":"y"}}]}', 'event: error', 'data: {"m":1}', '', 'data: {"n":2}', 'data: [DONE]']
    lines = spark.createDataFrame([("p", k + 1, v) for k, v in enumerate(body)], "path string, line long, value string")
    assert [tuple(r) for r in streams.stream_texts(lines).collect()] == [("p", "a", "xy")]
    assert [tuple(r) for r in streams.stream_errors(lines).collect()] == [("p", 7, '{"m":1}')]


def test_file_manifest(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.json").write_text("{}")
    (tmp_path / "sub/b.bin").write_bytes(gzip.compress(b"x"))
    (tmp_path / "sub/c.pyc").write_bytes(b"")
    got = {r.path.rsplit("/", 1)[1]: (r.bytes, r.sha256, r.format) for r in files.file_manifest(spark, str(tmp_path), r"\.pyc$").collect()}
    assert set(got) == {"a.json", "b.bin"}
    assert got["a.json"] == (2, hashlib.sha256(b"{}").hexdigest(), "json") and got["b.bin"][2] == "gzip"


def test_record_guards(spark):
    parents = spark.createDataFrame([("p1", True), ("p2", None)], "id string, enabled boolean")
    children = spark.createDataFrame([("c1", "p1")], "id string, parent_id string")
    assert records.page(parents, {"enabled": None}, "id", ["id"]).count() == 1
    with pytest.raises(TypeError):
        records.page(parents, {"enabled": 0}, "id", ["id"])
    with pytest.raises(ValueError):
        records.update(children, {}, {"parent_id": "x"}, ["id"])
    with pytest.raises(PySparkException, match="referenced"):
        records.delete(parents, {"id": "p1"}, ["id"], [(children, ["parent_id"])]).collect()
    assert records.delete(parents, {"id": "p2"}, ["id"], [(children, ["parent_id"])]).count() == 1
    with pytest.raises(PySparkException, match="key exists"):
        records.create(parents, parents.limit(1), ["id"]).collect()
    with pytest.raises(PySparkException, match="key exists"):
        records.create(parents, spark.createDataFrame([("p9", True), ("p9", None)], parents.schema), ["id"]).collect()
    with pytest.raises(PySparkException, match="not unique"):
        records.get(parents.unionByName(parents), {"id": "p1"}, ["id"]).collect()


def test_release_guards_and_lint(spark):
    part = spark.createDataFrame([(1, "a")], "id long, t string")
    with pytest.raises(PySparkException, match="duplicate id 1"):
        releases.merged([part, part], "id").collect()
    assert constraints.lint({"a": constraints.Field("text"), "b": constraints.Field("integer", minimum=3, maximum=2)}) == ["a: unknown type text", "b: minimum over maximum"]
    assert constraints.schema_issues(part, {"id": constraints.Field("string"), "x": constraints.Field("string")}) == ["t: undeclared", "x: missing", "id: bigint is no string"]


def test_intervals_merge(spark):
    rows = spark.createDataFrame([(1, 0, 5), (1, 3, 8), (1, 8, 9), (1, 20, 21), (2, 0, 1)], "k int, s int, e int")
    assert sorted(map(tuple, spans.merged_intervals(rows, "k", "s", "e").collect())) == [(1, 0, 9), (1, 20, 21), (2, 0, 1)]


@pytest.fixture
def event_files(spark, sf_dir, tmp_path):
    events = spark.read.parquet(f"{sf_dir}/events.parquet").where("user_id < 20")
    for k in range(3):
        events.where(f"event_id % 3 = {k}").coalesce(1).write.parquet(str(tmp_path / f"in/{k}"))
    return events, str(tmp_path / "in"), str(tmp_path / "state")


def run(spark, stream, name, state, mode="append"):
    query = stream.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", state).trigger(availableNow=True).start()
    query.awaitTermination(120)
    return spark.table(name)


def read(spark, events, folder):
    return spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/*")


def test_stream_of_new_keys_is_the_batch_result(spark, event_files):
    events, folder, state = event_files
    got = run(spark, event_logs.new_keys(read(spark, events, folder), "user_id"), "new_keys", state)
    assert sorted(r.user_id for r in got.collect()) == sorted(r.user_id for r in events.select("user_id").distinct().collect())


def test_stream_budget_counts_across_batches(spark, event_files):
    events, folder, state = event_files
    got = run(spark, event_logs.call_budget(read(spark, events, folder), "user_id", "event_id", 25), "budget", state)
    per_user = {r.user_id: r.n for r in events.groupBy("user_id").agg(F.count("*").alias("n")).collect()}
    rows = got.collect()
    assert len(rows) == sum(per_user.values())
    for user, n in per_user.items():
        own = [r for r in rows if r.user_id == user]
        assert sorted(r.call for r in own) == list(range(1, n + 1))
        assert sum(r.allowed for r in own) == min(n, 25)


def test_stream_breaker_counts_distinct_errors(spark, event_files):
    events, folder, state = event_files
    stream = read(spark, events, folder).where("event_type = 'error'").withColumns({"line": F.expr("event_id % 13"), "batch": F.lit("all")})
    got = run(spark, event_logs.distinct_errors(stream, "user_id", "line", "batch", 5), "breaker", state, "complete").first()
    want = events.where("event_type = 'error'").selectExpr("user_id", "event_id % 13 AS line").distinct().count()
    assert (got.n_errors, got.open) == (want, want >= 5)


def test_windowed_counts_equal_the_batch(spark, event_files):
    events, folder, state = event_files
    got = run(spark, event_logs.windowed_counts(read(spark, events, folder), "ts", ["event_type"], "1 day", "400 days"), "windows", state, "update")
    newest = got.groupBy("window", "event_type").agg(F.max("n").alias("n"))
    want = events.groupBy(F.window(F.col("ts").cast("timestamp"), "1 day"), "event_type").agg(F.count("*").alias("n"))
    assert sorted(map(str, newest.collect())) == sorted(map(str, want.collect()))


def test_stream_of_calls_counts_each_once(spark, event_files):
    events, folder, state = event_files
    named = read(spark, events, folder).selectExpr("user_id", "event_id % 9 AS call", "CASE WHEN event_id % 3 = 0 THEN 'native_x' WHEN event_id % 3 = 1 THEN 'env_y' ELSE 'z' END AS name", "ts")
    got = run(spark, event_logs.call_counts(named, "user_id", "call", "name", "ts", "400 days"), "calls", state, "complete")
    want = {}
    for r in events.selectExpr("user_id", "event_id % 9 AS call").distinct().collect():
        want.setdefault(r.user_id, [0, 0, 0])[r.call % 3] += 1
    assert {r.user_id: [r.native, r.environment, r.other] for r in got.collect()} == want
