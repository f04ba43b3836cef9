"""The live monitor against a plain simulation, over restarts from its checkpoint."""

from __future__ import annotations

import json
import random
from datetime import datetime, timedelta

import pytest

from tracewright.streaming import monitor

START = datetime(2024, 1, 1)
SCHEMA = "b string, r string, t timestamp, l long, k string"


@pytest.fixture
def rocks(spark):
    name, value = monitor.PROVIDER
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    yield
    spark.conf.set(name, before)


def events(seed: int, n: int) -> list[tuple]:
    rng = random.Random(seed)
    return [(rng.choice(["b1", "b2"]), f"r{rng.randrange(6)}", k, rng.choice([None, *range(40)]), rng.choice(["call"] * 6 + ["error", "note"] + ["stop"] * (k % 37 == 0))) for k in range(n)]


def simulated(rows: list[tuple], limits: monitor.Limits) -> set[tuple]:
    calls, errors, seen, stopped, batch, out = {}, {}, set(), set(), {}, set()
    known: dict = {}
    for b, r, k, line, kind in rows:
        run = (b, r)
        known.setdefault(b, set()).add(run)
        if run in stopped:
            continue
        calls[run] = calls.get(run, 0) + (kind == "call")
        if kind == "error" and (run, line) not in seen:
            seen.add((run, line))
            errors[run] = errors.get(run, 0) + 1
            batch[b] = batch.get(b, 0) + 1
        why = "upstream" if kind == "stop" else "calls" if calls[run] > limits.calls else "batch errors" if batch.get(b, 0) >= limits.batch_errors else "errors" if errors.get(run, 0) >= limits.errors else None
        ended = {x for x in known[b] if x not in stopped} if why == "batch errors" else {run} if why else set()
        for x in ended:
            stopped.add(x)
            out.add((*x, k, line, why, calls.get(x, 0), errors.get(x, 0)))
    return out


def fed(spark, folder, check, out, limits) -> None:
    stream = spark.readStream.schema(SCHEMA).json(str(folder))
    query = monitor.live_stops(stream, "b", "r", "t", "l", "k", "1 hour", limits).writeStream.format("parquet").option("checkpointLocation", str(check)).option("path", str(out)).trigger(availableNow=True).start()
    query.awaitTermination(120)
    assert query.exception() is None


def put(folder, name: str, rows: list[tuple]) -> None:
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(json.dumps({"b": b, "r": r, "t": (START + timedelta(seconds=k)).isoformat(), "l": line, "k": kind}) + "\n" for b, r, k, line, kind in rows))


def test_each_stop_is_told_once_over_restarts(spark, tmp_path, rocks):
    limits, rows = monitor.Limits(calls=25, errors=4, batch_errors=9, idle=10**6, keep=10**7), events(5, 260)
    for k in range(0, len(rows), 65):  # a new query for every part, from the same checkpoint
        put(tmp_path / "in", f"{k:04}.json", [*rows[k : k + 65], *([(None, "r1", k, 1, "stop"), ("b1", None, k, 1, "stop")])])
        fed(spark, tmp_path / "in", tmp_path / "check", tmp_path / "out", limits)
    got = [(r.batch, r.run, int((r.at - START).total_seconds()), r.line, r.reason, r.calls, r.errors) for r in spark.read.parquet(str(tmp_path / "out")).collect()]
    want = simulated(rows, limits)
    assert set(got) == want and len(got) == len(want)
    assert {g[4] for g in got} >= {"batch errors", "upstream"}


def test_silent_runs_end_by_a_timer(spark, tmp_path, rocks):
    limits = monitor.Limits(calls=50, errors=5, batch_errors=9, idle=60, keep=5000)
    put(tmp_path / "in", "0.json", [("b", "quiet", 0, 1, "call"), ("b", "busy", 0, 1, "call"), ("b", "done", 1, 1, "stop")])
    put(tmp_path / "in", "1.json", [("b", "busy", 4000, 2, "call")])
    fed(spark, tmp_path / "in", tmp_path / "check", tmp_path / "out", limits)
    put(tmp_path / "in", "2.json", [("b", "busy", 4030, 3, "call"), ("c", "late", 8000, 3, "call")])
    fed(spark, tmp_path / "in", tmp_path / "check", tmp_path / "out", limits)
    got = sorted((r.run, r.reason) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert ("done", "upstream") in got and ("quiet", "idle") in got and [g[0] for g in got].count("quiet") == 1


def test_the_store_is_asked_once_a_run_however_many_events_it_has():
    import pandas as pd

    class Store(dict):
        asked = 0

        def containsKey(self, key):
            self.asked += 1
            return key in self

        def updateValue(self, key, value):
            self[key] = value

    class Total:
        exists, update = staticmethod(lambda: False), staticmethod(lambda value: None)

    class Handle:
        registerTimer = staticmethod(lambda ms: None)

    m = monitor.StopMonitor(monitor.Limits())
    m.handle, m.runs, m.seen, m.totals = Handle(), Store(), Store(), Total()
    rows = pd.DataFrame([(f"r{k % 2}", pd.Timestamp(START) + pd.Timedelta(seconds=k), 1, "note") for k in range(50)], columns=["run", "at", "line", "kind"])
    list(m.handleInputRows(("b",), iter([rows]), None))
    assert m.runs.asked == 2 and len(m.runs) == 2
