"""Tiered choices against a loop, first examples, dialogue shards, profiles on odd rows."""

import json
import random

import pytest
from pyspark.sql import functions as F

from tracewright.operators import profiles, tiers
from tracewright.sources import dialogues

CHAINS = "g string, k int, chain array<string>, tier int, score double"


def _looped(rows, count, penalty):
    """The rule told row by row: (g, place) to (k, value)."""
    pairs = lambda c: set(zip(c, c[1:], strict=False))
    out = {}
    for g in {r[0] for r in rows}:
        chosen, rest = [], [r for r in rows if r[0] == g]
        top = {t: max(r[4] for r in rest if r[3] == t) or 1.0 for t in {r[3] for r in rest}}

        def value(r):
            alike = [len(pairs(r[2]) & pairs(c[2])) / min(len(pairs(r[2])), len(pairs(c[2]))) if pairs(r[2]) and pairs(c[2]) else 0.0 for c in chosen]
            return r[4] / top[r[3]] - penalty * max(alike, default=0.0)

        while rest and len(chosen) < count:
            tier = max(r[3] for r in rest)
            best = max((r for r in rest if r[3] == tier), key=lambda r: (value(r), r[4], len(r[2]), r[2], -r[1]))
            out[g, len(chosen) + 1] = (best[1], value(best))
            chosen.append(best)
            rest.remove(best)
    return out


@pytest.mark.parametrize(("count", "penalty"), [(3, 0.4), (6, 1.5)])
def test_tiers_choose_as_a_loop_does(spark, count, penalty):
    rng = random.Random(count)
    rows = [(rng.choice("ab"), k, [rng.choice("xyz") for _ in range(rng.randint(0, 5))], rng.choice((1, 1, 2, 3)) if k % 20 else 4, float(rng.choice((0, 5, 8, 9, 9, 10)))) for k in range(60)]
    rows += [("a", 100 + k, r[2], r[3], r[4]) for k, r in enumerate(rows[:15]) if r[0] == "a"]  # the same again
    df = spark.createDataFrame([*rows, (None, 1, [], 9, 1.0), ("a", 2, None, 9, 1.0), ("a", 3, [], 9, None)], CHAINS)
    got = {(r.g, r.place): (r.k, r.value) for r in tiers.tiered_selection(df, "g", "k", "chain", "tier", "score", count, penalty).collect()}
    want = _looped(rows, count, penalty)
    assert got.keys() == want.keys()
    for at, (k, value) in want.items():
        assert got[at][0] == k and got[at][1] == pytest.approx(value)


def test_tiers_of_nothing_and_bad_penalties(spark):
    none = spark.createDataFrame([], CHAINS)
    assert tiers.tiered_selection(none, "g", "k", "chain", "tier", "score", 2, 0.5).collect() == []
    zero = spark.createDataFrame([("a", 1, ["x"], 1, 0.0), ("a", 2, ["x", "y"], 1, 0.0)], CHAINS)
    assert [(r.k, r.value) for r in tiers.tiered_selection(zero, "g", "k", "chain", "tier", "score", 5, 0.5).orderBy("place").collect()] == [(2, 0.0), (1, 0.0)]
    with pytest.raises(ValueError):
        tiers.tiered_selection(none, "g", "k", "chain", "tier", "score", 2, -1.0)


def test_first_of_each_passes_over_keys_taken(spark):
    rows = spark.createDataFrame([("a", 1, 5), ("b", 2, 5), ("a", 3, 7), ("c", 4, None), ("d", 5, 1), (None, 0, 5)], "k string, o int, x int")
    wanted = [F.col("x") == 5, F.col("x") >= 5, F.col("x") == 7]
    got = [(r.k, r.o, r.place, r.wanted) for r in tiers.first_of_each(rows, "k", "o", wanted, 3).orderBy("place").collect()]
    assert got == [("a", 1, 1, 0), ("b", 2, 2, 1), ("c", 4, 3, None)]  # the only key with a 7 is taken
    assert tiers.first_of_each(rows, "k", "o", wanted, 1).count() == 1
    assert tiers.first_of_each(rows.limit(0), "k", "o", wanted, 3).collect() == []


def test_dialogue_shards(spark, tmp_path):
    frame = {"service": "Hotels_1", "state": {"active_intent": "Find", "requested_slots": ["price", "area"]}, "service_call": {"method": "Find", "parameters": {"n": 1}}, "service_results": [{"a": "b"}], "actions": [{"act": "NOTIFY_SUCCESS", "slot": ""}]}
    one = {"dialogue_id": "1", "services": ["Hotels_1"], "turns": [{"speaker": "USER", "utterance": "hi", "frames": [{"service": "Hotels_1", "state": {"active_intent": "NONE"}}]}, {"speaker": "SYSTEM", "utterance": "yes", "frames": [frame, {**frame, "service": "", "service_results": []}]}]}
    for split, name, value in (("dev", "dialogues_001.json", [{"dialogue_id": "0"}, one]), ("train", "dialogues_001.json", []), ("train", "schema.json", {"x": 1})):
        (tmp_path / split).mkdir(exist_ok=True)
        (tmp_path / split / name).write_text(json.dumps(value))
    rows = dialogues.read_dialogues(spark, str(tmp_path))
    tasks = {r.dialogue_id: r for r in dialogues.dialogue_tasks(rows).collect()}
    assert {k: (r.split, r.place, r.n_turns, r.n_user_turns, r.verifiable, r.successes) for k, r in tasks.items()} == {"0": ("dev", 0, 0, 0, False, 0), "1": ("dev", 1, 2, 1, False, 2)}
    assert tasks["1"].intents == ["Find"] and tasks["1"].requested_slots == ["area", "price"] and tasks["1"].utterances == ["hi"]
    assert [(c.method, c.parameters, c.results) for c in tasks["1"].calls] == [("Find", {"n": "1"}, 1), ("Find", {"n": "1"}, 0)]
    assert [(r.service, r.intent, r.dialogues) for r in dialogues.intent_dialogues(dialogues.dialogue_tasks(rows)).collect()] == [("Hotels_1", "Find", 1)]
    assert sorted((r.turn, r.frame_no, r.speaker) for r in dialogues.frame_rows(rows, ["dialogue_id"]).collect()) == [(0, 0, "USER"), (1, 0, "SYSTEM"), (1, 1, "SYSTEM")]
    summary = dialogues.corpus_summary(dialogues.dialogue_tasks(rows)).first()
    assert (summary.dialogues, summary.turns, summary.calls, summary.calls_with_results, summary.result_rate, summary.verifiable_rate) == (2, 2, 2, 1, 0.5, 0.0)
    (tmp_path / "train" / "dialogues_002.json").write_text("{}")
    with pytest.raises(Exception, match="not a list of dialogues"):
        dialogues.read_dialogues(spark, str(tmp_path)).collect()


def test_profiles_of_odd_cards(spark):
    universe = spark.createDataFrame([("tool", "a", ["seed", "seed"]), ("tool", "b", ["seed", "scenario"]), ("task", "c", []), ("task", "d", ["seed"])], "subject_type string, subject_name string, origins array<string>")
    cards = spark.createDataFrame([("tool", "a", "partial", "record", "p1", "x"), ("tool", "a", "partial", "record", "p2", "y"), ("tool", "a", "missing", "record", "p3", "z"), ("tool", "b", "supported", "semantic_evidence", "p1", "x"), ("task", "d", "great", None, "p1", "x"), (None, "a", "supported", "record", "p9", "x")], "subject_type string, subject_name string, status string, role string, path string, reason string")
    free = spark.createDataFrame([("task", "c", None)], "subject_type string, subject_name string, reason string")
    coverage = profiles.subject_coverage(universe, cards, free)
    assert {r.subject_name: (r.status, r.basis, r.path, r.reason) for r in coverage.collect()} == {"a": ("partial", "record", "p2", "y"), "b": ("missing", "none", None, None), "c": ("not_required", "none", None, ""), "d": ("missing", "none", "p1", "x")}
    assert {(r.origin, r.subject_type): (r.supported, r.total, r.listed, r.percent) for r in profiles.measures(coverage).collect()} == {("seed", "tool"): (0, 2, 2, 0.0), ("scenario", "tool"): (0, 1, 1, 0.0), ("seed", "task"): (0, 1, 1, 0.0), ("seed", None): (0, 3, 3, 0.0), ("scenario", None): (0, 1, 1, 0.0)}
    works = profiles.work_status(spark.createDataFrame([(" w ",), ("",), (None,), ("v",)], "task_name string"), spark.createDataFrame([("w", "partial", "r"), ("w", "supported", "s"), ("u", "partial", "t")], "task_name string, status string, reason string"))
    assert {(r.task_name, r.status, r.reason) for r in works.collect()} == {("w", "supported", "s"), ("v", "missing", None)}
    assert {(r.subject_name, r.status) for r in profiles.gaps(coverage, works).collect()} == {("a", "partial"), ("b", "missing"), ("d", "missing"), ("v", "missing")}
    none = profiles.work_measure(works.limit(0)).first()
    assert (none.total, none.percent) == (0, 0.0)
