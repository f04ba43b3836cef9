"""Views of graphs and tasks: what bars them, and what they show."""

from tracewright.operators import views

BUNDLE = f"k int, tools array<string>, edges {views.EDGES}, prerequisites {views.PREREQUISITES}, tasks {views.TASKS}"


def _task(name, chain, passed=None, **run):
    return {"task_id": name, "chain": chain, "score": 1.0, "validation": None if passed is None else {"passed": passed, "errors": [] if passed else ["e"]}, "execution": {"success": run.get("success"), "calls": run.get("calls"), "attempts": run.get("attempts")}}


def test_views(spark):
    sound = [{"from_tool": "a", "to_tool": "b", "weight": 1, "reason": None}, {"from_tool": "b", "to_tool": "a", "weight": 3, "reason": "r"}]
    tasks = [_task("t", ["a", "b"], True, success=True, calls=["a", "b"]), _task("u", ["a", "b"], False, success=False, calls=["a"], attempts=[{"failed_tool": "a", "failure_kind": "x"}, {"failed_tool": "z", "failure_kind": "y"}]), _task("v", ["a", "b"], None, success=False, attempts=[{"failed_tool": "b", "failure_kind": "x"}]), _task("w", [], False)]
    bad_edges = [*sound, {"from_tool": "a", "to_tool": "b", "weight": 4, "reason": ""}, {"from_tool": None, "to_tool": "b", "weight": None, "reason": ""}]
    needs = [{"to_tool": "b", "any_of": [{"all_of": ["a"], "reason": "r"}, {"all_of": ["a", "a"], "reason": "r"}, {"all_of": ["a"], "reason": " "}, {"all_of": ["q"], "reason": "r"}]}, {"to_tool": "q", "any_of": []}]
    bad_tasks = [_task("", ["a"], True), _task("x", None, True), _task("y", [], True), {**_task("z", ["a"]), "validation": {"passed": None, "errors": []}}, _task("p", ["a", None])]
    df = spark.createDataFrame([(1, ["a", "b"], sound, needs[:1] and [{**needs[0], "any_of": needs[0]["any_of"][:1]}], tasks), (2, ["a", "b"], bad_edges, needs, bad_tasks), (3, None, None, None, None)], BUNDLE)
    got = sorted((r.k, r.code, r.path, r.detail) for r in views.view_issues(df, "k").collect())
    assert got == sorted([
        (2, "invalid_weight", "/edges/2", "4"), (2, "repeated_edge", "/edges/2", "a>b"), (2, "unknown_tool", "/edges/3", "b"), (2, "invalid_weight", "/edges/3", ""),
        (2, "invalid_alternative", "/prerequisites/0/any_of/1", "a,a"), (2, "invalid_alternative", "/prerequisites/0/any_of/2", "a"), (2, "invalid_alternative", "/prerequisites/0/any_of/3", "q"), (2, "invalid_prerequisite", "/prerequisites/1", "q"),
        (2, "no_task_id", "/tasks/0", ""), (2, "invalid_chain", "/tasks/1", "x"), (2, "empty_chain", "/tasks/1", "x"), (2, "empty_chain", "/tasks/2", "y"), (2, "invalid_verdict", "/tasks/3", "z"), (2, "invalid_chain", "/tasks/4", "p"),
    ])
    packed = {r.k: r for r in views.packed_views(df, "k").collect()}
    assert packed.keys() == {1, 3}
    assert packed[1].counts.asDict() == {"tools": 2, "edges": 2, "tasks": 4, "passed": 1, "rejected": 2, "pending": 1} and packed[3].counts.tasks == 0
    assert [(t.task_id, t.passed, t.attempts, t.failed_tool, t.failure_kind, t.errors) for t in packed[1].tasks] == [("t", True, 0, None, None, []), ("u", False, 2, "b", "y", ["e"]), ("v", None, 1, "b", "x", []), ("w", False, 0, None, None, ["e"])]
    assert [(e.id, e.source, e.target, e.weight, e.reason) for e in packed[1].edges] == [("base-0", "a", "b", 1, ""), ("base-1", "b", "a", 3, "r")]
