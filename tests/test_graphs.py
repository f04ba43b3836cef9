"""Walks over tool graphs."""

from __future__ import annotations

from collections import Counter

from tracewright.operators import graphs


def edges_of(spark, pairs):
    return spark.createDataFrame(pairs, "from_tool string, to_tool string, weight long")


def test_walks_have_many_lengths_start_at_roots_and_are_distinct(spark):
    names = [f"t{k:02d}" for k in range(9)]
    pairs = [(a, b, 1 + (i + j) % 2) for i, a in enumerate(names) for j, b in enumerate(names) if a != b] + [("t00", "end", 3), ("end", "t01", 1)]
    rows = graphs.sampled_walks(spark, edges_of(spark, pairs), 600, 7, 3, 12).collect()
    lengths = Counter(len(r.chain) for r in rows)
    assert set(lengths) == set(range(3, 13))
    assert len({tuple(r.chain) for r in rows}) == len(rows)
    assert {r.chain[0] for r in rows} <= set(names)
    longer = {r.walk for r in graphs.sampled_walks(spark, edges_of(spark, pairs), 600, 7, 3, 100).collect()}
    assert {r.walk for r in rows} < longer  # walks above the limit are left out, not cut
    assert max(Counter(t for t in r.chain).most_common(1)[0][1] for r in rows) == 2


def test_walks_stop_by_the_number_of_open_tools(spark):
    pairs = [("a", "b", 1), ("b", "c", 1), ("c", "d", 1)] + [("c", f"x{k}", 1) for k in range(9)]
    rows = graphs.sampled_walks(spark, edges_of(spark, pairs).where("from_tool <> 'none'"), 3000, 1, 3, 9, tau=5.0, max_visits=1).collect()
    assert {len(r.chain) for r in rows} == {3, 4}
    assert len([r for r in rows if len(r.chain) == 4 and r.chain[0] == "a"]) == 10  # each open tool is reached


def test_walks_wait_for_prerequisites(spark):
    pairs = [("a", "b", 3), ("b", "a", 3), ("a", "c", 3), ("b", "c", 3), ("c", "a", 1), ("c", "b", 1)]
    needs = spark.createDataFrame([("c", [["a", "b"]]), ("b", [["a"]])], "tool string, any_of array<array<string>>")
    rows = graphs.sampled_walks(spark, edges_of(spark, pairs), 300, 3, 2, 9, prerequisites=needs).collect()
    assert rows and {r.chain[0] for r in rows} == {"a"}
    assert any("c" in r.chain for r in rows)
    assert all({"a", "b"} <= set(r.chain[: r.chain.index("c")]) for r in rows if "c" in r.chain)


def greedy(rows, count, penalty):
    """As the reference selects: over all chains, with ties by score, length and chain."""
    left, worst, out = {k: (c, s) for k, c, s in rows}, {k: 0.0 for k, _, _ in rows}, []
    while left and len(out) < count:
        best = max(left, key=lambda k: (left[k][1] - penalty * worst[k], left[k][1], len(left[k][0]), left[k][0]))
        out.append((best, len(out) + 1, left[best][1] - penalty * worst[best]))
        members = set(left.pop(best)[0])
        for k, (c, _) in left.items():
            worst[k] = max(worst[k], len(members & set(c)) / min(len(members), len(set(c))))
    return out


def test_selection_reaches_chains_below_the_best_two_thousand(spark):
    rows = [(k, ["a", "b", f"c{k}"], 3.0 - k / 10_000) for k in range(2100)] + [(5000, ["x", "y", "z", "x"], 1.0), (5001, ["x", "w"], 1.0), (5002, ["a", "q", "r"], 0.5)]
    df = spark.createDataFrame(rows, "walk long, chain array<string>, eligibility double")
    got = [tuple(r) for r in graphs.diverse_selection(df, "walk", "eligibility", 8, 10.0).orderBy("turn").collect()]
    want = greedy(rows, 8, 10.0)
    assert [g[:2] for g in got] == [w[:2] for w in want] and got[1][0] == 5000
    assert all(abs(g[2] - w[2]) < 1e-9 for g, w in zip(got, want, strict=True))
    assert len(graphs.diverse_selection(df.limit(3), "walk", "eligibility", 8, 10.0).collect()) == 3
