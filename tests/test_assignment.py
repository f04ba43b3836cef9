"""Matchings, distinct rows, samples and portfolios against sequential rules."""

from __future__ import annotations

import random

from tests.prose import noted
from tracewright.operators import assignment, selection


def largest(edges: set[tuple]) -> int:
    """The size of a maximum matching, by trying every subset of edges in turn with memo over the lefts."""
    lefts = sorted({a for a, _ in edges})
    best = {frozenset(): 0}
    for a in lefts:
        rights, grown = [b for x, b in edges if x == a], dict(best)
        for used, n in best.items():
            for b in rights:
                if b not in used:
                    grown[used | {b}] = max(grown.get(used | {b}, 0), n + 1)
        best = grown
    return max(best.values())


def test_matchings_are_maximum_where_greed_fails(spark):
    rng = random.Random(4)
    cases = {0: {(0, 0), (0, 1), (1, 0)}, 1: {(a, b) for a in range(4) for b in range(2)}, 2: {(k, k) for k in range(5)} | {(k, k - 1) for k in range(1, 6)}}
    cases |= {k: {(rng.randrange(9), rng.randrange(8)) for _ in range(rng.randrange(3, 22))} for k in range(3, 25)}
    rows = [(k, *e) for k, edges in cases.items() for e in edges] + [(0, 0, 0), (0, None, 1), (0, 1, None), (None, 1, 1)]
    found = assignment.maximum_matching(spark.createDataFrame(rows, "k int, a int, b int"), "k", "a", "b").collect()
    for k, edges in cases.items():
        pairs = [(r.a, r.b) for r in found if r.k == k]
        assert set(pairs) <= edges and len({a for a, _ in pairs}) == len(pairs) == len({b for _, b in pairs})
        assert len(pairs) == largest(edges), k
    assert assignment.maximum_matching(spark.createDataFrame([], "k int, a int, b int"), "k", "a", "b").collect() == []


def test_no_round_of_a_matching_broadcasts(spark, monkeypatch):
    plans, write = [], assignment.written
    monkeypatch.setattr(assignment, "written", lambda df, label: plans.append(df._jdf.queryExecution().executedPlan().toString()) or write(df, label))
    found = assignment.maximum_matching(spark.createDataFrame([(0, 0, 0), (0, 0, 1), (0, 1, 0)], "k int, a int, b int"), "k", "a", "b")
    assert found.count() == 2
    assert any("SortMergeJoin" in p for p in plans) and not any("Broadcast" in p for p in plans)


def test_shortened_names_that_share_a_stem_are_paired(spark):
    base, mark = "tool_" + "x" * 50, "_0a1b2c3d"
    full = [base + c * 20 for c in "abc"]
    alias = [(base + "y" * 9)[: 64 - len(mark)].replace("y", "a") + mark, base + mark]
    fits = base[: 64 - len(mark)]
    rows = [(1, "expected", f) for f in full[:2]] + [(1, "observed", fits + mark), (1, "observed", fits + "-0a1b2c3d"[:9])]
    rows += [(2, "expected", full[0]), (2, "observed", fits + mark), (2, "observed", "other")]
    rows += [(3, "expected", "plain"), (3, "observed", "plain"), (4, "expected", "plain"), (4, "observed", "plane")]
    rows += [(5, "expected", full[0]), (5, "expected", full[1]), (5, "observed", fits + mark), (5, "observed", "z" * 55 + mark)]
    got = {r.c: r.matched for r in selection.shortened_match(spark.createDataFrame(rows, "c int, side string, name string"), "c").collect()}
    assert got == {1: True, 2: False, 3: True, 4: False, 5: False}, alias


def test_distinct_rows_are_those_of_a_sequential_pass(spark):
    rng = random.Random(7)
    rows = [(k, rng.choice([None, *range(60)]), rng.choice([None, *range(50)])) for k in range(400)] + [(1000 + k, 100 + k, 100 + k + 1) for k in range(30)] + [(2000 + k, 200 + k, 200 + k - 1) for k in range(30)]
    chain = [(3000 + k, f"{300 + k // 2}", f"{300 + (k + 1) // 2}") for k in range(40)]  # each row bars the next one
    rows += [(k, int(a), int(b)) for k, a, b in chain]
    taken, want = (set(), set()), []
    for k, a, b in sorted(rows):
        if a not in taken[0] and b not in taken[1]:
            want.append(k)
            taken[0].update({a} - {None})
            taken[1].update({b} - {None})
    df = spark.createDataFrame([(*r, "x") for r in rows], "k int, a int, b int, links string")
    got = assignment.first_distinct(df, ["k"], ["a", "b"])
    assert sorted(r.k for r in got.collect()) == want and got.columns == df.columns
    assert assignment.first_distinct(df.limit(0), ["k"], ["a", "b"]).collect() == []


def test_a_row_that_loses_to_a_skipped_row_is_taken(spark):
    rows = [(0, "u1", "n1"), (1, "u1", "n2"), (2, "u2", "n2")]
    df = spark.createDataFrame(rows, "k int, url string, name string")
    order = sorted(rows, key=lambda r: noted(5, r[0]))
    want, urls, names = [], set(), set()
    for k, u, n in order:
        if u not in urls and n not in names:
            want.append(k)
            urls.add(u)
            names.add(n)
    got = selection.seeded_distinct(df, ["k"], 5, df.limit(0), ["url", "name"], 5)
    assert sorted(r.k for r in got.collect()) == sorted(want)


def test_one_item_a_label_without_reuse(spark):
    rng = random.Random(3)
    labels = ["a", "b", "c", "d"]
    rows = [(g, rng.sample([*labels, "z"], rng.randrange(0, 4)), rng.choice([None, *range(12)]), rng.randrange(50), k) for g in (1, 2, 3, None) for k in range(30)] + [(9, ["a", "b"], 1, 1, 1), (9, ["b"], 1, 0, 2), (10, None, 1, 1, 1)]
    df = spark.createDataFrame(rows, "g int, f array<string>, item int, size int, k int")
    want = set()
    for g in {r[0] for r in rows}:
        used: set = set()
        for label in labels:
            open_ = [r for r in rows if r[0] == g and label in (r[1] or []) and r[2] is not None and r[2] not in used]
            if open_:
                r = min(open_, key=lambda r: (r[3], r[4]))
                used.add(r[2])
                want.add((g, label, r[2], r[3], r[4]))
    got = assignment.one_per_label(df, "g", labels, "f", "item", ["size", "k"]).collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_portfolios_are_those_of_the_sequential_rule(spark):
    rng = random.Random(8)
    forms = ["p", "q", "r", "s"]
    rows = [(g, k, rng.sample(forms, rng.randrange(0, 5)), rng.choice(["x", "y", None]), rng.randrange(3), rng.choice([None, 1.5, 2.5])) for g in (1, 2) for k in range(80)]
    before = [(1, ["p"], "x"), (1, ["p", "q"], None), (3, ["p"], "x")]
    want = []
    for g in (1, 2):
        count: dict = {}

        def up(fs, kind, count=count):
            for name in [*fs, ("set", tuple(sorted(fs))), ("kind", kind)]:
                count[name] = count.get(name, 0) + 1

        for b in before:
            if b[0] == g:
                up(b[1], b[2])
        left = [r for r in rows if r[0] == g]
        for place in range(1, 26):
            key = lambda r: (sum(f not in count for f in r[2]), ("set", tuple(sorted(r[2]))) not in count, ("kind", r[3]) not in count, round(sum(1 / (1 + count.get(f, 0)) for f in r[2]), 9), r[4], r[5] if r[5] is not None else -9.0, -r[1])  # noqa: B023, E731
            best = max(left, key=key)
            left.remove(best)
            want.append((g, best[1], place))
            up(best[2], best[3])
    df = spark.createDataFrame(rows, "g int, k int, f array<string>, kind string, s int, t double")
    got = assignment.novelty_portfolio(df, spark.createDataFrame(before, "g int, f array<string>, kind string"), "g", "k", "f", "kind", ["s", "t"], 25)
    assert sorted(map(tuple, got.collect())) == sorted(want)
