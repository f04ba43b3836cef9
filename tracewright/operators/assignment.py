"""Choices where one pick bars others: maximum matchings, first distinct rows, one pick a label, portfolios by novelty.

All run in rounds over DataFrames, or after a bounded cut per group, so a step of the sequential rule is never a loop over
rows. Tables that rounds read again are written to the shared folder. Null keys bar nothing and match nothing; ties are
broken by the columns named; empty tables give empty results; repeated edges count once.
"""

from __future__ import annotations

from fractions import Fraction

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracewright.session import written


def maximum_matching(edges: DataFrame, case: str, left: str, right: str) -> DataFrame:
    """(case, left, right): as many pairs along edges as there can be, each left and right at most once a case.

    Phases of breadth-first search from all free lefts at once: a level takes every right that no level has, with the
    least (root, left) that leads to it, and goes on along matched pairs. The first level with free rights ends the
    search; each root takes one of them, and as the ways of different roots share no node, all are turned over
    together. A phase that finds none proves the matching a maximum. Work is in joins on (case, node), merged and never
    broadcast, since each broadcast passes the driver and there are some a round; the rounds are phases times the length
    of the longest way taken.
    """
    names = [case, left, right]
    edges = written(edges.select(F.col(case).alias("case"), F.col(left).alias("l"), F.col(right).alias("r")).dropna().distinct(), "matching-edges")
    pairs = edges.groupBy("case", "l").agg(F.min("r").alias("r")).groupBy("case", "r").agg(F.min("l").alias("l")).select("case", "l", "r")
    pairs = written(pairs, "matching")
    while True:
        frontier = edges.select("case", "l").distinct().join(pairs.select("case", "l").hint("merge"), ["case", "l"], "left_anti").withColumn("root", F.col("l"))
        levels, ends = [], None
        while ends is None:
            reached = frontier.join(edges.hint("merge"), ["case", "l"])
            for seen in levels:
                reached = reached.join(seen.select("case", "r").hint("merge"), ["case", "r"], "left_anti")
            reached = reached.groupBy("case", "r").agg(F.min(F.struct("root", "l")).alias("by")).select("case", "r", "by.root", "by.l")
            mates = pairs.select("case", "r", F.col("l").alias("mate"))
            level = written(reached.join(mates.hint("merge"), ["case", "r"], "left"), "matching-level")
            n, free = level.agg(F.count("*"), F.count_if(F.col("mate").isNull())).first()
            if not n:
                return pairs.select(*(F.col(c).alias(k) for c, k in zip(("case", "l", "r"), names, strict=True)))
            levels.append(level)
            if free:
                ends = level.where("mate IS NULL").groupBy("case", "root").agg(F.min("r").alias("r")).select("case", "r")
            frontier = level.select("case", F.col("mate").alias("l"), "root")
        turned = None
        for level in reversed(levels):
            step = level.join(ends.hint("merge"), ["case", "r"]).select("case", "l", "r")
            turned = step if turned is None else turned.unionAll(step)
            # the right that a left had before is the end of the rest of the way
            ends = step.select("case", "l").join(pairs.hint("merge"), ["case", "l"]).select("case", "r")
        turned = written(turned, "matching-turned")
        pairs = written(pairs.join(turned.select("case", "l").hint("merge"), ["case", "l"], "left_anti").unionByName(turned), "matching")


def first_distinct(df: DataFrame, order: list[str], names: list[str]) -> DataFrame:
    """The rows that a pass in ``order`` takes if it skips each row that shares a value of ``names`` with one taken.

    A round takes every row that is first for all its values, then drops the rows that share a value with one taken;
    rows that lose only to dropped rows come up in a later round, as in the pass. With an order that doesn't depend on
    the values some log n rounds do. ``order`` must be unique. Only order and values travel.
    """
    kinds = [F.struct(F.lit(k).alias("kind"), F.col(c).cast("string").alias("value")) for k, c in enumerate(names)]
    left = written(df.select(F.struct(*order).alias("at"), F.filter(F.array(*kinds), lambda x: x["value"].isNotNull()).alias("links")), "distinct-left")
    taken: list[DataFrame] = []
    while not left.isEmpty():
        links = left.select("at", F.explode("links").alias("link")).select("at", "link.*")
        first = links.groupBy("kind", "value").agg(F.min("at").alias("first"))
        behind = links.join(first, ["kind", "value"]).where(F.col("at") != F.col("first")).select("at").distinct()
        now = written(left.join(behind, "at", "left_anti"), "distinct-taken")
        taken.append(now)
        used = now.select(F.explode("links").alias("link")).select("link.*").distinct()
        barred = links.join(used, ["kind", "value"], "left_semi").select("at").distinct()
        left = written(left.join(now.select("at"), "at", "left_anti").join(barred, "at", "left_anti"), "distinct-left")
    keys = [F.col(f"tw_at.{c}").alias(f"tw_{c}") for c in order]
    if not taken:
        return df.limit(0)
    every = taken[0].select("at")
    for t in taken[1:]:
        every = every.unionAll(t.select("at"))
    every = every.select(F.col("at").alias("tw_at")).select(*keys)
    same = [df[c].eqNullSafe(every[f"tw_{c}"]) for c in order]
    return df.join(every, same, "left_semi")


def one_per_label(df: DataFrame, group: str, labels: list[str], features: str, item: str, order: list[str]) -> DataFrame:
    """(group, label, item, order): for each label in turn the first row with that feature whose item no label before took.

    The labels before one take at most one item each, so only its first ``len(labels)`` items can matter: ranks with a
    limit, cut before the shuffle, leave at most their square a group, and a fold over these makes the choice.
    """
    place = {label: k for k, label in enumerate(labels)}
    rows = df.select(group, F.explode(F.array_distinct(features)).alias("label"), F.col(item).alias("item"), F.struct(*order).alias("at")).where(F.col("label").isin(labels) & F.col("item").isNotNull())
    best = rows.groupBy(group, "label", "item").agg(F.min("at").alias("at"))
    best = best.withColumn("n", F.row_number().over(Window.partitionBy(group, "label").orderBy("at", "item"))).where(F.col("n") <= len(labels))
    turn = F.create_map(*(x for label, k in place.items() for x in (F.lit(label), F.lit(k))))[F.col("label")]
    held = best.groupBy(group).agg(F.array_sort(F.collect_list(F.struct(turn.alias("turn"), "n", "label", "item", "at"))).alias("held"))
    none = F.slice("held", F.lit(1), F.lit(0))

    def take(picks, turn):
        free = F.filter("held", lambda x: (x["turn"] == turn) & ~F.exists(picks, lambda p: p["item"] == x["item"]))
        return F.concat(picks, F.slice(free, 1, 1))

    picks = F.aggregate(F.sequence(F.lit(0), F.lit(len(labels) - 1)), none, take)
    out = held.select(group, F.explode(picks).alias("pick"))
    return out.select(group, "pick.label", F.col("pick.item").alias(item), *(F.col(f"pick.at.{c}").alias(c) for c in order if c != item))


def novelty_portfolio(candidates: DataFrame, accepted: DataFrame, group: str, key: str, forms: str, kind: str, strength: list[str], count: int) -> DataFrame:
    """(group, key, place): the first ``count`` candidates of each group by novelty, then strength, chosen one after another.

    A choice prefers, in this order: more forms that none chosen or accepted has, a set of forms that none has, a kind that
    none has, forms that few have (the sum of 1 / (1 + their number)), the columns of ``strength`` (larger first), the
    smaller key. All but the last two depend on (forms, kind) alone, so of candidates alike in these only the first
    ``count`` by strength can matter: ranks with a limit leave that many a bucket, and each step compares the heads of
    buckets. Null forms are none; a null kind is a kind.
    """
    alike = F.array_join(F.array_sort(F.array_distinct(F.coalesce(F.array_compact(forms), F.array().cast("array<string>")))), "\x1f")
    rows = candidates.select(F.col(group).alias("group"), F.col(key).alias("key"), alike.alias("forms"), F.coalesce(F.col(kind).cast("string"), F.lit("\x00")).alias("kind"), *(F.col(s).cast("double").alias(f"s{k}") for k, s in enumerate(strength)))
    by = Window.partitionBy("group", "forms", "kind").orderBy(*(F.desc_nulls_last(f"s{k}") for k in range(len(strength))), "key")
    heads = rows.withColumn("n", F.row_number().over(by)).where(F.col("n") <= count)
    known = accepted.groupBy(F.col(group).alias("group"), alike.alias("forms"), F.coalesce(F.col(kind).cast("string"), F.lit("\x00")).alias("kind")).agg(F.count("*").alias("n"))

    def choose(key_of_group: tuple, rows: pd.DataFrame, before: pd.DataFrame) -> pd.DataFrame:
        seen: dict = {}

        def count_up(text: str, kind: str, n: int) -> None:
            for name in (*((0, f) for f in text.split("\x1f") if f), (1, text), (2, kind)):
                seen[name] = seen.get(name, 0) + n

        for text, kind, n in zip(before["forms"], before["kind"], before["n"], strict=True):
            count_up(text, kind, n)
        buckets: dict = {}
        for r in rows.sort_values("n").itertuples(index=False):
            buckets.setdefault((r.forms, r.kind), []).append((tuple(getattr(r, f"s{k}") if pd.notna(getattr(r, f"s{k}")) else float("-inf") for k in range(len(strength))), r.key))
        at, chosen = dict.fromkeys(buckets, 0), []

        def novelty(bucket: tuple) -> tuple:
            parts = [f for f in bucket[0].split("\x1f") if f]
            return (sum((0, f) not in seen for f in parts), (1, bucket[0]) not in seen, (2, bucket[1]) not in seen, sum((Fraction(1, 1 + seen.get((0, f), 0)) for f in parts), Fraction(0)))

        while len(chosen) < count and at:
            values = {b: (novelty(b), buckets[b][k][0]) for b, k in at.items()}
            top = max(values.values())
            best = min((b for b in at if values[b] == top), key=lambda b: buckets[b][at[b]][1])
            chosen.append(buckets[best][at[best]][1])
            count_up(*best, 1)
            at[best] += 1
            if at[best] == len(buckets[best]):
                del at[best]
        return pd.DataFrame({"group": [key_of_group[0]] * len(chosen), "key": chosen, "place": range(1, len(chosen) + 1)})

    types = dict(rows.dtypes)
    found = heads.groupBy("group").cogroup(known.groupBy("group")).applyInPandas(choose, f"group {types['group']}, key {types['key']}, place int")
    return found.select(F.col("group").alias(group), F.col("key").alias(key), "place")
