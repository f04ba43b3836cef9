"""Joins beyond equality: multiset, positional, set-equal, prefix, pattern, interval and as-of."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def multiset_match(calls: DataFrame, records: DataFrame, on: list[str], call_order: str, record_order: str) -> DataFrame:
    """Every call takes the first record of the same values that no earlier call took; unmatched calls have a null."""
    a = calls.withColumn("tw_turn", F.row_number().over(Window.partitionBy(*on).orderBy(call_order)))
    b = records.select(*on, F.col(record_order).alias("matched"), F.row_number().over(Window.partitionBy(*on).orderBy(record_order)).alias("tw_turn"))
    return a.join(b, [*on, "tw_turn"], "left").drop("tw_turn")


def multiset_excess(part: DataFrame, whole: DataFrame) -> DataFrame:
    """Rows of ``part`` beyond those of ``whole``, with how many; empty if it is contained."""
    columns = part.columns
    a = part.withColumn("tw_n", F.lit(1))
    b = whole.select(columns).withColumn("tw_n", F.lit(-1))
    return a.unionByName(b).groupBy(*columns).agg(F.sum("tw_n").alias("excess")).where("excess > 0")


def positional_join(left: DataFrame, right: DataFrame, within: str, left_order: str, right_order: str) -> DataFrame:
    """(within, place, left_id, right_id): the k-th of each side inside a group; a missing partner is null."""
    a = left.select(within, F.col(left_order).alias("left_id"), F.row_number().over(Window.partitionBy(within).orderBy(left_order)).alias("place"))
    b = right.select(within, F.col(right_order).alias("right_id"), F.row_number().over(Window.partitionBy(within).orderBy(right_order)).alias("place"))
    return a.join(b, [within, "place"], "full")


def member_sets(df: DataFrame, group: str, member: str) -> DataFrame:
    return df.groupBy(group).agg(F.sort_array(F.collect_set(member)).alias("members"))


def set_equality_join(left: DataFrame, right: DataFrame, group: str, member: str) -> DataFrame:
    """(left_group, right_group) whose distinct members are the same."""
    a = member_sets(left, group, member).select(F.col(group).alias("left_group"), "members")
    b = member_sets(right, group, member).select(F.col(group).alias("right_group"), "members")
    return a.join(b, "members").select("left_group", "right_group")


def prefix_aliases(names: DataFrame, column: str, length: int) -> DataFrame:
    """(alias, name) where only one name starts with the alias, the first ``length`` characters."""
    grouped = names.select(F.col(column).alias("name")).distinct().groupBy(F.substring("name", 1, length).alias("alias"))
    return grouped.agg(F.count("*").alias("tw_n"), F.min("name").alias("name")).where("tw_n = 1").drop("tw_n")


def most_specific_rule(df: DataFrame, column: str, rules: list[tuple[str, str]]) -> Column:
    """The name of the matching rule with the longest literal part; ``rules``: (name, glob with * and ?)."""
    found = None
    for name, glob in sorted(rules, key=lambda r: (-len(r[1].replace("*", "").replace("?", "")), r[0])):
        pattern = "^" + "".join({"*": ".*", "?": "."}.get(c, c if c.isalnum() else "\\" + c) for c in glob) + "$"
        hit = F.col(column).rlike(pattern)
        found = F.when(hit, name) if found is None else found.when(hit, name)
    return found


def segments(df: DataFrame, boundary: Column, within: str, order: list[str]) -> DataFrame:
    """Adds ``segment``: 0 before a group's first boundary row, then one more from each boundary row on."""
    frame = Window.partitionBy(within).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("segment", F.coalesce(F.sum(boundary.cast("int")).over(frame), F.lit(0)))


def next_of_kind(df: DataFrame, kind: Column, value: str, within: str, order: list[str], name: str) -> DataFrame:
    """Adds the value of the first later row of a kind inside the group (a forward as-of join)."""
    frame = Window.partitionBy(within).orderBy(*order).rowsBetween(1, Window.unboundedFollowing)
    return df.withColumn(name, F.first(F.when(kind, F.col(value)), ignorenulls=True).over(frame))
