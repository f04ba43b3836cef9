"""Batches of work: preflight, pending targets, cut-offs, attempts, merges and comparisons by key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def preflight(requests: DataFrame, known: DataFrame, key: str, valid: Column) -> DataFrame:
    """(key, n, status) per requested key: missing_id, duplicate, unknown, invalid or ready, the first that holds.

    Requests are counted per key first, so one key with many requests is one row in the join.
    """
    counts = requests.groupBy(key).agg(F.count("*").alias("n"), F.bool_and(F.coalesce(valid, F.lit(False))).alias("tw_valid"))
    there = known.select(key).distinct().withColumn("tw_known", F.lit(True))
    status = F.when(F.col(key).isNull(), "missing_id").when(F.col("n") > 1, "duplicate").when(F.col("tw_known").isNull(), "unknown").when(~F.col("tw_valid"), "invalid").otherwise("ready")
    return counts.join(there, key, "left").select(key, "n", status.alias("status"))


def pending(targets: DataFrame, done: DataFrame, key: str) -> DataFrame:
    return targets.join(done.select(key), key, "left_anti")


def until_target(rows: DataFrame, within: str, order: list[str], accepted: Column, target: int) -> DataFrame:
    """The rows of each group up to the one that reaches the target, with the running count."""
    frame = Window.partitionBy(within).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    counted = rows.withColumn("tw_hit", accepted.cast("long")).withColumn("accepted_so_far", F.sum("tw_hit").over(frame))
    return counted.where(F.col("accepted_so_far") - F.col("tw_hit") < target).drop("tw_hit")


def attempts(runs: DataFrame, slot: list[str], order: list[str], seconds: str) -> DataFrame:
    """Per slot the number of attempts, their cumulative time and the latest one."""
    last = F.struct(*order)
    return runs.groupBy(*slot).agg(F.count("*").alias("attempts"), F.sum(seconds).alias("total"), F.max(last).alias("tw_last")).select(*slot, "attempts", "total", F.col(f"tw_last.{order[-1]}").alias("latest"))


def first_known(rows: DataFrame, key: Column, order: str, fields: list[str]) -> DataFrame:
    """Rows of one key merged: each field's first non-null value in the order, and how many rows there were."""
    pick = [F.min_by(F.col(f), F.when(F.col(f).isNotNull(), F.col(order))).alias(f) for f in fields]
    return rows.groupBy(key.alias("key")).agg(*pick, F.count("*").alias("n"))


def differing_fields(local: DataFrame, remote: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """(key, fields) of keys on both sides whose values differ."""
    a = local.select(key, F.struct(*fields).alias("tw_l"))
    b = remote.select(key, F.struct(*fields).alias("tw_r"))
    names = F.array_compact(F.array(*(F.when(~F.col(f"tw_l.{f}").eqNullSafe(F.col(f"tw_r.{f}")), F.lit(f)) for f in fields)))
    return a.join(b, key).select(key, names.alias("fields")).where("size(fields) > 0")


def one_sided(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """(key, side) of keys that only one side has."""
    a = left.select(key).distinct().withColumn("tw_a", F.lit(1))
    b = right.select(key).distinct().withColumn("tw_b", F.lit(1))
    both = a.join(b, key, "full")
    return both.where("tw_a IS NULL OR tw_b IS NULL").select(key, F.when(F.col("tw_a").isNull(), "right").otherwise("left").alias("side"))


def mentions(docs: DataFrame, key: str, text: str, names: DataFrame, name: str) -> DataFrame:
    """(key, name, n): how often each name stands in a text as a whole word, by a join on words.

    Words are counted per document first, so a frequent word is one row a document.
    """
    words = docs.select(key, F.explode(F.regexp_extract_all(F.lower(text), F.lit("([a-z0-9]+)"), 1)).alias(name))
    counts = words.groupBy(key, name).agg(F.count("*").alias("n"))
    return counts.join(names.select(F.lower(name).alias(name)).distinct(), name)
