"""Order inside groups, ranks over whole tables, trailing and running frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracewright.session import written


def first_per_group(df: DataFrame, group: list[str], order: list[Column]) -> DataFrame:
    """One row a group, the first in a total order (for the last, give the order reversed)."""
    return top_per_group(df, group, order, 1).drop("place")


def top_per_group(df: DataFrame, group: list[str], order: list[Column], k: int) -> DataFrame:
    return df.withColumn("place", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where(F.col("place") <= k)


def dense_place(df: DataFrame, leading: Column, within: list[Column], name: str = "place") -> DataFrame:
    """Row numbers from 1 over the whole table, by ``leading`` descending and then ``within``.

    A range shuffle on all of these sorts the rows, so neither a value that many rows share nor a table of unique values
    is one task's; what stands before a partition comes from a count each. The sorted rows are written once, as the
    ranges drawn for a second job could differ.
    """
    spark, order = df.sparkSession, [leading.desc_nulls_last(), *within]
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = written(df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("tw_id", F.monotonically_increasing_id()), "ranked")
    part = F.shiftright("tw_id", 33)
    starts, seen = [], 0
    for p, count in sorted((r[0], r[1]) for r in rows.groupBy(part.alias("p")).count().collect()):  # a row per partition
        starts.append((p, seen))
        seen += count
    before = spark.createDataFrame(starts, "tw_part long, tw_before long")
    joined = rows.withColumn("tw_part", part).join(F.broadcast(before), "tw_part")
    return joined.withColumn(name, F.col("tw_before") + F.col("tw_id").bitwiseAND(F.lit((1 << 33) - 1)) + 1).drop("tw_part", "tw_before", "tw_id")


def trailing(within: str, order: list[str], size: int):
    return Window.partitionBy(within).orderBy(*order).rowsBetween(1 - size, 0)


def within_budget(df: DataFrame, within: str, order: list[str], limit: int) -> DataFrame:
    """Adds ``call`` (from 1) and ``allowed``."""
    return df.withColumn("call", F.row_number().over(Window.partitionBy(within).orderBy(*order))).withColumn("allowed", F.col("call") <= limit)


def running_distinct(df: DataFrame, within: str, value: str, order: list[str]) -> DataFrame:
    """Adds how many distinct values the group has shown up to each row: a running sum over first occurrences."""
    seen = F.row_number().over(Window.partitionBy(within, value).orderBy(*order))
    df = df.withColumn("tw_new", (F.col(value).isNotNull() & (seen == 1)).cast("long"))
    return df.withColumn("distinct_so_far", F.sum("tw_new").over(Window.partitionBy(within).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))).drop("tw_new")
