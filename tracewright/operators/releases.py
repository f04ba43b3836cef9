"""Building and extending releases of training records, with guards that make a bad release an error."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ranking import first_per_group


def merged(parts: list[DataFrame], key: str) -> DataFrame:
    """All records of all parts; an id in two of them is an error when the result is read."""
    rows = reduce(DataFrame.unionByName, parts)
    counts = rows.groupBy(key).agg(F.count("*").alias("tw_n"))
    return rows.join(counts, key).where(F.when(F.col("tw_n") > 1, F.raise_error(F.concat(F.lit("duplicate id "), F.col(key).cast("string")))).otherwise(F.lit(True))).drop("tw_n")


def replaced(base: DataFrame, fresh: DataFrame, key: str) -> DataFrame:
    """The base without the records that fresh ones replace, and the fresh ones."""
    return base.join(fresh.select(key), key, "left_anti").unionByName(fresh)


def appended(base: DataFrame, found: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """The base, and of the found records those with a new key, the first of each in the order."""
    fresh = first_per_group(found.join(base.select(key), key, "left_anti"), [key], order)
    return base.unionByName(fresh)


def split(df: DataFrame, flags: Column) -> tuple[DataFrame, DataFrame]:
    """Records without quality flags, and the others."""
    marked = df.withColumn("tw_flags", flags)
    return marked.where(F.size("tw_flags") == 0).drop("tw_flags"), marked.where(F.size("tw_flags") > 0).withColumnRenamed("tw_flags", "quality_flags")


def preserved(before: DataFrame, after: DataFrame, key: str, digest: str) -> DataFrame:
    """(key, issue) of records of the earlier release that the later one removed or modified; additions are allowed."""
    both = before.select(key, F.col(digest).alias("tw_a")).join(after.select(key, F.col(digest).alias("tw_b"), F.lit(True).alias("tw_there")), key, "left")
    issue = F.when(F.col("tw_there").isNull(), "removed").when(~F.col("tw_a").eqNullSafe(F.col("tw_b")), "modified")
    return both.select(key, issue.alias("issue")).where("issue IS NOT NULL")
