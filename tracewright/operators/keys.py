"""Keys and references between record sets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _all_set(fields: list[str]) -> Column:
    return reduce(Column.__and__, (F.col(f).isNotNull() for f in fields))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def reference_counts(source: DataFrame, fields: list[str], target: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of the source with a whole, a partly null and a null reference, and how many of the whole ones are met.

    Counts are per source row: a target key that occurs twice doesn't count twice.
    """
    per_key = source.groupBy(*fields).agg(F.count("*").alias("tw_n"))
    there = target.select(*(F.col(k).alias(f) for k, f in zip(keys, fields, strict=True))).distinct().withColumn("tw_met", F.lit(True))
    nulls = sum((F.col(f).isNull().cast("int") for f in fields), F.lit(0))
    total = lambda c: F.coalesce(F.sum(F.when(c, F.col("tw_n"))), F.lit(0))
    return per_key.join(there, fields, "left").agg(
        total((nulls == 0) & F.col("tw_met")).alias("matched"),
        total((nulls == 0) & F.col("tw_met").isNull()).alias("missing"),
        total((nulls > 0) & (nulls < len(fields))).alias("partly_null"),
        total(nulls == len(fields)).alias("all_null"),
    )


def missing_references(source: DataFrame, fields: list[str], target: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct whole references without a target row, and how many rows hold each."""
    there = target.select(*(F.col(k).alias(f) for k, f in zip(keys, fields, strict=True)))
    return source.where(_all_set(fields)).groupBy(*fields).agg(F.count("*").alias("n")).join(there, fields, "left_anti")


def key_report(df: DataFrame, label: str, keys: list[str]) -> DataFrame:
    """One row: rows, distinct whole keys, rows with a null in the key, whether the key is unique."""
    per_key = df.groupBy(*keys).agg(F.count("*").alias("tw_n"))
    whole = _all_set(keys)
    sums = per_key.agg(F.coalesce(F.sum("tw_n"), F.lit(0)).alias("n_rows"), F.count_if(whole).alias("distinct_keys"), F.coalesce(F.sum(F.when(~whole, F.col("tw_n"))), F.lit(0)).alias("null_keys"))
    return sums.select(F.lit(label).alias("label"), "*", (F.col("n_rows") == F.col("distinct_keys")).alias("is_key"))
