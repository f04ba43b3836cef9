"""Differences between versions of record sets and file lists, and digests of whole tables.

Null keys are equal to each other, and a row that is there with null fields is there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracewright.operators.nullsafe import sides


def row_text(df: DataFrame, columns: list[str] | None = None) -> Column:
    """A row as one string, with nulls told from empty strings."""
    return F.concat_ws("\x1f", *(F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in columns or df.columns))


def row_changes(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, change): inserted, updated or deleted, by a hash of the other fields."""
    rest = [c for c in before.columns if c not in keys]
    hashed = lambda df: df.select(*keys, F.sha2(row_text(df, rest), 256).alias("tw_row"))
    both = sides(hashed(before), hashed(after), keys)
    change = F.when(~F.col("tw_in_a"), "inserted").when(~F.col("tw_in_b"), "deleted").when(F.col("tw_a.tw_row") != F.col("tw_b.tw_row"), "updated")
    return both.withColumn("change", change).where("change IS NOT NULL").select(*keys, "change")


def field_changes(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, change, changed_fields): as ``row_changes``, with the names of the fields that differ."""
    rest = [c for c in before.columns if c not in keys]
    both = sides(before.select(*keys, *rest), after.select(*keys, *rest), keys)
    fields = F.array_compact(F.array(*(F.when(~F.col(f"tw_a.{c}").eqNullSafe(F.col(f"tw_b.{c}")), F.lit(c)) for c in rest)))
    change = F.when(~F.col("tw_in_a"), "inserted").when(~F.col("tw_in_b"), "deleted").when(F.size(fields) > 0, "updated")
    both = both.withColumns({"change": change, "changed_fields": F.when(change == "updated", fields).otherwise(F.array().cast("array<string>"))})
    return both.where("change IS NOT NULL").select(*keys, "change", "changed_fields")


def keyless_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """Whole rows whose multiplicity differs: (columns, n_before, n_after)."""
    columns = before.columns
    a = before.groupBy(*columns).agg(F.count("*").alias("n_before"), F.lit(0).cast("long").alias("n_after"))
    b = after.groupBy(*columns).agg(F.lit(0).cast("long").alias("n_before"), F.count("*").alias("n_after"))
    return a.unionByName(b).groupBy(*columns).agg(F.sum("n_before").alias("n_before"), F.sum("n_after").alias("n_after")).where("n_before <> n_after")


def path_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """(path, change) of two lists (path, sha256): created, modified or deleted."""
    both = sides(before.select("path", "sha256"), after.select("path", "sha256"), ["path"])
    change = F.when(~F.col("tw_in_a"), "created").when(~F.col("tw_in_b"), "deleted").when(~F.col("tw_a.sha256").eqNullSafe(F.col("tw_b.sha256")), "modified")
    return both.select("path", change.alias("change")).where("change IS NOT NULL")


def table_digest(df: DataFrame) -> DataFrame:
    """One row (n, digest) that any order of the same rows gives: the sum of 60-bit row hashes, so no task sees all rows."""
    value = F.conv(F.substring(F.md5(row_text(df).cast("binary")), 1, 15), 16, 10).cast("decimal(38,0)")
    return df.agg(F.count("*").alias("n"), F.coalesce(F.sum(value), F.lit(0)).cast("string").alias("digest"))


def ordinal(df: DataFrame, columns: list[str], name: str = "ordinal") -> DataFrame:
    """Numbers identical rows from 1."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*columns).orderBy(*columns)))
