"""Lines of text files with their physical numbers, and JSON objects from them.

Files are read by Spark's text source in byte ranges, so one file is as many tasks as it has ranges, and none is held
whole. A range doesn't know how many lines stand before it: each range's lines are counted, the counts of a file are
summed up in the order of ranges, and a line's number is its place in its range plus that sum. Only the counts, a row a
range, are shuffled and sorted by file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _ranges(spark: SparkSession, path: str, glob: str) -> DataFrame:
    """(path, at, id, value): ``at`` is the byte at which the range begins, ``id`` ascends within a range."""
    lines = spark.read.option("lineSep", "\n").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").text(path)
    return lines.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("at"), F.monotonically_increasing_id().alias("id"), "value")


def numbered_lines(spark: SparkSession, path: str, glob: str = "*.jsonl") -> DataFrame:
    """(path, line, value); lines end in \\n or \\r\\n, blank ones count, and what follows the last end is a line if it
    isn't empty. Any store that Spark reads will do; files must not change while they are read, as they are scanned
    twice. An empty file or folder gives no rows."""
    counts = _ranges(spark, path, glob).groupBy("path", "at").agg(F.min("id").alias("first"), F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("path").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select(F.col("path").alias("_path"), F.col("at").alias("_at"), (before - F.col("first") + 1).alias("_shift"))
    rows = _ranges(spark, path, glob)
    joined = rows.join(starts, (F.col("path") == F.col("_path")) & (F.col("at") == F.col("_at")))
    return joined.select("path", (F.col("id") + F.col("_shift")).alias("line"), F.regexp_replace("value", "\r$", "").alias("value"))


def lines_in_ranges(spark: SparkSession, path: str, glob: str = "*.jsonl") -> DataFrame:
    """(path, ranges, lines) of each file: how many tasks share it."""
    return _ranges(spark, path, glob).groupBy("path").agg(F.count_distinct("at").alias("ranges"), F.count("*").alias("lines"))


def is_object(value: Column) -> Column:
    return F.trim(value).startswith("{") & F.try_parse_json(value).isNotNull()


def strict_objects(lines: DataFrame, schema: T.StructType | str) -> DataFrame:
    """(path, line, fields): blank lines are skipped; a line that is no object is an error naming it."""
    rows = lines.where(F.trim("value") != "")
    checked = F.when(is_object(F.col("value")), F.col("value")).otherwise(F.raise_error(F.concat(F.lit("no JSON object at "), F.col("path"), F.lit(":"), F.col("line").cast("string"))))
    return rows.select("path", "line", F.from_json(checked, schema).alias("_row")).select("path", "line", "_row.*")


def lenient_objects(lines: DataFrame, schema: T.StructType | str) -> DataFrame:
    """As ``strict_objects``, but other lines are dropped."""
    return lines.where(is_object(F.col("value"))).select("path", "line", F.from_json("value", schema).alias("_row")).select("path", "line", "_row.*")


def paired(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Rows of two scans by line; a missing partner or another key is an error when the result is read."""
    a = left.select("line", F.struct(*[c for c in left.columns if c not in ("path", "line")]).alias("left"))
    b = right.select("line", F.struct(*[c for c in right.columns if c not in ("path", "line")]).alias("right"))
    same = F.col(f"left.{key}").eqNullSafe(F.col(f"right.{key}")) & F.col("left").isNotNull() & F.col("right").isNotNull()
    checked = F.when(same, F.lit(True)).otherwise(F.raise_error(F.concat(F.lit("no pair at line "), F.col("line").cast("string"))))
    return a.join(b, "line", "full").where(checked)
