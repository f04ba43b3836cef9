"""Server-sent event logs: per file the reasoning and answer texts in order, and the first error in the stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def stream_texts(lines: DataFrame) -> DataFrame:
    """(path, reasoning, answer) of ``data:`` lines, in either of two delta dialects; ``lines``: path, line, value."""
    data = F.trim(F.regexp_extract("value", r"^data:(.*)$", 1))
    pick = lambda *paths: F.coalesce(*(F.get_json_object("_data", p) for p in paths), F.lit(""))
    rows = lines.withColumn("_data", data).where(~F.col("_data").isin("", "[DONE]"))
    rows = rows.select("path", "line", pick("$.choices[0].delta.reasoning_content", "$.delta.thinking").alias("r"), pick("$.choices[0].delta.content", "$.delta.text").alias("a"))
    grouped = rows.groupBy("path").agg(F.array_sort(F.collect_list(F.struct("line", "r", "a"))).alias("_rows"))
    return grouped.select("path", F.array_join("_rows.r", "").alias("reasoning"), F.array_join("_rows.a", "").alias("answer"))


def stream_errors(lines: DataFrame) -> DataFrame:
    """(path, line, error) of each stream's first error; an event name holds until the next blank line."""
    order = Window.partitionBy("path").orderBy("line").rowsBetween(Window.unboundedPreceding, 0)
    blocks = lines.withColumn("_block", F.sum((F.trim("value") == "").cast("int")).over(order))
    inner = Window.partitionBy("path", "_block").orderBy("line").rowsBetween(Window.unboundedPreceding, 0)
    event = F.nullif(F.trim(F.regexp_extract("value", r"^event:(.*)$", 1)), F.lit(""))
    named = blocks.withColumn("_event", F.last(event, ignorenulls=True).over(inner)).withColumn("_data", F.trim(F.regexp_extract("value", r"^data:(.*)$", 1)))
    found = named.where("_data <> '' AND (_event = 'error' OR get_json_object(_data, '$.error') IS NOT NULL)")
    return found.groupBy("path").agg(F.min("line").alias("line"), F.min_by("_data", "line").alias("error"))
