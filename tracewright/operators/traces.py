"""Conversations and event logs: message arrays, integrity, context windows and their audit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .matching import segments

ROLES = ("system", "user", "assistant", "tool")


def messages(turns: DataFrame, conversation: str = "conv_id", order: str = "turn") -> DataFrame:
    """One row a conversation, its messages in order; an empty text becomes null."""
    entry = F.struct(order, "role", F.nullif(F.trim("text"), F.lit("")).alias("text"))
    return turns.groupBy(conversation).agg(F.sort_array(F.collect_list(entry)).alias("messages"))


def conversation_flags(turns: DataFrame, conversation: str = "conv_id", order: str = "turn") -> DataFrame:
    """Per conversation: gapless turns from 0, known roles only, an assistant message, the last role, all in one pass."""
    grouped = turns.groupBy(conversation).agg(
        F.count("*").alias("n"),
        F.count_distinct(order).alias("tw_distinct"),
        F.min(order).alias("tw_first"),
        F.max(order).alias("tw_last"),
        F.count_if(~F.col("role").isin(*ROLES) | F.col("role").isNull()).alias("unknown_roles"),
        F.count_if(F.col("role") == "assistant").alias("n_assistant"),
        F.max(F.struct(order, "role")).alias("tw_end"),
    )
    gapless = (F.col("tw_first") == 0) & (F.col("tw_last") == F.col("n") - 1) & (F.col("tw_distinct") == F.col("n"))
    return grouped.select(conversation, "n", gapless.alias("gapless"), "unknown_roles", "n_assistant", F.col("tw_end.role").alias("last_role"))


def call_issues(messages: DataFrame, conversation: str) -> DataFrame:
    """(conversation, call_id, issue) over rows (conversation, pos, kind 'call'|'result', call_id, tool, defined).

    A call id is used once, by a defined tool, and has one result, after it.
    """
    calls = F.col("kind") == "call"
    grouped = messages.groupBy(conversation, "call_id").agg(
        F.count_if(calls).alias("calls"),
        F.count_if(~calls).alias("results"),
        F.min(F.when(calls, F.col("pos"))).alias("called"),
        F.min(F.when(~calls, F.col("pos"))).alias("answered"),
        F.count_if(calls & ~F.col("defined")).alias("undefined"),
    )
    checks = ((F.col("calls") > 1, "duplicate call"), (F.col("calls") == 0, "result without call"), (F.col("undefined") > 0, "undefined tool"), (F.col("results") == 0, "unresolved"), (F.col("results") > 1, "duplicate result"), (F.col("answered") < F.col("called"), "result before call"))
    issues = F.array_compact(F.array(*(F.when(bad, F.lit(name)) for bad, name in checks)))
    return grouped.select(conversation, "call_id", F.explode(issues).alias("issue"))


def context_windows(turns: DataFrame, boundary: Column, conversation: str = "conv_id", order: str = "turn") -> DataFrame:
    """Adds ``segment``: the part before the first boundary, and one from each boundary on; they cover every turn once."""
    return segments(turns, boundary, conversation, [order])


def window_audit(windows: DataFrame, conversation: str = "conv_id", order: str = "turn") -> DataFrame:
    """Per window: messages, assistant messages, characters, first and last turn, last role."""
    return windows.groupBy(conversation, "segment").agg(
        F.count("*").alias("n_messages"),
        F.count_if(F.col("role") == "assistant").alias("n_assistant"),
        F.coalesce(F.sum(F.length("text")), F.lit(0)).cast("long").alias("n_chars"),
        F.min(order).alias("first_turn"),
        F.max(order).alias("last_turn"),
        F.max_by("role", order).alias("last_role"),
    )


def fold_events(events: DataFrame, run: str, order: list[str], begins: Column) -> DataFrame:
    """Step rows of an event log: the running count of begin events is the step, -1 before the first."""
    stepped = segments(events, begins, run, order).withColumn("step", F.col("segment") - 1)
    return stepped.drop("segment")
