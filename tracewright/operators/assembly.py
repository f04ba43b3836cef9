"""Training records from trajectories, the requests behind them and delivered environments: the whole way in one plan.

Cleaning and assembly are Columns over a row's nested values; the only shuffles are the joins on the trajectory and on the
environment. A trajectory is one row, and its steps fit in it. Null steps or messages are empty; a trajectory without a
request, or whose environment was not delivered with just its tools, gives no record, and ``unassembled`` tells why; with
several requests or deliveries the first in the order named counts. Equal rows give equal records.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewright.operators import training

WORKSPACE = "/workspace"


def first_rows(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The first row of each key, by an aggregate that keeps one row a key before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.col(order)).alias("tw_row")).select(*keys, "tw_row.*")


def _without(value: Column, root: Column) -> Column:
    return F.when(root.isNull(), value).otherwise(F.replace(value, root, F.lit(WORKSPACE)))


def _occurrences(df: DataFrame, columns: list[str], root: Column) -> Column:
    """How often the root stands in the values of the columns, in their JSON."""
    text = F.concat_ws("\n", *(F.to_json(c) for c in columns))
    return F.when(root.isNull(), 0).otherwise(F.floor((F.length(text) - F.length(F.replace(text, root, F.lit("")))) / F.length(root))).cast("long")


def cleaned(df: DataFrame, steps: str, messages: str, root: Column, names: Column, audit: set[str]) -> DataFrame:
    """Trajectories with portable paths, canonical tool names and no audit fields; adds ``scrubbed``, a map of counts.

    ``root``: the directory that strings anywhere in steps and messages name instead of the workspace, null for none;
    ``names``: a map from observed to canonical tool names.
    """
    rows = df.withColumn("tw_root", root).withColumn("tw_names", F.coalesce(names, F.create_map().cast("map<string,string>")))
    calls = F.flatten(F.transform(F.coalesce(steps, F.slice(steps, 1, 0)), lambda s: s["calls"]))
    renamed = F.size(F.filter(calls, lambda c: F.coalesce(F.try_element_at("tw_names", c["name"]) != c["name"], F.lit(False))))
    counts = F.create_map(F.lit("paths"), _occurrences(rows, [steps, messages], F.col("tw_root")), F.lit("names"), F.coalesce(renamed, F.lit(0)).cast("long"))
    rows = rows.withColumn("scrubbed", F.map_filter(counts, lambda _, n: n > 0))
    portable = training.with_rewritten(rows, [steps, messages], lambda text: _without(text, F.col("tw_root")))
    named = F.transform(steps, lambda s: s.withField("calls", F.transform(s["calls"], lambda c: c.withField("name", F.coalesce(F.try_element_at("tw_names", c["name"]), c["name"])))))
    portable = portable.withColumn(steps, named)
    return portable.withColumn(steps, training.without_fields(F.col(steps), portable.schema[steps].dataType, audit)).drop("tw_root", "tw_names")


def joined(trajectories: DataFrame, requests: DataFrame, deliveries: DataFrame, key: str, environment: str) -> DataFrame:
    """Trajectories (key, environment, tools, ...) with the first request (key, line, messages, defined) and the first
    delivery (environment, path, delivered) whose tools are the expected ones; ``reason`` tells what is missing."""
    first = first_rows(requests.where("line IS NOT NULL"), [key], "line").drop("line")
    rows = trajectories.join(first.withColumn("tw_request", F.lit(True)), key, "left").withColumn("tw_tools", F.array_sort(F.array_distinct("tools")))
    found = first_rows(deliveries.withColumn("tw_tools", F.array_sort(F.array_distinct("delivered"))).select(environment, "tw_tools", "path"), [environment, "tw_tools"], "path")
    rows = rows.join(found, [environment, "tw_tools"], "left")
    reason = F.when(F.col("tw_request").isNull(), "no request").when(F.col("path").isNull(), "no delivery with these tools")
    return rows.withColumn("reason", reason).drop("tw_request", "tw_tools")


def unassembled(rows: DataFrame, key: str) -> DataFrame:
    return rows.where("reason IS NOT NULL").select(key, "reason")


def base_records(rows: DataFrame, key: str, steps: str, messages: str, prompt: Column, original: Column, kind_of: Callable[[Column], Column], audit: set[str], root_pattern: str, names: Column) -> DataFrame:
    """A record per assembled trajectory: messages with the prompt in place of the task, the steps' messages after them,
    annotations of calls, flags of undefined tools, issues, counts of replacements and digests of source and result."""
    whole = rows.where("reason IS NULL").withColumn("source_sha256", F.sha2(F.to_json(F.struct(steps, messages)), 256))
    clean = cleaned(whole, steps, messages, training.system_root(F.col(messages), root_pattern), names, audit)
    asked = training.with_task_prompt(clean.withColumns({"tw_prompt": prompt, "tw_original": original}), messages, F.col("tw_prompt"), F.col("tw_original"))
    initial = F.transform(messages, lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content"), F.lit(None).cast("string").alias("tool_call_id"), F.lit(None).cast("array<struct<id:string,name:string,arguments:string>>").alias("tool_calls")))
    full = asked.withColumns({"messages_out": F.concat(initial, training.step_messages(F.col(steps))), "annotations": training.call_annotations(F.col(steps), kind_of)})
    called = F.transform(F.flatten(F.transform(steps, lambda s: s["calls"])), lambda c: c["name"])
    flags = F.transform(training.undefined_tools(called, F.col("defined")), lambda n: F.concat(F.lit("undefined:"), n))
    return full.select(key, "path", F.col("messages_out").alias("messages"), "annotations", flags.alias("flags"), training.conversation_issues(F.col("messages_out"), F.col("defined")).alias("issues"), "one_prompt", "scrubbed", "source_sha256", F.sha2(F.to_json(F.struct("messages_out", "annotations")), 256).alias("record_sha256"), F.col(steps).alias("steps"), F.col("defined"))


def continuation_records(base: DataFrame, windows: DataFrame, key: str) -> DataFrame:
    """A record per window (key, window, first, n, summary) of a base record: the summary as a user message, the messages of
    steps ``first`` to ``first + n - 1`` (from 0), and the annotations of the calls in them."""
    rows = base.select(key, "steps", "annotations", "defined", "record_sha256").join(windows, key)
    said = F.struct(F.lit("user").alias("role"), F.col("summary").alias("content"), F.lit(None).cast("string").alias("tool_call_id"), F.lit(None).cast("array<struct<id:string,name:string,arguments:string>>").alias("tool_calls"))
    messages = F.concat(F.array(said), training.step_messages(F.slice("steps", F.col("first") + 1, F.col("n"))))
    rows = rows.withColumn("messages", messages).withColumn("annotations", training.kept_annotations(F.col("annotations"), training.message_call_ids(F.col("messages"))))
    open_end = F.col("first") + F.col("n") < F.size("steps")
    issues = F.when(open_end, training.conversation_issues(F.col("messages"), F.col("defined"), True)).otherwise(training.conversation_issues(F.col("messages"), F.col("defined")))
    return rows.select(key, "window", "messages", "annotations", issues.alias("issues"), F.col("record_sha256").alias("parent_sha256"))
