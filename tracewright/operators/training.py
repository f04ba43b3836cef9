"""Training records from trajectories: rewrites of nested values, message building, annotations and partition checks.

Nested values are rewritten in place with higher-order functions over their declared schema; nothing is exploded, so a
row is one task's work and no shuffle is needed. Nulls stay null at every level, empty arrays stay empty, and repeated
rows are rewritten alike. Columns that a function doesn't name are kept.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StringType, StructType

Rewrite = Callable[[Column], Column]


def rewritten(value: Column, kind: DataType, rewrite: Rewrite) -> Column:
    """``value`` with every string in it rewritten, at any depth; names of fields and keys of maps stay."""
    if isinstance(kind, StringType):
        return rewrite(value)
    if isinstance(kind, ArrayType):
        return F.transform(value, lambda x: rewritten(x, kind.elementType, rewrite)) if _holds_text(kind) else value
    if isinstance(kind, MapType):
        return F.transform_values(value, lambda _, x: rewritten(x, kind.valueType, rewrite)) if _holds_text(kind) else value
    if isinstance(kind, StructType) and _holds_text(kind):
        fields = F.struct(*(rewritten(value.getField(f.name), f.dataType, rewrite).alias(f.name) for f in kind.fields))
        return F.when(value.isNotNull(), fields)
    return value


def _holds_text(kind: DataType) -> bool:
    if isinstance(kind, ArrayType):
        return _holds_text(kind.elementType)
    if isinstance(kind, MapType):
        return _holds_text(kind.valueType)
    if isinstance(kind, StructType):
        return any(_holds_text(f.dataType) for f in kind.fields)
    return isinstance(kind, StringType)


def replacing(rules: list[tuple[str, str]]) -> Rewrite:
    """Regular expressions replaced one after the other."""

    def rewrite(text: Column) -> Column:
        for pattern, by in rules:
            text = F.regexp_replace(text, pattern, by)
        return text

    return rewrite


def with_rewritten(df: DataFrame, columns: list[str], rewrite: Rewrite) -> DataFrame:
    return df.withColumns({c: rewritten(F.col(c), df.schema[c].dataType, rewrite) for c in columns})


def without_fields(value: Column, kind: DataType, names: set[str]) -> Column:
    """``value`` without the fields of these names, at any depth."""
    if isinstance(kind, ArrayType):
        return F.transform(value, lambda x: without_fields(x, kind.elementType, names))
    if isinstance(kind, MapType):
        return F.transform_values(value, lambda _, x: without_fields(x, kind.valueType, names))
    if isinstance(kind, StructType):
        kept = [f for f in kind.fields if f.name not in names]
        return F.when(value.isNotNull(), F.struct(*(without_fields(value.getField(f.name), f.dataType, names).alias(f.name) for f in kept)))
    return value


def step_messages(steps: Column) -> Column:
    """An array of messages of an array of steps (text, calls: array of (id, name, arguments, output)).

    A step gives one assistant message, whose empty text is null, and then a tool message for each call, in order.
    """
    none = F.lit(None).cast("string")

    def message(role: str, content: Column, call_id: Column, calls: Column) -> Column:
        return F.struct(F.lit(role).alias("role"), content.alias("content"), call_id.alias("tool_call_id"), calls.alias("tool_calls"))

    def of_step(step: Column) -> Column:
        calls = F.transform(step["calls"], lambda c: F.struct(c["id"].alias("id"), c["name"].alias("name"), F.to_json(c["arguments"]).alias("arguments")))
        said = F.array(message("assistant", F.nullif(step["text"], F.lit("")), none, calls))
        return F.concat(said, F.transform(step["calls"], lambda c: message("tool", c["output"], c["id"], F.when(F.lit(False), calls))))

    return F.flatten(F.transform(steps, of_step))


def call_annotations(steps: Column, kind_of: Callable[[Column], Column]) -> Column:
    """A map from call id to (name, kind, is_error); of calls with one id the first counts."""
    calls = F.flatten(F.transform(steps, lambda s: s["calls"]))
    first = F.filter(calls, lambda c, k: c["id"].isNotNull() & (F.array_position(F.transform(calls, lambda x: x["id"]), c["id"]) == k + 1))
    return F.map_from_entries(F.transform(first, lambda c: F.struct(c["id"], F.struct(c["name"].alias("name"), kind_of(c["name"]).alias("kind"), c["is_error"].alias("is_error")))))


def message_call_ids(messages: Column) -> Column:
    """Distinct call ids of messages: those called and those answered, in order of first appearance."""
    called = F.flatten(F.transform(messages, lambda m: F.coalesce(F.transform(m["tool_calls"], lambda c: c["id"]), F.array())))
    return F.array_compact(F.array_union(called, F.transform(messages, lambda m: m["tool_call_id"])))


def kept_annotations(annotations: Column, ids: Column) -> Column:
    """The annotations whose call is among the ids (semi join)."""
    return F.map_filter(annotations, lambda k, _: F.array_contains(ids, k))


def undefined_tools(called: Column, defined: Column) -> Column:
    """Called tools that no definition covers, sorted and distinct (anti join within the row)."""
    return F.array_sort(F.array_except(called, defined))


def with_task_prompt(df: DataFrame, messages: str, prompt: Column, original: Column) -> DataFrame:
    """User messages that hold the original task get the prompt; adds how many were replaced and whether exactly one
    user message is the prompt then."""
    is_user = lambda m: m["role"] == "user"
    replaced = F.transform(messages, lambda m: m.withField("content", F.when(is_user(m) & (m["content"] == original) & (m["content"] != prompt), prompt).otherwise(m["content"])))
    changes = F.size(F.filter(messages, lambda m: is_user(m) & (m["content"] == original) & (m["content"] != prompt)))
    out = df.withColumn("replacements", changes).withColumn(messages, replaced)
    return out.withColumn("one_prompt", F.size(F.filter(messages, lambda m: is_user(m) & (m["content"] == prompt))) == 1)


def system_root(messages: Column, pattern: str) -> Column:
    """The one distinct match of ``pattern`` (its first group) in the system messages; null where there are none or several."""
    said = F.filter(messages, lambda m: m["role"] == "system")
    found = F.array_distinct(F.flatten(F.transform(said, lambda m: F.regexp_extract_all(F.coalesce(m["content"], F.lit("")), F.lit(pattern), 1))))
    return F.when(F.size(found) == 1, F.get(found, F.lit(0)))


def conversation_issues(messages: Column, defined: Column, open_end: bool = False) -> Column:
    """What is wrong with an array of messages, as a sorted array of names.

    Call ids are used once, by defined tools, and answered once, after the call; there is an assistant message. With
    ``open_end`` the calls of the last message may be unanswered.
    """
    at = F.transform(messages, lambda m, k: F.struct(k.alias("k"), m["role"].alias("role"), m["tool_call_id"].alias("answers"), F.coalesce(F.transform(m["tool_calls"], lambda c: c["id"]), F.array().cast("array<string>")).alias("ids"), F.coalesce(F.transform(m["tool_calls"], lambda c: c["name"]), F.array().cast("array<string>")).alias("names")))
    called = F.flatten(F.transform(at, lambda m: m["ids"]))
    answers = F.transform(F.filter(at, lambda m: m["role"] == "tool"), lambda m: m["answers"])
    must = F.flatten(F.transform(F.filter(at, lambda m: m["k"] < F.size(messages) - 1), lambda m: m["ids"])) if open_end else called
    early = F.exists(at, lambda m: (m["role"] == "tool") & ~F.coalesce(F.array_contains(F.flatten(F.transform(F.slice(at, 1, m["k"]), lambda x: x["ids"])), m["answers"]), F.lit(False)))
    checks = {
        "duplicate call": F.size(called) > F.size(F.array_distinct(called)),
        "duplicate result": F.size(answers) > F.size(F.array_distinct(answers)),
        "no assistant": ~F.exists(at, lambda m: m["role"] == "assistant"),
        "result before call": early,
        "undefined tool": F.size(F.array_except(F.flatten(F.transform(at, lambda m: m["names"])), defined)) > 0,
        "unresolved": F.size(F.array_except(must, answers)) > 0,
    }
    return F.array_compact(F.array(*(F.when(bad, F.lit(name)) for name, bad in checks.items())))


def colliding(values: Column) -> Column:
    """Whether names that were told apart have become equal."""
    return F.size(values) > F.size(F.array_distinct(values))


def partition_issues(assigned: DataFrame, expected: DataFrame, keys: list[str], item: str, order: str) -> DataFrame:
    """Per key whether the windows' items are exactly the expected ones in order: counts and a verdict.

    ``order`` numbers the items within a key on both sides.
    """
    a = assigned.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(order, item))).alias("got"))
    b = expected.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(order, item))).alias("want"))
    items = lambda c: F.transform(F.coalesce(c, F.array().cast(a.schema["got"].dataType)), lambda x: x[item])
    both = a.join(b, keys, "full").select(*keys, items(F.col("got")).alias("got"), items(F.col("want")).alias("want"))
    return both.select(*keys, F.size("got").cast("long").alias("assigned"), F.size("want").cast("long").alias("expected"), F.col("got").eqNullSafe(F.col("want")).alias("partitioned"))


def pointed_requests(compactions: DataFrame, requests: DataFrame, keys: list[str]) -> DataFrame:
    """Compactions (keys, after_line) with the request logged at that line, or the reason why there is none.

    A line is the request's place among the non-blank ones, from 1; the request has to be an agent step of a known id.
    """
    found = compactions.join(requests.select(*keys, F.col("line").alias("after_line"), "kind", "request_id"), [*keys, "after_line"], "left")
    reason = F.when(F.col("kind").isNull(), "no such request").when((F.col("kind") != "agent_step") | F.col("request_id").isNull(), "not an agent step")
    return found.withColumn("reason", reason).withColumn("request_id", F.when(reason.isNull(), F.col("request_id"))).drop("kind")
